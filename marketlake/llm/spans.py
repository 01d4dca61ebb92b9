"""Repeated passages by sliding sentence spans.

A sentence ends at a full stop, question or exclamation mark, comma, semicolon or colon before
white space, or at a line end. What is then longer than 8 words is divided further, behind every word that
has the least hash of some 8 words in a row; so equal passages are divided alike wherever they stand, and
no sentence has more than 8 words. At every sentence a span begins: that one and the next ones,
three at least, until they hold 12 words.

A passage may begin and end inside sentences that are divided by words outside: only its first and last 8
words. From the first end of a sentence behind them, the 16th word at the latest, three sentences of at
most 8 words, or as many as hold 12, take 24 words; so any 50 words hold a span that is found wherever they stand.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import durable
from .arrow import add_columns, blocks, utf8
from .shingles import IS_WORD, _odd, mix, powers, words_of
from .sieve import frequent_filter

RUN, WORDS, LONG = 3, 12, 8
HASHES = 1 << 21  # hashes added up before they leave a task
ENDS = np.zeros(256, bool)
ENDS[np.frombuffer(b".!?,;:", np.uint8)] = True
FACTOR = int(_odd(1, 11)[0])
INVERSE = pow(FACTOR, -1, 1 << 64)


def _geometric(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def least_of_window(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which words have the least hash of some 8 words in a row of one text (ties: the last). Two
    such words are at most 8 apart, and whether a word is one depends on the 7 words at each side
    alone. ``first`` has the first word of each text, and the end."""
    chosen = np.zeros(len(words), bool)
    if len(words) >= LONG:
        view = np.lib.stride_tricks.sliding_window_view(words, LONG)
        text = np.searchsorted(first, np.arange(len(words)), "right")
        own = np.flatnonzero(text[: len(view)] == text[LONG - 1 :])
        chosen[own + LONG - 1 - view[own, ::-1].argmin(axis=1)] = True
    return chosen


def sentences(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a block of texts: a hash and the words of every sentence, the first sentence of each
    text (and the end), and the byte at which each sentence begins."""
    words, first, begins, ends = words_of(data, at)
    n = len(words)
    if not n:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, np.zeros(len(at), np.int64), none
    last = ENDS[data[ends - 1]]
    lines = np.concatenate([[0], np.cumsum(data == 10)])
    last |= lines[np.append(begins[1:], len(data))] > lines[ends]
    closes = first[1:] - 1
    last[closes[closes >= 0]] = True
    last[-1] = True
    size = np.diff(np.concatenate([[-1], np.flatnonzero(last)]))
    last |= np.repeat(size > LONG, size) & least_of_window(words, first)
    stops = np.flatnonzero(last)
    starts = np.concatenate([[0], stops[:-1] + 1])
    size = stops + 1 - starts
    place = np.arange(n) - np.repeat(starts, size)
    hashes = mix(np.add.reduceat(words * powers(int(size.max()))[place], starts) + size.astype(np.uint64))
    return hashes, size, np.searchsorted(starts, first), begins[starts]


def spans(hashes: np.ndarray, size: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of a block: their hash, first sentence and the one after the last."""
    n = len(hashes)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    total = np.concatenate([[0], np.cumsum(size)])
    begin = np.arange(n)
    stop = np.maximum(begin + RUN, np.searchsorted(total, total[:-1] + WORDS))
    limit = np.repeat(first[1:], np.diff(first))
    whole = stop <= limit
    begin, stop = begin[whole], stop[whole]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * _geometric(FACTOR, n))])
    value = (sums[stop] - sums[begin]) * _geometric(INVERSE, n)[begin]
    return mix(value + (stop - begin).astype(np.uint64)), begin, stop


def _hash_counts(df: DataFrame, text: str) -> DataFrame:
    """hash and n of the spans of all texts, added up inside tasks."""

    def run(batches):
        held, amount = [], 0

        def told() -> pa.RecordBatch:
            value, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(n.astype(np.int64))], ["hash", "n"])

        for batch in batches:
            data, at = utf8(batch.column(0))
            for a, b in blocks(at):
                hashes, size, first, _ = sentences(data[at[a] : at[b]], at[a : b + 1] - at[a])
                held.append(spans(hashes, size, first)[0])
                amount += len(held[-1])
            if amount > HASHES:
                yield told()
                held, amount = [], 0
        if amount:
            yield told()

    return df.select(text).mapInArrow(run, "hash long, n long")


def _spans_of(df: DataFrame, id: str, text: str, passes) -> DataFrame:
    """hash, doc, mark, i and j of the spans of all texts whose hash passes a broadcast filter."""
    kind = dict(df.dtypes)[id]
    own = df.select(F.col(id).alias("doc"), F.xxhash64(text).alias("mark"), F.col(text).alias("body"))

    def run(batches):
        for batch in batches:
            data, at = utf8(batch.column("body"))
            for a, b in blocks(at):
                here, places = data[at[a] : at[b]], at[a : b + 1] - at[a]
                hashes, size, first, _ = sentences(here, places)
                value, i, j = spans(hashes, size, first)
                able = passes.value(value) if len(value) else np.zeros(0, bool)
                if able.any():
                    value, i, j = value[able], i[able], j[able]
                    row = np.searchsorted(first, i, "right") - 1
                    rows = pa.array(row + a)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(value.view(np.int64)),
                            batch.column("doc").take(rows),
                            batch.column("mark").take(rows),
                            pa.array((i - first[row]).astype(np.int32)),
                            pa.array((j - first[row]).astype(np.int32)),
                        ],
                        ["hash", "doc", "mark", "i", "j"],
                    )

    return own.mapInArrow(run, f"hash long, doc {kind}, mark long, i int, j int")


def without_repeats(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with ``text`` less all sentences that a repeated span covers, but for the span's
    first place, and with ``removed`` (``start:stop`` in code points of the old text, joined by
    commas), ``n_sentences`` and ``n_removed``.

    First is the smallest id, then the place in the text; letters A-Z count as a-z. Spans of the
    same text count as well. Rows with the same id and text are one document and are treated
    alike. Null texts stay null, texts with less than three sentences or 12 words stay whole; null
    ids come first. Columns of ``df`` called like the three results are replaced.

    Hashes are counted first, added up inside the tasks. Spans are then made a second time, and only
    those whose hash may be repeated leave their task (a filter of at most 8 MB); both joins
    let Spark split the most frequent hash. What is gathered for a document is at most its own
    sentences.
    """
    counts = _hash_counts(df, text).groupBy("hash").agg(F.sum("n").alias("n"))
    # Written, so that the joins shuffle both sides anew: only then Spark may split a frequent hash.
    often = durable(counts.where("n > 1").select("hash"))
    passes = df.sparkSession.sparkContext.broadcast(frequent_filter(often))
    repeated = durable(durable(_spans_of(df, id, text, passes)).join(often, "hash"))
    order = F.struct("doc", "mark", "i")
    firsts = durable(repeated.groupBy("hash").agg(F.min(order).alias("least")))
    later = repeated.join(firsts, "hash").where(~order.eqNullSafe(F.col("least")))
    cut = later.groupBy("doc", "mark").agg(F.collect_set(F.struct("i", "j")).alias("_cut"))
    # helper columns whose names no column of df has
    free = max(len(c) for c in df.columns) * "_"
    doc, of, cuts_of, mark = (free + x for x in ("doc", "of", "cut", "mark"))
    cut = cut.select(F.col("doc").alias(doc), F.col("mark").alias(of), F.col("_cut").alias(cuts_of))
    marked = df.withColumn(mark, F.xxhash64(text))
    joined = marked.join(cut, marked[id].eqNullSafe(cut[doc]) & (marked[mark] == cut[of]), "left")
    kind = dict(df.dtypes)[text]

    def clean(batch: pa.RecordBatch) -> list[pa.Array]:
        column = batch.column(text)
        data, at = utf8(column)
        cuts = batch.column(cuts_of).to_pylist()
        texts, told, counts, gone = column.to_pylist(), [], [], []
        for a, b in blocks(at):
            here, places = data[at[a] : at[b]], at[a : b + 1] - at[a]
            _, _, first, begins = sentences(here, places)
            for k in range(b - a):
                n = int(first[k + 1] - first[k])
                counts.append(n)
                if not cuts[a + k]:
                    told.append("")
                    gone.append(0)
                    continue
                drop = np.zeros(n + 1, np.int64)
                for x in cuts[a + k]:
                    drop[x["i"]] += 1
                    drop[x["j"]] -= 1
                drop = np.cumsum(drop)[:n] > 0
                gone.append(int(drop.sum()))
                old = here[places[k] : places[k + 1]]
                edges = np.append(begins[first[k] : first[k + 1]] - places[k], len(old))
                change = np.flatnonzero(np.diff(np.concatenate([[0], drop.astype(np.int8), [0]])))
                points = np.concatenate([[0], np.cumsum((old & 0xC0) != 0x80)])
                parts, out, end = [], [], 0
                for x, y in zip(edges[change[::2]], edges[change[1::2]], strict=True):
                    stop = int(y)
                    while stop > x and not IS_WORD[old[stop - 1]]:
                        stop -= 1  # the white space behind belongs to no sentence
                    parts.append(f"{points[x]}:{points[stop]}")
                    out.append(old[end:x].tobytes())
                    end = int(y)
                out.append(old[end:].tobytes())
                told.append(",".join(parts))
                texts[a + k] = b"".join(out).decode("utf-8", "replace").rstrip(" \t\n\x0b\f\r")
        return [
            pa.array(texts, column.type),
            pa.array(told, pa.string()),
            pa.array(counts, pa.int64()),
            pa.array(gone, pa.int64()),
        ]

    return add_columns(
        joined,
        f"`{text}` {kind}, removed string, n_sentences long, n_removed long",
        clean,
        drop=(mark, doc, of, cuts_of),
    )
