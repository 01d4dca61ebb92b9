"""Secrets: fixed shapes, and two character Markov models that tell random strings from names."""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import add_columns, blocks, runs, utf8

# The base shapes, in the order in which kinds are listed.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
KINDS = ("assign", "access", "hex", "random")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24
KEYS = (b"passw", b"secret", b"token", b"api")

ALPHABET = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CODES = len(ALPHABET) + 1  # 0 is any other byte
CODE = np.zeros(256, np.int32)
CODE[np.frombuffer(ALPHABET, np.uint8)] = np.arange(1, CODES)
IS_HEX = np.zeros(256, bool)
IS_HEX[np.frombuffer(b"0123456789abcdef", np.uint8)] = True
IS_DIGIT = np.zeros(256, bool)
IS_DIGIT[np.frombuffer(b"0123456789", np.uint8)] = True
IS_LETTER = (CODE > 0) & (CODE <= 52)

MIN_LENGTH = 16
MIN_RATIO = 1.0  # nats a character by which the random model must win

SPANS = "array<struct<kind:string,start:long,stop:long>>"
Span = tuple[int, int, int]  # start and end in bytes of the text, place of the kind


def base_spans(data: np.ndarray, at: np.ndarray) -> list[list[Span]]:
    """The base shapes in each text, in bytes, ordered by start and kind."""
    found: list[list[Span]] = [[] for _ in range(len(at) - 1)]
    whole = data.tobytes()
    lower = whole.lower()
    for key in KEYS:
        place = lower.find(key)
        while place >= 0:  # on to the next text that holds the key
            row = int(np.searchsorted(at, place, "right")) - 1
            if not found[row] or found[row][0] != (-1, -1, 0):
                found[row].insert(0, (-1, -1, 0))  # marked
            place = lower.find(key, int(at[row + 1]))
    for row, spans in enumerate(found):
        if spans:
            text = whole[at[row] : at[row + 1]].decode("utf-8", "replace")
            spans.clear()
            begin = seen = 0  # bytes and code points before the match
            for m in ASSIGN.finditer(text):
                if len(m[2]) >= MIN_ASSIGN:
                    begin += len(text[seen : m.start()].encode())
                    seen = m.start()
                    spans.append((begin, begin + len(m[0].encode()), 0))
    place = whole.find(b"AKIA")
    while place >= 0:
        row = int(np.searchsorted(at, place, "right")) - 1
        m = ACCESS.match(whole, place, int(at[row + 1]))
        end = m.end() if m else place + 1  # the end of a text may stand inside these four bytes
        if m and m.end() - m.start() >= MIN_ACCESS:
            found[row].append((place - int(at[row]), end - int(at[row]), 1))
        place = whole.find(b"AKIA", end)
    begins, ends = runs(IS_HEX[data], at)
    for i in np.flatnonzero(ends - begins >= MIN_HEX):
        row = int(np.searchsorted(at, begins[i], "right")) - 1
        found[row].append((int(begins[i] - at[row]), int(ends[i] - at[row]), 2))
    for spans in found:
        spans.sort(key=lambda s: (s[0], s[2]))
    return found


def _pairs(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each byte the number of its pair with the next one, -1 where either is no token
    character or the text ends between them."""
    code = CODE[data]
    pair = np.full(len(data), -1, np.int32)
    if len(data) > 1:
        both = (code[:-1] > 0) & (code[1:] > 0)
        pair[:-1][both] = (code[:-1] * CODES + code[1:])[both]
        cut = at[1:-1] - 1
        pair[cut[cut >= 0]] = -1
    return pair


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs inside random and inside ordinary strings, summed over the task."""
    sums = np.zeros((2, CODES * CODES), np.int64)
    for batch in batches:
        data, at = utf8(batch.column(0))
        for first, last in blocks(at):
            here, places = data[at[first] : at[last]], at[first : last + 1] - at[first]
            pair = _pairs(here, places)
            random = np.zeros(len(here), bool)
            for row, spans in enumerate(base_spans(here, places)):
                for begin, end, _ in spans:
                    begin, end = int(places[row]) + begin, int(places[row]) + end
                    inside = IS_DIGIT[here[begin:end]]
                    if end - begin >= MIN_LENGTH and inside.any():
                        # of an assignment only the value, which holds the last token character
                        tail = np.flatnonzero(CODE[here[begin:end]] == 0)
                        random[begin + (int(tail[-1]) + 1 if len(tail) else 0) : end - 1] = True
            held = pair >= 0
            sums[0] += np.bincount(pair[held & ~random], minlength=CODES * CODES)
            sums[1] += np.bincount(pair[held & random], minlength=CODES * CODES)
    label, pair = np.nonzero(sums)
    yield pa.RecordBatch.from_arrays(
        [pa.array(label.astype(np.int32)), pa.array(pair.astype(np.int32)), pa.array(sums[label, pair])],
        ["label", "pair", "n"],
    )


@dataclass(frozen=True)
class Model:
    """``ratio`` of each pair: log probability when random less that when ordinary."""

    ratio: np.ndarray
    min_length: int = MIN_LENGTH
    min_ratio: float = MIN_RATIO

    def spans(self, data: np.ndarray, at: np.ndarray) -> list[list[Span]]:
        """All spans of each text in bytes; what the models add is whole runs with a letter in them,
        numbers stay, and lies inside no base span."""
        found = base_spans(data, at)
        begins, ends = runs(CODE[data] > 0, at)
        long = ends - begins >= self.min_length
        begins, ends = begins[long], ends[long]
        if not len(begins):
            return found
        pair = _pairs(data, at)
        score = np.concatenate([[0.0], np.cumsum(np.where(pair >= 0, self.ratio[pair], 0.0))])
        letters = np.concatenate([[0], np.cumsum(IS_LETTER[data])])
        wins = (score[ends - 1] - score[begins]) > self.min_ratio * (ends - begins - 1)
        wins &= letters[ends] > letters[begins]
        wins = np.flatnonzero(wins)
        rows = np.searchsorted(at, begins[wins], "right") - 1
        for row in np.unique(rows).tolist():
            base = found[row]
            # base spans by start, and the furthest end up to each: what one of them holds is not added
            opens = [b for b, _, _ in base]
            reach = np.maximum.accumulate([e for _, e, _ in base]).tolist()
            more: list[Span] = []
            for i in wins[rows == row]:
                begin, end = int(begins[i] - at[row]), int(ends[i] - at[row])
                before = bisect.bisect_right(opens, begin)
                if not before or reach[before - 1] < end:
                    more.append((begin, end, 3))
            found[row] = sorted(base + more, key=lambda s: (s[0], s[2]))
        return found


def train(
    df: DataFrame, text: str = "text", smooth: float = 0.5, min_length: int = MIN_LENGTH, min_ratio: float = MIN_RATIO
) -> Model:
    """Both first-order models from all texts of ``df``.

    The labelled samples are the texts themselves: values of base shapes with a digit and at
    least 16 characters are random strings, all other strings are ordinary. Every task sums its
    pairs, so what is fetched has at most 2 * 68 * 68 rows. Without samples both models are
    uniform, and nothing is added to the base spans.
    """
    rows = (
        df.select(text)
        .mapInArrow(_count, "label int, pair int, n long")
        .groupBy("label", "pair")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    counts = np.zeros((2, CODES * CODES))
    for r in rows:
        counts[r["label"], r["pair"]] = r["n"]
    counts = counts.reshape(2, CODES, CODES)[:, :, 1:] + smooth
    logs = np.log(counts / counts.sum(axis=2, keepdims=True))
    ratio = np.zeros((CODES, CODES))
    ratio[:, 1:] = logs[1] - logs[0]
    return Model(ratio.reshape(-1), min_length, min_ratio)


def _points(text: np.ndarray, spans: list[Span]) -> list[Span]:
    """Spans in code points."""
    if not spans:
        return spans
    before = np.concatenate([[0], np.cumsum((text & 0xC0) != 0x80)])
    return [(int(before[b]), int(before[e]), k) for b, e, k in spans]


def _told(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{b}:{e}" for b, e, k in spans)


def scan(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with ``secrets``, all spans (kind, start, stop in code points) by start and kind,
    and ``base_sha256``, the digest of the base spans alone.

    Null and empty texts have no spans. Texts are scanned whole, rows on their own; columns of
    ``df`` called like the two results are replaced.
    """

    def found(batch: pa.RecordBatch) -> list[pa.Array]:
        data, at = utf8(batch.column(text))
        spans, digests = [], []
        for first, last in blocks(at):
            here, places = data[at[first] : at[last]], at[first : last + 1] - at[first]
            for row, own in enumerate(model.spans(here, places)):
                own = _points(here[places[row] : places[row + 1]], own)
                spans.append([{"kind": KINDS[k], "start": b, "stop": e} for b, e, k in own])
                digests.append(hashlib.sha256(_told([s for s in own if s[2] < 3]).encode()).hexdigest())
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))
        return [pa.array(spans, kind), pa.array(digests, pa.string())]

    return add_columns(df, f"secrets {SPANS}, base_sha256 string", found)


def redacted(df: DataFrame, model: Model, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``df`` with every span of every text replaced by ``mark``, overlapping spans by one.

    Null texts stay null.
    """
    kind = dict(df.dtypes)[text]

    def clean(batch: pa.RecordBatch) -> list[pa.Array]:
        column = batch.column(text)
        data, at = utf8(column)
        texts: list[str | None] = column.to_pylist()
        for first, last in blocks(at):
            here, places = data[at[first] : at[last]], at[first : last + 1] - at[first]
            for row, own in enumerate(model.spans(here, places)):
                if own:
                    old, new, end = here[places[row] : places[row + 1]].tobytes(), [], 0
                    for b, e, _ in own:
                        if b >= end:
                            new += [old[end:b], mark.encode()]
                        end = max(end, e)
                    texts[first + row] = b"".join([*new, old[end:]]).decode("utf-8", "replace")
        return [pa.array(texts, column.type)]

    return add_columns(df, f"`{text}` {kind}", clean).select(df.columns)
