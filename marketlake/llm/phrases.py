"""Phrase collocations by Rabin-Karp fingerprints.

Every run of words gets a fingerprint from two prefix polynomials, one over the bytes of words and
one over words. Tasks add up equal fingerprints before the shuffle, and only fingerprints that are
frequent everywhere go on. Then texts are read once more: a run whose fingerprint may be frequent
points to its place in the text, where it is read word by word, and runs are counted by their words. So two
phrases of one fingerprint are told apart, and no text of a rare phrase is ever made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import durable
from .arrow import blocks, runs, utf8
from .shingles import LOWER, _odd, mix
from .sieve import frequent_filter

ENDS_PIECE = np.zeros(256, bool)
ENDS_PIECE[[*b".,;:!?", *range(10, 14)]] = True
IN_WORD = ~ENDS_PIECE
IN_WORD[[9, 32]] = False

BYTE = _odd(256, 41)
BASE, WORD_BASE = (int(x) for x in _odd(2, 42))
UNKNOWN = "und"

GRAMS = 1 << 22  # runs of words added up before they leave a task
# Counts below 10^15 words, in decimals: products pass 64 bits.
SCORE = (
    "(1000000BD * CAST(a AS DECIMAL(15, 0)) * CAST(a AS DECIMAL(15, 0)))"
    " DIV (CAST(l AS DECIMAL(19, 0)) * CAST(r AS DECIMAL(19, 0)))"
)


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def prefix_hashes(values: np.ndarray, base: int, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The polynomial of each range of ``values``, all from one prefix sum, modulo 2^64."""
    n = len(values)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * _powers(base, n))])
    return (sums[ends] - sums[begins]) * _powers(pow(base, -1, 1 << 64), n + 1)[begins]


class Words:
    """The words of a block of texts: where they are, and which follow each other in a piece."""

    def __init__(self, data: np.ndarray, at: np.ndarray):
        self.data = LOWER[data]
        self.inside = IN_WORD[data]
        self.begins, self.ends = runs(self.inside, at)
        self.row = np.searchsorted(at, self.begins, "right") - 1
        if len(self.begins):
            marks = np.concatenate([[0], np.cumsum(ENDS_PIECE[data])])
            self.joined = (marks[self.ends[:-1]] == marks[self.begins[1:]]) & (self.row[:-1] == self.row[1:])
        else:
            self.joined = np.zeros(0, bool)

    def starts(self, size: int) -> np.ndarray:
        """The words at which a run of ``size`` words begins that no piece ends inside."""
        n = len(self.begins) - size + 1
        whole = np.ones(max(n, 0), bool)
        for k in range(size - 1):
            whole &= self.joined[k : k + n]
        return np.flatnonzero(whole)

    def fingerprints(self, size: int, starts: np.ndarray, langs: np.ndarray) -> np.ndarray:
        """Fingerprints of runs of words; ``langs`` has a hash of the language of each text."""
        if not hasattr(self, "words"):
            sizes = (self.ends - self.begins).astype(np.uint64)
            self.words = mix(prefix_hashes(BYTE[self.data], BASE, self.begins, self.ends) + sizes)
        value = prefix_hashes(self.words, WORD_BASE, starts, starts + size)
        return mix(value + mix(langs[self.row[starts]] + np.uint64(size)))

    def texts(self) -> pa.Array:
        """All words as a dictionary array."""
        offsets = np.concatenate([[0], np.cumsum(self.ends - self.begins)]).astype(np.int64)
        letters = self.data[self.inside]
        return pa.LargeStringArray.from_buffers(len(self.begins), pa.py_buffer(offsets), pa.py_buffer(letters)).dictionary_encode()


def _blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[Words, np.ndarray, pa.Array]]:
    """Words, hashes of languages and languages of the texts of each block."""
    for batch in batches:
        data, at = utf8(batch.column("text"))
        langs = pc.fill_null(batch.column("lang").cast(pa.large_string()), UNKNOWN)
        letters, marks = utf8(langs)
        told = prefix_hashes(BYTE[letters], BASE, marks[:-1], marks[1:]) if len(letters) else np.zeros(len(langs), np.uint64)
        told = mix(told + np.diff(marks).astype(np.uint64))
        for a, b in blocks(at, most):
            yield Words(data[at[a] : at[b]], at[a : b + 1] - at[a]), told[a:b], langs[a:b]


def _counted(docs: DataFrame, sizes: tuple[int, ...], passes=None) -> DataFrame:
    """fp and n of all runs of words of the given sizes; with ``passes``, a broadcast filter,
    only of those whose both runs of one word less may be frequent."""

    def run(batches):
        held: list[np.ndarray] = []
        amount = 0

        def told() -> pa.RecordBatch:
            prints, counts = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(prints.view(np.int64)), pa.array(counts.astype(np.int64))], ["fp", "n"])

        for words, langs, _ in _blocks(batches, 1 << 20):
            for size in sizes:
                starts = words.starts(size)
                if passes is not None and len(starts):
                    own = words.starts(size - 1)
                    able = np.zeros(len(words.begins) + 1, bool)
                    able[own] = passes.value(words.fingerprints(size - 1, own, langs))
                    starts = starts[able[starts] & able[starts + 1]]
                if len(starts):
                    held.append(words.fingerprints(size, starts, langs))
                    amount += len(starts)
            if amount > GRAMS:
                yield told()
                held, amount = [], 0
        if held:
            yield told()

    return docs.mapInArrow(run, "fp long, n long")


def _recounted(docs: DataFrame, most: int, passes) -> DataFrame:
    """lang, size, phrase and n of all runs up to ``most`` words whose fingerprint may be
    frequent, counted by their words; and one row a language with all its words (size 0)."""

    def run(batches):
        for words, prints, langs in _blocks(batches, 1 << 24):
            langs = langs.dictionary_encode()
            lang = langs.indices.to_numpy()[words.row].astype(np.int64)
            counts = np.bincount(lang, minlength=len(langs.dictionary))
            none = pa.nulls(len(counts), pa.large_string())
            yield _rows(langs.dictionary, 0, none, counts)
            if not len(lang):
                continue
            texts = words.texts()
            names = np.unique(lang << 32 | texts.indices.to_numpy(), return_inverse=True)[1].astype(np.int64)
            keys = names  # one number for each different run of words in this block
            for size in range(1, most + 1):
                starts = words.starts(size)
                if size > 1:  # exact: the number of the run without its last word, and that word's
                    wide = np.zeros(len(names), np.int64)
                    wide[starts] = keys[starts] << 32 | names[starts + size - 1]
                    keys = np.zeros(len(names), np.int64)
                    if len(starts):
                        keys[starts] = np.unique(wide[starts], return_inverse=True)[1]
                starts = starts[passes.value(words.fingerprints(size, starts, prints))]
                if not len(starts):
                    continue
                _, at, counts = np.unique(keys[starts], return_index=True, return_counts=True)
                first = starts[at]  # where each is read
                parts = [texts.dictionary.take(pa.array(texts.indices.to_numpy()[first + k])) for k in range(size)]
                phrase = pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())) if size > 1 else parts[0]
                yield _rows(langs.dictionary.take(pa.array(lang[first])), size, phrase, counts)

    return docs.mapInArrow(run, "lang string, size int, phrase string, n long").groupBy("lang", "size", "phrase").agg(F.sum("n").alias("f"))


def _rows(lang: pa.Array, size: int, phrase: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
    columns = [lang.cast(pa.string()), pa.array(np.full(len(counts), size, np.int32)), phrase.cast(pa.string()), pa.array(counts.astype(np.int64))]
    return pa.RecordBatch.from_arrays(columns, ["lang", "size", "phrase", "n"])


def _words(first: int | Column, count: Column) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), first, count), " ")


def collocations(
    df: DataFrame,
    longest: int = 3,
    least: int = 10,
    covered: int = 50,
    top: int = 2000,
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """The first ``top`` phrases of 2 to ``longest`` words of each language, by score.

    Letters A-Z count as a-z. Texts are divided at ``.,;:!?`` and line ends into pieces, these at blanks and tabs
    into words. ``a`` is how often a phrase stands in pieces, ``least`` times at least; cut in two
    parts, with ``l`` and ``r`` places, it scores floor(1000000 a a / (l r)), and the cut with the
    lowest score counts (ties: the shorter first part). A phrase within a longer one that has ``covered``
    per cent of its places is dropped. ``n`` is the words of the language; null languages
    are ``und``, null and empty texts have no words. Rank is by score, then ``a``, both falling, then phrase.

    Parts of a frequent phrase are frequent, so all counts come from one table. Runs of more
    than two words are only counted where both shorter runs in them may be frequent.
    """
    spark = df.sparkSession
    docs = df.select(F.col(text).alias("text"), F.col(lang).alias("lang"))

    def often(counted: DataFrame) -> DataFrame:
        return durable(counted.groupBy("fp").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("fp"))

    known = often(_counted(docs, (1, 2)))
    passes = spark.sparkContext.broadcast(frequent_filter(known))
    for size in range(3, longest + 1):
        known = durable(known.union(often(_counted(docs, (size,), passes))))
        passes = spark.sparkContext.broadcast(frequent_filter(known))
    told = durable(_recounted(docs, longest, passes).where((F.col("f") >= least) | (F.col("size") == 0)))
    totals = told.where("size = 0").select("lang", F.col("f").alias("n"))
    phrases = told.where("size > 0")

    # every cut of every candidate
    cuts = phrases.where("size > 1").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select("lang", "phrase", "size", "k", F.col("f").alias("a"), _words(1, F.col("k")).alias("head"), _words(F.col("k") + 1, F.col("size")).alias("tail"))
    part = lambda name, f: phrases.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    cuts = cuts.join(part("head", "l"), ["lang", "head"]).join(part("tail", "r"), ["lang", "tail"])
    cuts = cuts.withColumn("score", F.expr(SCORE))
    lowest = cuts.groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    # the most frequent longer candidate around every phrase
    inner = phrases.where("size > 2").withColumn("w", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    inner = inner.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("w") + 1)))
    inner = inner.select("lang", _words(F.col("i"), F.col("w")).alias("phrase"), "f")
    around = inner.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = lowest.join(around, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * covered)
    )
    flat = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = flat.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
