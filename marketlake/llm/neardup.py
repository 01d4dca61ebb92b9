"""Near-duplicates by SetSketch registers: band, estimate, verify, connect.

A register holds the place of an exponentially spread minimum on a logarithmic scale, cut off at
both ends. Registers of a union are the larger ones of each pair, so sketches merge; two sets
agree in a register with about the probability of their similarity, so groups of registers
serve as bands. What agrees in a band is estimated from the counts of larger, smaller and equal
registers, and links are confirmed on the full shingle sets.
"""

from __future__ import annotations

import hashlib
import math
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import durable
from .arrow import add_columns, utf8
from .graph import components
from .shingles import _odd, mix, shingle_sets

BASE, RATE, TOP = 1.001, 20.0, 65535  # registers run from 0 to TOP
BAND, BANDS = 4, 20
REGISTERS = BAND * BANDS
MULTIPLY = _odd(REGISTERS, 7)
PERCENT = 85
SURE = 0.25  # an estimate so far below the threshold rules a pair out: over five deviations
SAME = 0.3  # so does a share of equal registers so far below it
PIVOTS, CHUNK = 1024, 512  # members of a bucket that meet at a time


def registers(shingles: np.ndarray) -> np.ndarray:
    """SetSketch registers of a set of 64-bit hashes; all 0 for the empty set."""
    if not len(shingles):
        return np.zeros(REGISTERS, np.uint16)
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 2048):
        part = shingles[at : at + 2048]
        np.minimum(least, (part[None, :] * MULTIPLY[:, None]).min(axis=1), out=least)
    low = -np.log1p(-(least.astype(np.float64) + 1.0) / 18446744073709551617.0) / RATE
    places = np.floor(1.0 - np.log(np.maximum(low, 1e-300)) / math.log(BASE))
    return np.clip(places, 0, TOP).astype(np.uint16)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def band_keys(rows: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of each sketch (rows of REGISTERS)."""
    packed = rows.reshape(len(rows), BANDS, BAND).astype(np.uint64)
    key = packed[:, :, 0]
    for k in range(1, BAND):
        key = (key << np.uint64(16)) | packed[:, :, k]
    return mix(mix(key) + np.arange(1, BANDS + 1, dtype=np.uint64)[None, :] * MULTIPLY[:BANDS]).view(np.int64)


def similarity(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Most likely similarity of sets of known sizes, from registers row by row.

    The chance that a register of A is larger is p(u - vJ), that it is smaller p(v - uJ), with
    u and v the shares of the sizes and p(x) = -log(1 - x (b - 1) / b) / log(b). The joint
    likelihood of the three counts is concave in J; thirds close in on its top.
    """
    more, less = (a > b).sum(axis=1), (a < b).sum(axis=1)
    same = a.shape[1] - more - less
    u = na / (na + nb)
    v = 1.0 - u
    spread, per = (BASE - 1.0) / BASE, math.log(BASE)

    def chance(x: np.ndarray) -> np.ndarray:
        return np.clip(-np.log1p(-np.clip(x, 0.0, 1.0) * spread) / per, 1e-12, 1.0)

    def likelihood(j: np.ndarray) -> np.ndarray:
        p, q = chance(u - v * j), chance(v - u * j)
        return more * np.log(p) + less * np.log(q) + same * np.log(np.maximum(1.0 - p - q, 1e-12))

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(40):
        third = (high - low) / 3
        up = likelihood(low + third) < likelihood(high - third)
        low = np.where(up, low + third, low)
        high = np.where(up, high, high - third)
    return (low + high) / 2


@dataclass(frozen=True)
class Sketches:
    """``rows``: one per document, with its class; ``classes``: one per distinct shingle set."""

    rows: DataFrame
    classes: DataFrame


def sketch(df: DataFrame, id: str, text: str) -> Sketches:
    """Sketches every whole text, and gathers documents with equal sets in classes.

    ``rows``: id, mark of the text, n_shingles, set (128 bits of the sorted set; null if empty). ``classes``: rep
    (a number), set, n, regs, id and mark of a document that has the set. Equal sets
    meet after their map tasks have kept one each.
    """

    def sketched(batch: pa.RecordBatch) -> list[pa.Array]:
        sizes, names, sketches = [], [], []
        for own in shingle_sets(*utf8(batch.column("_text"))):
            sizes.append(len(own))
            names.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
            sketches.append(registers(own).tobytes() if len(own) else None)
        return [pa.array(sizes, pa.int64()), pa.array(names, pa.binary()), pa.array(sketches, pa.binary())]

    own = df.select(F.col(id).alias("_id"), F.col(text).alias("_text"), F.xxhash64(text).alias("_mark"))
    rows = durable(add_columns(own, "n_shingles long, set binary, regs binary", sketched, drop=("_text",)))
    classes = durable(
        rows.where("n_shingles > 0")
        .dropDuplicates(["set"])
        .select(F.monotonically_increasing_id().alias("rep"), "set", F.col("n_shingles").alias("n"), "regs", "_id", "_mark")
    )
    return Sketches(rows.select("_id", "_mark", "n_shingles", "set"), classes)


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def _banded(classes: DataFrame) -> DataFrame:
    """rep and key of every band of every class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                reps = np.repeat(batch.column("rep").to_numpy(), BANDS)
                keys = band_keys(_matrix(batch.column("regs"))).reshape(-1)
                yield pa.RecordBatch.from_arrays([pa.array(reps), pa.array(keys)], ["rep", "key"])

    return classes.select("rep", "regs").mapInArrow(run, "rep long, key long")


def _likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sizes allow the similarity and whose estimate does not rule it out."""
    side = lambda s: classes.select(F.col("rep").alias(s), F.col("n").alias(f"n_{s}"), F.col("regs").alias(f"regs_{s}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    sized = both.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = _matrix(batch.column("regs_a")), _matrix(batch.column("regs_b"))
                na, nb = (batch.column(f"n_{s}").to_numpy().astype(float) for s in "ab")
                keep = similarity(a, b, na, nb) >= percent / 100 - SURE
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep))

    return sized.mapInArrow(likely, "a long, b long")


def _texts(reps: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """rep and the text of one document of it, found by its id and the mark of its text."""
    marks = reps.distinct().join(classes.select("rep", "_id", "_mark"), "rep")
    found = marks.join(texts, (marks["_mark"] == texts["_mark"]) & marks["_id"].eqNullSafe(texts["_id"]))
    return found.select("rep", "_text").dropDuplicates(["rep"])


def _alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= percent * (len(x) + len(y) - common)


def _verified(pairs: DataFrame, classes: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` that reach the similarity on their full shingle sets."""
    found = durable(_texts(pairs.select(F.col("a").alias("rep")).union(pairs.select("b")), classes, texts))
    side = lambda s: found.select(F.col("rep").alias(s), F.col("_text").alias(f"text_{s}"))
    # the best of a bucket has many partners: its join may be split before any text is cut up
    both = pairs.join(side("b"), "b").join(side("a"), "a")

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: OrderedDict[int, np.ndarray] = OrderedDict()  # few: a class often has many partners

        def sets(ids: list[int], column: pa.Array) -> list[np.ndarray]:
            new = {i: k for k, i in enumerate(ids) if i not in known}
            for i, own in zip(new, shingle_sets(*utf8(column.take(pa.array(list(new.values()), pa.int64())))), strict=True):
                known[i] = own
            return [known[i] for i in ids]

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                a, b = part.column("a").to_pylist(), part.column("b").to_pylist()
                pairs = zip(sets(a, part.column("text_a")), sets(b, part.column("text_b")), strict=True)
                keep = [_alike(x, y, percent) for x, y in pairs]
                while len(known) > 256:
                    known.popitem(last=False)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]).filter(
                    pa.array(keep, pa.bool_())
                )

    return both.mapInArrow(confirm, "a long, b long")


BLOCK = "key long, chunk long, rep long, comp long, place int, pivot boolean, n long, regs binary"


def _candidates(block: pa.Table, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """Of a block its pivots, each with the members it has to be compared with: of another
    component, not met before, of a fitting size, likely enough, and in no earlier band together."""
    comp, place, n = (block.column(c).to_numpy() for c in ("comp", "place", "n"))
    regs = _matrix(block.column("regs"))
    pivot = block.column("pivot").to_numpy()
    band = int(np.flatnonzero(band_keys(regs[:1])[0] == block.column("key")[0].as_py())[0])
    members = np.flatnonzero(~pivot)
    left, right = [], []
    for i in np.flatnonzero(pivot):
        fit = (comp[members] != comp[i]) & (place[members] > place[i])
        fit &= 100 * np.minimum(n[members], n[i]) >= percent * np.maximum(n[members], n[i])
        able = members[fit]
        if len(able):
            equal = regs[able] == regs[i]
            near = equal.mean(axis=1) >= percent / 100 - SAME
            if band:
                near &= ~equal.reshape(len(able), BANDS, BAND)[:, :band].all(axis=2).any(axis=1)
            right.append(able[near])
            left.append(np.full(len(right[-1]), i))
    if not left:
        return
    a, b = np.concatenate(left), np.concatenate(right)
    likely = [
        similarity(regs[a[k : k + 8192]], regs[b[k : k + 8192]], n[a[k : k + 8192]].astype(float), n[b[k : k + 8192]].astype(float))
        for k in range(0, len(a), 8192)
    ]
    keep = np.concatenate([np.zeros(0), *likely]) >= percent / 100 - SURE
    a, b = a[keep], b[keep]
    cuts = np.flatnonzero(np.diff(a)) + 1
    for i, able in zip(np.split(a, cuts), np.split(b, cuts), strict=True):
        if len(i):
            yield int(i[0]), able


def _met(open_: DataFrame, classes: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links among the rows of blocks (BLOCK): first by sketch alone, which leaves those rows
    that have a likely partner, then on the sets of these. A block links every two of its
    components once at most."""

    def needed(block: pa.Table) -> pa.Table:
        use: set[int] = set()
        for i, able in _candidates(block, percent):
            use.add(i)
            use.update(able.tolist())
        return block.take(pa.array(sorted(use), pa.int64()))

    def links(block: pa.Table) -> pa.Table:
        sets: dict[int, np.ndarray] = {}
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.setdefault(x, x) != x:
                x = root[x]
            return x

        def own(k: int) -> np.ndarray:
            if k not in sets:
                sets[k] = next(shingle_sets(*utf8(text.slice(k, 1))))
            return sets[k]

        text = block.column("_text").combine_chunks()
        comp, rep = block.column("comp").to_pylist(), block.column("rep").to_pylist()
        out: list[tuple[int, int]] = []
        for i, able in _candidates(block, percent):
            for j in able.tolist():
                if find(comp[i]) != find(comp[j]) and _alike(own(i), own(j), percent):
                    root[find(comp[i])] = find(comp[j])
                    out.append((rep[i], rep[j]))
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([x for _, x in out], pa.int64())})

    rows = durable(open_.groupBy("key", "chunk").applyInArrow(needed, BLOCK))
    found = _texts(rows.select("rep"), classes, texts)
    return rows.join(found, "rep").groupBy("key", "chunk").applyInArrow(links, "a long, b long")


def linked(df: DataFrame, sketches: Sketches, id: str, text: str, percent: int = PERCENT) -> DataFrame:
    """``node`` and ``component`` of the classes that are linked with another one.

    A bucket is what agrees in a band. First every class is compared with one of its bucket: the
    one that shares its buckets with most, which of edited copies is the one nearest to all.
    Buckets that are then in one component are done: their links would add nothing. In the
    others up to 1024 pivots, members of the rarest components, meet all members of other
    components, 512 at a time, and leave the bucket. Rounds go on until every bucket is done. So
    no bucket has all its pairs written out, and each pair that could join two components is
    looked at, in the first band it shares.
    """
    classes = sketches.classes
    texts = df.select(F.col(id).alias("_id"), F.col(text).alias("_text"), F.xxhash64(text).alias("_mark"))
    bands = durable(_banded(classes))
    # Written, so that the join shuffles both sides anew: only then Spark may split a large bucket.
    sizes = durable(bands.groupBy("key").agg(F.count("*").alias("of")).where("of > 1"))
    members = durable(bands.join(sizes, "key"))
    weight = F.sum("of").over(Window.partitionBy("rep"))  # of the few buckets of a class
    weighed = members.select("key", "rep", weight.alias("weight"))
    best = durable(
        weighed.groupBy("key").agg(F.max(F.struct("weight", "rep")).alias("top")).select("key", F.col("top.rep").alias("best"))
    )
    pairs = members.join(best, "key").where("rep <> best").select(F.col("rep").alias("a"), F.col("best").alias("b"))
    pairs = pairs.repartition("a").distinct()  # where they meet the sketches of a next
    likely = durable(_likely(pairs, classes, percent))
    links = durable(_verified(likely, classes, texts, percent))
    # the best of each bucket has met all others
    open_ = members.select("key", "rep").join(best, "key").where("rep <> best").select("key", "rep")
    found = None
    while True:
        edges = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if found is not None:  # what is known already, as stars
            edges = edges.union(found.select(F.col("node").alias("u"), F.col("component").alias("v")))
        found = components(edges)
        named = (
            open_.join(found, open_["rep"] == found["node"], "left")
            .select("key", "rep", F.coalesce("component", "rep").alias("comp"))
        )
        parts = named.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("of"))
        parts = parts.where("low <> high").select("key", F.ceil(F.col("of") / CHUNK).alias("chunks"))
        left = durable(named.join(parts, "key"))
        counts = left.groupBy("key", "comp").agg(F.count("*").alias("alike"))
        order = Window.partitionBy("key").orderBy("alike", "rep")
        pivots = durable(
            left.join(counts, ["key", "comp"]).withColumn("place", F.row_number().over(order)).where(F.col("place") <= PIVOTS)
        )
        if pivots.isEmpty():
            return found
        regs = classes.select("rep", "n", "regs")
        # as members, pivots meet those of earlier places
        members_ = left.join(pivots.select("key", "rep", "place"), ["key", "rep"], "left").select(
            "key",
            F.pmod(F.xxhash64("rep"), F.col("chunks")).alias("chunk"),
            "rep", "comp",
            F.coalesce("place", F.lit(PIVOTS + 1)).alias("place"),
            F.lit(False).alias("pivot"),
        )
        pivots_ = pivots.select(
            "key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"),
            "rep", "comp", "place", F.lit(True).alias("pivot"),
        )
        blocks = members_.union(pivots_).join(regs, "rep").select("key", "chunk", "rep", "comp", "place", "pivot", "n", "regs")
        links = durable(_met(blocks, classes, texts, percent))
        open_ = durable(left.select("key", "rep").join(pivots.select("key", "rep"), ["key", "rep"], "left_anti"))


def assigned(df: DataFrame, id: str, text: str, percent: int) -> DataFrame:
    """_id, _mark (of the text), n_shingles, component_id and kept of every row of ``df``."""
    sketches = sketch(df, id, text)
    found = linked(df, sketches, id, text, percent)
    rows, classes = sketches.rows, sketches.classes
    names = (
        classes.select("rep", "set")
        .join(found, F.col("rep") == F.col("node"), "left")
        .select("set", F.coalesce("component", "rep").alias("_comp"))
    )
    placed = durable(rows.join(names, "set", "left"))
    least = placed.where("_comp IS NOT NULL").groupBy("_comp").agg(F.min("_id").alias("_least"))
    component = F.coalesce("_least", "_id")
    return placed.join(least, "_comp", "left").select(
        "_id",
        "_mark",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("_id") == component, F.col("_least").isNull()).alias("kept"),
    )


def near_duplicates(df: DataFrame, id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per row of ``df``: the id, ``n_shingles`` (distinct runs of five words; with
    fewer words the whole text as one), ``component_id`` (the smallest id reachable by links)
    and ``kept`` (the id is that one).

    Two texts are linked if 100 * common >= percent * union of their shingles. Words are what
    stands between white space, with A-Z as a-z. Null, empty and wordless texts have 0 shingles,
    no links and stay; equal texts are linked. Repeated rows share a component, and all rows with
    its smallest id are kept. Rows without id are named by the other members of their component,
    if any, and are kept if there are none. Other columns of ``df`` are not read.
    """
    return assigned(df, id, text, percent).select(F.col("_id").alias(id), "n_shingles", "component_id", "kept")


def deduplicated(df: DataFrame, id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of ``df`` that ``near_duplicates`` keeps, with all their columns, whatever their names."""
    stays = assigned(df, id, text, percent).where("kept").select("_id", "_mark").distinct()
    of = max(len(c) for c in df.columns) * "_" + "of"  # longer than any name of df
    marked = df.withColumn(of, F.xxhash64(text))
    return marked.join(
        stays, marked[id].eqNullSafe(stays["_id"]) & (marked[of] == stays["_mark"]), "left_semi"
    ).drop(of)
