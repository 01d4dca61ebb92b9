"""SimHash near-duplicates by pivot distance tables.

Fingerprints of unlike texts differ in half of their bits, and so do their distances to any
reference fingerprint: over all 64 bits a table of such distances rules hardly anything out before
rows meet. So distances are taken block of bits by block of bits. By the triangle inequality the
distances of two fingerprints to one reference differ by no more than they themselves do, in every
block and in the sum of all. Of six blocks at least two agree wholly where at most four bits differ: there
all coordinates of the table are equal, and rows of equal coordinates meet. Of those that meet, pairs
with a coordinate difference above the limit go unread, and the rest is verified bit by bit.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import durable
from .arrow import add_columns, utf8
from .graph import components
from .shingles import LOWER, _odd, mix

SHINGLE, SEED = 4, 42
DIFFER = 4  # bits in which linked fingerprints may differ
BLOCKS, AGREE = 6, 2  # of 6 blocks 6 - 4 agree
PIVOTS = _odd(16, 31)  # the reference fingerprints
PAIRS = list(itertools.combinations(range(BLOCKS), AGREE))
PART = 1 << 16  # shingles hashed at a time
CHUNK, SPLIT, LEVELS = 512, 4096, 2
TOGETHER = 16384  # rows of small buckets compared by one call
MOST_PAIRS = 1 << 20  # links held before they are drawn together


def fingerprint(text: bytes) -> int:
    """SimHash of a text: a bit is set where over half of the hashes of its shingles have it.

    Shingles are runs of four words, repeats counted, or all words if there are fewer; without
    words the fingerprint is 0.
    """
    words = text.translate(LOWER.tobytes()).split()  # bytes: white space is 0x20 and 0x09 to 0x0D
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    begins = np.cumsum(sizes + 1) - sizes - 1
    width = min(SHINGLE, len(words))
    n = len(words) - width + 1
    starts, stops = begins[:n], begins[width - 1 :] + sizes[width - 1 :]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, n, PART):
        ends = zip(starts[at : at + PART].tolist(), stops[at : at + PART].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in ends], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def masks(within: int) -> list[int]:
    """The set bits of ``within`` dealt to six masks, as even as can be."""
    bits = [b for b in range(64) if within >> b & 1]
    return [sum(1 << b for b in bits[k::BLOCKS]) for k in range(BLOCKS)]


def distances(prints: np.ndarray, within: int) -> np.ndarray:
    """The pivot table: one row a fingerprint, its distance to every reference inside a mask."""
    return np.bitwise_count((prints[:, None] ^ PIVOTS[None, :]) & np.uint64(within))


def _keys(prints: np.ndarray, within: int, level: int) -> list[np.ndarray]:
    """For each two of the six blocks a key of all table coordinates in them."""
    weights = _odd(len(PIVOTS) * BLOCKS, 37 + level).reshape(BLOCKS, -1)
    told = [(distances(prints, m).astype(np.uint64) * w).sum(axis=1) for m, w in zip(masks(within), weights, strict=True)]
    return [mix(told[a] + mix(told[b] + np.uint64(k + 1))) for k, (a, b) in enumerate(PAIRS)]


WHOLE = (1 << 64) - 1
# what is left of the bits once the two blocks of a key agree
LEFT = [WHOLE & ~(masks(WHOLE)[a] | masks(WHOLE)[b]) for a, b in PAIRS]


def _first_keys(classes: DataFrame) -> DataFrame:
    """key, pair and fp: 15 rows a fingerprint."""

    def run(batches):
        for batch in batches:
            prints = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for k, key in enumerate(_keys(prints, WHOLE, 0)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(np.full(len(key), k, np.int32)), batch.column(0)], ["key", "pair", "fp"]
                )

    return classes.select("fp").mapInArrow(run, "key long, pair int, fp long")


def _finer_keys(members: DataFrame) -> DataFrame:
    """The same inside large buckets: keys over the bits that are left."""

    def run(batches):
        for batch in batches:
            prints = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            above = batch.column("key").to_numpy(zero_copy_only=False).view(np.uint64)
            pair = batch.column("pair").to_numpy(zero_copy_only=False)
            for k in np.unique(pair):
                own = np.flatnonzero(pair == k)
                for key in _keys(prints[own], LEFT[k], 1):
                    key = mix(key + above[own])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64)), pa.array(np.full(len(key), -1, np.int32)), batch.column("fp").take(pa.array(own))],
                        ["key", "pair", "fp"],
                    )

    return members.mapInArrow(run, "key long, pair int, fp long")


def _labels(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The smallest node that each of n nodes reaches along pairs."""
    label = np.arange(n)
    while len(u):
        least = np.minimum(label[u], label[v])
        np.minimum.at(label, u, least)
        np.minimum.at(label, v, least)
        np.minimum.at(label, label[u], least)
        label = label[label]
        apart = label[u] != label[v]
        u, v = u[apart], v[apart]
    while (label[label] != label).any():
        label = label[label]
    return label


def linked(keys: np.ndarray, prints: np.ndarray, comps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links inside buckets, rows sorted by key: a forest of them, so at most one a row.

    Every row meets all later ones of its bucket that are not yet in its component. The pivot
    table rules pairs out, reference by reference; what stays is verified.
    """
    table = distances(prints, WHOLE).astype(np.int16)
    _, at, inverse = np.unique(comps, return_index=True, return_inverse=True)
    before = at[inverse]  # one row stands for all of its component
    roots = before
    found: list[tuple[np.ndarray, np.ndarray]] = []
    held, step = 0, 1
    alive = np.arange(len(keys))
    while len(alive):
        alive = alive[alive + step < len(keys)]
        alive = alive[keys[alive] == keys[alive + step]]
        near = alive[roots[alive] != roots[alive + step]]
        for p in range(table.shape[1]):
            near = near[np.abs(table[near, p] - table[near + step, p]) <= DIFFER]
        near = near[np.bitwise_count(prints[near] ^ prints[near + step]) <= DIFFER]
        if len(near):
            found.append((near, near + step))
            held += len(near)
        step += 1
        if found and (held > MOST_PAIRS or not len(alive)):
            u, v = (np.concatenate(x) for x in zip(*found, strict=True))
            roots = _labels(len(keys), np.append(u, np.arange(len(keys))), np.append(v, roots))
            found, held = [], 0
    own = np.flatnonzero(roots != before)
    return prints[own], prints[roots[own]]


def _compared(members: DataFrame) -> DataFrame:
    """Links (u, v) between members (key, fp, comp, n) of the same bucket.

    Buckets of up to 512 fingerprints come many to a call; larger ones are cut in chunks, and
    each two chunks make a bucket of their own.
    """
    chunks = F.ceil(F.col("n") / CHUNK)
    mine = F.pmod(F.xxhash64("fp"), chunks)
    small = members.where(F.col("n") <= CHUNK).select("key", "fp", "comp")
    large = (
        members.where(F.col("n") > CHUNK)
        .withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)))
        .select(F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("key"), "fp", "comp")
    )
    rows = small.union(large)
    bins = max(1, rows.count() // TOGETHER)

    def run(table: pa.Table) -> pa.Table:
        keys, prints, comps = (table.column(c).to_numpy() for c in ("key", "fp", "comp"))
        order = np.lexsort((prints, keys))
        u, v = linked(keys[order], prints[order].view(np.uint64), comps[order])
        return pa.table({"u": u.view(np.int64), "v": v.view(np.int64)})

    return rows.withColumn("bin", F.pmod("key", F.lit(bins))).groupBy("bin").applyInArrow(run, "u long, v long")


def _near(a: str, b: str):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= DIFFER


def links(classes: DataFrame) -> DataFrame:
    """Links (u, v) that connect all fingerprints of ``classes`` (fp, distinct) at most four bits apart.

    All members of a bucket are compared with two of them first, which is all there is to do in
    buckets of up to three. Only buckets that still hold several components go on; those above
    4096 are divided once more by the bits that are left, so a hot bucket never meets itself whole
    unless its members are dense in those bits as well.
    """
    found: list[DataFrame] = []
    keyed = _first_keys(classes)
    for level in range(LEVELS):
        keyed = durable(keyed)
        crowd = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("fp").alias("low"), F.max("fp").alias("high"))
        members = durable(keyed.join(durable(crowd.where("n > 1")), "key"))
        stars = [
            members.where((F.col("fp") != F.col(c)) & _near("fp", c)).select(F.col("fp").alias("u"), F.col(c).alias("v"))
            for c in ("low", "high")
        ]
        found.append(durable(stars[0].union(stars[1]).distinct()))
        parts = components(_union(found).distinct())
        wide = members.where("n > 3").select("key", "pair", "fp", "n")
        placed = wide.join(parts.withColumnRenamed("node", "fp"), "fp", "left")
        placed = durable(placed.select("key", "pair", "fp", "n", F.coalesce("component", "fp").alias("comp")))
        torn = placed.groupBy("key").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).where("a != b").select("key")
        still = durable(placed.join(durable(torn), "key"))
        last = level == LEVELS - 1
        found.append(durable(_compared(still if last else still.where(F.col("n") <= SPLIT))))
        keyed = still.where(F.col("n") > SPLIT)
        if last or keyed.isEmpty():
            break
        keyed = _finer_keys(keyed.select("key", "pair", "fp"))
    return _union(found)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.union(f)
    return out


def simhash_duplicates(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``fingerprint`` (16 hexadecimal digits) and ``component_id`` of every row of ``df``: the
    smallest id reachable along fingerprints at most four bits apart, its own included.

    Rows without words have fingerprint 0 and are linked like all others. Rows with the same id
    are documents of their own. A component whose ids are all null has none; null ids are passed
    over where there are others. Equal fingerprints are one node, so copies cost no links.
    """

    def prints(batch: pa.RecordBatch) -> list[pa.Array]:
        data, at = utf8(batch.column(1))
        whole = data.tobytes()
        made = [fingerprint(whole[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        return [pa.array(np.array(made, np.uint64).view(np.int64))]

    own = df.select(F.col(id).alias("id"), F.col(text).alias("text"))
    marked = durable(add_columns(own, "fp long", prints, drop=("text",)))
    classes = durable(marked.groupBy("fp").agg(F.min("id").alias("least")))
    parts = durable(components(links(classes).distinct()))
    placed = classes.join(parts.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("component", "fp"))
    placed = durable(placed.select("fp", "least", "root"))
    least = durable(placed.groupBy("root").agg(F.min("least").alias("component_id")))
    named = durable(placed.join(least, "root").select("fp", "component_id"))
    return marked.join(named, "fp").select(
        F.col("id").alias(id), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
