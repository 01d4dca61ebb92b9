"""Nearest neighbours by inner product along several shifted Hilbert curves.

Vectors are projected at random to a few dimensions, once per curve, shifted, and put in the
order of a Hilbert curve; rows that are near on one of the curves are compared exactly. A largest
inner product becomes a shortest distance by one more dimension that fills every vector up to the
longest one, and by queries of that length.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.keys import surrogate_key
from ..runtime import durable

BITS = 15  # of each projected dimension in a key


@dataclass(frozen=True)
class Curves:
    """``count`` curves over ``dims`` projected dimensions; a query meets the rows within
    ``share`` of all places before and behind its own on each of them. So the rows looked at
    are the same share of any table; on vectors without structure recall follows that share."""

    count: int = 8
    dims: int = 4
    share: float = 0.125
    seed: int = 5


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of every row of integer coordinates (bits * columns <= 62)."""
    axes = [c.astype(np.int64) for c in cells.T]
    level = 1 << (bits - 1)
    while level > 1:  # undo the turns of every level, the coarsest first
        low = level - 1
        for k, axis in enumerate(axes):
            turned = (axis & level) != 0
            swap = np.where(turned, 0, (axes[0] ^ axis) & low)
            axes[0] = np.where(turned, axes[0] ^ low, axes[0]) ^ swap
            if k:
                axes[k] = axis ^ swap
        level >>= 1
    for k in range(1, len(axes)):
        axes[k] = axes[k] ^ axes[k - 1]
    flip = np.zeros_like(axes[0])
    level = 1 << (bits - 1)
    while level > 1:
        flip = np.where((axes[-1] & level) != 0, flip ^ (level - 1), flip)
        level >>= 1
    key = np.zeros_like(axes[0])
    for bit in reversed(range(bits)):
        for axis in axes:
            key = (key << 1) | (((axis ^ flip) >> bit) & 1)
    return key


def usable(vector: str) -> Column:
    """True for vectors without null or non-finite components that are not zero."""
    v = F.col(vector)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & F.coalesce(fine, F.lit(False)) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _placed(items: DataFrame, curves: Curves, size: int, longest: float) -> DataFrame:
    """Every item (class, query, vec) once per curve, with its key."""
    rng = np.random.default_rng(curves.seed)
    dims = min(curves.dims, size + 1)
    turns = [np.linalg.qr(rng.normal(size=(size + 1, dims)))[0] for _ in range(curves.count)]
    shifts = rng.uniform(size=(curves.count, dims))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            vec = _matrix(batch.column("vec"))
            query = batch.column("query").to_numpy(zero_copy_only=False)
            lengths = np.linalg.norm(vec, axis=1)
            filled = np.sqrt(np.maximum(longest**2 - lengths**2, 0.0))
            scale = np.where(query, longest / lengths, 1.0)
            wide = np.column_stack([vec * scale[:, None], np.where(query, 0.0, filled)]) / longest
            for c in range(curves.count):
                z = wide @ turns[c] * math.sqrt(size)
                even = (0.5 + 0.5 * z / np.sqrt(1.0 + z * z) + shifts[c]) / 2  # in (0, 1)
                key = hilbert_keys(np.clip(even * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(key), c, np.int32)), pa.array(key), *(batch.column(n) for n in ("class", "query", "vec"))],
                    ["curve", "key", "class", "query", "vec"],
                )

    kinds = dict(items.dtypes)
    return items.mapInArrow(run, f"curve int, key long, class long, query boolean, vec {kinds['vec']}")


def nearest(
    df: DataFrame, queries: Column, k: int = 20, id: str = "vec_id", vector: str = "embedding", curves: Curves = Curves()  # noqa: B008
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``id`` and ``score`` of the ``k`` nearest rows found for
    each row of ``df`` for which ``queries`` holds: largest inner product in double precision,
    ties to the smaller id, the query's own row left out.

    Vectors that are null, zero or hold null or non-finite components take no part, nor do those
    of another length than most (ties: the longer) and rows without id. Of equal vectors one is
    placed on the curves, and its k + 1 smallest ids stand for all; so copies crowd no window.
    Repeated ids are rows of their own, and all of them are left out for a query of that id; if
    it stands on several vectors, the best of all of them are merged.

    Items are ranked by (curve, key) through range partitions. Places are cut in blocks; a block
    of queries meets a block of rows where one of their windows reaches it, so a task holds two
    blocks of bounded size. The best of each meeting are merged and ranked again.
    """
    spark = df.sparkSession
    own = df.where(usable(vector) & F.col(id).isNotNull()).select(
        F.col(id).alias("id"), F.col(vector).alias("vec"), F.coalesce(queries, F.lit(False)).alias("query")
    )
    empty = spark.createDataFrame([], f"query_id long, rank int, `{id}` long, score double")
    common = own.groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if common is None:
        return empty
    size = common["size"]
    own = own.where(F.size("vec") == size)
    # the rows of the k + 1 smallest ids of each vector, k of each id: whichever id a query leaves
    # out, k rows are left; the limits run in the map tasks already
    few = Window.partitionBy("vec", "id").orderBy(F.lit(0))
    kept = own.select("id", "vec").withColumn("place", F.row_number().over(few)).where(F.col("place") <= k)
    kept = kept.withColumn("place", F.dense_rank().over(Window.partitionBy("vec").orderBy("id"))).where(F.col("place") <= k + 1)
    first = own.groupBy("vec").agg(F.min("id").alias("class"), F.max("query").alias("query"))
    classes = durable(first)
    members = durable(kept.join(classes.select("vec", "class"), "vec").select("class", "id"))
    asked = durable(own.where("query").join(classes.select("vec", "class"), "vec").select(F.col("id").alias("query_id"), "class"))
    # an id on several vectors leaves out as many of them
    most = k + (asked.distinct().groupBy("query_id").count().agg(F.max("count")).first()[0] or 0)
    length = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    longest = classes.agg(F.max(length)).first()[0]
    items = classes.withColumn("query", F.lit(False)).union(classes.where("query").select("vec", "class", "query"))
    total = items.count()
    window = math.ceil(curves.share * total)
    block = min(max(window, 1024), 65536)
    placed = surrogate_key(
        _placed(items, curves, size, longest), ["curve", "key", "query", "class"], start=-1, id="spot"
    ).withColumn("spot", F.col("spot") - F.col("curve") * F.lit(total))

    wide = 16 * block
    rows = placed.where("NOT query").select(
        "curve",
        F.floor(F.col("spot") / block).cast("long").alias("rb"),
        F.explode(
            F.sequence(
                F.floor(F.greatest(F.col("spot") - window, F.lit(0)) / wide), F.floor((F.col("spot") + window) / wide)
            )
        ).alias("qb"),
        "spot", "class", "query", "vec",
    )
    lines = placed.where("query").select(
        "curve",
        F.explode(
            F.sequence(
                F.floor(F.greatest(F.col("spot") - window, F.lit(0)) / block),
                F.floor(F.least(F.col("spot") + window, F.lit(total - 1)) / block),
            )
        ).alias("rb"),
        F.floor(F.col("spot") / wide).cast("long").alias("qb"),
        "spot", "class", "query", "vec",
    )

    def meet(table: pa.Table) -> pa.Table:
        query = table.column("query").to_numpy()
        spot, name = table.column("spot").to_numpy(), table.column("class").to_numpy()
        vec = _matrix(table.column("vec"))
        order = np.flatnonzero(~query)
        order = order[np.argsort(name[order])]  # equal scores: the smaller id first
        there, ids, base = spot[order], name[order], vec[order]
        out: list[list[np.ndarray]] = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]]
        ask = np.flatnonzero(query)
        for at in range(0, len(ask) if len(order) else 0, 256):
            part = ask[at : at + 256]
            score = vec[part] @ base.T
            score[np.abs(spot[part][:, None] - there[None, :]) > window] = -np.inf
            if score.shape[1] > most:  # all that reach the last score that counts, then in order
                bound = -np.partition(-score, most - 1, axis=1)[:, most - 1]
            else:
                bound = np.full(len(part), -np.inf)
            for row in range(len(part)):
                able = np.flatnonzero((score[row] >= bound[row]) & (score[row] > -np.inf))
                able = able[np.argsort(-score[row][able], kind="stable")][:most]
                out[0].append(np.full(len(able), name[part[row]]))
                out[1].append(ids[able])
                out[2].append(score[row][able])
        return pa.table({n: np.concatenate(x) for n, x in zip(("asked", "class", "score"), out, strict=True)})

    met = rows.union(lines).groupBy("curve", "rb", "qb").applyInArrow(meet, "asked long, class long, score double")
    best = Window.partitionBy("asked").orderBy(F.desc("score"), "class")
    merged = met.groupBy("asked", "class").agg(F.max("score").alias("score"))
    top = durable(merged.withColumn("place", F.row_number().over(best)).where(F.col("place") <= most).drop("place"))
    own_rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (
        asked.distinct()
        .join(top.withColumnRenamed("class", "near"), F.col("class") == F.col("asked"))
        .join(members.withColumnRenamed("class", "near"), "near")
        .where(F.col("id") != F.col("query_id"))
        .withColumn("rank", F.row_number().over(own_rank).cast("int"))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias(id), "score")
    )
