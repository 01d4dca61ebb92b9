"""Duplicates: which row to keep, and what was left out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import durable
from .topk import top_k

COPIES = 10_000  # of one row made by a task at a time


def dedup_keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first in ``order``, ties broken by all other columns.

    NULL keys are one group. Spark applies the limit of one row per key before
    the shuffle, and the rows of a hot key that are left meet in heaps first, as in
    :func:`top_k`.
    """
    rest = [c for c in df.columns if c not in {*keys, *order}]
    return top_k(df, keys, [F.col(c).asc() for c in [*order, *rest]], 1)


def dedup_where_repeated(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows of :func:`dedup_keep_first`, for long rows with few repeated keys.

    A hash of the keys is counted first; only rows whose hash comes again are sorted and shuffled,
    the others stay where they are. Keys that share a hash by chance are told apart like all others.
    The hashes that come again, and the rows kept of these, are written at once: later passes over the
    result read ``df`` once and sort nothing. Rows that stand alone move only if the hashes are
    too many to broadcast.
    """
    marked = df.withColumn("_mark", F.xxhash64(*keys))
    counted = marked.groupBy("_mark").agg(F.count(F.lit(1)).alias("_rows"))
    again = durable(counted.where(F.col("_rows") > 1).select("_mark"))
    alone = marked.join(again, "_mark", "left_anti").drop("_mark")
    repeated = marked.join(again, "_mark", "left_semi").drop("_mark")
    return alone.unionByName(durable(dedup_keep_first(repeated, keys, order)))


def duplicate_report(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """All rows but the first of every key, each with the size of its key.

    Pass only the columns to report: all of them are grouped by. No window runs
    over a key, since one key may hold a third of the table.
    Equal rows are counted first, then each row is compared with the first row
    of its key; the join may be split along hot keys. Copies are made in two steps
    with a shuffle between, so those of one row come from many tasks.
    """
    keys, order = list(keys), [c for c in order if c not in keys]
    rest = [c for c in df.columns if c not in {*keys, *order}]
    row = F.struct(*order, *rest)
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    firsts = (
        copies.groupBy(*keys)
        .agg(F.min(row).alias("_first"), F.sum("_copies").alias("key_rows"))
        .where(F.col("key_rows") > 1)
        .select(*[F.col(k).alias(f"_key_{k}") for k in keys], "_first", "key_rows")
    )
    same_key = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    left_over = F.col("_copies") - F.when(row.eqNullSafe(F.col("_first")), 1).otherwise(0)
    return (
        copies.join(firsts, same_key)
        .withColumn("_left_over", left_over)
        .where("_left_over > 0")
        .withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_left_over") - 1) / COPIES))))
        .hint("rebalance", *[F.col(k) for k in keys], F.col("_part"))
        .withColumn("_here", F.least(F.col("_left_over") - F.col("_part") * COPIES, F.lit(COPIES)))
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_here"))))
        .select(*df.columns, "key_rows")
    )
