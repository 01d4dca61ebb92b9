"""Different values of wide tables from sketches that merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType

LOG_SIZE = 12  # of a sketch: 2^12 cells, about 2.5 KB


def relative_error(log_size: int = LOG_SIZE, deviations: float = 3.0) -> float:
    """How far an estimate may be off, in parts of the exact count."""
    return deviations * 1.04 / 2 ** (log_size / 2)


def _sketched(df: DataFrame, name: str, log_size: int) -> Column:
    plain = isinstance(df.schema[name].dataType, (IntegerType, LongType, StringType, BinaryType))
    # an empty text leaves a sketch as it is, so it is counted by itself
    value = F.col(name) if plain else F.col(name).cast("string")
    return F.hll_sketch_agg(value, log_size)


def distinct_sketches(df: DataFrame, by: Sequence[str | Column], names: Sequence[str] | None = None, log_size: int = LOG_SIZE) -> DataFrame:
    """One row per group (say an hour) and column: ``by``, ``column``, ``n_rows``, ``n_null``, ``n_blank`` and ``sketch``.

    All columns are sketched side by side in one aggregation: a row is read once and never
    multiplied, and what is shuffled is a sketch per task, group and column. Store the result; a new hour
    adds rows, and any span of hours is merged from it without a look at the data.
    """
    names = list(names or df.columns)
    keys = [F.col(b) if isinstance(b, str) else b for b in by]
    measures = []
    for name in names:
        blank = F.count_if(F.col(name) == "") if isinstance(df.schema[name].dataType, StringType) else F.lit(0).cast("long")
        measures.append(
            F.struct(
                F.lit(name).alias("column"), F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(name).isNull()).alias("n_null"),
                blank.alias("n_blank"), _sketched(df, name, log_size).alias("sketch"),
            )
        )
    grouped = df.groupBy(*keys).agg(*[m.alias(f"_m{i}") for i, m in enumerate(measures)])
    held = [c for c in grouped.columns if c not in {f"_m{i}" for i in range(len(names))}]
    return grouped.select(*held, F.inline(F.array(*[f"_m{i}" for i in range(len(names))])))


def distinct_estimate(sketches: DataFrame) -> DataFrame:
    """One row per column: ``column``, ``n_rows`` and ``n_estimate``, the different values over all rows of ``sketches``, with
    NULL and the empty text counting as one each."""
    merged = sketches.groupBy("column").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_null").alias("_null"), F.sum("n_blank").alias("_blank"), F.hll_union_agg("sketch").alias("_sketch")
    )
    extra = (F.col("_null") > 0).cast("long") + (F.col("_blank") > 0).cast("long")
    return merged.select("column", "n_rows", (F.hll_sketch_estimate("_sketch") + extra).alias("n_estimate"))
