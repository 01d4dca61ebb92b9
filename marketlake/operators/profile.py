"""Profiles of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, StringType)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def blanks(df: DataFrame, name: str) -> Column:
    return F.count_if(F.col(name) == "") if _is_text(df, name) else F.lit(0).cast("long")


def _distinct(df: DataFrame, name: str, digest: bool) -> Column:
    """Different values, NULL counting as one.

    Long texts may be compared by their SHA-256: as good as exact, and the
    shuffle carries 64 characters a value and not the text.
    """
    value = F.sha2(F.col(name), 256) if digest and _is_text(df, name) else F.col(name)
    return F.count_distinct(value) + F.max(F.col(name).isNull().cast("int"))


def profile(
    df: DataFrame, names: list[str] | None = None, distinct: bool = True, digest: bool = True
) -> DataFrame:
    """One row per column: dtype, rows, NULLs, blanks, different values, bounds as text.

    Everything comes from a single aggregation over the table; the one wide row
    is then turned into rows.
    """
    names = names or df.columns
    dtypes = dict(df.dtypes)
    measures = []
    for n in names:
        measures.append(
            F.struct(
                F.lit(n).alias("column"),
                F.lit(dtypes[n]).alias("dtype"),
                F.count(F.lit(1)).alias("n_rows"),
                F.count_if(F.col(n).isNull()).alias("n_null"),
                blanks(df, n).alias("n_blank"),
                (_distinct(df, n, digest) if distinct else F.lit(None).cast("long"))
                .cast("long")
                .alias("n_distinct"),
                F.min(n).cast("string").alias("min_value"),
                F.max(n).cast("string").alias("max_value"),
            )
        )
    wide = df.agg(*[m.alias(f"_{i}") for i, m in enumerate(measures)])
    return wide.select(F.inline(F.array(*[f"_{i}" for i in range(len(names))])))


def null_blank_profile(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """NULLs and empty strings per column: counts only, values are not compared."""
    names = names or df.columns
    rows = [
        F.struct(
            F.lit(n).alias("column"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col(n).isNull()).alias("n_null"),
            blanks(df, n).alias("n_blank"),
        )
        for n in names
    ]
    wide = df.agg(*[r.alias(f"_{i}") for i, r in enumerate(rows)])
    return wide.select(F.inline(F.array(*[f"_{i}" for i in range(len(names))])))


def distinct_profile(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    names = names or df.columns
    wide = df.agg(*[_distinct(df, n, True).cast("long").alias(f"_{i}") for i, n in enumerate(names)])
    rows = [F.struct(F.lit(n).alias("column"), F.col(f"_{i}").alias("n_distinct")) for i, n in enumerate(names)]
    return wide.select(F.inline(F.array(*rows)))


def date_bounds(df: DataFrame, value: Column | str) -> DataFrame:
    return df.agg(F.min(value).alias("min_date"), F.max(value).alias("max_date"))


def max_hour(df: DataFrame, hour: str = "hour") -> DataFrame:
    return df.agg(F.max(hour).alias("max_hour"))


def dtype_profile(df: DataFrame) -> DataFrame:
    """Columns and their types, in order; no data is read."""
    rows = [(i, name, dtype) for i, (name, dtype) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, dtype string")
