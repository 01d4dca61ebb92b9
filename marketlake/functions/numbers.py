"""Small numeric columns used by reports and tiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .times import column


def round_half_up(value: Column | str, digits: int = 2) -> Column:
    """Half-up rounding; exact when ``value`` is a decimal."""
    return F.round(column(value), digits)


def fill_zero(df: DataFrame, *names: str) -> DataFrame:
    """NULL and NaN become 0 in the named columns."""
    floats = {f.name for f in df.schema if f.dataType.simpleString() in ("double", "float")}
    return df.withColumns(
        {
            n: F.coalesce(F.nanvl(F.col(n), F.lit(None)) if n in floats else F.col(n), F.lit(0))
            for n in names
        }
    )


def coalesce_default(value: Column | str, default) -> Column:
    return F.coalesce(column(value), F.lit(default))


def abs_greatest(*values: Column | str) -> Column:
    """Largest absolute value of a row; NULL terms are skipped."""
    return F.greatest(*[F.abs(column(v)) for v in values])


def substring_prefix(text: Column | str, length: int = 3) -> Column:
    return F.substring(column(text), 1, length)


def price_direction(diff: Column | str) -> Column:
    d = column(diff)
    return F.when(d > 0, "green").when(d < 0, "red").otherwise("gray")


def metric_format(value: Column | str) -> Column:
    """Two decimals, or the text ``null``."""
    v = column(value)
    return F.when(v.isNull(), "null").otherwise(F.format_string("%.2f", v.cast("double")))
