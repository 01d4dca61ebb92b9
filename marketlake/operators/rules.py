"""Data-quality rules and their check."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import instant

RESULT = "rule string, column string, failed_rows long, total_rows long, passed boolean"


@dataclass(frozen=True)
class Rule:
    """A named check of one table.

    ``broken`` is true for rows that break the rule. Rules about the whole table
    give ``summary`` instead: an aggregate that counts failures. Rules that need
    a shuffle of their own give ``frame``: a frame with one row and the column
    ``failed_rows``.
    """

    name: str
    column: str
    broken: Column | None = None
    summary: Column | None = None
    frame: Callable[[DataFrame], DataFrame] | None = None


def _rows(name: str, column: str, broken: Column) -> Rule:
    return Rule(name, column, broken=broken)


def not_null(column: str) -> Rule:
    return _rows("not_null", column, F.col(column).isNull())


def required_fields(*columns: str) -> Rule:
    complete = reduce(and_, [F.col(c).isNotNull() for c in columns])
    return _rows("required_fields", ",".join(columns), ~complete)


def no_empty_string(column: str) -> Rule:
    return _rows("no_empty_string", column, F.col(column) == "")


def min_row_count(least: int) -> Rule:
    short = F.greatest(F.lit(least) - F.count(F.lit(1)), F.lit(0))
    return Rule("min_row_count", "*", summary=short)


def _surplus(columns: Sequence[str]) -> Callable[[DataFrame], DataFrame]:
    """Rows beyond the first of every key, from counts that are combined before the shuffle."""

    def count(df: DataFrame) -> DataFrame:
        keys = df.groupBy(*(columns or df.columns)).agg(F.count(F.lit(1)).alias("n"))
        return keys.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("failed_rows"))

    return count


def unique_column(column: str) -> Rule:
    return Rule("unique_column", column, frame=_surplus([column]))


def unique_combination(*columns: str) -> Rule:
    return Rule("unique_combination", ",".join(columns), frame=_surplus(columns))


def no_duplicate_rows() -> Rule:
    return Rule("no_duplicate_rows", "*", frame=_surplus([]))


def data_type(column: str, kind: str) -> Rule:
    wrong = F.col(column).isNotNull() & F.col(column).try_cast(kind).isNull()
    return _rows("data_type", column, wrong)


def date_format(column: str, pattern: str = "yyyy-MM-dd") -> Rule:
    """Text that does not follow the pattern, or that says 1970-01-01."""
    day = F.try_to_timestamp(F.col(column), F.lit(pattern))
    wrong = day.isNull() | (F.to_date(day) == F.lit("1970-01-01").cast("date"))
    return _rows("date_format", column, F.col(column).isNotNull() & wrong)


def enumeration(column: str, values: Sequence) -> Rule:
    return _rows("enumeration", column, ~F.col(column).isin(*values))


def numeric_range(column: str, low: float, high: float) -> Rule:
    return _rows("numeric_range", column, ~F.col(column).between(low, high))


def date_logic(earlier: str, later: str) -> Rule:
    return _rows("date_logic", f"{earlier},{later}", F.col(earlier) > F.col(later))


def cross_field(column: str, when: Column, forbidden: Column) -> Rule:
    """Where one condition holds, another must not."""
    return _rows("cross_field", column, when & forbidden)


def length(column: str, most: int) -> Rule:
    return _rows("length", column, F.char_length(column) > most)


def trimmed(column: str) -> Rule:
    return _rows("trimmed", column, F.col(column) != F.trim(F.col(column)))


def recent(column: str, as_of: datetime | str, hours: int) -> Rule:
    """The newest value must lie within ``hours`` of ``as_of``; fails for the table, not for rows."""
    bound = instant(as_of) - F.make_interval(hours=F.lit(hours))
    stale = F.coalesce(F.max(F.col(column)).cast("timestamp") < bound, F.lit(True))
    return Rule("recent", column, summary=stale.cast("long"))


def no_future(column: str, as_of: datetime | str) -> Rule:
    return _rows("no_future", column, F.col(column).cast("timestamp") > instant(as_of))


def arrival_time(column: str, latest: str = "10:00:00") -> Rule:
    """Days whose first row comes later than a time of day."""

    def late_days(df: DataFrame) -> DataFrame:
        firsts = df.groupBy(F.to_date(column).alias("_day")).agg(F.min(column).alias("first"))
        late = F.date_format("first", "HH:mm:ss") > latest
        return firsts.agg(F.count_if(late).alias("failed_rows"))

    return Rule("arrival_time", column, frame=late_days)


def implication(column: str, when: Column, then: Column) -> Rule:
    """Where one condition holds, the other must hold, too."""
    return _rows("implication", column, when & ~F.coalesce(then, F.lit(False)))


def arithmetic(column: str, expected: Column, tolerance: float = 0.005) -> Rule:
    return _rows("arithmetic", column, F.abs(F.col(column) - expected) > tolerance)


def pattern(column: str, regex: str) -> Rule:
    return _rows("pattern", column, ~F.col(column).rlike(regex))


def referential(column: str, target: DataFrame, key: str) -> Rule:
    """Rows whose value is missing in the key column of another table.

    Values are counted before the join, so a hot value is joined once.
    """

    def orphans(df: DataFrame) -> DataFrame:
        used = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        lost = used.join(target.select(F.col(key).alias(column)), column, "left_anti")
        return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failed_rows"))

    return Rule("referential", column, frame=orphans)


def dq_check(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: failed rows, total rows, passed.

    Every row rule and table rule is a column of one aggregation, so the table
    is read once for all of them, and once more for each rule with a shuffle.
    """
    columns = [F.count(F.lit(1)).alias("_total")]
    for i, r in enumerate(rules):
        if r.broken is not None:
            columns.append(F.count_if(r.broken).alias(f"_{i}"))
        elif r.summary is not None:
            columns.append(r.summary.cast("long").alias(f"_{i}"))
    one_row = df.agg(*columns)
    for i, r in enumerate(rules):
        if r.frame is not None:
            # Both sides have exactly one row.
            own = r.frame(df).select(F.col("failed_rows").cast("long").alias(f"_{i}"))
            one_row = one_row.withColumn("_one", F.lit(1)).join(
                own.withColumn("_one", F.lit(1)), "_one"
            ).drop("_one")
    results = [
        F.struct(
            F.lit(r.name).alias("rule"),
            F.lit(r.column).alias("column"),
            F.col(f"_{i}").alias("failed_rows"),
            F.col("_total").alias("total_rows"),
            (F.col(f"_{i}") == 0).alias("passed"),
        )
        for i, r in enumerate(rules)
    ]
    return one_row.select(F.inline(F.array(*results)))
