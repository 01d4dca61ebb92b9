"""Time columns: parsing, epochs, keys and calendar parts."""

from __future__ import annotations

from datetime import datetime
from string import ascii_letters

from pyspark.sql import Column
from pyspark.sql import functions as F

# The date patterns that feeds and typed messages use.
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"
# Mail style dates without their day name (Spark does not parse day names): seconds and zone may be left out.
MAIL = "d MMM yyyy HH:mm[:ss][ Z][ z]"

# What a text must look like to be tried. A pattern that fails costs an exception
# inside Spark, a look at the shape does not.
ISO_SHAPE = r"^\d{4}-\d\d-\d\d([T ]\d\d:\d\d(:\d\d(\.\d{1,9})?( ?Z| ?[+-]\d\d(:?\d\d)?| UTC| GMT)?)?)?$"
MAIL_SHAPE = r"^([A-Za-z]{3,9},? +)?\d{1,2} [A-Za-z]{3} \d{4} \d\d:\d\d(:\d\d)?( [A-Za-z]+| [+-]\d{4})?$"
# What may stand before the day of the month.
DAY_NAME_CHARS = ascii_letters + ", "

# Numbers above this bound are epoch milliseconds, others epoch seconds.
EPOCH_MILLIS_BOUND = 1e12


def column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def instant(as_of: datetime | str) -> Column:
    """A timestamp literal; text is taken as UTC."""
    return F.lit(as_of).cast("timestamp")


def _with_seconds(text: Column) -> Column:
    """``:00`` between the minutes and the zone of an ISO text; the built-in cast needs it there."""
    zone_after_minutes = (F.locate("-", text) == 5) & F.substring(text, 17, 1).isin(" ", "Z", "+", "-")
    return F.when(zone_after_minutes, F.overlay(text, F.lit(":00"), 17, 0)).otherwise(text)


def parse_timestamp(text: Column | str) -> Column:
    """A date text in any of the known notations as a timestamp; NULL for all others.

    ISO dates to the day, minute, second or a part of it, with ``Z``, ``+hh``, ``+hhmm``,
    ``+hh:mm`` or no zone, and mail dates with or without day name, seconds and zone. Without
    a zone the session's zone is meant, UTC in this package.
    """
    said = _with_seconds(F.trim(column(text)))
    mail = F.ltrim(said, F.lit(DAY_NAME_CHARS))
    return F.when(said.rlike(ISO_SHAPE), said.try_cast("timestamp")).when(
        said.rlike(MAIL_SHAPE), F.try_to_timestamp(mail, F.lit(MAIL))
    )


def unreadable_date(text: Column | str) -> Column:
    """True for a text that says something but is no date in a known notation."""
    said = F.trim(column(text))
    return F.coalesce(said != "", F.lit(False)) & parse_timestamp(said).isNull()


def epoch_to_timestamp(number: Column | str) -> Column:
    """Epoch seconds or milliseconds to a timestamp; NULL beyond the year 9999."""
    value = column(number).cast("double")
    seconds = F.when(value > EPOCH_MILLIS_BOUND, value / 1000).otherwise(value)
    return F.when(F.abs(seconds) < 253402300800, F.timestamp_seconds(seconds))


def millis_to_second(millis: Column | str) -> Column:
    """Epoch milliseconds cut to the whole second."""
    return F.date_trunc("second", F.timestamp_millis(column(millis).cast("long")))


def date_parts(ts: Column | str) -> dict[str, Column]:
    t = column(ts)
    return {
        "year": F.year(t),
        "month": F.month(t),
        "day": F.dayofmonth(t),
        "hour": F.hour(t),
        "week_of_year": F.weekofyear(t),
        "quarter": F.quarter(t),
    }


def partition_parts(ts: Column | str) -> dict[str, Column]:
    """The four columns that silver and gold tables are partitioned by."""
    parts = date_parts(ts)
    return {name: parts[name] for name in ("year", "month", "day", "hour")}


def date_key(ts: Column | str) -> Column:
    return F.date_format(column(ts), "yyyyMMdd")


def day_name(ts: Column | str) -> Column:
    return F.date_format(column(ts), "EEEE")


def is_weekend(ts: Column | str) -> Column:
    return F.dayofweek(column(ts)).isin(1, 7)


def display_timezone(ts: Column | str, offset: str = "+07:00") -> Column:
    return F.from_utc_timestamp(column(ts), offset)


def epoch_diff_seconds(later: Column | str, earlier: Column | str) -> Column:
    return (F.unix_micros(column(later)) - F.unix_micros(column(earlier))) / F.lit(1e6)


def ingest_time(as_of: datetime | str | None = None) -> Column:
    """The given instant, or the clock of the running query for streams."""
    return F.current_timestamp() if as_of is None else instant(as_of)
