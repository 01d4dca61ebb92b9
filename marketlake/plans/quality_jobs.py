"""The four quality jobs: raw records to rows that keep their contract."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators.dedup import dedup_keep_first, dedup_where_repeated, duplicate_report
from ..operators.filters import (
    as_instant,
    cast_columns,
    dropna_any,
    nonblank_filter,
    rename_columns,
)
from ..operators.profile import date_bounds, profile
from ..schemas import (
    COMMENTS_CONTRACT,
    NEWS_CONTRACT,
    REALTIME_CONTRACT,
    SENTIMENT_CONTRACT,
    TECHNICAL_CONTRACT,
    Contract,
)
from ..sources.contracts import schema_contract_check
from ..sources.payloads import one_author

PRICES = ("volume", "quotevolume", "open", "close", "highest", "lowest")
INDICATOR_NUMBERS = (
    "id", "realtime_id", "sma20", "ema12", "rsi10", "macd", "bb", "atr", "va_high", "va_low", "poc",
)


@dataclass(frozen=True)
class Checked:
    """What a quality job gives: rows that keep the contract, rejected rows, and reports on demand."""

    clean: DataFrame
    rejected: DataFrame
    raw: DataFrame
    filled: DataFrame
    unique: DataFrame
    key: str | None = None
    order: str | None = None
    time: str | None = None

    def raw_profile(self) -> DataFrame:
        """NULLs, blanks and bounds of the records as they came."""
        return profile(self.raw, distinct=False)

    def clean_profile(self) -> DataFrame:
        """The same, and the different values, once blank and repeated records are gone."""
        return profile(self.unique)

    def duplicates(self) -> DataFrame:
        """Key, order and title of the repeated records that were left out; texts stay behind."""
        shown = [c for c in dict.fromkeys((self.key, self.order, "title")) if c in self.filled.columns]
        return duplicate_report(self.filled.select(*shown), [self.key], [self.order])

    def dates(self) -> DataFrame:
        """First and last time of the records."""
        return date_bounds(self.unique, as_instant(self.unique, self.time))


def news_quality(raw: DataFrame, contract: Contract = NEWS_CONTRACT) -> Checked:
    """Rows with text and date, the smallest title of every url, one author column. Few urls come
    again, so texts stay where they are but for those."""
    filled = one_author(nonblank_filter(raw, ["text", "published"]))
    unique = dedup_where_repeated(filled, ["url"], ["title"])
    clean, rejected = schema_contract_check(unique, contract)
    return Checked(clean, rejected, raw, filled, unique, "url", "title", "published")


def comments_quality(raw: DataFrame, contract: Contract = COMMENTS_CONTRACT) -> Checked:
    """Rows with a text, one per id (the earliest, then by all other columns), typed numbers."""
    filled = nonblank_filter(raw, ["selftext"])
    unique = dedup_keep_first(filled, ["id"], ["created_utc"])
    types = {"score": "double", "created_utc": "double", "num_comments": "int"}
    clean, rejected = schema_contract_check(cast_columns(unique, types), contract)
    return Checked(clean, rejected, raw, filled, unique, "id", "created_utc", "created_utc")


def realtime_quality(raw: DataFrame, contract: Contract = REALTIME_CONTRACT) -> Checked:
    """Candles under their silver name with numbers as doubles."""
    typed = cast_columns(
        rename_columns(raw, {"event_id": "realtime_id"}), {p: "double" for p in PRICES}
    )
    clean, rejected = schema_contract_check(typed, contract)
    return Checked(clean, rejected, raw, typed, typed, "realtime_id", "endtime", "endtime")


def stat_sent_quality(
    stat: DataFrame,
    sent: DataFrame,
    stat_contract: Contract = TECHNICAL_CONTRACT,
    sent_contract: Contract = SENTIMENT_CONTRACT,
) -> tuple[Checked, Checked]:
    """Indicators and labels without NULLs, under their silver names."""

    def check(raw: DataFrame, numbers: tuple[str, ...], contract: Contract) -> Checked:
        complete = dropna_any(rename_columns(raw, {"event_id": "realtime_id"}))
        typed = cast_columns(complete, {n: "double" for n in numbers})
        clean, rejected = schema_contract_check(typed, contract)
        return Checked(clean, rejected, raw, complete, typed, "realtime_id", "endtime", "endtime")

    return (
        check(stat, INDICATOR_NUMBERS, stat_contract),
        check(sent, ("id", "realtime_id"), sent_contract),
    )
