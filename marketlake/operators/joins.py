"""Left joins to the dimensions.

No join carries a broadcast hint. Spark knows the size of lists written in the
job and of stored tables and broadcasts them below its threshold; others it
measures at run time. Hot keys on the left of a larger dimension are split by its
skew handling.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import QUOTE_CURRENCY, TOPIC_OF_TAG


def select_star_plus(left: DataFrame, dim: DataFrame, on: Column, *names: str) -> DataFrame:
    """All columns of the left side, once per match, plus the named ones of the dimension."""
    return left.join(dim, on, "left").select(left["*"], *[dim[n] for n in names])


def topic_of(tag: Column) -> Column:
    known = [F.lit(x) for pair in TOPIC_OF_TAG.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*known), tag), tag)


def join_topic_dim(df: DataFrame, dim: DataFrame, tag: str = "tag") -> DataFrame:
    """Adds ``id_topic`` by tag; both coin tags belong to the topic ``coin``."""
    return select_star_plus(df, dim, topic_of(df[tag]) == dim["topic"], "id_topic")


def join_coin_dim_name(df: DataFrame, dim: DataFrame, name: str = "name") -> DataFrame:
    """Adds ``coin_id`` by coin name, in any case."""
    return select_star_plus(df, dim, F.lower(df[name]) == F.lower(dim["name"]), "coin_id")


def join_coin_dim_prefix(df: DataFrame, dim: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Adds ``coin_id`` by ticker: the symbol without its quote currency."""
    ticker = F.regexp_replace(df[symbol], f"{QUOTE_CURRENCY}$", "")
    return select_star_plus(df, dim, ticker == dim["symbol"], "coin_id")


def join_author_dim(df: DataFrame, dim: DataFrame, author: str = "author") -> DataFrame:
    """Adds ``id_author``; the dimension holds an author once, so rows are not multiplied."""
    return select_star_plus(df, dim, df[author] == dim["author"], "id_author")


def join_indicator_sentiment(indicators: DataFrame, sentiment: DataFrame) -> DataFrame:
    """Indicators with their labels by candle; times and date parts are those of the labels."""
    left = indicators.drop("endtime", "id", "year", "month", "day", "hour")
    return left.join(sentiment.drop("id"), "realtime_id", "left")
