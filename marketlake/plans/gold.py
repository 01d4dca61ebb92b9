"""Silver tables to the star schema.

Each load takes the newest hour of a silver table; with ``one_hour`` the rows given are one hour
already, and no partition is looked for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.times import date_key
from ..operators.dims import author_dim_union, new_authors
from ..operators.filters import latest_partition_filter
from ..operators.joins import (
    join_author_dim,
    join_coin_dim_name,
    join_coin_dim_prefix,
    join_indicator_sentiment,
    join_topic_dim,
)
from ..operators.keys import surrogate_key
from ..runtime import durable
from ..schemas import GOLD

# Publication time alone is not unique; url and title make the order total.
NEWS_ORDER = ("published", "url", "title")


def _declared(df: DataFrame, table: str) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in GOLD[table]])


def _hour(silver: DataFrame, one_hour: bool) -> DataFrame:
    return silver if one_hour else latest_partition_filter(silver)


def news_to_gold(
    silver: DataFrame, topic: DataFrame, max_id: int = 0, one_hour: bool = False
) -> DataFrame:
    """The newest hour of news: ids after ``max_id`` in order of publication, topic and date keys."""
    return numbered_news_to_gold(surrogate_key(_hour(silver, one_hour), NEWS_ORDER, max_id), topic)


def numbered_news_to_gold(numbered: DataFrame, topic: DataFrame) -> DataFrame:
    """News that have their ids, with topic and date keys."""
    dated = numbered.withColumn("timestamp_id", date_key("published"))
    return _declared(join_topic_dim(dated, topic).drop("tag"), "dim_news")


def comments_to_gold(
    silver: DataFrame, topic: DataFrame, coin: DataFrame, author: DataFrame, one_hour: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(the newest hour of comments with its keys, the author dimension with new authors).

    The authors are materialised once: both outputs must agree on their ids.
    """
    newest = _hour(silver, one_hour)
    authors = durable(author_dim_union(author, new_authors(newest, author)))
    keyed = newest.withColumn("timestamp_id", date_key("created_utc"))
    keyed = join_coin_dim_name(join_topic_dim(keyed, topic), coin, "subreddit")
    keyed = join_author_dim(keyed, authors).withColumnRenamed("selftext", "self_text")
    return _declared(keyed, "dim_comments"), authors


def realtime_to_gold(silver: DataFrame, coin: DataFrame, one_hour: bool = False) -> DataFrame:
    """The newest hour of candles with coin and date keys instead of names."""
    newest = _hour(silver, one_hour)
    dated = newest.withColumns(
        {"starttime_id": date_key("starttime"), "endtime_id": date_key("endtime")}
    )
    keyed = join_coin_dim_name(dated, coin).drop("symbol", "name", "tag")
    return _declared(keyed, "dim_realtime")


def statistic_to_gold(
    stat: DataFrame, sent: DataFrame, coin: DataFrame, max_id: int = 0, one_hour: bool = False
) -> DataFrame:
    """The newest hour of indicators joined with their labels, with ids after ``max_id``."""
    joined = join_indicator_sentiment(_hour(stat, one_hour), _hour(sent, one_hour))
    dated = joined.withColumn("timestamp_id", date_key("endtime"))
    keyed = join_coin_dim_prefix(dated, coin).drop("symbol")
    numbered = surrogate_key(keyed, ["endtime", "realtime_id"], max_id)
    return _declared(numbered.withColumnRenamed("bb", "bolling_band"), "coin_sentiment_statistic")
