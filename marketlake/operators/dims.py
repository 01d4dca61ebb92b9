"""Dimension tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.times import date_key, date_parts, day_name, is_weekend
from ..schemas import COINS, GOLD, TOPICS
from .keys import fetch_max_id, surrogate_key

# First and last day of the time dimension.
FIRST_DAY = date(2022, 1, 1)
LAST_DAY = date(2028, 12, 31)


def days_between(bounds: DataFrame, first: str = "first", last: str = "last") -> DataFrame:
    """One row per day from the first to the last day of a one-row frame."""
    return bounds.select(
        F.explode(F.sequence(F.col(first).cast("date"), F.col(last).cast("date"))).alias("_day")
    ).select(F.col("_day").cast("timestamp").alias("datetime"))


def time_attributes(days: DataFrame, ts: str = "datetime") -> DataFrame:
    parts = date_parts(ts)
    return days.select(
        date_key(ts).alias("timestamp_id"),
        *[parts[n].alias(n) for n in ("year", "month", "day", "week_of_year", "quarter")],
        day_name(ts).alias("day_of_week"),
        is_weekend(ts).alias("is_weekend"),
        F.col(ts).alias("datetime"),
    )


def dim_time(spark: SparkSession, first: date = FIRST_DAY, last: date = LAST_DAY) -> DataFrame:
    bounds = spark.range(1).select(F.lit(first).alias("first"), F.lit(last).alias("last"))
    return time_attributes(days_between(bounds))


def numbered_names(df: DataFrame, name: str, id: str) -> DataFrame:
    """Ids 1, 2, ... for a short list of names, in order of name."""
    ids = F.row_number().over(Window.orderBy(name)).cast("long")
    return df.withColumn(id, ids)


def dim_coin(spark: SparkSession) -> DataFrame:
    coins = spark.createDataFrame(list(COINS), "name string, symbol string")
    return numbered_names(coins, "name", "coin_id").select("coin_id", "symbol", "name")


def dim_topic(spark: SparkSession) -> DataFrame:
    topics = spark.createDataFrame([(t,) for t in TOPICS], "topic string")
    return numbered_names(topics, "topic", "id_topic").select("id_topic", "topic")


def distinct_authors(comments: DataFrame) -> DataFrame:
    """Different (author, score) pairs with an author."""
    return comments.where(F.col("author").isNotNull()).select("author", "score").distinct()


def new_authors(comments: DataFrame, dim: DataFrame) -> DataFrame:
    """One row per author the dimension does not hold; the credit is the highest score seen."""
    best = (
        comments.where(F.col("author").isNotNull())
        .groupBy("author")
        .agg(F.max("score").cast("double").alias("credit_score"))
    )
    return best.join(dim.select("author"), "author", "left_anti")


def author_dim_union(dim: DataFrame, new: DataFrame) -> DataFrame:
    """The dimension with new authors, numbered after the ids it has, in order of author."""
    numbered = surrogate_key(new, ["author"], fetch_max_id(dim, "id_author"), "id_author")
    return dim.select(*GOLD["author_credit"].names).unionByName(
        numbered.select(*GOLD["author_credit"].names)
    )
