"""The hour jobs: raw records to quality, topic, silver and gold, one step after the other.

The hour is the batch. Topic, silver, rejects and gold keep an hour in a folder of its own (``batch=2024013105``) and
replace it when it runs again; silver is read back from that folder alone, and gold is never
read but for the key column of hours near by. Ids come from a ledger of ranges, so hours may run late, again and in any
order, and no id is given twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dims import new_authors
from ..operators.filters import RECENT_HOURS
from ..operators.keys import fetch_max_id, surrogate_key
from ..runtime import durable
from ..schemas import GOLD, PARTITIONED_BY, SILVER
from ..sinks.files import topic_json_write
from ..sinks.tables import missing_rows, silver_append
from ..sources.raw import json_topic_decode, raw_json_read, raw_json_rejects
from ..sources.tables import parquet_or_empty
from .gold import NEWS_ORDER, comments_to_gold, numbered_news_to_gold, realtime_to_gold, statistic_to_gold
from .ledger import Ledger
from .quality_jobs import Checked, comments_quality, news_quality, realtime_quality, stat_sent_quality

LOOK_BACK = RECENT_HOURS + 1  # hours in which a record may come again


def number_of(hour: datetime) -> int:
    return int(hour.strftime("%Y%m%d%H"))


@dataclass(frozen=True)
class HourResult:
    """What an hour gave: the rows of the hour in gold, the table, and what was left out on the way."""

    added: DataFrame
    gold: str
    broken: DataFrame | None
    rejected: DataFrame
    undecoded: DataFrame


@dataclass(frozen=True)
class Hour:
    """One hour below a root folder (raw, topic, silver, rejects, gold, ledger)."""

    spark: SparkSession
    root: str
    at: datetime

    @property
    def number(self) -> int:
        return number_of(self.at)

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def own(self, layer: str, table: str) -> str:
        return f"{self.path(layer, table)}/batch={self.number}"

    def to_silver(self, entity: str, checked: Checked) -> tuple[DataFrame, DataFrame]:
        """Clean records through the topic to the silver rows of this hour; also the messages that
        could not be read. Both, and the rejected records, are stored."""
        topic_json_write(checked.clean, "text", {"path": self.own("topic", entity), "compression": "gzip"}, mode="overwrite")
        messages = self.spark.read.schema("value string").text(self.own("topic", entity))
        good, undecoded = json_topic_decode(messages, checked.clean.schema)
        silver_append(good, entity, self.root, self.at, self.number)
        undecoded.write.mode("overwrite").parquet(self.own("rejects", f"{entity}_messages"))
        checked.rejected.write.mode("overwrite").parquet(self.own("rejects", entity))
        silver = parquet_or_empty(self.spark, self.own("silver", entity), SILVER[entity])
        return silver, self.spark.read.schema(undecoded.schema).parquet(self.own("rejects", f"{entity}_messages"))

    def near(self, table: str, key: str, look_back: int) -> DataFrame:
        """Keys that other hours of a gold table hold, as many hours before and after this one."""
        ledger, span = Ledger(self.spark, self.root, table), timedelta(hours=look_back)
        held = ledger.hours(number_of(self.at - span), number_of(self.at + span))
        paths = [f"{self.path('gold', table)}/batch={h}" for h in sorted(held) if h != self.number]
        return parquet_or_empty(self.spark, paths, GOLD[table], self.path("gold", table)).select(key)

    def to_gold(
        self, table: str, silver: DataFrame, make: Callable[[DataFrame, int], DataFrame], key: str | None = None,
        look_back: int = LOOK_BACK, start: int = 0,
    ) -> DataFrame:
        """Replaces this hour of a gold table by what ``make`` makes of the silver rows and the last
        id before them. With ``key``, rows whose key an hour near by holds stay out."""
        fresh = durable(missing_rows(silver, self.near(table, key, look_back), [key])) if key else silver
        n = fresh.count()
        first = Ledger(self.spark, self.root, table).reserve(self.number, n, start)
        return self.replaced(table, make(fresh, first - 1) if n else self.spark.createDataFrame([], GOLD[table]))

    def to_numbered_gold(
        self, table: str, silver: DataFrame, make: Callable[[DataFrame], DataFrame], key: str, order: Sequence[str],
        look_back: int = LOOK_BACK, start: int = 0,
    ) -> DataFrame:
        """As ``to_gold`` for rows that hold every ``key`` once and get their ``id`` in ``order``: what is
        compared, sorted and numbered are the keys alone, and the rows with their texts move once,
        to meet their ids."""
        keys = silver.select(*dict.fromkeys([key, *order]))
        fresh = durable(missing_rows(keys, self.near(table, key, look_back), [key]))
        n = fresh.count()
        first = Ledger(self.spark, self.root, table).reserve(self.number, n, start)
        if not n:
            return self.replaced(table, self.spark.createDataFrame([], GOLD[table]))
        ids = durable(surrogate_key(fresh, order, first - 1).select(F.col(key).alias("_key"), "id"))
        return self.replaced(table, make(silver.join(ids, F.col(key).eqNullSafe(F.col("_key"))).drop("_key")))

    def replaced(self, table: str, rows: DataFrame) -> DataFrame:
        """This hour of a gold table, once it holds ``rows`` and nothing else."""
        writer = rows.write.mode("overwrite").option("compression", "zstd")
        writer.partitionBy(*PARTITIONED_BY[f"gold.{table}"]).parquet(self.own("gold", table))
        return parquet_or_empty(self.spark, self.own("gold", table), GOLD[table])


def gold_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """All hours of a gold table."""
    base = f"{root.rstrip('/')}/gold/{table}"
    return parquet_or_empty(spark, f"{base}/batch=*", GOLD[table], base)


def news_hour(
    spark: SparkSession, root: str, hour: datetime, topic: DataFrame, max_id: int = 0, look_back: int = LOOK_BACK
) -> HourResult:
    """One hour of news, from its raw folder on. Ids start after ``max_id``, the highest of what gold held before
    the first hour job. An article whose url an hour within ``look_back`` holds stays out."""
    own, raw_root = Hour(spark, root, hour), f"{root.rstrip('/')}/raw"
    checked = news_quality(raw_json_read(spark, raw_root, "news", hour))
    silver, undecoded = own.to_silver("news", checked)
    rows = own.to_numbered_gold("dim_news", silver, lambda df: numbered_news_to_gold(df, topic), "url", NEWS_ORDER, look_back, max_id)
    broken = raw_json_rejects(spark, raw_root, "news", hour)
    return HourResult(rows, own.path("gold", "dim_news"), broken, checked.rejected, undecoded)


def comments_hour(
    spark: SparkSession, root: str, hour: datetime, topic: DataFrame, coin: DataFrame, authors: DataFrame | None = None, look_back: int = LOOK_BACK
) -> HourResult:
    """One hour of comments, from its raw folder on, with the authors it brings.

    ``authors`` is the dimension before the first hour job. New authors of an hour go to its folder
    of ``author_credit``; those it has brought before keep their ids when it runs again.
    """
    own, raw_root = Hour(spark, root, hour), f"{root.rstrip('/')}/raw"
    checked = comments_quality(raw_json_read(spark, raw_root, "comments", hour))
    silver, undecoded = own.to_silver("comments", checked)
    names = GOLD["author_credit"].names
    seed = spark.createDataFrame([], GOLD["author_credit"]) if authors is None else authors.select(*names)
    known = seed.unionByName(gold_table(spark, root, "author_credit"))

    def make(fresh: DataFrame, _: int) -> DataFrame:
        new = durable(new_authors(fresh, known))
        n = new.count()
        if n:
            first = Ledger(spark, root, "author_credit").reserve_more(own.number, n, fetch_max_id(seed, "id_author"))
            numbered = surrogate_key(new, ["author"], first - 1, "id_author").select(*names)
            before = parquet_or_empty(spark, own.own("gold", "author_credit"), GOLD["author_credit"])
            durable(before.unionByName(numbered)).write.mode("overwrite").parquet(own.own("gold", "author_credit"))
        everyone = durable(seed.unionByName(gold_table(spark, root, "author_credit")))
        return comments_to_gold(fresh, topic, coin, everyone, True)[0]

    rows = own.to_gold("dim_comments", silver, make, "id", look_back)
    broken = raw_json_rejects(spark, raw_root, "comments", hour)
    return HourResult(rows, own.path("gold", "dim_comments"), broken, checked.rejected, undecoded)


def realtime_hour(spark: SparkSession, root: str, hour: datetime, raw: DataFrame, coin: DataFrame) -> HourResult:
    """The candles that the extract of an hour gave, to gold; they bring their own ids."""
    own, checked = Hour(spark, root, hour), realtime_quality(raw)
    silver, undecoded = own.to_silver("realtime", checked)
    rows = own.to_gold("dim_realtime", silver, lambda df, _: realtime_to_gold(df, coin, True))
    return HourResult(rows, own.path("gold", "dim_realtime"), None, checked.rejected, undecoded)


def statistic_hour(
    spark: SparkSession, root: str, hour: datetime, stat: DataFrame, sent: DataFrame, coin: DataFrame, max_id: int = 0
) -> HourResult:
    """The indicators and labels that the extract of an hour gave, joined in gold, with ids after ``max_id``."""
    own = Hour(spark, root, hour)
    checked = stat_sent_quality(stat, sent)
    (numbers, bad_numbers), (labels, bad_labels) = (own.to_silver(e, c) for e, c in zip(("technical", "sentiment"), checked, strict=True))
    table = "coin_sentiment_statistic"

    rows = own.to_gold(table, numbers, lambda df, last: statistic_to_gold(df, labels, coin, last, True), start=max_id)
    rejected = checked[0].rejected.unionByName(checked[1].rejected, allowMissingColumns=True)
    return HourResult(rows, own.path("gold", table), None, rejected, bad_numbers.unionByName(bad_labels))
