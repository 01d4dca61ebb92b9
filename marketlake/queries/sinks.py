"""Queries: written data, read back."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from ..plans import quality_jobs
from ..runtime import work_dir
from ..schemas import RAW, SILVER
from ..sinks import files, tables
from ..sources.raw import json_topic_decode, raw_json_read
from ..streaming import batches
from .base import (
    COMMENTS_SQL,
    NEWS_SQL,
    bars_sql,
    comments,
    news,
    query,
    raw_candles,
    raw_candles_sql,
)
from .composites import CLEAN_COMMENTS, CLEAN_NEWS, silver_news

HOURS = (datetime(2024, 1, 31, 5), datetime(2024, 1, 31, 6))
NEWS_COLUMNS = ", ".join(RAW["news"].names)
RAW_COMMENTS = ", ".join(RAW["comments"].names)


@query("raw_landing_write", f"""
  SELECT {NEWS_COLUMNS}, CASE WHEN author IS NULL THEN 6 ELSE 5 END AS landed_hour FROM ({NEWS_SQL})""")
def _(spark, sf):
    """Two hour folders, read back as one tree; the hour is taken from the folder."""
    root = work_dir(spark, "raw")
    rows = news(spark, sf)
    files.raw_landing_write(rows.where("author IS NOT NULL"), root, "news", HOURS[0])
    files.raw_landing_write(rows.where("author IS NULL"), root, "news", HOURS[1])
    landed = raw_json_read(spark, root, "news").select("*", "_metadata.file_path")
    hour = F.regexp_extract("file_path", r"/news/\d{4}/\d{2}/\d{2}/(\d{2})/", 1).cast("int")
    return landed.withColumn("landed_hour", hour).drop("file_path")


@query("topic_json_write", f"SELECT {NEWS_COLUMNS} FROM ({NEWS_SQL})")
def _(spark, sf):
    """News as JSON messages in text files, decoded again."""
    path = work_dir(spark, "topic")
    files.topic_json_write(news(spark, sf), "text", {"path": path})
    return json_topic_decode(spark.read.text(path), RAW["news"])[0]


@query("jsonl_write", f"SELECT subreddit, url, selftext, num_comments FROM ({COMMENTS_SQL})")
def _(spark, sf):
    """Comments with one folder per subreddit, read back with the folder as a column."""
    path = work_dir(spark, "jsonl")
    rows = comments(spark, sf).select("subreddit", "url", "selftext", "num_comments")
    files.jsonl_write(rows, path, "subreddit")
    return spark.read.schema(rows.schema).json(path)


AS_OF = "2024-01-31 05:10:00"
PARTS = "2024 AS year, 1 AS month, 31 AS day, 5 AS hour"


SILVER_CANDLES = f"""
  SELECT realtime_id, symbol, name, "interval", starttime, endtime, volume, quotevolume, open, close,
         highest, lowest, tag, {PARTS}
  FROM (SELECT event_id AS realtime_id, * FROM ({raw_candles_sql()}))"""


@query("silver_append", SILVER_CANDLES)
def _(spark, sf):
    root = work_dir(spark, "silver")
    clean = quality_jobs.realtime_quality(raw_candles(spark, sf)).clean
    path = tables.silver_append(clean, "realtime", root, AS_OF)
    return spark.read.schema(SILVER["realtime"]).parquet(path)


@query("silver_stream", SILVER_CANDLES)
def _(spark, sf):
    """Candles from a topic to silver in several micro-batches, every one of them given twice."""
    root, landing = work_dir(spark, "silver"), work_dir(spark, "topic")
    clean = quality_jobs.realtime_quality(raw_candles(spark, sf)).clean
    messages = files.topic_messages(clean)
    messages.repartition(3).write.parquet(landing)
    handle = tables.silver_handler("realtime", clean.schema, root, AS_OF)

    def twice(batch, number):
        handle(batch, number)
        handle(batch, number)

    stream = batches.new_file_pickup(spark, landing, messages.schema, files_per_batch=1)
    batches.drain_available(stream, twice, work_dir(spark, "checkpoint"))
    return spark.read.parquet(f"{root}/silver/realtime").select(*SILVER["realtime"].names)


@query("raw_landing_stream", f"SELECT {RAW_COMMENTS} FROM ({COMMENTS_SQL})")
def _(spark, sf):
    """Comments landed from a stream under an hour folder, every micro-batch given twice."""
    root, landing = work_dir(spark, "raw"), work_dir(spark, "topic")
    rows = comments(spark, sf).select(*RAW["comments"].names)
    rows.repartition(3).write.parquet(landing)

    def twice(batch, number):
        files.raw_landing_write(batch, root, "comments", HOURS[0], number)
        files.raw_landing_write(batch, root, "comments", HOURS[0], number)

    stream = batches.new_file_pickup(spark, landing, rows.schema, files_per_batch=1)
    batches.drain_available(stream, twice, work_dir(spark, "checkpoint"))
    return raw_json_read(spark, root, "comments", HOURS[0])


def dim_news_rows(spark, sf):
    rows = silver_news(spark, sf).withColumns(
        {
            "id": F.lit(None).cast("long"),
            "id_topic": F.lit(1).cast("long"),
            "timestamp_id": F.date_format("published", "yyyyMMdd"),
        }
    )
    return rows.drop("tag")


@query("gold_append", f"SELECT url, title, published_ts AS published FROM ({CLEAN_NEWS})")
def _(spark, sf):
    """The same news appended twice: the second time, only what is missing gets in."""
    root = work_dir(spark, "gold")
    rows = dim_news_rows(spark, sf)
    path = tables.gold_append(rows.where("author IS NOT NULL"), "dim_news", root, ["url"])
    stored = spark.read.parquet(path)
    tables.gold_append(rows, "dim_news", root, ["url"], stored)
    return spark.read.parquet(path).select("url", "title", "published")


@query("lakehouse_ddl", f"""
  SELECT 'comments' AS "table", count(*) AS n_rows, count(DISTINCT id) AS n_keys FROM ({CLEAN_COMMENTS})
  UNION ALL SELECT 'news', count(*), count(DISTINCT url) FROM ({CLEAN_NEWS})
  UNION ALL SELECT 'realtime', count(*), count(DISTINCT event_id) FROM ({bars_sql()})
  UNION ALL SELECT 'technical', 0, 0 UNION ALL SELECT 'sentiment', 0, 0""")
def _(spark, sf):
    """All tables created, three of them filled from the given data, counted through the catalog."""
    root, prefix = work_dir(spark, "lake"), f"lake_{uuid.uuid4().hex[:8]}_"
    tables.lakehouse_ddl(spark, root, prefix)
    for entity, clean in (
        ("news", quality_jobs.news_quality(news(spark, sf)).clean),
        ("comments", quality_jobs.comments_quality(comments(spark, sf)).clean),
        ("realtime", quality_jobs.realtime_quality(raw_candles(spark, sf)).clean),
    ):
        tables.silver_append(clean, entity, root, AS_OF)
        spark.sql(f"MSCK REPAIR TABLE {prefix}silver.{entity}")
    counts = []
    for entity, key in (
        ("comments", "id"), ("news", "url"), ("realtime", "realtime_id"),
        ("technical", "id"), ("sentiment", "id"),
    ):
        counts.append(
            spark.read.table(f"{prefix}silver.{entity}").agg(
                F.lit(entity).alias("table"),
                F.count(F.lit(1)).alias("n_rows"),
                F.count_distinct(key).alias("n_keys"),
            )
        )
    result = counts[0]
    for c in counts[1:]:
        result = result.unionByName(c)
    return result


