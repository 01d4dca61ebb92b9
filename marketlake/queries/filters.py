"""Queries: projections, filters and duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.times import partition_parts
from ..operators import dedup
from ..operators import filters as fl
from ..operators.joins import select_star_plus
from .base import COMMENTS_SQL, NEWS_SQL, bars, candles_sql, comments, load, news, query


@query("rename_columns", f"SELECT event_id AS realtime_id, symbol, endtime, close FROM ({candles_sql()})")
def _(spark, sf):
    b = bars(spark, sf).select("event_id", "symbol", "endtime", "close")
    return fl.rename_columns(b, {"event_id": "realtime_id", "authors": "author"})


@query("cast_columns", """
  SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
         TRY_CAST(event_type AS INTEGER) AS event_type FROM events""")
def _(spark, sf):
    rows = load(spark, sf, "events").select(
        "event_id", F.get_json_object("props", "$.k").alias("k"), "event_type"
    )
    return fl.cast_columns(rows, {"k": "double", "event_type": "int"})


@query("drop_columns", f"SELECT domain, title, url, published FROM ({NEWS_SQL})")
def _(spark, sf):
    return news(spark, sf).drop("text", "author", "authors", "source", "tag")


@query("nonblank_filter", f"""
  SELECT title, url, published, author FROM ({NEWS_SQL}) WHERE author IS NOT NULL AND text <> ''""")
def _(spark, sf):
    rows = fl.nonblank_filter(news(spark, sf), ["author", "text"])
    return rows.select("title", "url", "published", "author")


@query("dropna_any", f"""
  SELECT subreddit, title, author, id, num_comments FROM ({COMMENTS_SQL}) WHERE author IS NOT NULL""")
def _(spark, sf):
    rows = comments(spark, sf).select("subreddit", "title", "author", "id", "num_comments")
    return fl.dropna_any(rows)


@query("recency_filter", f"""
  SELECT 'event' AS kind, CAST(event_id AS VARCHAR) AS id, ts AS at FROM events
  WHERE ts >= TIMESTAMP '2024-01-01 02:00:00' AND ts < TIMESTAMP '2024-01-01 06:00:00'
  UNION ALL
  SELECT 'news', title, published_ts FROM ({NEWS_SQL})
  WHERE published_ts >= TIMESTAMP '2024-01-01 02:00:00' AND published_ts < TIMESTAMP '2024-01-01 06:00:00'
  UNION ALL
  SELECT 'comment', url, created_ts FROM ({COMMENTS_SQL})
  WHERE created_ts >= TIMESTAMP '2024-01-01 02:00:00' AND created_ts < TIMESTAMP '2024-01-01 06:00:00'""")
def _(spark, sf):
    """The same four hours of a time column, of date texts and of epoch numbers."""
    as_of = "2024-01-01 06:00:00"
    kept = []
    for kind, df, name, id in (
        ("event", load(spark, sf, "events"), "ts", "event_id"),
        ("news", news(spark, sf), "published", "title"),
        ("comment", comments(spark, sf), "created_utc", "url"),
    ):
        recent = fl.recency_filter(df, name, as_of)
        at = fl.as_instant(recent, name).cast("timestamp_ntz").alias("at")
        kept.append(recent.select(F.lit(kind).alias("kind"), F.col(id).cast("string").alias("id"), at))
    return kept[0].unionByName(kept[1]).unionByName(kept[2])


@query("threshold_filter", f"""
  SELECT title, published FROM ({NEWS_SQL}) WHERE published_ts > TIMESTAMP '2024-01-01 03:00:00'""")
def _(spark, sf):
    kept = fl.threshold_filter(news(spark, sf), "published", "2024-01-01 03:00:00")
    return kept.select("title", "published")


def parted_events(spark, sf):
    return load(spark, sf, "events").withColumns(partition_parts("ts"))


@query("latest_partition", """
  SELECT CAST(year(h) AS INTEGER) AS year, CAST(month(h) AS INTEGER) AS month,
         CAST(day(h) AS INTEGER) AS day, CAST(hour(h) AS INTEGER) AS hour
  FROM (SELECT max(ts) AS h FROM events)""")
def _(spark, sf):
    return fl.latest_partition(parted_events(spark, sf))


@query("latest_partition_filter", """
  SELECT event_id, ts, event_type, value FROM events
  WHERE date_trunc('hour', ts) = (SELECT date_trunc('hour', max(ts)) FROM events)""")
def _(spark, sf):
    return fl.latest_partition_filter(parted_events(spark, sf)).select(
        "event_id", "ts", "event_type", "value"
    )


@query("select_star_plus", """
  SELECT c.*, n.n_name FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def _(spark, sf):
    customer, nation = load(spark, sf, "customer"), load(spark, sf, "nation")
    on = customer["c_nationkey"] == nation["n_nationkey"]
    return select_star_plus(customer, nation, on, "n_name")


@query("news_list", f"SELECT title, published, url FROM ({NEWS_SQL})")
def _(spark, sf):
    return news(spark, sf).select("title", "published", "url")


@query("dedup_keep_first", f"""
  SELECT 'news' AS kind, url AS key, title, published AS at FROM ({NEWS_SQL})
  QUALIFY row_number() OVER (PARTITION BY url ORDER BY title) = 1
  UNION ALL
  SELECT 'comments', id, title, CAST(created_ts AS VARCHAR) FROM (
    SELECT * FROM ({COMMENTS_SQL}) QUALIFY row_number() OVER (PARTITION BY id ORDER BY created_utc) = 1)""")
def _(spark, sf):
    n = dedup.dedup_keep_first(news(spark, sf), ["url"], ["title"])
    c = dedup.dedup_keep_first(comments(spark, sf), ["id"], ["created_utc"])
    at = F.date_format(fl.as_instant(c, "created_utc"), "yyyy-MM-dd HH:mm:ss")
    return n.select(
        F.lit("news").alias("kind"), F.col("url").alias("key"), "title", F.col("published").alias("at")
    ).unionByName(
        c.select(F.lit("comments").alias("kind"), F.col("id").alias("key"), "title", at.alias("at"))
    )


@query("duplicate_report", f"""
  SELECT 'news' AS kind, url AS key, title, key_rows FROM (
    SELECT *, row_number() OVER (PARTITION BY url ORDER BY title) AS place,
           count(*) OVER (PARTITION BY url) AS key_rows FROM ({NEWS_SQL})) WHERE place > 1
  UNION ALL
  SELECT 'comments', id, title, key_rows FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY created_utc) AS place,
           count(*) OVER (PARTITION BY id) AS key_rows FROM ({COMMENTS_SQL})) WHERE place > 1""")
def _(spark, sf):
    n = dedup.duplicate_report(news(spark, sf).select("url", "title"), ["url"], ["title"])
    turns = comments(spark, sf).select("id", "created_utc", "title")
    c = dedup.duplicate_report(turns, ["id"], ["created_utc"])
    return n.select(F.lit("news").alias("kind"), F.col("url").alias("key"), "title", "key_rows").unionByName(
        c.select(F.lit("comments").alias("kind"), F.col("id").alias("key"), "title", "key_rows")
    )


