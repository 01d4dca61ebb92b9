"""Queries: dimensions, joins to them, authors and the maximum cache."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dims, joins, stats24h
from ..operators.indicators import indicator_series
from ..operators.keys import surrogate_key
from ..operators.sentiment import sentiment_labels
from ..operators.topk import latest_per_symbol
from ..runtime import work_dir
from ..sinks import tables
from .base import (
    COINS_SQL,
    COMMENTS_SQL,
    MINUTES,
    NEWS_SQL,
    TOPICS_SQL,
    bars,
    coins,
    comments,
    load,
    news,
    query,
    raw_candles,
    raw_candles_sql,
    r6,
    sql_r6,
)
from .indicators import LABELED, LABELS, NUMBERS, SERIES

TOPIC = "CASE WHEN n.tag IN ('coin_news', 'coins_news') THEN 'coin' ELSE n.tag END"


@query("join_topic_dim", f"""
  SELECT n.title, n.tag, t.id_topic FROM ({NEWS_SQL}) n
  LEFT JOIN ({TOPICS_SQL}) t ON t.topic = {TOPIC}""")
def _(spark, sf):
    rows = news(spark, sf).select("title", "tag")
    return joins.join_topic_dim(rows, dims.dim_topic(spark))


@query("join_coin_dim_name", f"""
  SELECT r.event_id, r.name, c.coin_id FROM ({raw_candles_sql()}) r
  LEFT JOIN ({COINS_SQL}) c ON lower(r.name) = lower(c.name)""")
def _(spark, sf):
    rows = raw_candles(spark, sf).select("event_id", "name")
    return joins.join_coin_dim_name(rows, coins(spark, sf))


@query("join_coin_dim_prefix", f"""
  SELECT r.event_id, r.symbol, c.coin_id FROM ({raw_candles_sql()}) r
  LEFT JOIN ({COINS_SQL}) c ON regexp_replace(r.symbol, 'USDT$', '') = c.symbol""")
def _(spark, sf):
    rows = raw_candles(spark, sf).select("event_id", "symbol")
    return joins.join_coin_dim_prefix(rows, coins(spark, sf))


@query("distinct_authors", f"""
  SELECT DISTINCT author, score FROM ({COMMENTS_SQL}) WHERE author IS NOT NULL""")
def _(spark, sf):
    return dims.distinct_authors(comments(spark, sf))


# Authors of the first turns are known already, in the order of their name.
KNOWN_SQL = f"""
  SELECT row_number() OVER (ORDER BY author) AS id_author, author, credit_score
  FROM (SELECT author, max(score) AS credit_score FROM ({COMMENTS_SQL})
        WHERE author IS NOT NULL AND num_comments < 1 GROUP BY author)
"""
NEW_SQL = f"""
  SELECT author, max(score) AS credit_score FROM ({COMMENTS_SQL})
  WHERE author IS NOT NULL AND author NOT IN (SELECT author FROM ({KNOWN_SQL})) GROUP BY author
"""
AUTHORS_SQL = f"""
  SELECT id_author, author, credit_score FROM ({KNOWN_SQL})
  UNION ALL
  SELECT (SELECT count(*) FROM ({KNOWN_SQL})) + row_number() OVER (ORDER BY author), author, credit_score
  FROM ({NEW_SQL})
"""


def known_authors(spark, sf):
    first = comments(spark, sf).where("num_comments < 1 AND author IS NOT NULL")
    best = first.groupBy("author").agg(F.max("score").alias("credit_score"))
    return surrogate_key(best, ["author"], id="id_author")


@query("new_authors", NEW_SQL)
def _(spark, sf):
    return dims.new_authors(comments(spark, sf), known_authors(spark, sf))


@query("author_dim_union", AUTHORS_SQL)
def _(spark, sf):
    known = known_authors(spark, sf)
    return dims.author_dim_union(known, dims.new_authors(comments(spark, sf), known))


@query("join_author_dim", f"""
  SELECT c.url, c.author, coalesce(a.id_author, 0) AS id_author FROM ({COMMENTS_SQL}) c
  LEFT JOIN ({KNOWN_SQL}) a ON c.author = a.author""")
def _(spark, sf):
    rows = comments(spark, sf).select("url", "author")
    joined = joins.join_author_dim(rows, known_authors(spark, sf))
    return joined.withColumn("id_author", F.coalesce("id_author", F.lit(0)))


@query("join_indicator_sentiment", f"""
  SELECT l.event_id AS realtime_id, l.symbol, {sql_r6(*(f"l.{n}" for n in NUMBERS)).replace("AS l.", "AS ")},
         r.endtime, {", ".join(f"r.{n}" for n, _, _ in LABELS)}
  FROM ({SERIES}) l LEFT JOIN (SELECT * FROM ({LABELED}) WHERE rsi10 >= 40) r ON l.event_id = r.event_id""")
def _(spark, sf):
    """Labels were stored for candles that are not oversold only."""
    series = indicator_series(bars(spark, sf), MINUTES).withColumnRenamed("event_id", "realtime_id")
    labeled = sentiment_labels(series).where("rsi10 >= 40")
    labels = labeled.select("realtime_id", "endtime", *[n for n, _, _ in LABELS])
    return r6(joins.join_indicator_sentiment(series, labels), *NUMBERS)


# --- dimensions over the dates and names of the tables -----------------------------
@query("dim_time", """
  SELECT strftime(d, '%Y%m%d') AS timestamp_id, CAST(year(d) AS INTEGER) AS year,
         CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
         CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(quarter(d) AS INTEGER) AS quarter,
         dayname(d) AS day_of_week, dayofweek(d) IN (0, 6) AS is_weekend, d AS datetime
  FROM (SELECT unnest(generate_series(CAST(min(o_orderdate) AS TIMESTAMP), max(o_orderdate),
                                      INTERVAL 1 DAY)) AS d FROM orders)""")
def _(spark, sf):
    """A row for every day between the first and the last order."""
    bounds = load(spark, sf, "orders").agg(
        F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last")
    )
    return dims.time_attributes(dims.days_between(bounds))


@query("dim_coin", COINS_SQL)
def _(spark, sf):
    return coins(spark, sf)


@query("dim_topic", """
  SELECT row_number() OVER (ORDER BY topic) AS id_topic, topic
  FROM (SELECT DISTINCT source AS topic FROM documents)""")
def _(spark, sf):
    topics = load(spark, sf, "documents").select(F.col("source").alias("topic")).distinct()
    return surrogate_key(topics, ["topic"], id="id_topic")


# --- maximum cache: a customer is a symbol, an order a candle ------------------------
# The cache holds the newest order before 1997 of each customer; then their newest order
# of all comes in.
def _orders(spark, sf):
    return load(spark, sf, "orders").select(
        F.col("o_custkey").alias("symbol"),
        F.col("o_totalprice").alias("close"),
        F.col("o_orderdate").alias("endtime"),
        F.col("o_orderkey").alias("event_id"),
    )


def cache_and_newest(spark, sf):
    orders = _orders(spark, sf)
    old = latest_per_symbol(orders.where(F.col("endtime") < F.lit("1996-01-01").cast("timestamp_ntz")), 1)
    cache = old.select(
        "symbol", F.col("close").alias("max_value"), F.col("endtime").alias("max_timestamp")
    )
    return cache, latest_per_symbol(orders, 1)


def _newest_order(where: str) -> str:
    return f"""SELECT o_custkey AS symbol, o_totalprice AS close, o_orderdate AS endtime, o_orderkey AS event_id
      FROM orders {where} QUALIFY row_number() OVER (PARTITION BY o_custkey
                                             ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""


OLD = _newest_order("WHERE o_orderdate < TIMESTAMP '1996-01-01'")
NEWEST = _newest_order("")
TAKES = "(o.symbol IS NULL OR n.endtime - o.endtime >= INTERVAL 24 HOURS OR n.close > o.close)"
UPSERT = f"""
  SELECT coalesce(o.symbol, n.symbol) AS symbol,
         CASE WHEN {TAKES} THEN n.close ELSE o.close END AS max_value,
         CASE WHEN {TAKES} THEN n.endtime ELSE o.endtime END AS max_timestamp
  FROM ({OLD}) o FULL JOIN ({NEWEST}) n ON o.symbol = n.symbol
"""


@query("max_cache_upsert", UPSERT)
def _(spark, sf):
    cache, newest = cache_and_newest(spark, sf)
    return stats24h.max_cache_upsert(cache, newest)


@query("max_cache_next", f"SELECT CAST(symbol AS VARCHAR) AS symbol, max_value, max_timestamp FROM ({UPSERT})")
def _(spark, sf):
    """The cache as versions: the old one, a version that was never finished, and the next."""
    cache, newest = cache_and_newest(spark, sf)
    root = work_dir(spark, "cache")
    symbol = F.col("symbol").cast("string").alias("symbol")

    def candles(df, close, ts):
        return df.select(symbol, F.col(close).alias("close"), F.col(ts).cast("timestamp").alias("endtime"))

    tables.max_cache_next(spark, root, candles(cache, "max_value", "max_timestamp"))
    cache.limit(0).write.parquet(f"{root}/version=1")
    tables.max_cache_next(spark, root, candles(newest, "close", "endtime"))
    return tables.max_cache(spark, root)


@query("not_exists_anti", f"""
  SELECT symbol, close, endtime, event_id FROM ({NEWEST}) WHERE symbol NOT IN (SELECT symbol FROM ({OLD}))""")
def _(spark, sf):
    cache, newest = cache_and_newest(spark, sf)
    return stats24h.not_exists_anti(newest, cache)


@query("update_from_join", f"SELECT * FROM ({UPSERT}) WHERE symbol IN (SELECT symbol FROM ({OLD}))")
def _(spark, sf):
    cache, newest = cache_and_newest(spark, sf)
    return stats24h.update_from_join(cache, newest)


@query("union_all_ctes", f"""
  SELECT u.*, o.symbol IS NULL AS inserted FROM ({UPSERT}) u LEFT JOIN ({OLD}) o ON u.symbol = o.symbol""")
def _(spark, sf):
    """What the upsert returns: inserted and updated rows in one list."""
    cache, newest = cache_and_newest(spark, sf)
    inserted = stats24h.not_exists_anti(newest, cache).select(
        "symbol", F.col("close").alias("max_value"), F.col("endtime").alias("max_timestamp")
    )
    updated = stats24h.update_from_join(cache, newest)
    return inserted.withColumn("inserted", F.lit(True)).unionByName(
        updated.withColumn("inserted", F.lit(False))
    )


