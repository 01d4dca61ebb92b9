"""Queries: quality jobs and the star schema."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..functions.times import partition_parts
from ..operators import dims
from ..operators.indicators import indicator_series
from ..operators.sentiment import sentiment_labels
from ..operators import rules
from ..plans import gold, hour, quality_jobs, watched
from ..plans.silver import to_silver
from ..runtime import durable, work_dir
from ..schemas import NEWS_CONTRACT, PARTITION_COLUMNS
from ..sinks.files import raw_landing_write
from ..sources.tables import hourly_extract
from ..streaming import batches
from .base import (
    COINS_SQL,
    COMMENTS_SQL,
    MINUTES,
    NEWS_SQL,
    TOPICS_SQL,
    bars,
    candles_sql,
    coins,
    comments,
    landed,
    news,
    query,
    r6,
    raw_candles,
    raw_candles_of,
    raw_candles_sql,
    sql_r6,
)
from .indicators import LABELED, LABELS, NUMBERS, SERIES
from .joins import AUTHORS_SQL, TOPIC, known_authors

CLEAN_NEWS = f"""
  SELECT domain, title, url, text, published, published_ts, coalesce(author, authors) AS author, source, tag
  FROM ({NEWS_SQL}) WHERE text <> '' QUALIFY row_number() OVER (PARTITION BY url ORDER BY title) = 1
"""
CLEAN_COMMENTS = f"""
  SELECT * FROM (
    SELECT * FROM ({COMMENTS_SQL}) WHERE selftext <> ''
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY created_utc) = 1)
  WHERE author IS NOT NULL
"""


@query("news_quality", f"SELECT * EXCLUDE (published_ts) FROM ({CLEAN_NEWS})")
def _(spark, sf):
    return quality_jobs.news_quality(news(spark, sf)).clean


# --- counts that come out of the job that writes the rows -------------------------------
NEWS_COLUMNS = ("domain", "title", "url", "text", "published", "author", "authors", "source", "tag")
UNIQUE_COLUMNS = tuple(c for c in NEWS_COLUMNS if c != "authors")


def news_rules():
    return [
        rules.not_null("author"),
        rules.required_fields("author", "source"),
        rules.no_empty_string("text"),
        rules.length("text", 2_000),
        rules.trimmed("text"),
        rules.enumeration("tag", ["economy", "politics"]),
        rules.pattern("title", "^doc [0-9]*[02468]$"),
        rules.min_row_count(150),
    ]


NEWS_RULES_SQL = (
    ("not_null", "author", "count(*) FILTER (author IS NULL)"),
    ("required_fields", "author,source", "count(*) FILTER (author IS NULL OR source IS NULL)"),
    ("no_empty_string", "text", "count(*) FILTER (text = '')"),
    ("length", "text", "count(*) FILTER (length(text) > 2000)"),
    ("trimmed", "text", "count(*) FILTER (text <> trim(text, ' '))"),
    ("enumeration", "tag", "count(*) FILTER (tag NOT IN ('economy', 'politics'))"),
    ("pattern", "title", "count(*) FILTER (NOT regexp_matches(title, '^doc [0-9]*[02468]$'))"),
    ("min_row_count", "*", "greatest(150 - count(*), 0)"),
)


def counts_sql(step, source, columns=(), more=()):
    measures = [("n_rows", "*", "count(*)")]
    for c in columns:
        measures += [("n_null", c, f"count(*) FILTER ({c} IS NULL)"), ("n_blank", c, f"count(*) FILTER ({c} = '')")]
    rows = ", ".join(f"{{'measure': '{m}', 'column': '{c}', 'n': ({x})::BIGINT}}" for m, c, x in (*measures, *more))
    return f"""SELECT '{step}' AS step, u.measure AS measure, u."column" AS "column", u.n AS n
  FROM (SELECT unnest([{rows}]) AS u FROM ({source}))"""


def checked_sql(source):
    fails = [(f"violations of {n}", "*", "0" if n == "author" else f"count(*) FILTER ({n} IS NULL)") for n in NEWS_CONTRACT.properties]
    needed = " AND ".join(f"{n} IS NOT NULL" for n in NEWS_CONTRACT.properties if n != "author")
    return counts_sql("checked", source, more=[("n_accepted", "*", f"count(*) FILTER ({needed})"), *fails])


@query("observed_quality", " UNION ALL ".join([
    counts_sql("raw", NEWS_SQL, NEWS_COLUMNS, NEWS_RULES_SQL),
    counts_sql("filled", f"SELECT * FROM ({NEWS_SQL}) WHERE text <> ''"),
    counts_sql("unique", CLEAN_NEWS, UNIQUE_COLUMNS),
    checked_sql(CLEAN_NEWS),
    f"SELECT 'stored', 'n_rows', '*', count(*) FROM ({CLEAN_NEWS})",
]))
def _(spark, sf):
    """News written once, and every count of the job that wrote it."""
    done = watched.news_quality_written(news(spark, sf), work_dir(spark, "watched"), news_rules())
    stored = done.stored.agg(F.count(F.lit(1)).alias("n"))
    return done.report.union(stored.select(F.lit("stored"), F.lit("n_rows"), F.lit("*"), "n"))


@query("observed_batches", " UNION ALL ".join([counts_sql("raw", NEWS_SQL, NEWS_COLUMNS, NEWS_RULES_SQL[:-1]), checked_sql(NEWS_SQL)]))
def _(spark, sf):
    """News as a stream: every micro-batch is written with its counts, which add up."""
    rows, out = news(spark, sf), work_dir(spark, "watched")
    path, files = landed(spark, rows, 4)
    stream = batches.new_file_pickup(spark, path, rows.schema, files_per_batch=files // 2)
    write = watched.watched_batches(out, news_rules()[:-1], NEWS_CONTRACT)
    batches.drain_available(stream, write, work_dir(spark, "checkpoint"))
    return watched.batch_reports(spark, out)


@query("comments_quality", f"SELECT * EXCLUDE (created_ts) FROM ({CLEAN_COMMENTS})")
def _(spark, sf):
    return quality_jobs.comments_quality(comments(spark, sf)).clean


ISO_SQL = "strftime({0}, '%Y-%m-%dT%H:%M:%S.%gZ') AS {0}"


@query("realtime_quality", f"""
  SELECT event_id AS realtime_id, symbol, name, "interval", {ISO_SQL.format("starttime")},
         {ISO_SQL.format("endtime")}, volume, quotevolume, open, close, highest, lowest, tag
  FROM ({raw_candles_sql()})""")
def _(spark, sf):
    return quality_jobs.realtime_quality(raw_candles(spark, sf)).clean


def raw_indicators(spark, sf):
    # Indicators and labels come from the same rows, computed once.
    return as_extracted(durable(indicator_series(bars(spark, sf), MINUTES)))


def as_extracted(series):
    """Indicators and labels as the extract writes them; labels of oversold candles are missing."""
    iso = F.date_format("endtime", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    labeled = sentiment_labels(series)
    symbol = F.concat(F.upper("symbol"), F.lit("USDT"))
    stat = series.withColumns({"id": F.col("event_id"), "endtime": iso, "symbol": symbol})
    shown = [F.when(F.col("rsi10") >= 20, F.col(n)).alias(n) for n, _, _ in LABELS]
    sent = labeled.select(F.col("event_id").alias("id"), "event_id", iso.alias("endtime"), *shown)
    return stat, sent


@query("stat_sent_quality", f"""
  SELECT CAST(s.event_id AS DOUBLE) AS realtime_id, upper(s.symbol) || 'USDT' AS symbol,
         {ISO_SQL.format("s.endtime").replace("AS s.", "AS ")},
         {sql_r6(*(f"s.{n}" for n in NUMBERS)).replace("AS s.", "AS ")},
         {", ".join(f"CASE WHEN s.rsi10 >= 20 THEN l.{n} END AS {n}" for n, _, _ in LABELS)}
  FROM ({SERIES}) s JOIN ({LABELED}) l ON s.event_id = l.event_id""")
def _(spark, sf):
    """Clean indicators next to the clean labels they have."""
    stat, sent = quality_jobs.stat_sent_quality(*raw_indicators(spark, sf))
    labels = sent.clean.select("realtime_id", *[n for n, _, _ in LABELS])
    joined = stat.clean.drop("id").join(labels, "realtime_id", "left")
    return r6(joined, *NUMBERS)


# --- gold: silver rows are partitioned by their own time here -----------------------
def by_own_time(df, ts):
    """Silver rows with the hour of their own time, stored once: a load looks for the newest hour
    first and then reads it, and neither makes the rows again. A month of small hours in one table,
    so not a folder an hour."""
    return durable(df.withColumns(partition_parts(ts)))


def hour_parts(ts: str) -> str:
    return ", ".join(f"CAST({p}({ts}) AS INTEGER) AS {p}" for p in PARTITION_COLUMNS)


def newest_hour(source: str, ts: str) -> str:
    return f"SELECT * FROM ({source}) WHERE date_trunc('hour', {ts}) = (SELECT date_trunc('hour', max({ts})) FROM ({source}))"


def silver_news(spark, sf):
    clean = quality_jobs.news_quality(news(spark, sf)).clean
    return by_own_time(to_silver(clean, "news", "2024-01-01"), "published")


@query("news_to_gold", f"""
  SELECT 500 + row_number() OVER (ORDER BY n.published_ts, n.url, n.title) AS id, t.id_topic, n.domain,
         n.title, n.url, n.text, n.published_ts AS published,
         strftime(n.published_ts, '%Y%m%d') AS timestamp_id, n.author, n.source, {hour_parts("n.published_ts")}
  FROM ({newest_hour(CLEAN_NEWS, "published_ts")}) n LEFT JOIN ({TOPICS_SQL}) t ON t.topic = {TOPIC}""")
def _(spark, sf):
    return gold.news_to_gold(silver_news(spark, sf), dims.dim_topic(spark), max_id=500)


@query("news_hour", f"""
  SELECT 500 + row_number() OVER (ORDER BY n.published_ts, n.url, n.title) AS id, t.id_topic, n.domain,
         n.title, n.url, n.text, n.published_ts AS published,
         strftime(n.published_ts, '%Y%m%d') AS timestamp_id, n.author, n.source,
         2024 AS year, 1 AS month, 31 AS day, 5 AS hour
  FROM ({CLEAN_NEWS}) n LEFT JOIN ({TOPICS_SQL}) t ON t.topic = {TOPIC}""")
def _(spark, sf):
    """An hour of news from its raw folder to gold, run twice: gold holds every url once."""
    root, at = work_dir(spark, "hour"), datetime(2024, 1, 31, 5)
    raw_landing_write(news(spark, sf), f"{root}/raw", "news", at)
    topics = dims.dim_topic(spark)
    for _ in range(2):
        hour.news_hour(spark, root, at, topics, max_id=500)
    return hour.gold_table(spark, root, "dim_news")


def part_of_news(part):
    """News whose number leaves one of two rests of 3."""
    return f"CAST(substr(title, 5) AS BIGINT) % 3 IN ({part}, {part + 1})"


NEWS_OF = [CLEAN_NEWS.replace("WHERE text <> ''", f"WHERE text <> '' AND {part_of_news(part)}") for part in (0, 1)]


def hour_news_sql(source, start, at):
    return f"""
  SELECT {start} + row_number() OVER (ORDER BY n.published_ts, n.url, n.title) AS id, t.id_topic, n.domain,
         n.title, n.url, n.text, n.published_ts AS published,
         strftime(n.published_ts, '%Y%m%d') AS timestamp_id, n.author, n.source,
         2024 AS year, 1 AS month, 31 AS day, {at} AS hour
  FROM ({source}) n LEFT JOIN ({TOPICS_SQL}) t ON t.topic = {TOPIC}"""


@query("news_hours", hour_news_sql(NEWS_OF[0], 0, 6) + " UNION ALL " + hour_news_sql(
    f"SELECT * FROM ({NEWS_OF[1]}) WHERE url NOT IN (SELECT url FROM ({NEWS_OF[0]}))", f"(SELECT count(*) FROM ({NEWS_OF[0]}))", 5))
def _(spark, sf):
    """Hour 6, then hour 5, which is late and shares articles with it, then both again: every url
    once, every id once, and each hour as it was."""
    root, topics = work_dir(spark, "hours"), dims.dim_topic(spark)
    runs = {at: datetime(2024, 1, 31, at) for at in (6, 5)}
    for part, at in enumerate(runs.values()):
        raw_landing_write(news(spark, sf).where(part_of_news(part)), f"{root}/raw", "news", at)
    for at in (6, 5, 5, 6):
        hour.news_hour(spark, root, runs[at], topics)
    return hour.gold_table(spark, root, "dim_news")


def silver_comments(spark, sf):
    clean = quality_jobs.comments_quality(comments(spark, sf)).clean
    return by_own_time(to_silver(clean, "comments", "2024-01-01"), "created_utc")


NEWEST_COMMENTS = newest_hour(CLEAN_COMMENTS, "created_ts")
GOLD_AUTHORS = AUTHORS_SQL.replace(
    f"FROM ({COMMENTS_SQL})\n  WHERE author IS NOT NULL AND author NOT IN",
    f"FROM ({NEWEST_COMMENTS})\n  WHERE author IS NOT NULL AND author NOT IN",
)


@query("comments_to_gold", f"""
  SELECT k.coin_id, CAST(2 AS BIGINT) AS id_topic, c.created_ts AS created_utc,
         strftime(c.created_ts, '%Y%m%d') AS timestamp_id, c.title, a.id_author, c.score, c.url, c.id,
         c.selftext AS self_text, c.num_comments, {hour_parts("c.created_ts")}
  FROM ({NEWEST_COMMENTS}) c
  LEFT JOIN (VALUES (CAST(1 AS BIGINT), 'bitcoin'), (3, 'ethereum')) AS k(coin_id, name) ON c.subreddit = k.name
  LEFT JOIN ({GOLD_AUTHORS}) a ON c.author = a.author""")
def _(spark, sf):
    rows, _ = gold.comments_to_gold(
        silver_comments(spark, sf),
        dims.dim_topic(spark),
        dims.dim_coin(spark),
        known_authors(spark, sf),
    )
    return rows


HOUR_AUTHORS = AUTHORS_SQL.replace(
    f"FROM ({COMMENTS_SQL})\n  WHERE author IS NOT NULL AND author NOT IN",
    f"FROM ({CLEAN_COMMENTS})\n  WHERE author IS NOT NULL AND author NOT IN",
)


@query("comments_hour", f"""
  SELECT k.coin_id, CAST(2 AS BIGINT) AS id_topic, c.created_ts AS created_utc,
         strftime(c.created_ts, '%Y%m%d') AS timestamp_id, c.title, a.id_author, c.score, c.url, c.id,
         c.selftext AS self_text, c.num_comments, 2024 AS year, 1 AS month, 31 AS day, 5 AS hour
  FROM ({CLEAN_COMMENTS}) c
  LEFT JOIN (VALUES (CAST(1 AS BIGINT), 'bitcoin'), (3, 'ethereum')) AS k(coin_id, name) ON c.subreddit = k.name
  LEFT JOIN ({HOUR_AUTHORS}) a ON c.author = a.author""")
def _(spark, sf):
    """An hour of comments from its raw folder to gold with its new authors, run twice."""
    root, at = work_dir(spark, "hour"), datetime(2024, 1, 31, 5)
    raw_landing_write(comments(spark, sf), f"{root}/raw", "comments", at)
    known = durable(known_authors(spark, sf))
    for _ in range(2):
        hour.comments_hour(spark, root, at, dims.dim_topic(spark), dims.dim_coin(spark), known)
    return hour.gold_table(spark, root, "dim_comments")


def silver_realtime(spark, sf):
    clean = quality_jobs.realtime_quality(raw_candles(spark, sf)).clean
    return by_own_time(to_silver(clean, "realtime", "2024-01-01"), "starttime")


@query("realtime_to_gold", f"""
  SELECT r.event_id AS realtime_id, c.coin_id, r."interval", r.starttime,
         strftime(r.starttime, '%Y%m%d') AS starttime_id, r.endtime, strftime(r.endtime, '%Y%m%d') AS endtime_id,
         r.volume, r.quotevolume, r.open, r.close, r.highest, r.lowest, {hour_parts("r.starttime")}
  FROM ({newest_hour(raw_candles_sql(), "starttime")}) r LEFT JOIN ({COINS_SQL}) c ON lower(r.name) = c.name""")
def _(spark, sf):
    return gold.realtime_to_gold(silver_realtime(spark, sf), coins(spark, sf))


LAST_HOUR_SQL = f"(SELECT date_trunc('hour', max(endtime)) FROM ({candles_sql()}))"


def last_hour(spark, sf, rows):
    """The rows of the extract of the last full hour of the candles, and that hour."""
    end = rows.agg(F.date_trunc("hour", F.max("endtime"))).first()[0]
    return hourly_extract(rows, end), datetime(2024, 1, 31, 5)


@query("realtime_hour", f"""
  SELECT r.event_id AS realtime_id, c.coin_id, r."interval", r.starttime,
         strftime(r.starttime, '%Y%m%d') AS starttime_id, r.endtime, strftime(r.endtime, '%Y%m%d') AS endtime_id,
         r.volume, r.quotevolume, r.open, r.close, r.highest, r.lowest, 2024 AS year, 1 AS month, 31 AS day, 5 AS hour
  FROM ({raw_candles_sql()}) r LEFT JOIN ({COINS_SQL}) c ON lower(r.name) = c.name
  WHERE r.endtime < {LAST_HOUR_SQL} AND r.endtime >= {LAST_HOUR_SQL} - INTERVAL 1 HOUR""")
def _(spark, sf):
    """The candles of the last full hour from their extract to gold, run twice."""
    root = work_dir(spark, "hour")
    own, at = last_hour(spark, sf, bars(spark, sf))
    raw = raw_candles_of(own)
    for _ in range(2):
        hour.realtime_hour(spark, root, at, raw, coins(spark, sf))
    return hour.gold_table(spark, root, "dim_realtime")


@query("statistic_hour", f"""
  SELECT 900 + row_number() OVER (ORDER BY n.endtime NULLS FIRST, s.event_id) AS id, c.coin_id, s.event_id AS realtime_id,
         strftime(n.endtime, '%Y%m%d') AS timestamp_id, n.endtime,
         {sql_r6(*(f"s.{n}" for n in NUMBERS)).replace("AS s.", "AS ").replace("AS bb", "AS bolling_band")},
         {", ".join(f"n.{n}" for n, _, _ in LABELS)},
         {", ".join(f"CASE WHEN n.event_id IS NOT NULL THEN {v} END AS {p}" for p, v in zip(PARTITION_COLUMNS, (2024, 1, 31, 5)))}
  FROM (SELECT * FROM ({SERIES}) WHERE endtime < {LAST_HOUR_SQL} AND endtime >= {LAST_HOUR_SQL} - INTERVAL 1 HOUR) s
  LEFT JOIN (SELECT * FROM ({LABELED}) WHERE rsi10 >= 20) n ON s.event_id = n.event_id
  LEFT JOIN ({COINS_SQL}) c ON upper(s.symbol) = c.symbol""")
def _(spark, sf):
    """Indicators and labels of the last full hour from their extract to gold, run twice."""
    root = work_dir(spark, "hour")
    own, at = last_hour(spark, sf, durable(indicator_series(bars(spark, sf), MINUTES)))
    stat, sent = as_extracted(own)
    for _ in range(2):
        hour.statistic_hour(spark, root, at, stat, sent, coins(spark, sf), max_id=900)
    rows = hour.gold_table(spark, root, "coin_sentiment_statistic")
    return r6(rows, *[("bolling_band" if n == "bb" else n) for n in NUMBERS])


def silver_indicators(spark, sf):
    checked = quality_jobs.stat_sent_quality(*raw_indicators(spark, sf))
    # A candle belongs to the hour it started in.
    started = F.col("endtime") - F.expr("INTERVAL 1 MINUTE")
    return [
        by_own_time(to_silver(c.clean, entity, "2024-01-01"), started)
        for c, entity in zip(checked, ("technical", "sentiment"))
    ]


START = "endtime - INTERVAL 1 MINUTE"


@query("statistic_to_gold", f"""
  SELECT 900 + row_number() OVER (ORDER BY n.endtime NULLS FIRST, s.event_id) AS id, c.coin_id, s.event_id AS realtime_id,
         strftime(n.endtime, '%Y%m%d') AS timestamp_id, n.endtime,
         {sql_r6(*(f"s.{n}" for n in NUMBERS)).replace("AS s.", "AS ").replace("AS bb", "AS bolling_band")},
         {", ".join(f"n.{n}" for n, _, _ in LABELS)},
         {", ".join(f"CAST({p}(n.{START}) AS INTEGER) AS {p}" for p in PARTITION_COLUMNS)}
  FROM (SELECT * FROM ({SERIES}) WHERE date_trunc('hour', {START}) =
          (SELECT date_trunc('hour', max({START})) FROM ({candles_sql()}))) s
  LEFT JOIN (SELECT * FROM ({LABELED}) WHERE rsi10 >= 20) n
    ON s.event_id = n.event_id
  LEFT JOIN ({COINS_SQL}) c ON upper(s.symbol) = c.symbol""")
def _(spark, sf):
    stat, sent = silver_indicators(spark, sf)
    rows = gold.statistic_to_gold(stat, sent, coins(spark, sf), max_id=900)
    return r6(rows, *[("bolling_band" if n == "bb" else n) for n in NUMBERS])

