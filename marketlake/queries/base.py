"""Registry of queries, and how the given tables stand in for candles, news and comments."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, TimestampType

from ..functions.times import ISO_SECONDS
from ..operators.bars import INTERVALS, kline_resample
from ..operators.keys import surrogate_key
from ..operators.slices import Series
from ..runtime import prepare, work_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Times without zone and decimals as doubles, as the check compares them."""
    changes = {}
    for f in df.schema:
        if isinstance(f.dataType, TimestampType):
            changes[f.name] = F.col(f.name).cast("timestamp_ntz")
        elif isinstance(f.dataType, DecimalType):
            changes[f.name] = F.col(f.name).cast("double")
    return df.withColumns(changes) if changes else df


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under the name of its operator, with the SQL that must agree."""

    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(fn(prepare(spark), sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def landed(spark: SparkSession, df: DataFrame, files: int) -> tuple[str, int]:
    """A folder with the rows in ``files`` files, or in as many as tasks read them if these are more,
    so that no file grows with the table; and how many there are."""
    path, files = work_dir(spark, "landing"), max(files, df.rdd.getNumPartitions())
    df.repartition(files).write.parquet(path)
    return path, files


def r6(df: DataFrame, *names: str) -> DataFrame:
    """Six decimals: sums of doubles may differ in the last digits between engines."""
    return df.withColumns({n: F.round(n, 6) + F.lit(0.0) for n in names})


def sql_r6(*names: str) -> str:
    return ", ".join(f"round({n}, 6) + 0.0 AS {n}" for n in names)


# --- candles: an event type is a symbol, a value is a price and a quantity ------
def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("value").cast("decimal(18,2)")
    return load(spark, sf_dir, "events").select(
        F.col("event_type").alias("symbol"),
        "ts",
        "event_id",
        value.alias("price"),
        value.alias("qty"),
    )


def bars(spark: SparkSession, sf_dir: str, every: str = "1m") -> DataFrame:
    return kline_resample(ticks(spark, sf_dir), every)


MINUTES = Series.of_interval(INTERVALS["1m"])
HOURS = Series.of_interval(INTERVALS["1h"])

TICKS_SQL = """
  SELECT event_type AS symbol, ts, event_id,
         CAST(value AS DECIMAL(18,2)) AS price, CAST(value AS DECIMAL(18,2)) AS qty
  FROM events
"""


def bars_sql(every: str = "1m") -> str:
    step = f"INTERVAL {INTERVALS[every]} SECONDS"
    return f"""
  SELECT arg_max(event_id, ts) AS event_id, symbol, '{every}' AS "interval",
         time_bucket({step}, ts) AS starttime, time_bucket({step}, ts) + {step} AS endtime,
         arg_min(price, ts) AS open, max(price) AS highest, min(price) AS lowest,
         arg_max(price, ts) AS close, sum(qty) AS volume, sum(price * qty) AS quotevolume
  FROM ({TICKS_SQL}) GROUP BY symbol, time_bucket({step}, ts)
"""


# Prices as doubles, as the indicators see them.
def candles_sql(every: str = "1m") -> str:
    prices = ("open", "highest", "lowest", "close", "volume", "quotevolume")
    doubles = ", ".join(f"CAST({p} AS DOUBLE) AS {p}" for p in prices)
    return f'SELECT event_id, symbol, "interval", starttime, endtime, {doubles} FROM ({bars_sql(every)})'


# --- news: a document is an article, equal texts share a url --------------------
TAG_OF_LANG = {"en": "economy", "fr": "coin_news", "de": "politics", "es": "coins_news"}
# The first article appears at this instant, the others a minute apart.
FIRST_EPOCH = 1_704_067_200


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    tag = F.col("lang")
    for lang, name in TAG_OF_LANG.items():
        tag = F.when(F.col("lang") == lang, name).otherwise(tag)
    at = F.timestamp_seconds(F.lit(FIRST_EPOCH) + F.col("doc_id") * 60)
    return load(spark, sf_dir, "documents").select(
        F.concat("source", F.lit(".example.com")).alias("domain"),
        F.concat(F.lit("doc "), F.lpad(F.col("doc_id").cast("string"), 9, "0")).alias("title"),
        F.concat(F.lit("https://news.example.com/"), F.md5("text")).alias("url"),
        "text",
        F.date_format(at, ISO_SECONDS).alias("published"),
        F.when(F.col("lang").isin("en", "de"), F.col("lang")).alias("author"),
        F.when(F.col("lang").isin("fr", "es"), F.col("lang")).alias("authors"),
        "source",
        tag.alias("tag"),
    )


NEWS_SQL = f"""
  SELECT source || '.example.com' AS domain,
         'doc ' || lpad(CAST(doc_id AS VARCHAR), 9, '0') AS title,
         'https://news.example.com/' || md5(text) AS url, text,
         strftime(make_timestamp(({FIRST_EPOCH} + doc_id * 60) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS published,
         make_timestamp(({FIRST_EPOCH} + doc_id * 60) * 1000000) AS published_ts,
         CASE WHEN lang IN ('en', 'de') THEN lang END AS author,
         CASE WHEN lang IN ('fr', 'es') THEN lang END AS authors, source,
         CASE lang WHEN 'en' THEN 'economy' WHEN 'fr' THEN 'coin_news'
                   WHEN 'de' THEN 'politics' WHEN 'es' THEN 'coins_news' ELSE lang END AS tag
  FROM documents
"""


# --- comments: a turn is a comment, a conversation is the id it shares -----------
def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    role = F.col("role")
    seconds = (F.lit(FIRST_EPOCH) + F.col("conv_id") * 60 + F.col("turn")).cast("double")
    return load(spark, sf_dir, "conversations").select(
        F.when(role == "user", "bitcoin")
        .when(role == "assistant", "ethereum")
        .otherwise("dogecoin")
        .alias("subreddit"),
        F.concat_ws(" ", role, F.col("turn").cast("string")).alias("title"),
        F.when(role != "system", F.concat(role, F.col("conv_id").cast("string"))).alias("author"),
        F.char_length("text").cast("double").alias("score"),
        F.concat_ws("/", F.lit("https://forum.example.com"), "conv_id", "turn").alias("url"),
        F.when(role == "assistant", seconds * 1000).otherwise(seconds).alias("created_utc"),
        F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("id"),
        F.col("text").alias("selftext"),
        F.col("turn").cast("int").alias("num_comments"),
        F.lit("comment").alias("tag"),
    )


COMMENTS_SQL = f"""
  SELECT CASE role WHEN 'user' THEN 'bitcoin' WHEN 'assistant' THEN 'ethereum'
                   ELSE 'dogecoin' END AS subreddit,
         role || ' ' || turn AS title,
         CASE WHEN role <> 'system' THEN role || conv_id END AS author,
         CAST(length(text) AS DOUBLE) AS score,
         'https://forum.example.com/' || conv_id || '/' || turn AS url,
         CAST({FIRST_EPOCH} + conv_id * 60 + turn AS DOUBLE)
           * CASE WHEN role = 'assistant' THEN 1000 ELSE 1 END AS created_utc,
         make_timestamp(({FIRST_EPOCH} + conv_id * 60 + turn) * 1000000) AS created_ts,
         'c' || conv_id AS id, text AS selftext, CAST(turn AS INTEGER) AS num_comments,
         'comment' AS tag
  FROM conversations
"""


# --- coins: one per event type -----------------------------------------------
def coins(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = load(spark, sf_dir, "events").select(F.col("event_type").alias("name")).distinct()
    return surrogate_key(names, ["name"], id="coin_id").select(
        "coin_id", F.upper("name").alias("symbol"), "name"
    )


COINS_SQL = """
  SELECT row_number() OVER (ORDER BY event_type) AS coin_id, upper(event_type) AS symbol,
         event_type AS name
  FROM (SELECT DISTINCT event_type FROM events)
"""
TOPICS_SQL = """
  SELECT * FROM (VALUES (CAST(1 AS BIGINT), 'coin'), (2, 'comment'), (3, 'economy'),
                        (4, 'politics')) AS t(id_topic, topic)
"""


def named(symbol: Column) -> Column:
    """Display name of the coin of an event type."""
    return F.initcap(symbol)


# --- raw candles, as the extract writes them --------------------------------------
def raw_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_candles_of(bars(spark, sf_dir))


def raw_candles_of(b: DataFrame) -> DataFrame:
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
    return b.select(
        "event_id",
        F.concat(F.upper("symbol"), F.lit("USDT")).alias("symbol"),
        named(F.col("symbol")).alias("name"),
        "interval",
        F.date_format("starttime", iso).alias("starttime"),
        F.date_format("endtime", iso).alias("endtime"),
        *[
            F.col(p).cast("double").alias(p)
            for p in ("volume", "quotevolume", "open", "close", "highest", "lowest")
        ],
        F.lit("realtime").alias("tag"),
    )


def raw_candles_sql() -> str:
    return f"""
  SELECT event_id, upper(symbol) || 'USDT' AS symbol,
         upper(symbol[1]) || symbol[2:] AS name, "interval",
         starttime, endtime, volume, quotevolume, open, close, highest, lowest,
         'realtime' AS tag
  FROM ({candles_sql()})
"""
