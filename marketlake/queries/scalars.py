"""Queries: scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numbers, text, times
from .base import COMMENTS_SQL, NEWS_SQL, comments, load, news, query


def parts_sql(ts: str) -> str:
    names = {"year": "year", "month": "month", "day": "day", "hour": "hour",
             "week_of_year": "weekofyear", "quarter": "quarter"}
    return ", ".join(f"CAST({fn}({ts}) AS INTEGER) AS {n}" for n, fn in names.items())


@query("date_parts", f"SELECT event_id, {parts_sql('ts')} FROM events")
def _(spark, sf):
    parts = times.date_parts("ts")
    return load(spark, sf, "events").select("event_id", *[c.alias(n) for n, c in parts.items()])


@query("date_key", "SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS timestamp_id FROM orders")
def _(spark, sf):
    orders = load(spark, sf, "orders")
    return orders.select("o_orderkey", times.date_key("o_orderdate").alias("timestamp_id"))


@query("day_name_weekend", """
  SELECT o_orderkey, dayname(o_orderdate) AS day_of_week, dayofweek(o_orderdate) IN (0, 6) AS is_weekend
  FROM orders""")
def _(spark, sf):
    return load(spark, sf, "orders").select(
        "o_orderkey",
        times.day_name("o_orderdate").alias("day_of_week"),
        times.is_weekend("o_orderdate").alias("is_weekend"),
    )


# Notations of one instant: how DuckDB writes it, and what of it must come back.
NOTATIONS = {
    "iso": ("%Y-%m-%dT%H:%M:%SZ", "second"),
    "millis": ("%Y-%m-%dT%H:%M:%S.%gZ", "millisecond"),
    "micros": ("%Y-%m-%dT%H:%M:%S.%fZ", "microsecond"),
    "offset": ("%Y-%m-%dT%H:%M:%S+00:00", "second"),
    "millis_offset": ("%Y-%m-%dT%H:%M:%S.%g+00:00", "millisecond"),
    "offset_plain": ("%Y-%m-%dT%H:%M:%S+0000", "second"),
    "no_zone": ("%Y-%m-%dT%H:%M:%S", "second"),
    "millis_no_zone": ("%Y-%m-%dT%H:%M:%S.%g", "millisecond"),
    "blank": ("%Y-%m-%d %H:%M:%S", "second"),
    "day": ("%Y-%m-%d", "day"),
    "mail": ("%a, %d %b %Y %H:%M:%S GMT", "second"),
    "mail_offset": ("%a, %d %b %Y %H:%M:%S +0000", "second"),
    "mail_minutes": ("%a, %d %b %Y %H:%M GMT", "minute"),
}
# The same patterns as Spark writes them.
SPARK_PATTERN = {
    "iso": "yyyy-MM-dd'T'HH:mm:ss'Z'", "millis": "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'", "micros": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'",
    "offset": "yyyy-MM-dd'T'HH:mm:ss'+00:00'", "millis_offset": "yyyy-MM-dd'T'HH:mm:ss.SSS'+00:00'",
    "offset_plain": "yyyy-MM-dd'T'HH:mm:ss'+0000'", "no_zone": "yyyy-MM-dd'T'HH:mm:ss", "millis_no_zone": "yyyy-MM-dd'T'HH:mm:ss.SSS",
    "blank": "yyyy-MM-dd HH:mm:ss", "day": "yyyy-MM-dd", "mail": "E, dd MMM yyyy HH:mm:ss 'GMT'",
    "mail_offset": "E, dd MMM yyyy HH:mm:ss '+0000'", "mail_minutes": "E, dd MMM yyyy HH:mm 'GMT'",
}


@query("parse_timestamp", "SELECT event_id, " + ", ".join(
    f"date_trunc('{part}', ts)::TIMESTAMP AS {name}" for name, (_, part) in NOTATIONS.items()
) + ", CAST(NULL AS TIMESTAMP) AS garbage FROM events")
def _(spark, sf):
    """The same instant in every notation, and a text that is no date."""
    # To parse a row costs many times what it costs to read it, and a table in a few row groups is read by as few tasks.
    # The number is given, as Spark would merge the rows, narrow as they are, to few tasks again.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    events = load(spark, sf, "events").select("event_id", "ts", "props").repartition(tasks, "event_id")
    at = F.col("ts").cast("timestamp")
    written = {name: times.parse_timestamp(F.date_format(at, pattern)) for name, pattern in SPARK_PATTERN.items()}
    return events.select("event_id", *[c.alias(n) for n, c in written.items()], times.parse_timestamp("props").alias("garbage"))


@query("unreadable_date", """
  SELECT event_id, CASE WHEN event_id % 3 = 0 THEN event_type ELSE 'soon' END AS published
  FROM events WHERE event_id % 3 < 2 AND (event_id % 3 = 1 OR event_type <> '')""")
def _(spark, sf):
    """Events whose date text says something that is no date: the rows a time filter would lose."""
    third = F.pmod("event_id", F.lit(3))
    text = F.when(third == 0, F.col("event_type")).when(third == 1, "soon").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    rows = load(spark, sf, "events").select("event_id", text.alias("published"))
    return rows.where(times.unreadable_date("published"))


@query("epoch_to_timestamp", f"SELECT url, created_ts FROM ({COMMENTS_SQL})")
def _(spark, sf):
    return comments(spark, sf).select("url", times.epoch_to_timestamp("created_utc").alias("created_ts"))


@query("display_timezone", "SELECT event_id, ts + INTERVAL 7 HOURS AS local_ts FROM events")
def _(spark, sf):
    local = times.display_timezone(F.col("ts").cast("timestamp"))
    return load(spark, sf, "events").select("event_id", local.alias("local_ts"))


@query("round_half_up", """
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity,
         CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2)), 2) AS DOUBLE) AS saved
  FROM lineitem""")
def _(spark, sf):
    money = lambda n: F.col(n).cast("decimal(18,2)")
    saved = numbers.round_half_up(money("l_extendedprice") * money("l_discount"))
    return load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
        saved.alias("saved"),
    )


@query("substring_prefix", "SELECT c_custkey, substring(c_mktsegment, 1, 3) AS prefix FROM customer")
def _(spark, sf):
    prefix = numbers.substring_prefix("c_mktsegment")
    return load(spark, sf, "customer").select("c_custkey", prefix.alias("prefix"))


@query("abs_greatest", """
  SELECT c_custkey, greatest(abs(c_acctbal), abs(c_nationkey)) AS largest FROM customer""")
def _(spark, sf):
    largest = numbers.abs_greatest("c_acctbal", "c_nationkey")
    return load(spark, sf, "customer").select("c_custkey", largest.alias("largest"))


@query("fill_zero", """
  SELECT d.doc_id, coalesce(l.quality, 0) AS quality, coalesce(l.toxic, 0) AS toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def _(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id")
    return numbers.fill_zero(docs.join(load(spark, sf, "labels"), "doc_id", "left"), "quality", "toxic")


@query("coalesce_default", f"""
  SELECT title, coalesce(author, '') AS author, coalesce(authors, 'none') AS authors FROM ({NEWS_SQL})""")
def _(spark, sf):
    return news(spark, sf).select(
        "title",
        numbers.coalesce_default("author", "").alias("author"),
        numbers.coalesce_default("authors", "none").alias("authors"),
    )


@query("epoch_diff_seconds", """
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
         CAST(epoch_us(l_shipdate) - epoch_us(o_orderdate) AS DOUBLE) / 1000000 AS seconds,
         epoch_us(l_shipdate) - epoch_us(o_orderdate) >= 86400000000 AS expired
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def _(spark, sf):
    both = load(spark, sf, "lineitem").join(
        load(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    at = lambda n: F.col(n).cast("timestamp")
    seconds = times.epoch_diff_seconds(at("l_shipdate"), at("o_orderdate"))
    return both.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        seconds.alias("seconds"), (seconds >= 86_400).alias("expired"),
    )


@query("price_direction", """
  SELECT o_orderkey, CASE WHEN o_totalprice - c_acctbal > 0 THEN 'green'
                          WHEN o_totalprice - c_acctbal < 0 THEN 'red' ELSE 'gray' END AS color
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def _(spark, sf):
    both = load(spark, sf, "orders").join(
        load(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left"
    )
    diff = F.col("o_totalprice") - F.col("c_acctbal")
    return both.select("o_orderkey", numbers.price_direction(diff).alias("color"))


@query("metric_format", """
  SELECT p_partkey, printf('%.2f', p_retailprice) AS price,
         coalesce(printf('%.2f', CASE WHEN p_size > 25 THEN CAST(p_size AS DOUBLE) END), 'null') AS size
  FROM part""")
def _(spark, sf):
    return load(spark, sf, "part").select(
        "p_partkey",
        numbers.metric_format("p_retailprice").alias("price"),
        numbers.metric_format(F.when(F.col("p_size") > 25, F.col("p_size"))).alias("size"),
    )


COMMON = ("that", "nicht", "mente")


@query("search_or_query", f"""
  SELECT doc_id, source, regexp_matches(text, '{text.word_pattern(text.ECONOMY_TERMS)}') AS economy,
         regexp_matches(text, '{text.word_pattern(COMMON)}') AS common FROM documents""")
def _(spark, sf):
    return load(spark, sf, "documents").select(
        "doc_id",
        "source",
        text.search_or_query("text").alias("economy"),
        text.search_or_query("text", COMMON).alias("common"),
    )


@query("json_get_set", """
  SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' AS message FROM events""")
def _(spark, sf):
    return load(spark, sf, "events").select(
        "event_id",
        text.json_get("props", "k int").k.alias("k"),
        text.json_set("event_id", "event_type").alias("message"),
    )


@query("ingest_time", """
  SELECT doc_id, TIMESTAMP '2024-01-01 00:00:00' AS ingested, 2024 AS year, 1 AS month, 1 AS day, 0 AS hour
  FROM documents""")
def _(spark, sf):
    at = times.ingest_time("2024-01-01 00:00:00")
    docs = load(spark, sf, "documents").select("doc_id", at.alias("ingested"))
    return docs.withColumns(times.partition_parts("ingested"))
