"""Queries: profiles and other aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.times import partition_parts
from ..operators import keys, sketches
from ..operators import profile as pf
from ..operators.filters import as_instant
from ..runtime import durable
from .base import COMMENTS_SQL, NEWS_SQL, comments, load, news, query


@query("row_count", f"SELECT count(*) AS n_rows FROM ({NEWS_SQL}) WHERE text <> ''")
def _(spark, sf):
    return pf.row_count(news(spark, sf).where(F.col("text") != ""))


NEWS_COLUMNS = ("domain", "title", "url", "text", "published", "author", "authors", "source", "tag")


@query("null_blank_profile", " UNION ALL ".join(f"""
  SELECT '{c}' AS "column", count(*) AS n_rows, count(*) - count({c}) AS n_null,
         CAST(coalesce(sum(CASE WHEN CAST({c} AS VARCHAR) = '' THEN 1 END), 0) AS BIGINT) AS n_blank
  FROM ({COMMENTS_SQL})""" for c in ("title", "url", "id", "selftext", "score", "author")))
def _(spark, sf):
    names = ["title", "url", "id", "selftext", "score", "author"]
    return pf.null_blank_profile(comments(spark, sf), names)


@query("distinct_profile", " UNION ALL ".join(f"""
  SELECT '{c}' AS "column", count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS n_distinct
  FROM ({NEWS_SQL})""" for c in NEWS_COLUMNS))
def _(spark, sf):
    return pf.distinct_profile(news(spark, sf))


SKETCHED = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_returnflag", "l_linestatus", "l_shipdate")


@query("distinct_sketches", " UNION ALL ".join(f"""
  SELECT '{c}' AS "column", count(*) AS n_rows, count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS n_distinct,
         TRUE AS within FROM lineitem""" for c in SKETCHED))
def _(spark, sf):
    """Sketches of every day of shipping, stored, merged over all days, and held against exact counts."""
    rows = load(spark, sf, "lineitem")
    stored = durable(sketches.distinct_sketches(rows, [F.to_date("l_shipdate").alias("day")], SKETCHED))
    exact = durable(pf.distinct_profile(rows, list(SKETCHED)))
    both = sketches.distinct_estimate(stored).join(exact, "column")
    off = F.abs(F.col("n_estimate") - F.col("n_distinct"))
    within = off <= F.col("n_distinct") * F.lit(sketches.relative_error())
    return both.select("column", "n_rows", "n_distinct", within.alias("within"))


@query("date_bounds", f"""
  SELECT min(published_ts) AS min_date, max(published_ts) AS max_date FROM ({NEWS_SQL})""")
def _(spark, sf):
    rows = news(spark, sf)
    return pf.date_bounds(rows, as_instant(rows, "published"))


@query("max_hour", "SELECT CAST(max(hour(ts)) AS INTEGER) AS max_hour FROM events")
def _(spark, sf):
    return pf.max_hour(load(spark, sf, "events").withColumns(partition_parts("ts")))


@query("max_surrogate_id", "SELECT coalesce(max(o_orderkey), 0) AS max_id FROM orders")
def _(spark, sf):
    return keys.max_surrogate_id(load(spark, sf, "orders"), "o_orderkey")


@query("dtype_profile", """
  SELECT CAST(ordinal_position - 1 AS INTEGER) AS position, column_name AS "column",
         CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
              WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' END AS dtype
  FROM (SELECT row_number() OVER () AS ordinal_position, * FROM (
          SELECT column_name, column_type AS data_type FROM (DESCRIBE lineitem)))""")
def _(spark, sf):
    return pf.dtype_profile(load(spark, sf, "lineitem"))


@query("surrogate_key", f"""
  SELECT title, url, published, 1000 + row_number() OVER (ORDER BY published, url, title) AS id
  FROM ({NEWS_SQL})""")
def _(spark, sf):
    rows = news(spark, sf).select("title", "url", "published")
    return keys.surrogate_key(rows, ["published", "url", "title"], start=1000)
