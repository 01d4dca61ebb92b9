"""Queries: data-quality rules over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import rules as r
from .base import load, query


def verdict(rule: str, column: str, failed: str, source: str, total: str = "count(*)") -> str:
    """The row of one rule, from an aggregate that counts failures."""
    return f"""
  SELECT '{rule}' AS rule, '{column}' AS "column", CAST({failed} AS BIGINT) AS failed_rows,
         CAST({total} AS BIGINT) AS total_rows, {failed} = 0 AS passed FROM {source}"""


def where(condition: str) -> str:
    return f"coalesce(sum(CASE WHEN {condition} THEN 1 ELSE 0 END), 0)"


def surplus(columns: str, table: str) -> str:
    return f"(SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM {table} GROUP BY {columns}))"


def check(name, table, sql, make):
    """Register one rule on one table; ``make`` builds the rule from (spark, sf)."""

    @query(name, sql)
    def _(spark, sf):
        return r.dq_check(table(spark, sf), [make(spark, sf)])


def of(name):
    return lambda spark, sf: load(spark, sf, name)


def labeled(spark, sf):
    """Documents with the labels some of them have."""
    labels = load(spark, sf, "labels")
    return load(spark, sf, "documents").select("doc_id", "lang", "source").join(labels, "doc_id", "left")


LABELED = "(SELECT d.doc_id, lang, source, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"


def shipped(spark, sf):
    lines = load(spark, sf, "lineitem").select("l_orderkey", "l_shipdate")
    orders = load(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


SHIPPED = "(SELECT l_shipdate, o_orderdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"

check("dq_not_null", labeled, verdict("not_null", "quality", where("quality IS NULL"), LABELED),
      lambda s, sf: r.not_null("quality"))
check("dq_required_fields", labeled,
      verdict("required_fields", "lang,source,toxic", where("lang IS NULL OR source IS NULL OR toxic IS NULL"), LABELED),
      lambda s, sf: r.required_fields("lang", "source", "toxic"))


def trimmed_markup(spark, sf):
    """What is left of each event payload once its digits are gone from short ones."""
    short = F.regexp_replace("props", r'^\{"k": \d\}$', "")
    return load(spark, sf, "events").select("event_id", short.alias("props"))


check("dq_no_empty_string", trimmed_markup,
      verdict("no_empty_string", "props", where("""regexp_matches(props, '^\\{"k": \\d\\}$')"""), "events"),
      lambda s, sf: r.no_empty_string("props"))
check("dq_min_row_count", of("lineitem"),
      verdict("min_row_count", "*", "greatest(100000 - count(*), 0)", "lineitem"),
      lambda s, sf: r.min_row_count(100_000))
check("dq_unique_column", of("lineitem"),
      verdict("unique_column", "l_orderkey", surplus("l_orderkey", "lineitem"), "lineitem"),
      lambda s, sf: r.unique_column("l_orderkey"))
check("dq_no_duplicate_rows", lambda s, sf: load(s, sf, "documents").select("text", "lang"),
      verdict("no_duplicate_rows", "*", surplus("text, lang", "documents"), "documents"),
      lambda s, sf: r.no_duplicate_rows())
check("dq_unique_combination", of("lineitem"),
      verdict("unique_combination", "l_orderkey,l_linenumber", surplus("l_orderkey, l_linenumber", "lineitem"), "lineitem"),
      lambda s, sf: r.unique_combination("l_orderkey", "l_linenumber"))
check("dq_data_type", lambda s, sf: load(s, sf, "orders").withColumn("code", F.substring("o_orderpriority", 3, 2)),
      verdict("data_type", "code", where("TRY_CAST(substring(o_orderpriority, 3, 2) AS INTEGER) IS NULL"), "orders"),
      lambda s, sf: r.data_type("code", "int"))


def order_days(spark, sf):
    """Order dates as text; open orders write the day first."""
    day = F.when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "dd/MM/yyyy"))
    return load(spark, sf, "orders").select(
        "o_orderkey", F.coalesce(day, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day")
    )


check("dq_date_format", order_days, verdict("date_format", "day", where("o_orderstatus = 'O'"), "orders"),
      lambda s, sf: r.date_format("day"))
check("dq_enumeration", of("orders"),
      verdict("enumeration", "o_orderstatus", where("o_orderstatus NOT IN ('O', 'F')"), "orders"),
      lambda s, sf: r.enumeration("o_orderstatus", ["O", "F"]))
check("dq_numeric_range", of("lineitem"),
      verdict("numeric_range", "l_discount", where("l_discount NOT BETWEEN 0.02 AND 0.08"), "lineitem"),
      lambda s, sf: r.numeric_range("l_discount", 0.02, 0.08))
check("dq_date_logic", shipped,
      verdict("date_logic", "o_orderdate,l_shipdate", where("o_orderdate > l_shipdate"), SHIPPED),
      lambda s, sf: r.date_logic("o_orderdate", "l_shipdate"))
check("dq_cross_field", of("lineitem"),
      verdict("cross_field", "l_linestatus", where("l_returnflag = 'R' AND l_linestatus = 'O'"), "lineitem"),
      lambda s, sf: r.cross_field("l_linestatus", F.col("l_returnflag") == "R", F.col("l_linestatus") == "O"))
check("dq_length", of("documents"), verdict("length", "text", where("length(text) > 1000"), "documents"),
      lambda s, sf: r.length("text", 1000))
check("dq_trimmed", lambda s, sf: load(s, sf, "part").withColumn("word", F.regexp_extract("p_name", r"^\w+ ?", 0)),
      verdict("trimmed", "word", where("regexp_extract(p_name, '^\\w+ ?') <> trim(regexp_extract(p_name, '^\\w+ ?'))"), "part"),
      lambda s, sf: r.trimmed("word"))
AS_OF = "2024-01-31 06:00:00"
check("dq_recent", of("events"),
      verdict("recent", "ts", f"CASE WHEN max(ts) < TIMESTAMP '{AS_OF}' - INTERVAL 4 HOURS THEN 1 ELSE 0 END", "events"),
      lambda s, sf: r.recent("ts", AS_OF, 4))
check("dq_no_future", of("orders"),
      verdict("no_future", "o_orderdate", where("o_orderdate > TIMESTAMP '2001-01-01'"), "orders"),
      lambda s, sf: r.no_future("o_orderdate", "2001-01-01"))
check("dq_arrival_time", of("events"),
      verdict("arrival_time", "ts",
              "(SELECT count(*) FROM (SELECT min(ts) AS first FROM events GROUP BY CAST(ts AS DATE)) WHERE strftime(first, '%H:%M:%S') > '00:05:00')",
              "events"),
      lambda s, sf: r.arrival_time("ts", "00:05:00"))
check("dq_implication", of("orders"),
      verdict("implication", "o_orderpriority", where("o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT'"), "orders"),
      lambda s, sf: r.implication("o_orderpriority", F.col("o_orderstatus") == "F", F.col("o_orderpriority") == "1-URGENT"))
check("dq_arithmetic", of("lineitem"),
      verdict("arithmetic", "l_extendedprice", where("abs(l_extendedprice - l_quantity * 2000.0::DOUBLE) > 10000.0"), "lineitem"),
      lambda s, sf: r.arithmetic("l_extendedprice", F.col("l_quantity") * 2000.0, 10_000.0))
check("dq_pattern", of("pages"),
      verdict("pattern", "url", where(r"NOT regexp_matches(url, '^https?://[^/]*\.example\.(org|net)/')"), "pages"),
      lambda s, sf: r.pattern("url", r"^https?://[^/]*\.example\.(org|net)/"))
check("dq_referential", of("documents"),
      verdict("referential", "doc_id", where("doc_id NOT IN (SELECT doc_id FROM labels)"), "documents"),
      lambda s, sf: r.referential("doc_id", load(s, sf, "labels"), "doc_id"))


@query("dq_check", " UNION ALL ".join([
    verdict("not_null", "l_partkey", where("l_partkey IS NULL"), "lineitem"),
    verdict("enumeration", "l_returnflag", where("l_returnflag NOT IN ('A', 'N')"), "lineitem"),
    verdict("numeric_range", "l_quantity", where("l_quantity NOT BETWEEN 1 AND 40"), "lineitem"),
    verdict("no_future", "l_shipdate", where("l_shipdate > TIMESTAMP '2001-06-01'"), "lineitem"),
    verdict("min_row_count", "*", "greatest(10 - count(*), 0)", "lineitem"),
    verdict("unique_combination", "l_orderkey,l_linenumber", surplus("l_orderkey, l_linenumber", "lineitem"), "lineitem"),
    verdict("referential", "l_orderkey", where("l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')"), "lineitem"),
]))
def _(spark, sf):
    """Row, table, uniqueness and reference rules of one table together."""
    settled = load(spark, sf, "orders").where("o_orderstatus <> 'P'")
    return r.dq_check(
        load(spark, sf, "lineitem"),
        [
            r.not_null("l_partkey"),
            r.enumeration("l_returnflag", ["A", "N"]),
            r.numeric_range("l_quantity", 1, 40),
            r.no_future("l_shipdate", "2001-06-01"),
            r.min_row_count(10),
            r.unique_combination("l_orderkey", "l_linenumber"),
            r.referential("l_orderkey", settled, "o_orderkey"),
        ],
    )
