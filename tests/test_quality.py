"""Duplicates, filters, profiles, contracts and rules on hand-made rows."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from marketlake.operators import dedup, filters, profile, rules, topk
from marketlake.plans import quality_jobs
from marketlake.schemas import (
    COMMENTS_CONTRACT,
    NEWS_CONTRACT,
    RAW,
    SENTIMENT_CONTRACT,
    TECHNICAL_CONTRACT,
    Contract,
    contract_is_backward,
)
from marketlake.sources.contracts import schema_contract_check

PAIR = "url string, title string"


def test_first_title_is_kept_and_null_is_one_key(spark):
    df = spark.createDataFrame(
        [("u", "b"), ("u", "a"), (None, "x"), (None, "y"), ("v", "c"), ("v", "c")], PAIR
    )
    kept = sorted(map(tuple, dedup.dedup_keep_first(df, ["url"], ["title"]).collect()), key=str)
    assert kept == [("u", "a"), ("v", "c"), (None, "x")]
    left = sorted(map(tuple, dedup.duplicate_report(df, ["url"], ["title"]).collect()), key=str)
    assert left == [("u", "b", 2), ("v", "c", 2), (None, "y", 2)]


def test_few_repeated_keys_give_the_same_rows(spark):
    rows = [("u", "b", 1), ("u", "a", 2), ("u", "a", 1), (None, "y", 1), (None, "x", 2), ("v", None, 3), ("v", None, 3), ("w", "t", 4)]
    df = spark.createDataFrame([*rows, *[(f"k{i}", "t", i) for i in range(200)]], "url string, title string, n int")
    kept, same = (f(df, ["url"], ["title"]) for f in (dedup.dedup_where_repeated, dedup.dedup_keep_first))
    assert kept.columns == same.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(map(tuple, same.collect()), key=str)
    assert dedup.dedup_where_repeated(df.limit(0), ["url"], ["title"]).collect() == []


@pytest.mark.parametrize("copies", [1, 5, 1000])
def test_kept_and_left_out_rows_make_the_table(spark, copies):
    """One key holds a third of all rows, as equal and as different rows."""
    base = spark.range(30).select(
        F.when(F.col("id") < 10, "hot").otherwise(F.col("id").cast("string")).alias("url"),
        (F.col("id") % 3).cast("string").alias("title"),
    )
    df = base.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("n")
    kept = dedup.dedup_keep_first(df, ["url"], ["title"])
    left = dedup.duplicate_report(df, ["url"], ["title"])
    assert kept.count() == 21
    assert left.count() == df.count() - 21
    assert kept.unionAll(left.drop("key_rows")).exceptAll(df).count() == 0


def test_profile_counts_null_once_and_blank_once(spark):
    df = spark.createDataFrame([("", 1), (None, 2), ("", 2), ("a", None), (None, None)], "t string, n int")
    found = {r["column"]: r for r in profile.profile(df).collect()}
    t, n = found["t"], found["n"]
    assert (t.n_rows, t.n_null, t.n_blank, t.n_distinct, t.dtype) == (5, 2, 2, 3, "string")
    assert (n.n_null, n.n_blank, n.n_distinct, n.min_value, n.max_value) == (2, 0, 3, "1", "2")
    assert {r["column"]: r.n_distinct for r in profile.distinct_profile(df).collect()} == {"t": 3, "n": 3}


def test_recency_bounds_and_unreadable_times(spark):
    texts = [
        "2024-01-01T08:00:00Z", "2024-01-01T11:59:59.999Z", "Mon, 01 Jan 2024 08:00:00 GMT",
        "Mon, 01 Jan 2024 09:30:00 +0000", "2024-01-01T12:00:00Z", "2024-01-01T07:59:59Z",
        "yesterday", "", None,
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    kept = filters.recency_filter(df, "t", datetime(2024, 1, 1, 12))
    assert sorted(r.i for r in kept.collect()) == [0, 1, 2, 3]
    numbers = spark.createDataFrame([(0, 1.7e9), (1, 1.7e12), (2, None), (3, 1.6e9)], "i int, t double")
    kept = filters.recency_filter(numbers, "t", "2023-11-14 22:13:21")
    assert sorted(r.i for r in kept.collect()) == [0, 1]
    assert [r.i for r in filters.threshold_filter(numbers, "t", "2023-11-14 22:13:19").collect()] == [0, 1]


def test_latest_partition_of_a_month_before(spark):
    rows = [(1, 2023, 12, 31, 23), (2, 2023, 12, 31, 22), (3, 2023, 11, 30, 23), (4, 2023, 12, 31, 23)]
    df = spark.createDataFrame(rows, "i int, year int, month int, day int, hour int")
    assert sorted(r.i for r in filters.latest_partition_filter(df).collect()) == [1, 4]
    with pytest.raises(ValueError):
        filters.latest_partition_filter(df.where("i > 9"))


def test_top_k_of_a_hot_group(spark):
    df = spark.range(5_000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("g")
    )
    found = topk.top_k(df.repartition(9), ["g"], [F.col("id").desc()], 7, heaps=4)
    expected = {}
    for r in df.collect():
        expected.setdefault(r.g, []).append(r.id)
    got = {}
    for r in found.collect():
        got.setdefault(r.g, []).append(r.id)
    assert {g: sorted(v) for g, v in got.items()} == {g: sorted(v)[-7:] for g, v in expected.items()}


def test_contract(spark):
    contract = Contract("c", {"a": "string", "n": "number", "i": "integer", "o": "string"}, frozenset({"o"}))
    lines = [
        '{"a":"x","n":1.5,"i":1.0}', '{"a":"x","n":1,"i":2,"o":"o"}', '{"n":1,"i":1}', '{"a":"x","n":"1","i":1}',
        '{"a":"x","n":1,"i":1.5}',
    ]
    df = spark.createDataFrame([(x,) for x in lines], "v string").select(
        *[F.variant_get(F.parse_json("v"), f"$.{n}", "variant").alias(n) for n in "anio"]
    )
    valid, rejected = schema_contract_check(df, contract)
    assert valid.count() == 2
    assert sorted(r.violations for r in rejected.collect()) == [["a:missing"], ["i:not integer"], ["n:not number"]]
    _, without = schema_contract_check(df.drop("i"), contract)
    assert without.count() == 5


def test_backward_contracts():
    old = Contract("c", {"a": "string", "n": "integer"})
    assert contract_is_backward(old, old)
    assert contract_is_backward(old, Contract("c", {"a": "string"}))
    assert contract_is_backward(old, Contract("c", {"a": "string", "n": "number"}))
    assert contract_is_backward(old, Contract("c", {**old.properties, "b": "string"}, frozenset({"b"})))
    assert not contract_is_backward(old, Contract("c", {**old.properties, "b": "string"}))
    assert not contract_is_backward(old, Contract("c", {"a": "number", "n": "integer"}))
    assert not contract_is_backward(Contract("c", {"a": "string"}, frozenset({"a"})), Contract("c", {"a": "string"}))


def test_contracts_cover_the_records():
    assert set(NEWS_CONTRACT.properties) == set(RAW["news"].names) - {"authors"}
    assert set(COMMENTS_CONTRACT.properties) == set(RAW["comments"].names)
    renamed = lambda names: {"realtime_id" if n == "event_id" else n for n in names}
    assert set(TECHNICAL_CONTRACT.properties) == renamed(RAW["statistic"].names)
    assert set(SENTIMENT_CONTRACT.properties) == renamed(RAW["sentiment"].names)


def news(spark, rows):
    return spark.createDataFrame(
        [("d", t, u, x, p, a, s, "src", "economy") for t, u, x, p, a, s in rows], RAW["news"]
    )


def test_news_job(spark):
    day = "2024-01-01T00:00:00Z"
    raw = news(spark, [
        ("b", "u1", "text", day, "ann", None), ("a", "u1", "text", day, None, "gnews"),
        ("c", "u2", "", day, None, None), ("d", "u3", "text", None, None, None),
        (None, "u4", "text", day, None, None),
    ])
    result = quality_jobs.news_quality(raw)
    assert [(r.title, r.author) for r in result.clean.collect()] == [("a", "gnews")]
    assert [r.violations for r in result.rejected.collect()] == [["title:missing"]]
    assert [(r.title, r.key_rows) for r in result.duplicates().collect()] == [("b", 2)]
    assert result.dates().first().min_date == datetime(2024, 1, 1)
    raw_profile = {r["column"]: r for r in result.raw_profile().collect()}
    assert (raw_profile["text"].n_blank, raw_profile["published"].n_null) == (1, 1)
    assert {r["column"]: r.n_distinct for r in result.clean_profile().collect()}["url"] == 2


def test_rules_on_edge_cases(spark):
    day = datetime(2024, 1, 2, 9)
    rows = [
        (1, "a", "2024-01-01", 5.0, day, 10.0), (2, "", "1970-01-01", 500.0, datetime(2024, 1, 3, 11), 11.0),
        (2, " b", "01/02/2024", None, None, 10.0), (None, "cc", None, -1.0, day, 20.0),
    ]
    df = spark.createDataFrame(rows, "id int, name string, day string, x double, at timestamp, twice double")
    target = spark.createDataFrame([(1,)], "key int")
    as_of = "2024-01-03 00:00:00"
    checks = {
        "not_null": (rules.not_null("id"), 1),
        "required_fields": (rules.required_fields("id", "day", "x"), 2),
        "no_empty_string": (rules.no_empty_string("name"), 1),
        "min_row_count": (rules.min_row_count(6), 2),
        "unique_column": (rules.unique_column("id"), 1),
        "unique_combination": (rules.unique_combination("id", "name"), 0),
        "no_duplicate_rows": (rules.no_duplicate_rows(), 0),
        "data_type": (rules.data_type("name", "int"), 4),
        "date_format": (rules.date_format("day"), 2),
        "enumeration": (rules.enumeration("name", ["a", "cc"]), 2),
        "numeric_range": (rules.numeric_range("x", 0, 100), 2),
        "no_future": (rules.no_future("at", as_of), 1),
        "recent": (rules.recent("at", "2024-01-04 00:00:00", 12), 1),
        "arrival_time": (rules.arrival_time("at"), 1),
        "length": (rules.length("name", 1), 2),
        "trimmed": (rules.trimmed("name"), 1),
        "arithmetic": (rules.arithmetic("twice", F.col("x") * 2), 2),
        "pattern": (rules.pattern("name", "^[a-z]+$"), 2),
        "referential": (rules.referential("id", target, "key"), 2),
        "implication": (rules.implication("name", F.col("id") == 2, F.col("name") == ""), 1),
        "cross_field": (rules.cross_field("x", F.col("id") == 2, F.col("x") > 100), 1),
    }
    found = {r.rule: r for r in rules.dq_check(df, [rule for rule, _ in checks.values()]).collect()}
    assert {name: found[name].failed_rows for name in checks} == {name: n for name, (_, n) in checks.items()}
    assert all(r.total_rows == 4 and r.passed == (r.failed_rows == 0) for r in found.values())
