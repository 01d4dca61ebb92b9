"""Keys, dimensions, gold plans and sinks."""

import os
import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from marketlake import runtime
from marketlake.operators import dims, joins, keys
from marketlake.plans import gold, hour
from marketlake.plans.silver import to_silver
from marketlake.runtime import durable, work_dir
from marketlake.schemas import GOLD, RAW, SILVER
from marketlake.sinks import files, tables
from marketlake.sources.raw import raw_json_read

AS_OF = "2024-01-31 05:10:00"


@pytest.mark.parametrize("partitions", [None, 1, 7, 64])
def test_ids_are_dense_and_in_order(spark, partitions):
    df = spark.range(5_000).select(F.pmod(F.xxhash64("id"), F.lit(40)).alias("k"), "id")
    found = keys.surrogate_key(df, ["k", "id"], start=10, id="n", partitions=partitions).orderBy("n").collect()
    assert [r.n for r in found] == list(range(11, 5_011))
    assert [(r.k, r.id) for r in found] == sorted((r.k, r.id) for r in found)


def test_ids_after_the_highest(spark):
    dim = spark.createDataFrame([(4, "a", 1.0)], GOLD["author_credit"])
    comments = spark.createDataFrame(
        [("b", 1.0), ("b", 3.0), ("a", 9.0), (None, 2.0), ("c", 0.0)], "author string, score double"
    )
    new = dims.new_authors(comments, dim)
    both = dims.author_dim_union(dim, new)
    assert sorted(map(tuple, both.collect())) == [(4, "a", 1.0), (5, "b", 3.0), (6, "c", 0.0)]
    assert dims.new_authors(comments, both).count() == 0
    assert keys.fetch_max_id(dim.where("false"), "id_author") == 0


def test_static_dimensions(spark):
    assert {r.name: r.coin_id for r in dims.dim_coin(spark).collect()} == {
        "bitcoin": 1, "bnb": 2, "ethereum": 3, "solana": 4, "xrp": 5}
    assert {r.topic: r.id_topic for r in dims.dim_topic(spark).collect()} == {
        "coin": 1, "comment": 2, "economy": 3, "politics": 4}
    days = dims.dim_time(spark)
    assert days.count() == 2_557 and days.schema.names == GOLD["dim_time"].names
    saturday = days.where("timestamp_id = '20240106'").first()
    assert (saturday.day_of_week, saturday.is_weekend, saturday.week_of_year) == ("Saturday", True, 1)


def test_topic_and_coin_joins(spark):
    topic, coin = dims.dim_topic(spark), dims.dim_coin(spark)
    tags = spark.createDataFrame([("coin_news",), ("coins_news",), ("economy",), ("sport",), (None,)], "tag string")
    found = {r.tag: r.id_topic for r in joins.join_topic_dim(tags, topic).collect()}
    assert found == {"coin_news": 1, "coins_news": 1, "economy": 3, "sport": None, None: None}
    names = spark.createDataFrame([("Bitcoin",), ("bitcoin",), ("Doge",)], "name string")
    assert {r.name: r.coin_id for r in joins.join_coin_dim_name(names, coin).collect()} == {
        "Bitcoin": 1, "bitcoin": 1, "Doge": None}
    symbols = spark.createDataFrame([("BTCUSDT",), ("SOLUSDT",), ("BTCEUR",)], "symbol string")
    assert {r.symbol: r.coin_id for r in joins.join_coin_dim_prefix(symbols, coin).collect()} == {
        "BTCUSDT": 1, "SOLUSDT": 4, "BTCEUR": None}


def comments(spark, n=20):
    rows = [("bitcoin", f"t{i}", f"a{i % 3}" if i % 5 else None, float(i), f"u{i}", 1.7e9 + i, f"c{i}", "x", i, "comment")
            for i in range(n)]
    return spark.createDataFrame(rows, RAW["comments"])


def test_comments_to_gold_gives_declared_columns(spark):
    silver = to_silver(comments(spark), "comments", AS_OF)
    assert silver.schema.names == SILVER["comments"].names
    none = spark.createDataFrame([], GOLD["author_credit"])
    rows, authors = gold.comments_to_gold(silver, dims.dim_topic(spark), dims.dim_coin(spark), none)
    assert rows.schema.names == GOLD["dim_comments"].names and rows.count() == 20
    assert sorted(r.id_author for r in authors.collect()) == [1, 2, 3]
    assert rows.where("id_author IS NULL").count() == 4
    first = rows.where("id = 'c1'").first()
    assert (first.coin_id, first.id_topic, first.timestamp_id, first.hour) == (1, 2, "20231114", 5)


def test_gold_append_adds_nothing_twice(spark):
    root = work_dir(spark, "gold")
    days = dims.dim_time(spark, datetime(2024, 1, 1).date(), datetime(2024, 3, 31).date())
    path = tables.gold_append(days, "dim_time", root, ["timestamp_id"])
    stored = lambda: spark.read.parquet(path)
    more = dims.dim_time(spark, datetime(2024, 3, 1).date(), datetime(2024, 4, 30).date())
    tables.gold_append(more, "dim_time", root, ["timestamp_id"], stored())
    tables.gold_append(more, "dim_time", root, ["timestamp_id"], stored())
    assert stored().count() == stored().select("timestamp_id").distinct().count() == 121


def test_landing_and_messages(spark):
    root, rows = work_dir(spark, "raw"), comments(spark)
    hour = datetime(2024, 1, 31, 5)
    folder = files.raw_landing_write(rows, root, "comments", hour)
    files.raw_landing_write(rows, root, "comments", hour)
    assert folder.endswith("/comments/2024/01/31/05")
    assert raw_json_read(spark, root, "comments", hour).count() == 40
    message = files.topic_messages(rows).first().value
    assert message.startswith('{"subreddit":"bitcoin"')


def test_an_hour_of_news_makes_no_working_copy_of_its_texts(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(runtime, "work_dir", lambda _, purpose: f"{tmp_path}/work/{purpose}-{uuid.uuid4().hex}")
    root, at = f"{tmp_path}/root", datetime(2024, 1, 1, 5)
    text = "word " * 200
    rows = [(f"https://a.example/{i % 38}", f"t{i:02}", f"{text}{i}", f"2024-01-01T04:{i:02}:00Z") for i in range(40)]
    df = spark.createDataFrame(rows, "url string, title string, text string, published string")
    files.raw_landing_write(df.selectExpr("*", "'d' AS domain", "'s' AS source", "'economy' AS tag", "'a' AS author"), f"{root}/raw", "news", at)
    for _ in range(2):
        hour.news_hour(spark, root, at, dims.dim_topic(spark))
    stored = hour.gold_table(spark, root, "dim_news").orderBy("id").collect()
    assert [(r["id"], r["title"]) for r in stored] == [(i + 1, f"t{i:02}") for i in range(38)]
    copies = [spark.read.parquet(f"{tmp_path}/work/{d}") for d in os.listdir(f"{tmp_path}/work")]
    assert sum(t.count() for t in copies if "text" in t.columns) == 4  # the kept rows of two repeated urls, twice


def test_created_tables_take_rows(spark):
    root = work_dir(spark, "lake")
    names = tables.lakehouse_ddl(spark, root, "t1_")
    assert len(names) == 13
    assert tables.lakehouse_ddl(spark, root, "t1_") == names
    tables.silver_append(comments(spark), "comments", root, AS_OF)
    spark.sql("MSCK REPAIR TABLE t1_silver.comments")
    stored = spark.read.table("t1_silver.comments")
    assert stored.count() == 20 and stored.schema.names == SILVER["comments"].names
    plan = stored.where("day = 31 AND hour = 5")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan


def test_work_lies_in_the_shared_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert work_dir(spark, "x").startswith(named)
    kept = durable(spark.range(10))
    assert kept.count() == 10
    assert all(named in f for f in kept.inputFiles())
