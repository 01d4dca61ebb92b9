"""Every registered query against its SQL, on the smallest tables."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from marketlake.queries import ORACLES, QUERIES

from .conftest import SMALL

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()
DUCK_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return con


def in_order(rows):
    return sorted((tuple(map(str, r)) for r in rows))


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


def test_entry_points_need_no_session():
    code = "import __spark_entry__ as e; assert e.queries().keys() >= e.oracle_sql().keys()"
    subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parent.parent, check=True, timeout=120)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    found = df.select(*[f"`{c}`" for c in columns]).collect()
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    assert sorted(names) == columns
    assert {c: DUCK_TYPE[t] for c, t in df.dtypes} == kinds
    places = [names.index(c) for c in columns]
    expected = [tuple(row[i] for i in places) for row in result.fetchall()]
    assert in_order(found) == in_order(expected)


def test_date_texts_of_one_row_group_are_parsed_by_several_tasks(spark, tmp_path):
    at = F.timestamp_seconds(F.col("id") * 7).cast("timestamp_ntz").alias("ts")
    rows = spark.range(400_000).select(F.col("id").alias("event_id"), at, F.md5(F.col("id").cast("string")).alias("props"))
    rows.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    parsed = QUERIES["parse_timestamp"](spark, str(tmp_path))
    assert parsed.select(F.spark_partition_id()).distinct().count() > 1
