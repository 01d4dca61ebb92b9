"""Quality jobs that write their rows and report on them in one pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import dedup_keep_first
from ..operators.filters import nonblank_filter
from ..operators.observed import REPORT, Watch
from ..operators.rules import Rule
from ..schemas import NEWS_CONTRACT, Contract
from ..sources.contracts import VIOLATIONS, violations
from ..sources.payloads import one_author
from ..streaming.batches import Handler

ACCEPTED = "accepted"


@dataclass(frozen=True)
class Written:
    """A table with rows that keep the contract and rows that do not, and the counts of the job."""

    path: str
    stored: DataFrame
    report: DataFrame

    @property
    def clean(self) -> DataFrame:
        return self.stored.where(ACCEPTED).drop(ACCEPTED, VIOLATIONS)

    @property
    def rejected(self) -> DataFrame:
        return self.stored.where(f"NOT {ACCEPTED}").drop(ACCEPTED)


def checked_and_marked(df: DataFrame, contract: Contract, watch: Watch) -> DataFrame:
    """Rows with their violations and whether they have none, counted on the way."""
    marked = df.withColumn(VIOLATIONS, violations(df, contract)).withColumn(ACCEPTED, F.size(VIOLATIONS) == 0)

    def fails_of(name: str) -> Column:
        return F.count_if(F.exists(VIOLATIONS, lambda v: F.startswith(v, F.lit(f"{name}:"))))

    fails = {f"violations of {n}": fails_of(n) for n in contract.properties}
    return watch.rows(marked, "checked", more={"n_accepted": F.count_if(ACCEPTED), **fails})


def news_quality_written(raw: DataFrame, path: str, rules: Sequence[Rule] = (), contract: Contract = NEWS_CONTRACT) -> Written:
    """The news job as one pass: raw rows are read once, and clean rows, rejected rows and all counts are there.

    Rows go to ``path`` by whether they keep the contract, so each kind is read by its folder.
    Counts are of the raw records (with the row rules), of those with text and date, of one per url,
    and of the contract.
    """
    spark, watch = raw.sparkSession, Watch()
    seen = watch.rows(raw, "raw", raw.columns, rules)
    filled = watch.rows(one_author(nonblank_filter(seen, ["text", "published"])), "filled")
    unique = dedup_keep_first(filled, ["url"], ["title"])
    unique = watch.rows(unique, "unique", unique.columns)
    marked = checked_and_marked(unique, contract, watch)
    marked.write.mode("overwrite").partitionBy(ACCEPTED).parquet(path)
    stored = spark.read.schema(marked.schema).parquet(path)
    return Written(path, stored, watch.report(spark))


def watched_batches(path: str, rules: Sequence[Rule], contract: Contract) -> Handler:
    """A handler for micro-batches: batch ``n`` is checked and written to ``rows/batch=n``, its
    counts to ``report/batch=n``; both are replaced when it comes again."""

    def write(batch: DataFrame, number: int) -> None:
        watch = Watch()
        seen = watch.rows(batch, "raw", batch.columns, rules)
        checked_and_marked(seen, contract, watch).write.mode("overwrite").parquet(f"{path}/rows/batch={number}")
        watch.report(batch.sparkSession).coalesce(1).write.mode("overwrite").parquet(f"{path}/report/batch={number}")

    return write


def batch_reports(spark: SparkSession, path: str) -> DataFrame:
    """The counts of all micro-batches, summed up."""
    all_batches = spark.read.schema(REPORT).parquet(f"{path}/report/batch=*")
    return all_batches.groupBy("step", "measure", "column").agg(F.sum("n").alias("n"))
