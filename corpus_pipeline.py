"""The corpus pipeline: stages over documents, each written and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm import cotraining, neardup, queries, secrets
from marketlake.llm.mixing import sampled
from marketlake.llm.registry import ready, table
from marketlake.runtime import durable

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
PERCENT = 80  # of all different shingles of two texts, from which on they are near-duplicates


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier finds good; trained on the given ``labels``."""
    ready(spark)
    docs = docs.select(*COLUMNS)
    model = cotraining.train(docs, table(spark, sf_dir, "labels"))
    return cotraining.classified(docs, model).where("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id; texts are linked
    from ``PERCENT`` of their shingles in common on."""
    ready(spark)
    return neardup.deduplicated(docs.select(*COLUMNS), percent=PERCENT)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of every secret."""
    ready(spark)
    docs = docs.select(*COLUMNS)
    clean = secrets.redacted(docs, secrets.train(docs))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draws documents so that sources, languages and topics come to their shares of tokens: some
    not at all, some more than once. Null and other languages than the listed ones keep their
    natural share."""
    ready(spark)
    return sampled(queries.mix(docs.select(*COLUMNS))).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document in pieces of sequences of at most 4096 tokens."""
    ready(spark)
    return queries.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("near-duplicates", near_duplicates),
    ("secret scan", secret_scan),
    ("mixing", mixing),
    ("packing", packing),
]

# Trained models, sketches and tokenizers have no SQL form; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; the result of the last one."""
    docs = table(ready(spark), sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
