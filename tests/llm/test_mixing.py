"""Languages that no target lists."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from marketlake.llm import mixing, queries


@pytest.mark.parametrize("lang", [None, "it"])
def test_no_listed_language(llm, docs, lang):
    df = docs([f"word {k} " * 5 for k in range(60)]).withColumn("lang", F.lit(lang).cast("string"))
    assert {r["weight"] for r in queries.mix(df).collect()} == {1.0}
    assert corpus_pipeline.mixing(llm, df, "").count() == 60


def test_nulls_and_a_fifth_language_keep_their_share(llm, docs):
    df = docs([f"word {k} " * 5 for k in range(400)])
    k = F.col("doc_id") % 10
    df = df.withColumn("lang", F.when(k < 4, "en").when(k < 7, "fr").when(k < 9, "it"))
    rows = queries.mix(df).collect()
    whole = sum(r["tokens"] for r in rows)
    share = {}
    for r in rows:
        share[r["lang"]] = share.get(r["lang"], 0.0) + r["tokens"] * r["weight"] / whole
    assert share == pytest.approx({"en": 0.7 * 55 / 72, "fr": 0.7 * 17 / 72, "it": 0.2, None: 0.1}, abs=1e-3)
    langs = {r["lang"] for r in corpus_pipeline.mixing(llm, df, "").collect()}
    assert langs == {"en", "fr", "it", None}


def shares(rows, dim):
    """Shares of tokens by value of a column."""
    out = {}
    for r in rows:
        out[r[dim] or mixing.NONE] = out.get(r[dim] or mixing.NONE, 0) + r["tokens"]
    whole = sum(out.values())
    return {v: n / whole for v, n in out.items()}


def test_the_rows_that_come_out_meet_the_targets(llm, docs):
    """Token shares of the pipeline stage's own rows, within one per cent, also where weights are above 1."""
    df = docs([f"{'@ ' if i % 9 == 0 else ''}word {i} " * (1 + i % 3) for i in range(20_000)])
    k = F.col("doc_id") % 20
    df = df.withColumn("lang", F.when(k < 13, "en").when(k < 15, "fr").when(k < 16, "de").when(k < 17, "es").when(k < 18, "it"))
    df = df.withColumn("source", F.when(F.col("doc_id") % 7 < 5, "hot").otherwise(F.concat(F.lit("s"), (F.col("doc_id") % 3).cast("string"))))
    out = corpus_pipeline.mixing(llm, df, "").withColumns({"tokens": mixing.words(), "topic": mixing.topic_of()}).collect()
    natural = df.withColumns({"tokens": mixing.words(), "topic": mixing.topic_of()}).collect()
    assert max(r["weight"] for r in queries.mix(df).collect()) > 1.5
    for dim in mixing.DIMS:
        goal = mixing._wanted(shares(natural, dim), queries.MIX[dim])
        got = shares(out, dim)
        assert all(abs(got[v] - x) < 0.01 for v, x in goal.items()), dim


def test_helper_names_meet_no_columns(docs):
    df = docs(["a b c", "d e"]).withColumnsRenamed({"n_chars": "_tokens"}).withColumns({"_source": F.lit(1), "_weight": F.lit(2), "_copy": F.lit(3)})
    rows = mixing.sampled(queries.mix(df)).collect()
    assert {(r["_source"], r["_weight"], r["_copy"]) for r in rows} == {(1, 2, 3)}
