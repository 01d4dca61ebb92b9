"""Co-training: accuracy on labels that were not seen, and odd tables."""

import numpy as np
from pyspark.sql import functions as F

from marketlake.llm import cotraining
from marketlake.llm.registry import table

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(llm):
    docs, labels = table(llm, SF, "documents"), table(llm, SF, "labels")
    seen, unseen = labels.where("doc_id % 3 <> 0"), labels.where("doc_id % 3 = 0")
    model = cotraining.train(docs, seen, max_labels=2000)
    rows = cotraining.classified(docs.join(unseen, "doc_id"), model).select("quality", "score", "kept").collect()
    good = np.array([r["quality"] == 1 for r in rows])
    kept = np.array([r["kept"] for r in rows])
    assert len(rows) > 1000
    assert kept[good].mean() > 0.99  # clean documents stay
    assert (~kept[~good]).mean() > 0.9
    share = good.mean()
    assert abs(np.mean([r["score"] for r in rows]) - share) < 0.03  # calibrated


def test_views_teach_each_other(llm):
    """Few labels, and metadata that tell the classes apart only once pseudo-labels come in."""
    docs = llm.range(4000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 2 == 0, F.concat(F.lit("plain words of text number "), F.col("id"), F.lit(". and more of them")))
        .otherwise(F.concat(F.lit("### $$$ %%% ### "), F.col("id")))
        .alias("text"),
        F.lit("en").alias("lang"),
        F.when(F.col("id") % 2 == 0, "good").otherwise("bad").alias("source"),
        F.lit(100).cast("long").alias("n_chars"),
    )
    labels = docs.where("doc_id < 40").select("doc_id", (1 - F.col("doc_id") % 2).cast("int").alias("quality"))
    blank = docs.withColumn("source", F.when(F.col("doc_id") >= 40, F.col("source")))
    alone = cotraining.train(blank, labels, rounds=0)
    taught = cotraining.train(blank, labels, rounds=2)

    def right(model):
        rows = cotraining.classified(blank.where("doc_id >= 40"), model).select("doc_id", "meta_score").collect()
        return np.mean([(r["meta_score"] > 0.5) == (r["doc_id"] % 2 == 0) for r in rows])

    assert right(alone) < 0.6 and right(taught) > 0.95


def test_a_labelled_id_on_most_rows_counts_once(llm):
    """Many rows and texts of one labelled id change no model but by the one row that is taken."""
    one = llm.range(300).select(
        F.col("id").alias("doc_id"),
        F.concat(F.when(F.col("id") % 2 == 0, F.lit("plain words of text ")).otherwise(F.lit("### $$$ %%% ")), F.col("id")).alias("text"),
        F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(100).cast("long").alias("n_chars"),
    )
    labels = one.where("doc_id < 80").select("doc_id", (1 - F.col("doc_id") % 2).cast("int").alias("quality"))
    hot = one.where("doc_id = 6")
    again = one.unionByName(hot.crossJoin(llm.range(3000).select()))

    def scores(docs):
        rows = cotraining.classified(one, cotraining.train(docs, labels, rounds=1)).select("doc_id", "score", "kept").collect()
        return sorted(map(tuple, rows))

    assert scores(again) == scores(one)
    texts = hot.crossJoin(llm.range(2000).withColumnRenamed("id", "k")).withColumn("text", F.concat("text", F.lit(" "), "k")).drop("k")
    kept = {i: k for i, _, k in scores(one.where("doc_id <> 6").unionByName(texts))}
    assert sum(k == (i % 2 == 0) for i, k in kept.items()) >= 0.99 * len(kept)


def test_odd_tables(llm, docs):
    odd = docs([None, "", "x", (3, "three words here"), (3, "three words here"), (None, "no id")])
    odd = odd.unionByName(odd.withColumns({"lang": F.lit(None).cast("string"), "source": F.lit(None).cast("string"), "n_chars": F.lit(None).cast("long")}))
    labels = llm.createDataFrame([(0, 0), (0, 1), (1, 0), (2, 1), (3, 1), (None, 1), (4, None), (99, 1)], "doc_id long, quality int")
    for known in (labels, labels.where("quality = 1"), labels.where("false")):
        model = cotraining.train(odd, known)
        rows = cotraining.classified(odd.withColumn("score", F.lit("mine")).withColumn("_label", F.lit(1)), model).collect()
        assert len(rows) == 12 and all(0 <= r["score"] <= 1 and r["kept"] is not None for r in rows)
    assert cotraining.classified(odd.where("false"), model).collect() == []
    assert cotraining.train(odd.where("false"), labels).text is None


def test_the_same_model_twice(llm, documents):
    labels = table(llm, "/root/testdata/sf0.001", "labels")
    one, two = (cotraining.train(documents.repartition(n), labels) for n in (2, 3))
    assert np.allclose(one.combine, two.combine) and np.allclose(one.text.weights, two.text.weights)
