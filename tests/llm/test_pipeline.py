"""Every stage of the pipeline against what it says, and the pipeline as a whole."""

import re
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from marketlake.llm import cotraining, queries
from marketlake.llm.registry import table
from marketlake.runtime import durable

from .test_neardup import brute, shingles
from .test_secrets import brute as base_spans

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(llm):
    docs, out = table(llm, SF, "documents"), []
    out.append(docs)
    for _, stage in corpus_pipeline.STAGES:
        docs = durable(stage(llm, docs, SF))
        out.append(docs)
    return out


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_columns(steps):
    for df in steps[1:-1]:
        assert df.dtypes == steps[0].dtypes


def test_quality_rejects_junk_and_keeps_clean_documents(llm, steps):
    labels = {r["doc_id"]: r["quality"] for r in table(llm, SF, "labels").collect()}
    left = set(ids(steps[1]))
    good, bad = [i for i, q in labels.items() if q], [i for i, q in labels.items() if not q]
    assert sum(i in left for i in good) >= 0.99 * len(good)
    assert sum(i not in left for i in bad) >= 0.9 * len(bad)
    model = cotraining.train(steps[0], table(llm, SF, "labels"))
    assert ids(cotraining.classified(steps[0], model).where("kept")) == sorted(left)


def test_one_of_each_group_stays(steps):
    rows = [(r["doc_id"], r["text"]) for r in steps[1].collect()]
    assert ids(steps[2]) == sorted(i for i, _, _, kept in brute(rows, 80) if kept)


def test_pairs_from_four_fifths_on_are_near_duplicates(llm, docs):
    """100 shingles each; five of every changed word are lost on both sides."""
    texts = []
    for n in range(1, 7):
        words = [f"d{n}w{i}" for i in range(104)]
        texts.append(" ".join(words))
        for k in range(n):
            words[10 + 12 * k] = f"new{k}"
        texts.append(" ".join(words[: 104 - n]))
    likeness = [len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b)) for a, b in zip(texts[::2], texts[1::2], strict=True)]
    assert any(0.8 <= x < 0.85 for x in likeness) and any(x < 0.8 for x in likeness)
    left = ids(corpus_pipeline.near_duplicates(llm, docs(texts), SF))
    assert left == sorted([*range(0, 12, 2), *(2 * k + 1 for k, x in enumerate(likeness) if x < 0.8)])


def test_no_base_secret_is_left_and_the_rest_is_unchanged(steps):
    before = {r["doc_id"]: r["text"] for r in steps[2].collect()}
    rows = steps[3].collect()
    assert {r["doc_id"] for r in rows} == set(before)
    for r in rows:
        assert not base_spans(r["text"]) and r["n_chars"] == len(r["text"])
        if "[SECRET]" not in r["text"]:
            assert r["text"] == before[r["doc_id"]]
        else:
            assert re.fullmatch(".+".join(re.escape(x) for x in r["text"].split("[SECRET]")), before[r["doc_id"]], re.S)


def test_mixing_draws_as_sql_does(steps, tmp_path):
    steps[3].write.parquet(f"{tmp_path}/d.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d.parquet/*.parquet'")
    wanted = con.execute(f"SELECT doc_id, unnest(range(copies)) FROM ({queries.MIX_SQL})").fetchall()
    assert ids(steps[4]) == sorted(r[0] for r in wanted)


def test_packing_holds_every_drawn_document(llm, steps):
    """All ids of every document as often as it was drawn, none more."""
    rows = steps[5].collect()
    drawn, sizes, held = Counter(ids(steps[4])), {}, {}
    for r in rows:
        sizes[r["doc_id"]] = r["doc_tokens"]
        held.setdefault(r["doc_id"], Counter()).update(range(r["start"], r["start"] + r["length"]))
    assert set(sizes) == set(drawn)
    for name, n in drawn.items():
        assert held[name] == Counter(dict.fromkeys(range(sizes[name]), n))
    assert ids(corpus_pipeline.run(llm, SF)) == sorted(r["doc_id"] for r in rows)


def test_no_rows(llm, steps):
    docs = steps[0].where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = durable(stage(llm, docs, SF))
        assert docs.count() == 0
