"""Neighbours along Hilbert curves against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlake.llm import curves
from marketlake.llm.registry import table

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, asked, k):
    out = {}
    ids = np.array([i for i, _ in rows])
    vec = np.array([v for _, v in rows], np.float32).astype(float)
    for i in {i for i in ids if asked(i)}:
        q = vec[list(ids).index(i)]
        score = vec @ q
        order = [x for x in np.lexsort((ids, -np.round(score, 12))) if ids[x] != i][:k]
        out[int(i)] = [(int(ids[x]), score[x]) for x in order]
    return out


def found(df, asked, k=20, **how):
    rows = curves.nearest(df, asked, k, curves=curves.Curves(**how)).orderBy("query_id", "rank").collect()
    out = {}
    for r in rows:
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def recall(got, wanted):
    hits = [len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) / len(w) for q, w in wanted.items() if w]
    return np.mean(hits)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_recall_on_embeddings(llm, sf):
    df = table(llm, f"/root/testdata/{sf}", "embeddings")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    wanted = brute(rows, lambda i: i % 20 == 0, 20)
    got = found(df, F.col("vec_id") % 20 == 0)
    assert set(got) == set(wanted) and all(len(got[q]) == len(w) for q, w in wanted.items())
    assert recall(got, wanted) >= 0.9
    score = {(q, i): s for q, w in brute(rows, lambda i: i % 20 == 0, 10**6).items() for i, s in w}
    assert all(abs(s - score[q, i]) < 1e-12 for q, w in got.items() for i, s in w)


def test_whole_windows_are_exact_also_for_other_lengths(llm):
    rng = np.random.default_rng(7)
    rows = [(i, (rng.normal(size=8) * rng.uniform(0.1, 5)).tolist(), 0) for i in range(300)]
    wanted = brute([(i, v) for i, v, _ in rows], lambda i: i % 7 == 0, 5)
    got = found(llm.createDataFrame(rows, SCHEMA), F.col("vec_id") % 7 == 0, 5, share=1.0, count=1)
    assert {q: [i for i, _ in w] for q, w in got.items()} == {q: [i for i, _ in w] for q, w in wanted.items()}


def test_clusters_are_found_with_small_windows(llm):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(40, 16))
    rows = [(i, (centres[i % 40] + 0.05 * rng.normal(size=16)).tolist(), 0) for i in range(4000)]
    wanted = brute([(i, v) for i, v, _ in rows], lambda i: i % 100 == 0, 20)
    assert recall(found(llm.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0, share=0.03), wanted) >= 0.9


def test_copies_and_ties_go_by_id(llm):
    rng = np.random.default_rng(9)
    hot = rng.normal(size=8).tolist()
    rows = [(i, hot if i % 3 == 0 else rng.normal(size=8).tolist(), 0) for i in range(600)]
    got = found(llm.createDataFrame(rows, SCHEMA), F.col("vec_id") % 60 == 0, 20, share=1.0)
    wanted = brute([(i, v) for i, v, _ in rows], lambda i: i % 60 == 0, 20)
    assert {q: [i for i, _ in w] for q, w in got.items()} == {q: [i for i, _ in w] for q, w in wanted.items()}


def test_odd_vectors(llm):
    fine = [(0, [1.0, 0.0], 0), (20, [1.0, 0.5], 0), (3, [0.0, 1.0], 0)]
    odd = [
        (40, None, 0), (60, [0.0, 0.0], 0), (80, [None, 1.0], 0), (100, [float("nan"), 1.0], 0), (120, [float("inf"), 1.0], 0),
        (140, [], 0), (160, [1.0, 2.0, 3.0], 0), (None, [1.0, 1.0], 0),
    ]
    df = llm.createDataFrame(fine + odd, SCHEMA).withColumnRenamed("label", "rank")
    got = found(df, F.col("vec_id") % 20 == 0, share=1.0)
    assert got == {0: [(20, 1.0), (3, 0.0)], 20: [(0, 1.0), (3, 0.5)]}
    again = found(df.union(df), F.col("vec_id") % 20 == 0, share=1.0)
    assert {q: [i for i, _ in w] for q, w in again.items()} == {0: [20, 20, 3, 3], 20: [0, 0, 3, 3]}
    assert curves.nearest(llm.createDataFrame(odd[:5], SCHEMA), F.lit(True)).collect() == []
    assert curves.nearest(llm.createDataFrame([], SCHEMA), F.lit(True)).collect() == []
    assert curves.nearest(llm.createDataFrame(fine[:1], SCHEMA), F.lit(True)).collect() == []


def test_neighbours_on_the_curve_touch():
    side = np.arange(16)
    cells = np.array(np.meshgrid(side, side, side)).reshape(3, -1).T
    keys = curves.hilbert_keys(cells, 4)
    assert sorted(keys) == list(range(16**3))
    walk = cells[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def exact(rows, asked, k):
    """The k best rows of other ids, row by row."""
    out = {}
    for q in sorted({i for i, _ in rows if asked(i)}):
        best = {}
        for v in {tuple(v) for i, v in rows if i == q}:
            for place, (i, w) in enumerate(rows):
                if i != q:
                    s = float(np.dot(v, w))
                    best[place] = max(best.get(place, -np.inf), s)
        order = sorted(best, key=lambda x: (-best[x], rows[x][0]))[:k]
        out[q] = [rows[x][0] for x in order]
    return out


def test_own_ids_repeated_beyond_k(llm):
    """An id on very many equal rows, and one on many different vectors, still get k other rows."""
    rng = np.random.default_rng(10)
    hot, near = [1.0, 2.0, 0.5, 1.0], [1.0, 2.0, 0.5, 0.75]
    rows = [(0, hot)] * 25 + [(i, hot) for i in range(1, 6)] + [(i, rng.integers(-4, 4, 4).astype(float).tolist()) for i in range(101, 155)]
    rows += [(60, near)] * 30 + [(20, [1.0, 2.0, 0.5, x / 64]) for x in range(40)]
    rows = [(i, v) for i, v in rows if any(v)]
    df = llm.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    got = found(df, F.col("vec_id") % 20 == 0, 20, share=1.0, count=2)
    assert {q: [i for i, _ in w] for q, w in got.items()} == exact(rows, lambda i: i % 20 == 0, 20)
    assert all(len(w) == 20 for w in got.values())
