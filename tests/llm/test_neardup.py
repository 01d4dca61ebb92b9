"""Near-duplicates against all pairs, and the parts on their own."""

import re

import numpy as np
import pytest

from marketlake.llm import neardup
from marketlake.llm.graph import _stars, components
from marketlake.llm.shingles import mix


def shingles(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if 0 < len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows, percent=85):
    """component by row, from all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                root[find(i)] = find(j)
    groups = {}
    for i, (name, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(name)
    out = []
    for i, (name, _) in enumerate(rows):
        ids = [x for x in groups[find(i)] if x is not None]
        least = min(ids) if ids else None
        out.append((name, len(sets[i]), least, name == least if name is not None and least is not None else least is None))
    return out


def check(df, rows):
    found = neardup.near_duplicates(df).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, brute(rows)))


def test_documents_against_all_pairs(documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    check(documents, rows)


def test_chains_families_and_near_misses(docs):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(3000)]

    def edited(base, n):
        out = list(base)
        for k in rng.choice(len(out), n, replace=False):
            out[k] = str(rng.choice(words))
        return out

    rows, base = [], list(rng.choice(words, 300))
    for _ in range(40):  # a family around one text, some too far from it
        rows.append(" ".join(edited(base, int(rng.integers(0, 12)))))
    link = list(rng.choice(words, 300))
    for _ in range(12):  # a chain, whose ends are not alike
        rows.append(" ".join(link))
        link = edited(link, 4)
    for _ in range(30):  # unrelated texts with a long passage in common
        rows.append(" ".join(base[:150] + list(rng.choice(words, 150))))
    rows = list(enumerate(rows))
    check(docs(rows), rows)


def test_odd_texts(docs):
    rows = [
        (5, None), (6, ""), (7, " \t\n"), (8, "One two"), (9, "one TWO"), (10, "one two three"), (11, "Éa"), (12, "éa"),
        (13, "a b c d e"), (14, "a b c d e"), (14, "a b c d e"), (None, "a b c d e"), (None, "x y"), (3, "a\x0bb\x0cc d e"),
        (20, "z " * 200_000), (21, "z"), (22, "q" * 300_000),
    ]
    df = docs(rows).withColumnsRenamed({"lang": "rep", "source": "set", "n_chars": "component_id"})
    check(df, rows)


def test_no_rows(docs):
    assert neardup.near_duplicates(docs([])).collect() == []
    assert [tuple(r) for r in neardup.near_duplicates(docs([None])).collect()] == [(0, 0, 0, True)]


def test_clashing_names_and_other_thresholds(docs):
    base = [f"w{i}" for i in range(104)]
    rows = [(k, " ".join([*base[: 50 - k], f"x{k}", *base[51 - k :], *base[: 10 * k]])) for k in range(6)]
    df = docs(rows).withColumnsRenamed({"lang": "_of", "source": "_id", "n_chars": "_mark"})
    for percent in (50, 80, 95):
        found = neardup.deduplicated(df, percent=percent)
        assert found.columns == df.columns and {r["_of"] for r in found.collect()} == {"en"}
        assert sorted(r["doc_id"] for r in found.collect()) == [i for i, _, _, kept in brute(rows, percent) if kept]


def test_rounds_go_on_until_all_links_are_found(docs, monkeypatch):
    monkeypatch.setattr(neardup, "PIVOTS", 1)
    base = [f"w{i}" for i in range(400)]
    rows = []
    for k in range(14):
        text = list(base)
        text[7 * k : 7 * k + 1 + k % 5] = [f"x{k}y{i}" for i in range(1 + k % 5)]
        rows.append(" ".join(text + [f"t{k % 3}"] * 20))
    rows = list(enumerate(rows))
    check(docs(rows), rows)


@pytest.mark.parametrize("wanted", [0.3, 0.6, 0.85, 0.95])
def test_estimate(wanted):
    rng = np.random.default_rng(1)
    found = []
    for _ in range(40):
        all_ = mix(rng.integers(0, 1 << 62, 2000, dtype=np.uint64))
        common = int(2000 * wanted)
        rest = (2000 - common) // 2
        a = neardup.registers(all_[: common + rest])
        b = neardup.registers(np.concatenate([all_[:common], all_[common + rest :]]))
        size = np.array([float(common + rest)])
        found.append(neardup.similarity(a[None], b[None], size, size)[0])
    assert abs(np.mean(found) - wanted) < 0.03


def test_sketches_merge():
    rng = np.random.default_rng(2)
    a, b = (mix(rng.integers(0, 1 << 62, 500, dtype=np.uint64)) for _ in range(2))
    both = neardup.registers(np.concatenate([a, b]))
    assert (neardup.merged(neardup.registers(a), neardup.registers(b)) == both).all()


def test_components(llm):
    edges = [(i, i + 1) for i in range(30)] + [(100, 103), (103, 101), (101, 102)] + [(200, 200 + i) for i in range(1, 50)]
    found = {r["node"]: r["component"] for r in components(llm.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {
        **dict.fromkeys(range(31), 0), **dict.fromkeys(range(100, 104), 100), **dict.fromkeys(range(200, 250), 200)
    }
    assert components(llm.createDataFrame([], "u long, v long")).collect() == []


def test_repeated_links_cost_no_shuffle_of_their_own(llm):
    edges = [(1, 2), (2, 1), (1, 2), (3, 2), (3, 2), (9, 8), (5, 5)] * 3
    links = llm.createDataFrame(edges, "u long, v long")
    assert {(r["node"], r["component"]) for r in components(links).collect()} == {(1, 1), (2, 1), (3, 1), (8, 8), (9, 8)}
    plan = _stars(links, True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1, plan  # the least neighbour alone
