"""SimHash fingerprints and their links against plain expressions and all pairs."""

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from marketlake.llm import pivots


def plain(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    runs = [words] if len(words) < 4 else [words[i : i + 4] for i in range(len(words) - 3)]
    h = [xxhash.xxh64_intdigest(" ".join(r).encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(prints):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(np.array(prints[:i], np.uint64) ^ np.uint64(prints[i])) <= 4):
            root[find(i)] = find(int(j))
    return [find(i) for i in range(len(prints))]


def check(df, rows):
    prints = [plain(t) for _, t in rows]
    found = groups(prints)
    least = {}
    for (name, _), g in zip(rows, found, strict=True):
        if name is not None:
            least[g] = min(least.get(g, name), name)
    wanted = [(name, f"{p:016x}", least.get(g)) for (name, _), p, g in zip(rows, prints, found, strict=True)]
    got = [tuple(r) for r in pivots.simhash_duplicates(df).collect()]
    assert sorted(map(str, got)) == sorted(map(str, wanted))


def test_documents_against_all_pairs(documents):
    check(documents, [(r["doc_id"], r["text"]) for r in documents.collect()])


def test_odd_rows(docs):
    texts = [None, "", " \n\t", "one", "ONE", "a b c", "A\x0bb\x1fc", "ÀÉ Ü ABC def", "w " * 30_000, "x y z v " * 4000, "🙂 é " * 9]
    rows = [*enumerate(texts), (3, "one two three four five"), (None, "one two three four five"), (None, "q r s t u v w"), (50, "one")]
    check(docs(rows), rows)


def test_no_rows_and_clashing_names(docs):
    assert pivots.simhash_duplicates(docs([])).collect() == []
    df = docs(["a b c d e", "a b c d e"]).withColumnsRenamed({"lang": "fp", "source": "component_id", "n_chars": "fingerprint"})
    assert [r["component_id"] for r in pivots.simhash_duplicates(df).collect()] == [0, 0]


def connected(llm, prints):
    """Component by fingerprint, through the links the operator finds."""
    frame = llm.createDataFrame([(int(np.int64(np.uint64(p))),) for p in set(prints)], "fp long")
    parts = {r["node"]: r["component"] for r in pivots.components(pivots.links(frame)).collect()}
    return [parts.get(int(np.uint64(p).astype(np.int64)), int(np.uint64(p).astype(np.int64))) for p in prints]


def same_groups(a, b):
    return len(set(a)) == len(set(b)) == len(set(zip(a, b, strict=True)))


@pytest.mark.parametrize("split", [True, False])
def test_no_link_is_lost(llm, monkeypatch, split):
    """Chains of four bits, dense families, rows five bits apart, hot buckets divided and not."""
    if split:
        monkeypatch.setattr(pivots, "SPLIT", 40)
        monkeypatch.setattr(pivots, "CHUNK", 16)
        monkeypatch.setattr(pivots, "TOGETHER", 64)
    rng = np.random.default_rng(4)
    prints = []
    for distance in (1, 4, 5):
        for _ in range(40):  # chains
            at = int(rng.integers(0, 1 << 64, dtype=np.uint64))
            for _ in range(6):
                prints.append(at)
                for b in rng.choice(64, distance, replace=False):
                    at ^= 1 << int(b)
    base = int(rng.integers(0, 1 << 64, dtype=np.uint64))
    for _ in range(700):  # a family that agrees in many blocks, some of it apart
        prints.append(base ^ sum(1 << int(b) for b in rng.choice(40, int(rng.integers(0, 9)), replace=False)))
    prints += [0, 1, 0xFFFFFFFFFFFFFFFF, 0x0F, 0x1F, 0x7FFFFFFFFFFFFFFF]
    prints = sorted(set(prints))
    assert same_groups(connected(llm, prints), groups(prints))


def test_table_rules_out_no_near_pair():
    """Coordinates differ by no more than the fingerprints, inside any mask."""
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 1 << 64, (2, 500), np.uint64)
    for mask in [pivots.WHOLE, *pivots.masks(pivots.WHOLE), *pivots.masks(pivots.LEFT[3])]:
        gap = np.abs(pivots.distances(a, mask).astype(int) - pivots.distances(b, mask).astype(int)).max(axis=1)
        assert (gap <= np.bitwise_count((a ^ b) & np.uint64(mask))).all()
    assert sum(pivots.masks(pivots.WHOLE)) == pivots.WHOLE


def test_links_inside_a_bucket_are_a_forest():
    prints = np.arange(16, dtype=np.uint64)  # all within four bits
    keys = np.array([1] * 8 + [2] * 8)
    u, v = pivots.linked(keys, prints, prints.astype(np.int64))
    assert len(u) == 14 and all((a < 8) == (b < 8) for a, b in zip(u, v, strict=True))
    u, v = pivots.linked(keys, prints, np.zeros(16, np.int64))
    assert not len(u)


def test_hot_copies_are_one_node(llm, docs):
    df = docs(["the same few words again and again"] * 500 + ["something else is written here now"])
    found = pivots.simhash_duplicates(df).groupBy("component_id").agg(F.count("*").alias("n")).collect()
    assert {(r["component_id"], r["n"]) for r in found} == {(0, 500), (500, 1)}
