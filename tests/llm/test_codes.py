"""Vector codes against plain integers."""

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest

from marketlake.llm import codes
from marketlake.llm.registry import table

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, parts=16, entries=64, rounds=2):
    kept = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    vectors = [[math.floor(256 * x) if abs(x) < 1e300 else int(x) * 256 for x in v] for _, v, _ in kept]
    width = len(vectors[0]) // parts
    cut = [[tuple(v[p * width : (p + 1) * width]) for p in range(parts)] for v in vectors]
    order = sorted((i for i in range(len(kept)) if kept[i][0] is not None), key=lambda i: (kept[i][0], kept[i][1]))[:entries]
    book = [[cut[i][p] for i in order] for p in range(parts)]

    def near(x, entry_list):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(entry_list))

    for _ in range(rounds):
        for p in range(parts):
            groups = defaultdict(list)
            for row in cut:
                groups[near(row[p], book[p])[1]].append(row[p])
            book[p] = [
                tuple(sum(c) // len(groups[e]) for c in zip(*groups[e], strict=True)) if groups[e] else old for e, old in enumerate(book[p])
            ]
    digest = hashlib.sha256(",".join(str(c) for part in book for entry in part for c in entry).encode()).hexdigest()
    out, sums = [], defaultdict(int)
    for (name, _, label), row in zip(kept, cut, strict=True):
        found = [near(row[p], book[p]) for p in range(parts)]
        error = sum(d for d, _ in found)
        sums[label] += error
        out.append((name, "".join(f"{e:02x}" for _, e in found), error, label))
    most = codes.MOST
    return sorted(((n, c, min(e, most), min(sums[g], most), digest) for n, c, e, g in out), key=str)


def check(df, rows, **more):
    assert sorted((tuple(r) for r in codes.compressed(df, **more).collect()), key=str) == plain(rows, **more)


def test_table(llm):
    df = table(llm, "/root/testdata/sf0.001", "embeddings")
    check(df, [tuple(r) for r in df.select("vec_id", "embedding", "label").collect()])


def test_odd_rows(llm):
    rng = np.random.default_rng(2)
    rows = [(int(i) // 2, [float(x) for x in rng.normal(size=32)], int(i) % 3 or None) for i in range(90)]
    rows += [(500, None, 1), (501, [None] * 32, 1), (502, [math.nan] * 32, None), (503, [math.inf] * 32, 1), (504, [], 1)]
    rows += [(None, [0.0] * 32, None), (506, [0.0] * 32, 7), (506, [0.0] * 32, 7), (-3, [-0.001] * 32, 2)]
    check(llm.createDataFrame(rows, SCHEMA), rows)
    check(llm.createDataFrame(rows, SCHEMA), rows, parts=8, entries=5, rounds=3)
    with pytest.raises(ValueError):
        codes.compressed(llm.createDataFrame(rows, SCHEMA), entries=257)


def test_another_length_and_no_rows(llm):
    rows = [(i, [float(i)] * 16, 0) for i in range(5)] + [(9, [1.0] * 32, 0), (10, [1.0] * 17, 0)]
    assert {r[0] for r in codes.compressed(llm.createDataFrame(rows, SCHEMA)).collect()} == set(range(5))
    assert codes.compressed(llm.createDataFrame([], SCHEMA)).collect() == []
    assert codes.compressed(llm.createDataFrame([(None, [1.0] * 16, 0)], SCHEMA)).collect() == []


@pytest.mark.parametrize("size", [1e3, 1e6, 1e8, 1e15, 1e25, 1e300])
def test_large_components(llm, size):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=16) * size], i % 2) for i in range(12)]
    check(llm.createDataFrame(rows, SCHEMA), rows, entries=4)


def test_clashing_names(llm):
    rows = [(i, [float(i)] * 16, 0) for i in range(4)]
    df = llm.createDataFrame([(*r, "x", 1.5, "y") for r in rows], SCHEMA + ", code string, error double, vector string")
    check(df, rows)


def test_limbs_and_products():
    rng = np.random.default_rng(6)
    for most in (3, 1 << 20, 1 << 27, 1 << 29):
        a, b = rng.integers(-most, most, (2, 40, 7))
        for bits in (3, 20, 25):
            assert (sum(x.astype(np.int64) << (bits * k) for k, x in enumerate(codes.limbs(a, bits))) == a).all()
        assert (codes.exact_dot(a, b) == np.array(a.astype(object) @ b.T.astype(object), np.int64)).all()
    edge = np.array([[-(1 << 29), (1 << 29) - 1, 0, -1]])
    assert codes.exact_dot(edge, edge)[0, 0] == sum(int(x) ** 2 for x in edge[0])
