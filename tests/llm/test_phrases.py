"""Collocations against a plain count, and the fingerprints on their own."""

import re
from collections import Counter

import numpy as np
import pytest

from marketlake.llm import phrases
from marketlake.llm.phrases import collocations


def plain(rows, longest=3, least=10, covered=50, top=2000):
    """The contract, word by word."""
    count, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        total[lang] += 0
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, longest + 1):
                count.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    frequent = {key: f for key, f in count.items() if f >= least and len(key[1]) > 1}
    found = {}
    for (lang, w), a in frequent.items():
        inside = any(
            o == lang and len(x) > len(w) and 100 * f >= covered * a and any(x[i : i + len(w)] == w for i in range(len(x) - len(w) + 1))
            for (o, x), f in frequent.items()
        )
        if not inside:
            cuts = []
            for k in range(1, len(w)):
                left, right = count[lang, w[:k]], count[lang, w[k:]]
                cuts.append((1000000 * a * a // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            found.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    out = []
    for lang, items in found.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(items)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def check(df, rows, **more):
    got = sorted(tuple(r) for r in collocations(df, **more).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())
    assert got == plain(rows, **more)
    return got


def test_documents(documents):
    assert len(check(documents, [(r["lang"], r["text"]) for r in documents.collect()])) > 100


def make(llm, rows):
    return llm.createDataFrame([(i, t, g) for i, (g, t) in enumerate(rows)], "doc_id long, text string, lang string")


ODD = [
    (None, "New York  city. new\tYORK city, new york; the new york!"), ("und", "new york " * 6), ("", "b c " * 12), ("de", None), ("de", ""),
    ("en", "a b c d " * 20), ("en", "a b\nc d\x0ba b\x0cc d\r" * 12), ("en", "É é É é " * 11), ("en", "x " * 30_000), ("fr", ". , ; " * 40),
    ("fr", "p q r s t. " * 10 + "q r s. " * 3), ("en", "🙂 \x85 \x1f y " * 10),
]


def test_odd_rows(llm):
    check(make(llm, ODD), ODD)


@pytest.mark.parametrize("more", [{"longest": 2}, {"longest": 5, "least": 3}, {"covered": 90, "top": 3}, {"least": 1}])
def test_other_bounds(llm, more):
    check(make(llm, ODD[:8] + ODD[9:]), ODD[:8] + ODD[9:], **more)


def test_no_rows(llm):
    assert collocations(make(llm, [])).collect() == []
    assert collocations(make(llm, [("en", None)])).collect() == []


def test_clashing_names(llm):
    df = make(llm, ODD).selectExpr("text", "lang", "doc_id AS fp", "'x' AS phrase", "1 AS n", "2 AS size", "3 AS f")
    assert len(collocations(df).collect()) == len(plain(ODD))


def test_collisions_are_told_apart(llm, monkeypatch):
    """Though every phrase has one of a few fingerprints, counts are those of the words."""
    whole = phrases.Words.fingerprints
    monkeypatch.setattr(phrases.Words, "fingerprints", lambda *a: whole(*a) & np.uint64(3))
    check(make(llm, ODD[:8]), ODD[:8])


def test_blocks_and_small_sums(llm, monkeypatch):
    monkeypatch.setattr(phrases, "GRAMS", 10)
    check(make(llm, ODD), ODD)


def test_prefix_polynomials():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1 << 64, 300, np.uint64)
    base, mask = phrases.BASE, (1 << 64) - 1
    begins = rng.integers(0, 200, 50)
    ends = begins + rng.integers(0, 100, 50)
    want = [sum(int(v) * pow(base, k, 1 << 64) for k, v in enumerate(values[a:b])) & mask for a, b in zip(begins, ends, strict=True)]
    assert phrases.prefix_hashes(values, base, begins, ends).tolist() == want


def test_scores_beyond_64_bits(llm):
    """The exact expression on counts of billions."""
    from pyspark.sql import functions as F

    a, left, right = 3_000_000_000, 3_000_000_001, 4_000_000_007
    row = llm.range(1).select(F.lit(a).alias("a"), F.lit(left).alias("l"), F.lit(right).alias("r"))
    assert row.select(F.expr(phrases.SCORE)).first()[0] == 1000000 * a * a // (left * right)
