"""Packing: every id in exactly one piece, the limits, and the padding."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from marketlake.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def check(df, tokenizer, segments=128):
    rows = packing.packed(df, PATH, ids=True).collect()
    texts = {r["doc_id"]: r["text"] for r in df.collect()}
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
        assert len(r["ids"]) == r["length"] > 0
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]
    assert set(pieces) == set(texts)
    for name, own in pieces.items():
        whole = ids_of(tokenizer, texts[name])
        own.sort(key=lambda r: r["start"])
        at = 0
        for r in own:
            assert (r["start"], r["doc_tokens"]) == (at, len(whole))
            assert list(r["ids"]) == whole[at : at + r["length"]]
            at += r["length"]
        assert at == len(whole)
    padded = 0
    for own in sequences.values():
        own.sort(key=lambda r: r["offset"])
        at = 0
        for r in own:
            assert r["offset"] == at
            at += r["length"]
        assert at <= 4096 and len(own) <= segments
        padded += 0 if at & (at - 1) == 0 else 4096 - at
    return padded, sum(r["length"] for r in rows)


def test_documents(documents, tokenizer):
    padded, tokens = check(documents.select("doc_id", "text"), tokenizer)
    assert padded <= 0.01 * tokens


def test_odd_texts(docs, tokenizer):
    texts = [
        None, "", " ", "a", "Don't stop... it's U.S. <|endoftext|> x<|startoftext|>", "İstanbul ΣΑΣ é ﬁ x \x1f \x85 y",
        "word " * 30_000, "x" * 50_000, "日本語 テキスト", "a.b,c. d, e.. f,. 'S 's", " wide　space", "🙂🙂.",
    ]
    check(docs(texts).withColumnRenamed("lang", "sequence_id"), tokenizer)


def test_repeated_rows_and_no_rows(docs, tokenizer):
    rows = packing.packed(docs([(1, "same text"), (1, "same text"), (None, "x")]), PATH).collect()
    assert [r["doc_id"] for r in rows].count(1) >= 2 and any(r["doc_id"] is None for r in rows)
    assert packing.packed(docs([]), PATH).collect() == []


def place(done, left):
    return {p for row in [*done, left] for p in row}


def test_all_limits_hold_without_cutting():
    rng = np.random.default_rng(4)
    tokens = rng.integers(1, 900, 400)
    loss = (tokens * rng.uniform(0, 1, 400)).astype(np.int64)
    limits = packing.Limits(1000, 5, 400)
    loss = np.minimum(loss, 400)
    done, left = packing.fill(tokens, loss, limits, cut=False)
    rows = [r for r in [*done, left] if r]
    assert sorted(i for r in rows for i, _, _ in r) == list(range(400))
    for r in rows:
        picks = [i for i, _, _ in r]
        assert tokens[picks].sum() <= 1000 and len(picks) <= 5 and loss[picks].sum() <= 400
    least = max(tokens.sum() / 1000, 400 / 5, loss.sum() / 400)
    assert len(rows) <= 1.2 * least
    with pytest.raises(ValueError):
        packing.fill(np.array([1001]), np.array([0]), limits, cut=False)


def test_all_limits_hold_with_cutting():
    rng = np.random.default_rng(5)
    tokens = rng.integers(1, 5000, 300)
    loss = (tokens * rng.uniform(0, 1, 300)).astype(np.int64)
    limits = packing.Limits(1000, 4, 500)
    done, left = packing.fill(tokens, loss, limits)
    covered = np.zeros(300, np.int64)
    for row in [*done, left]:
        bears = 0
        for i, start, n in row:
            assert n > 0
            covered[i] += n
            quiet = tokens[i] - loss[i]
            bears += max(0, start + n - quiet) - max(0, start - quiet)
        assert sum(n for _, _, n in row) <= 1000 and len(row) <= 4 and bears <= 500
    assert (covered == tokens).all()
