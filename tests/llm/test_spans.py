"""Repeated passages against a plain reading of the same definition, and planted passages."""

import re

import numpy as np

from marketlake.llm import spans
from marketlake.llm.arrow import utf8
from marketlake.llm.registry import table
from marketlake.llm.shingles import words_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def hashes(text):
    import pyarrow as pa

    data, at = utf8(pa.array([text]))
    return words_of(data, at)[0]


def sentences(text):
    """(begin, end, words) of each sentence, word by word."""
    words = list(WORD.finditer(text))
    own = hashes(text).tolist()
    cuts = [False] * len(own)
    for i in range(len(own) - spans.LONG + 1):
        least = min(own[i : i + spans.LONG])
        cuts[max(k for k in range(i, i + spans.LONG) if own[k] == least)] = True
    closed, out = [], []
    for k, m in enumerate(words):
        nxt = words[k + 1].start() if k + 1 < len(words) else len(text)
        closed.append(m[0][-1] in ".!?,;:" or "\n" in text[m.end() : nxt] or k + 1 == len(words))
    first = 0
    for k in range(len(words)):
        if closed[k]:
            begin = first
            for x in range(first, k + 1):
                if x == k or (k + 1 - first > spans.LONG and cuts[x]):
                    out.append((words[begin].start(), words[x].end(), words[begin : x + 1]))
                    begin = x + 1
            first = k + 1
    return out


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows):
    """The spans to be removed, in order of (id, place); rows have distinct ids."""
    seen, out = set(), {}
    for name, text in sorted(rows, key=lambda r: r[0]):
        found = sentences(text or "")
        drop = [False] * len(found)
        for i in range(len(found)):
            j, total = i, 0
            while j < len(found) and (j - i < spans.RUN or total < spans.WORDS):
                total += len(found[j][2])
                j += 1
            if j - i < spans.RUN or total < spans.WORDS:
                continue
            key = tuple(tuple(lower(w[0]) for w in s[2]) for s in found[i:j])
            if key in seen:
                drop[i:j] = [True] * (j - i)
            seen.add(key)
        parts, k = [], 0
        while k < len(found):
            if drop[k]:
                first = k
                while k < len(found) and drop[k]:
                    k += 1
                parts.append(f"{found[first][0]}:{found[k - 1][1]}")
            else:
                k += 1
        out[name] = (",".join(parts), len(found), sum(drop))
    return out


def check(df):
    wanted = brute([(r["doc_id"], r["text"]) for r in df.collect()])
    rows = spans.without_repeats(df).collect()
    assert {r["doc_id"]: (r["removed"], r["n_sentences"], r["n_removed"]) for r in rows} == wanted
    return rows


def test_documents_against_plain_reading(llm):
    old = table(llm, "/root/testdata/sf0.01", "documents")
    texts = {r["doc_id"]: r["text"] for r in old.collect()}
    rows = check(old)
    assert sum(r["n_removed"] > 0 for r in rows) > 50
    for r in rows:
        cut = [tuple(map(int, x.split(":"))) for x in r["removed"].split(",") if x]
        assert WORD.findall(r["text"]) == WORD.findall(
            "".join(c for k, c in enumerate(texts[r["doc_id"]]) if not any(a <= k < b for a, b in cut))
        )
        if not cut:
            assert r["text"] == texts[r["doc_id"]]


def test_planted_passages_go_but_for_the_first(docs):
    rng = np.random.default_rng(6)

    def prose(n):
        words = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(n)]
        return " ".join(w + ("." if rng.random() < 0.1 else "") for w in words)

    passage = prose(60)
    texts = [f"{prose(80)}\n{passage}\n{prose(50)}" if k % 3 == 0 else f"{prose(60)} {passage} {prose(40)}" for k in range(30)]
    clean = [prose(150) for _ in range(20)]
    rows = {r["doc_id"]: r for r in check(docs(texts + clean))}
    core = set(passage.split()[16:-16])
    assert core <= set(rows[0]["text"].split())
    for k in range(1, 30):
        assert not core & set(rows[k]["text"].split())
    for k in range(30, 50):
        assert rows[k]["text"] == clean[k - 30]


ODD = [
    None, "", " \n", "One.", "a b c. d e f. g h i j k l.", "A b c. d E f. g h i j k l.", "x\n" * 5, "Hi. " * 4000, "word " * 20_000,
    "é" * 100_000, "a, b, c, d, e, f, g, h, i, j, k, l, m, n.  a, b, c, d, e, f, g, h, i, j, k, l, m, n.", "no end here", "  lead. tail  ",
]


def test_odd_texts(docs):
    rows = check(docs(ODD).withColumnsRenamed({"lang": "removed", "source": "n_sentences", "n_chars": "mark"}))
    assert {r["doc_id"]: r["text"] for r in rows}[0] is None


def test_repeated_rows_are_one_document(docs):
    text = "one two three four. five six seven eight. nine ten eleven twelve."
    rows = spans.without_repeats(docs([(1, text), (1, text), (2, text), (None, text)])).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in rows) == [(0, text), (1, ""), (1, ""), (2, "")]
    assert spans.without_repeats(docs([])).collect() == []


def keys(text):
    """Hashes of the spans of a text."""
    import pyarrow as pa

    hashed, size, first, _ = spans.sentences(*utf8(pa.array([text])))
    return set(spans.spans(hashed, size, first)[0].tolist())


def test_fifty_words_hold_a_span_wherever_they_stand():
    rng = np.random.default_rng(10)

    def prose(n, ends):
        words = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(n)]
        return " ".join(w + ("." if rng.random() < ends else "") for w in words)

    for trial in range(900):
        ends = (0.0, 0.05, 0.12)[trial % 3]
        passage = prose(50 + trial % 11, ends)
        one, other = (
            f"{prose(int(rng.integers(0, 40)), ends)} {passage} {prose(int(rng.integers(0, 40)), ends)}" for _ in range(2)
        )
        assert keys(one) & keys(other), passage


def test_worst_places_of_sentence_ends():
    words = [f"w{k}" for k in range(50)]
    for ends in ((11, 23, 35), (11, 23, 37), (0, 12, 24, 36, 48), (12, 25, 38), (24,), (11, 37), (12, 36)):
        passage = " ".join(w + "." * (k in ends) for k, w in enumerate(words))
        assert keys(f"x. {passage}. y") & keys(f"{'a ' * 30}{passage} {'b ' * 30}"), ends


def test_divisions_leave_no_long_sentence_and_do_not_depend_on_neighbours():
    import pyarrow as pa

    rng = np.random.default_rng(12)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 50, n)) for n in (3, 7, 8, 9, 40, 500)] + ["w " * 40, ""]
    data, at = utf8(pa.array(texts))
    _, size, first, begins = spans.sentences(data, at)
    assert size.max() <= spans.LONG
    for k, text in enumerate(texts):
        own = spans.sentences(*utf8(pa.array([text])))
        assert (own[3] == begins[first[k] : first[k + 1]] - at[k]).all()
