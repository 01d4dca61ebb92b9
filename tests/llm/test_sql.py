"""Operators that SQL can express, on tables full of odd rows."""

import duckdb
import pytest

from marketlake.llm import mixing, queries, rules
from marketlake.llm.registry import ORACLES, QUERIES


@pytest.fixture
def same(llm, tmp_path):
    def run(name, table, df):
        df.write.parquet(f"{tmp_path}/{table}.parquet")
        found = QUERIES[name](llm, str(tmp_path))
        columns = sorted(found.columns)
        con = duckdb.connect()
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
        result = con.execute(ORACLES[name])
        names = [d[0] for d in result.description]
        assert sorted(names) == columns
        wanted = [tuple(r[names.index(c)] for c in columns) for r in result.fetchall()]
        rows = [tuple(r) for r in found.select(*columns).collect()]
        assert sorted(map(str, rows)) == sorted(map(str, wanted))
        return [dict(zip(columns, r, strict=True)) for r in rows]

    return run


TEXTS = [
    None, "", " \n\t", "one", "a b c d e a b c d e", "a a a a a a a a a a a a", "x\ny\nx\n\n \nx", "ÀÉ Ü ABC def\x0bg\x0ch\r\n",
    "#*$%&|<> " * 4, "w " * 30_000, "q" * 60_000, "a b c d e f a b c d e g b c d e f", "🙂 é " * 9, "İ\x85 \x1f y",
    "this is a plain text of ten words and some more words",
]


def test_rules(same, docs):
    rows = same("op5_rule_ledger", "documents", docs([*TEXTS, (3, "one"), (None, "z")]).withColumnsRenamed({"lang": "n_words", "source": "kept"}))
    assert len(rows) == len(TEXTS) + 2


def test_rules_without_rows(same, docs):
    assert same("op5_rule_ledger", "documents", docs([])) == []


def test_ablation(same, docs):
    rows = same("rule_ablation", "documents", docs([*TEXTS, (3, "one"), (None, "z")]).withColumnsRenamed({"lang": "fail_bits"}))
    assert {r["policy"] for r in rows} == set(rules.POLICIES) and sum(r["n_failed"] for r in rows) > 0


def test_ablation_without_rows(same, docs):
    assert {(r["n_failed"], r["n_only"]) for r in same("rule_ablation", "documents", docs([]))} == {(0, 0)}


def test_policies_and_ablation(docs):
    entries = rules.ledger(docs(TEXTS))
    kept = {v: entries.where(rules.passes(p)).count() for v, p in rules.POLICIES.items()}
    assert kept["v2"] <= kept["v1"]
    bits = [r["fail_bits"] for r in entries.collect()]
    for policy in rules.POLICIES.values():
        found = {r["rule"]: (r["n_failed"], r["n_only"]) for r in rules.ablation(entries, policy).collect()}
        assert found == {
            r.name: (sum(b >> r.bit & 1 for b in bits), sum(b & policy.mask == 1 << r.bit for b in bits))
            for r in rules.RULES
            if r.name in policy.rules
        }
    assert {r["n_failed"] for r in rules.ablation(entries.where("false"), rules.POLICIES["v2"]).collect()} == {0}


CHAT = "conv_id long, turn long, role string, text string"


def test_chat(same, llm):
    rows = [
        (1, 0, "system", "be kind"), (1, 1, "ann", "hi <|im_end|>"), (1, 2, "bob", None), (1, 2, "bob", None), (1, None, None, "first"),
        (2, 0, "user", "é🙂"), (2, 1, "assistant", "ok"), (2, 2, "a<|b", "x"), (None, 0, "user", "no id"), (None, 0, "user", "no id"),
        (3, 0, "system", "alone"),
    ]
    rows += [(9, k, f"s{k % 5}", "t" * (k % 7)) for k in range(300)] + [(10, 0, "user", "again")] * 150
    rows += [(11, 0, "system", "one"), (11, 1, "early", "I was here"), (11, 1500, "system", "two")]
    rows += [(11, 2 + k, "ann", "la" * (k % 3)) for k in range(2500)] + [(None, k, "user", "no id") for k in range(1, 1100)]
    df = llm.createDataFrame(rows, CHAT)
    found = same("op3_chat_perspectives", "conversations", df.selectExpr("*", "role AS speaker", "1 AS part"))
    for r in found:
        for span in filter(None, r["mask"].split(",")):
            a, b = map(int, span.split(":"))
            assert r["text"][a:b].endswith("<|im_end|>") and r["text"][:a].endswith("<|im_start|>assistant\n")
        assert r["text"].count("<|im_start|>assistant\n") == r["n_loss_turns"]
    assert {(r["speaker"], r["part"], r["n_turns"]) for r in found if r["conv_id"] == 9} == {(f"s{s}", 0, 300) for s in range(5)}
    # a dialogue beyond one part: everyone in every part, led by the system turn in force
    assert {(r["speaker"], r["part"]) for r in found if r["conv_id"] == 11} == {(s, p) for s in ("ann", "early") for p in range(3)}
    led = {r["part"]: r["text"] for r in found if r["conv_id"] == 11 and r["speaker"] == "early"}
    assert [led[p].startswith(f"<|im_start|>system\n{s}<|im_end|>") for p, s in ((0, "one"), (1, "one"), (2, "two"))] == [True] * 3
    assert not [r for r in found if r["conv_id"] == 3]


def test_chat_without_rows(same, llm):
    assert same("op3_chat_perspectives", "conversations", llm.createDataFrame([], CHAT)) == []


def mixed_rows(docs):
    from pyspark.sql import functions as F

    df = docs([*TEXTS, *[f"word {k} " * (k % 40) for k in range(400)], (3, "one"), (None, "z @ | x")])
    k = F.monotonically_increasing_id() % 11
    return df.withColumns(
        {
            "lang": F.when(k < 6, "en").when(k < 8, "fr").when(k < 10, "xx"),
            "source": F.when(k != 4, F.concat(F.lit("s"), (F.xxhash64("text") % 3).cast("string"))),
        }
    )


def test_mixing(same, docs):
    from pyspark.sql import functions as F

    rows = same("op9_mix", "documents", mixed_rows(docs).withColumns({"weight": F.lit("w"), "copies": F.lit(2)}))
    assert 0 < sum(r["kept"] for r in rows) < len(rows)


def test_mixing_without_rows(docs):
    assert queries.mix(docs([])).collect() == []


def test_raked_weights_meet_all_shares(docs):
    df = queries.mix(mixed_rows(docs)).withColumn("topic", mixing.topic_of())
    rows = df.select("source", "lang", "topic", "tokens", "weight").collect()
    whole = sum(r["tokens"] for r in rows)
    sums = {}
    for r in rows:
        for dim in mixing.DIMS:
            for key, x in (("natural", r["tokens"]), ("raked", r["tokens"] * r["weight"])):
                sums.setdefault((dim, key), {}).setdefault(r[dim] or mixing.NONE, []).append(x / whole)
    for dim in mixing.DIMS:
        natural = {v: sum(x) for v, x in sums[dim, "natural"].items()}
        goal = mixing._wanted(natural, queries.MIX[dim])
        for value, x in sums[dim, "raked"].items():
            assert abs(sum(x) - goal[value]) < 1e-3, (dim, value)
