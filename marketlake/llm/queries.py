"""The operators of this subpackage on the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import durable
from . import cotraining, secrets
from .chat import TURNS, perspectives
from .codes import compressed
from .curves import nearest
from .html import extracted
from .mixing import SWEEPS, Target, mixed, topic_of, words
from .neardup import near_duplicates
from .packing import packed
from .phrases import collocations
from .pivots import simhash_duplicates
from .registry import query, table
from .rules import POLICIES, RULES, ablation, ledger, passes
from .spans import without_repeats

# --- 3: chat formatting ---------------------------------------------------------
CHAT_SQL = f"""
WITH own AS (
  SELECT conv_id, replace(coalesce(role, 'unknown'), '<|', '<\\|') AS role,
    replace(coalesce(text, ''), '<|', '<\\|') AS said,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, replace(coalesce(role, 'unknown'), '<|', '<\\|'),
      replace(coalesce(text, ''), '<|', '<\\|')) - 1 AS k
  FROM conversations),
parts AS (SELECT DISTINCT conv_id, k // {TURNS} AS part FROM own),
led AS (
  SELECT p.conv_id, p.part, arg_max(o.said, o.k) AS said FROM parts p
  JOIN own o ON p.conv_id IS NOT DISTINCT FROM o.conv_id AND o.role = 'system' AND o.k < p.part * {TURNS} GROUP BY ALL),
turns AS (
  SELECT conv_id, k // {TURNS} AS part, k, role, said FROM own
  UNION ALL SELECT conv_id, part, -1, 'system', said FROM led),
speakers AS (SELECT DISTINCT conv_id, role AS speaker FROM own WHERE role <> 'system'),
pieces AS (
  SELECT s.conv_id, o.part, s.speaker, o.k, o.role = s.speaker AS loss,
    CASE WHEN o.role = 'system' THEN '<|im_start|>system' || chr(10)
      WHEN o.role = s.speaker THEN '<|im_start|>assistant' || chr(10)
      ELSE '<|im_start|>user name=' || o.role || chr(10) END AS head,
    o.said || '<|im_end|>' AS body
  FROM speakers s JOIN turns o ON s.conv_id IS NOT DISTINCT FROM o.conv_id),
placed AS (
  SELECT *, coalesce(sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, part, speaker ORDER BY k
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT + length(head) AS start FROM pieces)
SELECT conv_id, part::INTEGER AS part, speaker, count(*) FILTER (k >= 0)::BIGINT AS n_turns, count(*) FILTER (loss)::BIGINT AS n_loss_turns,
  string_agg(head || body || chr(10), '' ORDER BY k) AS text,
  coalesce(string_agg(start || ':' || (start + length(body)), ',' ORDER BY k) FILTER (loss), '') AS mask
FROM placed GROUP BY conv_id, part, speaker
"""


@query("op3_chat_perspectives", CHAT_SQL)
def chat_perspectives(spark, sf_dir):
    """Every conversation from the view of each of its speakers."""
    return perspectives(table(spark, sf_dir, "conversations"))


# --- 5: quality rules -------------------------------------------------------------
_FAILS = {
    "few_words": "n_words < 10",
    "repeated_words": "100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 12 * n_words",
    "repeated_lines": "2 * n_dup_lines > n_lines",
    "shouting": "2 * n_upper > word_chars",
}
_BITS = " + ".join(f"CASE WHEN {_FAILS[r.name]} THEN {1 << r.bit} ELSE 0 END" for r in RULES)
RULES_SQL = f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w FROM t),
word AS (SELECT r, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM w),
win AS (
  SELECT * FROM (
    SELECT r, i, x || ' ' || lead(x, 1) OVER o || ' ' || lead(x, 2) OVER o || ' ' || lead(x, 3) OVER o || ' ' || lead(x, 4) OVER o AS s
    FROM word WINDOW o AS (PARTITION BY r ORDER BY i))
  WHERE s IS NOT NULL),
dup AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS n FROM win) WHERE n > 1),
cover AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM dup) GROUP BY r),
lines AS (SELECT r, unnest(string_split(text, chr(10))) AS l FROM t),
dups AS (SELECT r, count(*) AS n, count(*) - count(DISTINCT l) AS d FROM lines WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY r),
m AS (
  SELECT t.doc_id, len(w.w)::BIGINT AS n_words, length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(dups.n, 0)::BIGINT AS n_lines, coalesce(dups.d, 0)::BIGINT AS n_dup_lines,
    coalesce(cover.n, 0)::BIGINT AS n_repeat_words, length(regexp_replace(text, '\\P{{Lu}}', '', 'g'))::BIGINT AS n_upper
  FROM t JOIN w USING (r) LEFT JOIN dups USING (r) LEFT JOIN cover USING (r))
SELECT *, ({_BITS})::BIGINT AS fail_bits, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  ({_BITS}) = 0 AS kept FROM m
"""


@query("op5_rule_ledger", RULES_SQL)
def rule_ledger(spark, sf_dir):
    """Measurements, failure bits and the verdict of the newest policy for every document."""
    return ledger(table(spark, sf_dir, "documents")).select(
        "*", (~passes(POLICIES["v1"])).alias("base_failed"), passes(POLICIES["v2"]).alias("kept")
    )


ABLATION_SQL = f"WITH led AS MATERIALIZED ({RULES_SQL}) " + " UNION ALL ".join(
    f"SELECT '{version}' AS policy, '{r.name}' AS rule, count(*) FILTER (fail_bits & {1 << r.bit} <> 0) AS n_failed,"
    f" count(*) FILTER (fail_bits & {policy.mask} = {1 << r.bit}) AS n_only FROM led"
    for version, policy in POLICIES.items()
    for r in RULES
    if r.name in policy.rules
)


@query("rule_ablation", ABLATION_SQL)
def rule_ablation(spark, sf_dir):
    """What every rule of every policy does, from one stored ledger of all documents."""
    entries = durable(ledger(table(spark, sf_dir, "documents"), keep=()).select("fail_bits"))
    found = [ablation(entries, policy).select(F.lit(v).alias("policy"), "*") for v, policy in POLICIES.items()]
    return reduce(DataFrame.union, found)


# --- 9: mixing ----------------------------------------------------------------------
MIX = {
    "source": Target(temper=0.7),
    # null and all other languages keep their natural share
    "lang": Target({"en": 0.55, "fr": 0.17, "de": 0.17, "es": 0.11}, spare=True),
    "topic": Target(temper=0.9),
}


def _rake_sql() -> str:
    """The sweeps as a chain: one step per dimension, each scaled to its wanted shares."""
    steps, last = [], "cells"
    for sweep in range(SWEEPS):
        for dim in ("source", "lang", "topic"):
            name = f"s{sweep}_{dim}"
            steps.append(
                f"{name} AS MATERIALIZED (SELECT source, lang, topic, tokens, t_source, t_lang, t_topic,"
                f" coalesce(w * t_{dim} / nullif(sum(w) OVER (PARTITION BY {dim}), 0), 0) AS w FROM {last})"
            )
            last = name
    # the library fits the sources once more at the end
    steps.append(
        f"raked AS (SELECT source, lang, topic, coalesce(w * t_source / nullif(sum(w) OVER (PARTITION BY source), 0), 0)"
        f" * sum(tokens) OVER () / tokens AS w FROM {last})"
    )
    return ",\n".join(steps)


def _mix_sql(documents: str = "documents") -> str:
    return f"""
WITH own AS (
  SELECT *, coalesce(source, '(none)') AS _source, coalesce(lang, '(none)') AS _lang,
    greatest(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')), 1)::BIGINT AS _tokens,
    CASE WHEN contains(coalesce(text, ''), ' | ') THEN 'table' WHEN contains(coalesce(text, ''), '!!') THEN 'loud'
      WHEN contains(coalesce(text, ''), '###') THEN 'symbols' WHEN contains(lower(coalesce(text, '')), 'license') THEN 'legal'
      WHEN contains(coalesce(text, ''), '@') THEN 'contact' ELSE 'prose' END AS _topic
  FROM {documents}),
plain AS (SELECT _source AS source, _lang AS lang, _topic AS topic, sum(_tokens)::DOUBLE AS tokens FROM own GROUP BY ALL),
src AS (SELECT source, pow(sum(tokens), 0.7) AS x FROM plain GROUP BY source),
asked AS (
  SELECT lang, sum(tokens) AS n, CASE lang WHEN 'en' THEN 0.55 WHEN 'fr' THEN 0.17 WHEN 'de' THEN 0.17 WHEN 'es' THEN 0.11 END AS share
  FROM plain GROUP BY lang),
lng AS (
  SELECT lang, CASE WHEN share IS NULL THEN n / sum(n) OVER () ELSE share / sum(share) OVER ()
    * (1 - coalesce(sum(n) FILTER (share IS NULL) OVER (), 0) / sum(n) OVER ()) END AS x FROM asked),
tpc AS (SELECT topic, pow(sum(tokens), 0.9) AS x FROM plain GROUP BY topic),
cells AS (
  SELECT source, lang, topic, tokens, src.x / (SELECT sum(x) FROM src) AS t_source,
    lng.x / (SELECT sum(x) FROM lng) AS t_lang, tpc.x / (SELECT sum(x) FROM tpc) AS t_topic, tokens AS w
  FROM plain JOIN src USING (source) JOIN lng USING (lang) JOIN tpc USING (topic)),
{_rake_sql()},
drawn AS (
  SELECT own.*, round(raked.w, 6) + 0.0 AS _weight,
    ('0x' || substr(md5(concat_ws(':', coalesce(doc_id::VARCHAR, ''), '1')), 1, 8))::BIGINT / 4294967296.0 AS _u
  FROM own JOIN raked ON _source = raked.source AND _lang = raked.lang AND _topic = raked.topic)
"""


MIX_SQL = (
    _mix_sql()
    + """SELECT doc_id, _tokens AS tokens, _weight AS weight, least(_weight, 1.0) AS probability,
  floor(_weight + _u)::BIGINT AS copies, floor(_weight + _u) > 0 AS kept FROM drawn"""
)


def mix(df, targets=MIX):
    return mixed(df, targets, topic_of(), words())


@query("op9_mix", MIX_SQL)
def mix_query(spark, sf_dir):
    """Raked weight and draw of every document."""
    drawn = mix(table(spark, sf_dir, "documents"))
    return drawn.select("doc_id", "tokens", "weight", "probability", "copies", "kept")


# --- 8: secrets -----------------------------------------------------------------------
@query("op8_markov_secrets")
def markov_secrets(spark, sf_dir):
    """All secrets of every document: counts and digest of the base spans, and all spans."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs, secrets.train(docs)).drop("text")
    count = lambda kind: F.expr(f"cast(size(filter(secrets, s -> s.kind = '{kind}')) AS long)")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in secrets.KINDS],
        "base_sha256",
        F.expr("array_join(transform(secrets, s -> concat(s.kind, ':', s.start, ':', s.stop)), ',')").alias("spans"),
    )


# --- 6: main text ------------------------------------------------------------------------
@query("op6_text_density")
def text_density(spark, sf_dir):
    """Main text of every page."""
    return extracted(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


# --- 7: packing ----------------------------------------------------------------------------
def pack(df):
    import public_tokenizers

    return packed(df, public_tokenizers.path("word_bpe_49k.json"))


@query("op7_vector_packing")
def vector_packing(spark, sf_dir):
    """Every document cut to pieces of sequences of at most 4096 tokens."""
    return pack(table(spark, sf_dir, "documents"))


# --- 2: nearest neighbours -------------------------------------------------------------------
@query("op2_hilbert_curves")
def hilbert_neighbours(spark, sf_dir):
    """The 20 nearest vectors found for every vector whose id is divisible by 20."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


# --- 4: near-duplicates ------------------------------------------------------------------------
@query("op4_setsketch")
def setsketch(spark, sf_dir):
    """Component of every document among those that share 85 % of their shingles."""
    return near_duplicates(table(spark, sf_dir, "documents"))


# --- 10: repeated passages -----------------------------------------------------------------------
@query("op10_sentence_spans")
def sentence_spans(spark, sf_dir):
    """Every document without the passages that stand elsewhere before."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return without_repeats(docs).select("doc_id", "n_sentences", "n_removed", "removed", "text")


# --- 1: quality classifier -------------------------------------------------------------------------
@query("op1_cotraining")
def cotraining_query(spark, sf_dir):
    """Quality of every document by the text, the metadata and both."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = cotraining.classified(docs, cotraining.train(docs, labels)).drop("text")
    return scored.select("doc_id", *[F.round(c, 9).alias(c) for c in ("text_score", "meta_score", "score")], "kept")


# --- 11: SimHash near-duplicates ---------------------------------------------------------------------
@query("op11_pivot_tables")
def pivot_tables(spark, sf_dir):
    """Fingerprint of every document, and its component among those at most four bits apart."""
    return simhash_duplicates(table(spark, sf_dir, "documents"))


# --- 12: collocations -----------------------------------------------------------------------------------
COLLOCATIONS_SQL = """
WITH pieces AS (
  SELECT lang, row_number() OVER () AS piece, piece_text FROM (SELECT lang, unnest(x) AS piece_text FROM (
    SELECT coalesce(lang, 'und') AS lang, string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]') AS x
    FROM documents))),
split AS (SELECT lang, piece, regexp_extract_all(piece_text, '[^\x20\x09]+') AS w FROM pieces),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM split GROUP BY lang),
word AS (SELECT lang, piece, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM split),
run AS (
  SELECT lang, w AS a, lead(w, 1) OVER o AS b, lead(w, 2) OVER o AS c FROM word WINDOW o AS (PARTITION BY piece ORDER BY i)),
f AS MATERIALIZED (
  SELECT lang, 1 AS size, [a] AS words, count(*) AS f FROM run GROUP BY lang, a HAVING count(*) >= 10
  UNION ALL SELECT lang, 2, [a, b], count(*) FROM run WHERE b IS NOT NULL GROUP BY lang, a, b HAVING count(*) >= 10
  UNION ALL SELECT lang, 3, [a, b, c], count(*) FROM run WHERE c IS NOT NULL GROUP BY lang, a, b, c HAVING count(*) >= 10),
cuts AS (
  SELECT c.lang, c.words, c.f AS a, x.k, l.f AS l, r.f AS r,
    (1000000::HUGEINT * c.f * c.f) // (l.f::HUGEINT * r.f) AS score
  FROM f c JOIN (SELECT unnest([1, 2]) AS k) x ON x.k < c.size
  JOIN f l ON l.lang = c.lang AND l.words = c.words[1:x.k]
  JOIN f r ON r.lang = c.lang AND r.words = c.words[x.k + 1:]),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1),
inner_parts AS (
  SELECT lang, unnest([words[1:2], words[2:3]]) AS words, f FROM f WHERE size = 3),
around AS (SELECT lang, words, max(f) AS longer FROM inner_parts GROUP BY ALL),
kept AS (
  SELECT lowest.*, array_to_string(words, ' ') AS phrase FROM lowest LEFT JOIN around USING (lang, words)
  WHERE longer IS NULL OR 100 * longer < 50 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""


@query("op12_rabin_karp", COLLOCATIONS_SQL)
def rabin_karp(spark, sf_dir):
    """The first 2000 collocations of two and three words of every language."""
    return collocations(table(spark, sf_dir, "documents"))


# --- 13: vector codes -------------------------------------------------------------------------------------
def _nearest_sql(book: str) -> str:
    return f"""SELECT r, p, min(d * 64 + e) % 64 AS e, min(d * 64 + e) // 64 AS d FROM (
    SELECT r, p, e, sum((x - c) * (x - c)) AS d FROM pieces JOIN {book} USING (p, j) GROUP BY r, p, e) GROUP BY r, p"""


def _mean_sql(book: str, codes: str) -> str:
    return f"""SELECT p, e, j, coalesce((s - ((s % n) + n) % n) // n, c) AS c FROM {book} LEFT JOIN (
    SELECT p, e, j, sum(x) AS s, count(*) AS n FROM pieces JOIN {codes} USING (r, p) GROUP BY p, e, j) USING (p, e, j)"""


CODES_SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::HUGEINT) AS v
  FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pieces AS MATERIALIZED (
  SELECT r, g // (len(v) // 16) AS p, g % (len(v) // 16) AS j, v[g + 1] AS x FROM (SELECT r, v, unnest(range(len(v))) AS g FROM kept)),
b0 AS MATERIALIZED (SELECT p, r - 1 AS e, j, x AS c FROM pieces WHERE r <= 64),
c0 AS MATERIALIZED ({_nearest_sql("b0")}),
b1 AS MATERIALIZED ({_mean_sql("b0", "c0")}),
c1 AS MATERIALIZED ({_nearest_sql("b1")}),
b2 AS MATERIALIZED ({_mean_sql("b1", "c1")}),
c2 AS MATERIALIZED ({_nearest_sql("b2")}),
told AS (
  SELECT r, string_agg(printf('%02x', e::BIGINT), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM c2 GROUP BY r)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY p, e, j)) FROM b2) AS codebooks_sha256
FROM kept JOIN told USING (r)
"""


@query("op13_limb_split", CODES_SQL)
def limb_split(spark, sf_dir):
    """Code and error of every vector, after two rounds over its codebooks."""
    return compressed(table(spark, sf_dir, "embeddings"))
