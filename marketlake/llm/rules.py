"""Quality rules as a ledger: measure once, keep one failure bit per rule, decide later.

``ledger`` reads every text once and stores the measurements and a bit mask of the rules that
fail. A policy is a versioned mask: applying another version, or asking what single rules cost,
reads masks only, no text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper")
SYMBOLS = "#*$%&|<>"
WHITE = r"[\\x20\\x09-\\x0D]+"
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """Fails where ``fails`` holds over the measurements; ``bit`` never changes its meaning."""

    name: str
    bit: int
    fails: Callable[[Callable[[str], Column]], Column]


RULES = (
    Rule("few_words", 0, lambda m: m("n_words") < 10),
    Rule("repeated_words", 1, lambda m: 100 * m("n_repeat_words") > 20 * m("n_words")),
    Rule("symbols", 2, lambda m: 10 * m("n_symbols") > m("n_words")),
    Rule("short_words", 3, lambda m: m("word_chars") < 2 * m("n_words")),
    Rule("long_words", 4, lambda m: m("word_chars") > 12 * m("n_words")),
    Rule("repeated_lines", 5, lambda m: 2 * m("n_dup_lines") > m("n_lines")),
    Rule("shouting", 6, lambda m: 2 * m("n_upper") > m("word_chars")),
)
BASE = ("few_words", "repeated_words")


@dataclass(frozen=True)
class Policy:
    """A version and the names of the rules that count in it."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        bits = {r.name: r.bit for r in RULES}
        return sum(1 << bits[n] for n in self.rules)


POLICIES = {
    "v1": Policy("v1", BASE),
    "v2": Policy("v2", tuple(r.name for r in RULES)),
}


def measured(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and the measurements of each text; null counts as empty.

    Windows of five words are compared by a 64-bit hash. Positions are only sorted in texts
    that have a repeated window.
    """
    own = df.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    split = own.select(
        *keep,
        F.expr(f"filter(split(_text, '{WHITE}'), w -> w <> '')").alias("_words"),
        F.expr(f"filter(split(_text, '\\\\n'), l -> l rlike '[^\\\\x20\\\\x09-\\\\x0D]')").alias("_lines"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace("_text", r"\P{Lu}+", "")).cast("long").alias("n_upper"),
    )
    at = ", ".join(f"_words[i + {k}]" for k in range(WINDOW))
    hashed = split.select(
        *keep,
        F.size("_words").cast("long").alias("n_words"),
        F.expr("aggregate(_words, 0L, (n, w) -> n + length(w))").alias("word_chars"),
        "n_symbols",
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        "n_upper",
        F.expr(
            f"CASE WHEN size(_words) >= {WINDOW} THEN"
            f" transform(sequence(0, size(_words) - {WINDOW}), i -> xxhash64({at})) END"
        ).alias("_hashes"),
    )
    ordered = hashed.withColumn(
        "_sorted",
        F.expr(
            "CASE WHEN size(array_distinct(_hashes)) < size(_hashes) THEN"
            " array_sort(transform(_hashes, (h, i) -> struct(h, i))) END"
        ),
    )
    places = ordered.withColumn(
        "_places",
        F.expr(
            "array_sort(transform(filter(_sorted, (x, k) -> (k > 0 AND _sorted[k - 1].h = x.h)"
            " OR (k < size(_sorted) - 1 AND _sorted[k + 1].h = x.h)), x -> x.i))"
        ),
    )
    covered = F.expr(
        f"aggregate(_places, struct(0L AS n, -{WINDOW} AS last),"
        f" (a, p) -> struct(a.n + least({WINDOW}, p - a.last) AS n, p AS last), a -> a.n)"
    )
    # The id adds nothing, but keeps filters above: below, Spark would put the whole expression in
    # place of every use of an array and sort it once per element.
    once = F.monotonically_increasing_id() * 0
    counted = places.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long") + once)
    return counted.select(*keep, *MEASURES)


def ledger(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, all measurements and ``fail_bits``: one row per row of ``df``.

    Null and empty texts have all measurements 0 and fail ``few_words``. Repeated rows stay
    repeated. Further columns of ``df`` are not read, whatever their names.
    """
    own = measured(df, text, keep)
    bits = [F.when(r.fails(F.col), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long") for r in RULES]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask.bitwiseOR(bit)
    return own.withColumn("fail_bits", mask)


def passes(policy: Policy, bits: str = "fail_bits") -> Column:
    """True where no rule of the policy fails."""
    return F.col(bits).bitwiseAND(F.lit(policy.mask)) == 0


def ablation(entries: DataFrame, policy: Policy) -> DataFrame:
    """What every rule of the policy does: rule, n_failed (rows it fails) and n_only (rows that
    it alone fails, which come back when it is dropped). One row per rule, also for no entries.

    Rows are counted by mask first; there are at most 2 ** rules masks.
    """
    masks = (
        entries.select(F.col("fail_bits").bitwiseAND(F.lit(policy.mask)).alias("m"))
        .groupBy("m")
        .agg(F.count("*").alias("n"))
    )
    mine = [r for r in RULES if r.name in policy.rules]
    sums = masks.agg(
        *[F.sum(F.when(F.col("m").bitwiseAND(F.lit(1 << r.bit)) != 0, F.col("n"))).alias(f"failed_{r.bit}") for r in mine],
        *[F.sum(F.when(F.col("m") == F.lit(1 << r.bit), F.col("n"))).alias(f"only_{r.bit}") for r in mine],
    )
    zero = F.lit(0).cast("long")
    return sums.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(r.name).alias("rule"),
                        F.coalesce(f"failed_{r.bit}", zero).alias("n_failed"),
                        F.coalesce(f"only_{r.bit}", zero).alias("n_only"),
                    )
                    for r in mine
                ]
            )
        )
    )
