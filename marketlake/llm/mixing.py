"""Mixing: token weights raked to source, language and topic shares, then calibrated sampling."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import durable

DIMS = ("source", "lang", "topic")
SWEEPS = 12
MAX_PAIRS = 10_000
NONE = "(none)"


@dataclass(frozen=True)
class Target:
    """Wanted shares of one dimension.

    Values in ``shares`` get that share; all others divide what is left in proportion to their
    tokens to the power ``temper``. Shares are scaled to 1 over the values that occur. With
    ``spare`` (for languages and topics) the others keep their natural share together, and the
    listed ones divide what remains. Where nothing that occurs has a share, shares are natural.
    """

    shares: dict[str, float] = field(default_factory=dict)
    temper: float = 1.0
    spare: bool = False

    @property
    def rest(self) -> float:
        return max(0.0, 1.0 - sum(self.shares.values()))


def words(text: str = "text") -> Column:
    """Tokens of a text: its words, and 1 for null or empty texts."""
    found = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    return F.greatest(found, F.lit(1)).cast("long")


def topic_of(text: str = "text") -> Column:
    """A topic by form, for tables without a topic column."""
    t = F.coalesce(F.col(text), F.lit(""))
    return (
        F.when(t.contains(" | "), "table")
        .when(t.contains("!!"), "loud")
        .when(t.contains("###"), "symbols")
        .when(F.lower(t).contains("license"), "legal")
        .when(t.contains("@"), "contact")
        .otherwise("prose")
    )


def _wanted(tokens: dict[str, float], target: Target) -> dict[str, float]:
    listed = {v: target.shares[v] for v in tokens if v in target.shares}
    free = {v: n**target.temper for v, n in tokens.items() if v not in target.shares}
    whole = sum(free.values())
    rest = target.rest
    if target.spare and listed:
        rest = sum(tokens[v] for v in free) / sum(tokens.values())
        given = sum(listed.values())
        listed = {v: x / given * (1.0 - rest) for v, x in listed.items()} if rest and given else listed
    found = listed | {v: rest * x / whole for v, x in free.items()}
    scale = sum(found.values())
    if scale <= 0:
        found, scale = tokens, sum(tokens.values())
    return {v: x / scale for v, x in found.items()}


def rake(cells: DataFrame, targets: dict[str, Target], sweeps: int = SWEEPS) -> DataFrame:
    """``cells`` (source, lang, topic, tokens) with ``weight``: target over natural share.

    Iterative proportional fitting in factors: weight = a(source) b(lang) c(topic). Sources may
    be many: a is found row by row, from one row per source. Languages and topics are lists; a
    sweep is one aggregation to their pairs, at most ``MAX_PAIRS`` numbers, else ValueError.
    """
    spark = cells.sparkSession
    pairs = cells.groupBy("lang", "topic").agg(F.sum("tokens").alias("n")).limit(MAX_PAIRS + 1).collect()
    if len(pairs) > MAX_PAIRS:
        raise ValueError(f"more than {MAX_PAIRS} pairs of language and topic")
    if not pairs:
        return cells.withColumn("weight", F.lit(None).cast("double"))
    pairs.sort(key=lambda r: (r["lang"], r["topic"]))
    whole = float(sum(r["n"] for r in pairs))
    per = [{}, {}]
    for r in pairs:
        for sums, value in zip(per, (r["lang"], r["topic"]), strict=True):
            sums[value] = sums.get(value, 0.0) + float(r["n"])
    lang_goal, topic_goal = _wanted(per[0], targets["lang"]), _wanted(per[1], targets["topic"])
    place = spark.createDataFrame([(r["lang"], r["topic"], k) for k, r in enumerate(pairs)], "lang string, topic string, k int")

    # one row per source: its tokens in each pair, and the share it should have
    goal = targets["source"]
    by_source = (
        cells.join(F.broadcast(place), ["lang", "topic"])
        .groupBy("source")
        .agg(F.collect_list(F.struct("k", F.col("tokens").cast("double").alias("n"))).alias("row"), F.sum("tokens").alias("n"))
    )
    listed = F.lit(None).cast("double")
    for value, share in goal.shares.items():
        listed = F.when(F.col("source") == value, F.lit(float(share))).otherwise(listed)
    by_source = durable(
        by_source.select("source", "row", listed.alias("listed"), F.pow(F.col("n").cast("double"), F.lit(goal.temper)).alias("free"))
    )
    sums = by_source.agg(
        F.sum("listed").alias("listed"), F.sum(F.when(F.col("listed").isNull(), F.col("free"))).alias("free")
    ).first()
    rest = goal.rest if sums["free"] else 0.0
    scale = (sums["listed"] or 0.0) + rest
    share = F.coalesce(F.col("listed"), F.lit(rest) * F.col("free") / F.lit(sums["free"] or 1.0)) / F.lit(scale)

    b, c = dict.fromkeys(lang_goal, 1.0), dict.fromkeys(topic_goal, 1.0)

    def factors() -> DataFrame:
        """a of every source, fitted to the present b and c."""
        bc = F.array(*[F.lit(b[r["lang"]] * c[r["topic"]]) for r in pairs])
        mass = F.aggregate("row", F.lit(0.0), lambda acc, x: acc + x["n"] * F.get(F.col("_bc"), x["k"]))
        return by_source.withColumn("_bc", bc).withColumn("_mass", mass).select(
            "source", "row", F.when(F.col("_mass") > 0, share / F.col("_mass")).otherwise(0.0).alias("a")
        )

    for _ in range(sweeps):
        exploded = factors().select("a", F.inline("row")).groupBy("k").agg(F.sum(F.col("a") * F.col("n")).alias("m"))
        m = {r["k"]: r["m"] for r in exploded.collect()}
        for goals, factor, name in ((lang_goal, b, "lang"), (topic_goal, c, "topic")):
            have = dict.fromkeys(goals, 0.0)
            for k, r in enumerate(pairs):
                have[r[name]] += m.get(k, 0.0) * b[r["lang"]] * c[r["topic"]]
            for value, x in have.items():
                factor[value] *= goals[value] / x if x > 0 else 0.0
    fitted = factors().select("source", "a")
    values = spark.createDataFrame(
        [(r["lang"], r["topic"], b[r["lang"]] * c[r["topic"]] * whole) for r in pairs], "lang string, topic string, bc double"
    )
    return (
        cells.join(F.broadcast(values), ["lang", "topic"])
        .join(fitted, "source")
        .select(*DIMS, "tokens", (F.col("a") * F.col("bc")).alias("weight"))
    )


def mixed(
    df: DataFrame,
    targets: dict[str, Target],
    topic: Column,
    tokens: Column,
    id: str = "doc_id",
    sweeps: int = SWEEPS,
    seed: int = 1,
) -> DataFrame:
    """``df`` with ``tokens``, ``weight``, ``probability``, ``copies`` and ``kept``.

    ``weight`` is the raked share of the row's (source, lang, topic) over its natural share, to
    six decimals. A sample that meets the targets holds a row ``copies`` = floor(weight + u) times,
    which has the weight as its mean: once with the probability of the weight below 1, and as
    often as the weight says above. ``probability`` = min(1, weight) is that of being in it at all, ``kept`` is
    copies > 0. ``u`` is uniform and comes from ``id`` and ``seed`` alone, so repeated rows are
    drawn together. :func:`sampled` gives the sample itself.

    Null sources and languages are a value of their own. Rows are summed to cells before any
    shuffle; the cells are written, so a small table of weights is broadcast by its known size
    and a large one is joined by shuffle with hot cells split. Columns of ``df`` called like the
    five results are replaced.
    """
    keys = {d: F.coalesce(F.col(d), F.lit(NONE)) for d in DIMS[:2]}
    # helper columns whose names no column of df has
    free = max(len(c) for c in df.columns) * "_"
    places, size, share = [free + d for d in DIMS], free + "tokens", free + "weight"
    own = df.withColumns({**dict(zip(places, (keys["source"], keys["lang"], topic), strict=True)), size: tokens})
    cells = durable(
        own.groupBy(*places)
        .agg(F.sum(size).alias("tokens"))
        .select(*[F.col(p).alias(d) for p, d in zip(places, DIMS, strict=True)], "tokens")
    )
    weights = durable(
        rake(cells, targets, sweeps).select(
            *[F.col(d).alias(p) for p, d in zip(places, DIMS, strict=True)], (F.round("weight", 6) + F.lit(0.0)).alias(share)
        )
    )
    name = F.concat_ws(":", F.coalesce(F.col(id).cast("string"), F.lit("")), F.lit(str(seed)))
    u = F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    copies = F.floor(F.col(share) + u).cast("long")
    dropped = [c for c in ("tokens", "weight", "probability", "copies", "kept") if c in df.columns]
    return (
        own.join(weights, places)
        .drop(*dropped)
        .withColumns(
            {
                "tokens": F.col(size),
                "weight": F.col(share),
                "probability": F.least(F.col(share), F.lit(1.0)),
                "copies": copies,
                "kept": copies > 0,
            }
        )
        .drop(*places, size, share)
    )


def sampled(df: DataFrame) -> DataFrame:
    """The rows of a frame from :func:`mixed`, each as often as ``copies`` says, its columns as
    they are. Copies of a row are made where it is."""
    free = max(len(c) for c in df.columns) * "_" + "copy"
    drawn = df.where(F.col("copies") > 0)
    return drawn.withColumn(free, F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop(free)
