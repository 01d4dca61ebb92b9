"""Dialogues rendered once per participant, each time with that speaker as the assistant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.keys import surrogate_key
from ..runtime import durable

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
TURNS = 1024  # of a row: dialogues up to this length are rendered whole


def _head(role: str, speaker: str) -> str:
    """SQL of what stands before a turn's text, seen by ``speaker``."""
    return (
        f"CASE WHEN {role} = 'system' THEN '{OPEN}system\\n'"
        f" WHEN {role} = {speaker} THEN '{OPEN}assistant\\n'"
        f" ELSE concat('{OPEN}user name=', {role}, '\\n') END"
    )


def perspectives(
    df: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    turns: int = TURNS,
) -> DataFrame:
    """One row per conversation, part and participant: ``conv_id``, ``part`` (from 0),
    ``speaker``, ``n_turns``, ``n_loss_turns``, ``text`` and ``mask``, the spans of ``text`` that
    bear loss (``start:end`` in code points, comma-joined): what the speaker says and the mark
    that ends the turn.

    Turns are taken in the order of (turn, role, text); system turns stay system turns and are
    no participant. A dialogue of up to ``turns`` turns is one part. A longer one, which might hold a third of
    all rows, is cut in parts of that length, so that neither a task nor a row holds an endless dialogue;
    every part is rendered for every participant of the whole dialogue, also one who is silent
    in it, and begins with the last system turn before it (not counted in ``n_turns``). Null roles speak as ``unknown``, null texts
    are empty, rows without conv_id form one conversation without id, null turns come first.
    Repeated rows are turns of their own. ``<|`` in texts and roles is written ``<\\|``, so
    that no text can end its turn. Other columns of ``df`` are not read.
    """
    safe = lambda c, default: F.replace(F.coalesce(F.col(c), F.lit(default)), F.lit("<|"), F.lit("<\\|"))
    own = df.select(
        F.col(conv).alias("conv_id"),
        F.col(turn).alias("turn"),
        safe(role, "unknown").alias("role"),
        safe(text, "").alias("said"),
    )
    by: list[Column] = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "said")]
    rows = surrogate_key(own, by, start=-1, id="_rank")
    first = rows.groupBy("conv_id").agg(F.min("_rank").alias("_first"), F.count(F.lit(1)).alias("_n"))
    mine = first.select(F.col("conv_id").alias("_conv"), "_first", "_n")
    placed = rows.join(mine, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    placed = placed.withColumn("part", F.floor((F.col("_rank") - F.col("_first")) / turns).cast("int"))

    def gathered(some: DataFrame) -> DataFrame:
        turn_of = F.struct("_rank", "role", "said")
        return some.groupBy("conv_id", "part").agg(F.array_sort(F.collect_list(turn_of)).alias("_turns"))

    whole = gathered(placed.where(F.col("_n") <= turns)).withColumn(
        "speaker", F.explode(F.expr("array_distinct(filter(transform(_turns, t -> t.role), r -> r <> 'system'))"))
    )
    seen = whole.select("conv_id", "part", "speaker", "_turns", F.size("_turns").cast("long").alias("n_turns"))
    long = durable(placed.where(F.col("_n") > turns).select("conv_id", "part", "_rank", "role", "said"))
    if not long.isEmpty():
        seen = seen.union(_long_parts(long, gathered(long)))
    pieces = seen.withColumn(
        "_pieces",
        F.expr(
            f"transform(_turns, t -> struct({_head('t.role', 'speaker')} AS head,"
            f" concat(t.said, '{CLOSE}') AS body, t.role = speaker AS loss))"
        ),
    )
    spans = F.expr(
        "aggregate(_pieces, struct(0L AS at, cast(array() AS array<string>) AS spans), (a, p) -> struct("
        "a.at + length(p.head) + length(p.body) + 1 AS at,"
        " CASE WHEN p.loss THEN array_append(a.spans, concat(a.at + length(p.head), ':',"
        " a.at + length(p.head) + length(p.body))) ELSE a.spans END AS spans), a -> array_join(a.spans, ','))"
    )
    return pieces.select(
        "conv_id",
        "part",
        "speaker",
        "n_turns",
        F.expr("cast(size(filter(_pieces, p -> p.loss)) AS long)").alias("n_loss_turns"),
        F.expr("array_join(transform(_pieces, p -> concat(p.head, p.body, '\\n')), '')").alias("text"),
        spans.alias("mask"),
    )


def _long_parts(turns: DataFrame, parts: DataFrame) -> DataFrame:
    """Parts of long dialogues for all of their speakers, led by the system turn in force."""
    system = F.col("role") == "system"
    speakers = durable(turns.where(~system).select(F.col("conv_id").alias("_conv"), F.col("role").alias("speaker")).distinct())
    # one row a part, and one a part with a system turn, which counts from the next part on
    wanted = turns.select("conv_id", "part").distinct().select("conv_id", "part", F.lit(None).cast("long").alias("_at"), F.lit(None).cast("string").alias("_text"))
    last = turns.where(system).groupBy("conv_id", "part").agg(F.max(F.struct("_rank", "said")).alias("_s"))
    last = last.select("conv_id", F.col("part") + 1, F.col("_s._rank").alias("_at"), F.col("_s.said").alias("_text"))
    before = Window.partitionBy("conv_id").orderBy("part").rangeBetween(Window.unboundedPreceding, 0)
    told = wanted.union(last).withColumn("_led", F.max(F.when(F.col("_at").isNotNull(), F.struct("_at", "_text"))).over(before))
    led = durable(told.where("_at IS NULL").select(F.col("conv_id").alias("_c"), F.col("part").alias("_p"), "_led"))
    joined = durable(parts).join(led, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("part") == F.col("_p")))
    joined = joined.join(speakers, F.col("conv_id").eqNullSafe(F.col("_conv")))
    head = F.array(F.struct(F.col("_led._at").alias("_rank"), F.lit("system").alias("role"), F.col("_led._text").alias("said")))
    led_turns = F.when(F.col("_led").isNull(), F.col("_turns")).otherwise(F.concat(head, F.col("_turns")))
    return joined.select("conv_id", "part", "speaker", led_turns.alias("_turns"), F.size("_turns").cast("long").alias("n_turns"))
