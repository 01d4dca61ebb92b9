"""Quality by co-training: a view of the text and a view of the metadata teach each other.

Each view has a linear model, calibrated on labelled rows held out. In a round each scores all
documents without a label; the ones it is sure of become labels for the other view. At the end
both calibrated views are combined, with weights fitted on the rows held out.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import durable
from .arrow import add_columns

META = ("lang", "source", "n_chars")
HASHED, SOURCES = 64, 32
MAX_LABELS, MAX_PSEUDO, ROUNDS, SURE = 10_000, 4_000, 2, 0.97
HELD = 4  # every fourth label is held out

# Kinds of bytes: lower, upper, digit, beyond ASCII, white space, sentence marks, other marks.
KIND = np.full(256, 6, np.int64)
KIND[97:123], KIND[65:91], KIND[48:58], KIND[128:] = 0, 1, 2, 3
KIND[[32, *range(9, 14)]] = 4
KIND[np.frombuffer(b".,;:!?'\"-()", np.uint8)] = 5
LINES = re.compile(r"\n+")
TEXT_SIZE = 7 + 12 + HASHED
META_SIZE = 16 + SOURCES + 8


def text_view(text: str | None) -> np.ndarray:
    """What the text itself shows: kinds of characters, words, repeats, hashed byte pairs."""
    out = np.zeros(TEXT_SIZE, np.float32)
    data = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    if not len(data):
        return out
    out[:7] = np.bincount(KIND[data], minlength=7) / len(data)
    words = text.split()
    n = max(len(words), 1)
    often = Counter(words)
    lines = [x for x in LINES.split(text) if x.strip()]
    pairs = Counter(zip(words[:-2], words[1:-1], words[2:], strict=True))
    out[7:19] = (
        np.log1p(len(words)),
        len(text) / n,
        len(often) / n,
        np.log(n + 1.0) * len(often) / n,
        max(often.values(), default=0) / n,
        1.0 - len(pairs) / max(n - 2, 1) if n > 2 else 0.0,
        1.0 - len(set(lines)) / max(len(lines), 1),
        np.log1p(len(lines)),
        sum(w.isupper() for w in often) / max(len(often), 1),
        sum(not w[-1].isalnum() for w in words) / n,
        sum(not any(map(str.isalpha, w)) for w in words) / n,
        n < 10,
    )
    if len(data) > 1:
        code = data[:-1].astype(np.uint32) * 31 + data[1:]
        out[19:] = np.sqrt(np.bincount((code * np.uint32(2654435761)) >> np.uint32(26), minlength=HASHED) / len(code))
    return out


def meta_view(lang: str | None, source: str | None, n_chars: int | None) -> np.ndarray:
    """What is known without reading: hashed language and source, and the size in steps."""
    out = np.zeros(META_SIZE, np.float32)
    out[zlib.crc32((lang or "").encode()) % 16] = 1.0
    out[16 + zlib.crc32((source or "").encode()) % SOURCES] = 1.0
    size = np.log1p(max(n_chars or 0, 0))
    steps = np.clip(size - np.array([2.0, 3.5, 5.0, 6.5, 8.0, 9.5]), 0.0, 1.5)
    out[-8:-2], out[-2], out[-1] = steps, size < 4.0, n_chars is None
    return out


@dataclass(frozen=True)
class View:
    """A linear model over standardised features, and the line that calibrates its score."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) / self.scale
        return np.clip(self.slope * (z @ self.weights[:-1] + self.weights[-1]) + self.shift, -30.0, 30.0)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float, steps: int = 30) -> np.ndarray:
    """Weights and, last, the intercept, by Newton steps on the penalised likelihood."""
    wide = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(wide.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(wide @ w, -30.0, 30.0)))
        grad = wide.T @ (p - y) + penalty * w
        curve = (wide * (p * (1.0 - p) + 1e-6)[:, None]).T @ wide + np.diag(penalty)
        step = np.linalg.solve(curve, grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _fit(x: np.ndarray, y: np.ndarray, held_x: np.ndarray, held_y: np.ndarray) -> View:
    x = x.astype(np.float64)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale < 1e-6] = 1.0
    view = View(mean, scale, _logistic((x - mean) / scale, y, ridge=1.0))
    if len(np.unique(held_y)) < 2:
        return view
    slope, shift = _logistic(view.logit(held_x)[:, None], held_y, ridge=1e-3)
    return View(mean, scale, view.weights, max(float(slope), 1e-3), float(shift))


@dataclass(frozen=True)
class Model:
    """Both views and the weights (text, metadata, intercept) that combine their logits."""

    text: View | None
    meta: View | None
    combine: np.ndarray

    def scores(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probability of good quality by the text, by the metadata, and by both."""
        if self.text is None or self.meta is None:
            even = np.full(len(text), 0.5)
            return even, even, np.ones(len(text))
        a, b = self.text.logit(text), self.meta.logit(meta)
        both = np.clip(self.combine[0] * a + self.combine[1] * b + self.combine[2], -30.0, 30.0)
        return tuple(1.0 / (1.0 + np.exp(-x)) for x in (a, b, both))


def _stack(column: pa.Array, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(-1, size)


def _views(batch: pa.RecordBatch, text: str) -> tuple[np.ndarray, np.ndarray]:
    read = [text_view(t) for t in batch.column(text).to_pylist()]
    known = [meta_view(*row) for row in zip(*(batch.column(c).to_pylist() for c in META), strict=True)]
    return np.array(read, np.float32).reshape(-1, TEXT_SIZE), np.array(known, np.float32).reshape(-1, META_SIZE)


def _featured(df: DataFrame, id: str, text: str) -> DataFrame:
    """The id and both views as bytes."""

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        a, b = _views(batch, text)
        return [pa.array([r.tobytes() for r in x], pa.binary()) for x in (a, b)]

    own = df.select(F.col(id).alias("_id"), text, *META)
    return add_columns(own, "_text_view binary, _meta_view binary", run, drop=(text, *META))


def _smallest(df: DataFrame, order: Column, share: float) -> DataFrame:
    """About this share of the rows: those whose hash is small."""
    if share >= 1.0:
        return df
    return df.where(order <= F.lit(int(-(2**63) + share * 2**64)))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    rounds: int = ROUNDS,
    max_labels: int = MAX_LABELS,
    max_pseudo: int = MAX_PSEUDO,
    sure: float = SURE,
) -> Model:
    """Trains on about ``max_labels`` labelled documents at most, those with the smallest hashes of
    their ids (more labels are cut by a bound on the hash), of which every fourth is held out for calibration, and in each round on about
    ``max_pseudo`` pseudo-labels of each kind and view at most. Every other document is scored in
    every round; one is a candidate if a view gives it ``sure`` or more, and of more candidates
    those with the smallest hashes are taken.

    Several labels of an id count by their mean, from 0.5 on as good; null ids and labels are
    left out. Of several rows of a labelled id one is trained on, that with the least hash of its
    views, so what is fetched grows with neither rows nor texts of an id. Without labels of both kinds the model is empty and finds every document good.
    Texts are read once; the views are written and joined with the bounded sample of labels by
    broadcast, so nothing is shuffled.
    """
    order = F.xxhash64("_id")
    known = (
        labels.where(F.col(id).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(id).alias("_id"))
        .agg((F.avg(label) >= 0.5).cast("double").alias("_label"))
    )
    share = max_labels / max(known.count(), 1)
    known = durable(_smallest(known, order, share))
    rows = durable(_featured(docs, id, text)).join(F.broadcast(known), "_id", "left")
    # one row of each labelled id, however many rows have it
    labelled = rows.where("_label IS NOT NULL").withColumns({"_order": order, "_pick": F.xxhash64("_text_view", "_meta_view")})
    least = labelled.groupBy("_id").agg(F.min("_pick").alias("_pick"))
    take = labelled.join(F.broadcast(least), ["_id", "_pick"]).distinct().collect()
    take.sort(key=lambda r: (r["_order"], r["_id"], r["_text_view"]))
    y = np.array([r["_label"] for r in take])
    if len(np.unique(y)) < 2:
        return Model(None, None, np.zeros(3))
    a = np.stack([np.frombuffer(r["_text_view"], np.float32) for r in take])
    b = np.stack([np.frombuffer(r["_meta_view"], np.float32) for r in take])
    held = np.arange(len(y)) % HELD == HELD - 1
    if len(np.unique(y[~held])) < 2:
        held[:] = False
    kept = ~held
    text_model, meta_model = _fit(a[kept], y[kept], a[held], y[held]), _fit(b[kept], y[kept], b[held], y[held])
    for _ in range(rounds):
        model = Model(text_model, meta_model, np.zeros(3))

        def score(batch: pa.RecordBatch, model: Model = model) -> list[pa.Array]:
            one, two, _ = model.scores(_stack(batch.column("_text_view"), TEXT_SIZE), _stack(batch.column("_meta_view"), META_SIZE))
            return [pa.array(one), pa.array(two)]

        scored = add_columns(rows.where("_label IS NULL"), "_one double, _two double", score)
        sides = [  # teacher's verdict, pupil's view, label
            (F.col("_one") >= sure, "_meta_view", 1.0),
            (F.col("_one") <= 1.0 - sure, "_meta_view", 0.0),
            (F.col("_two") >= sure, "_text_view", 1.0),
            (F.col("_two") <= 1.0 - sure, "_text_view", 0.0),
        ]
        counts = scored.agg(*[F.count(F.when(certain, 1)).alias(f"n{k}") for k, (certain, _, _) in enumerate(sides)]).first()
        chosen = None
        for k, (certain, pupil, good) in enumerate(sides):
            some = _smallest(scored.where(certain), order, max_pseudo / max(counts[f"n{k}"], 1))
            some = some.select(F.lit(pupil).alias("pupil"), F.lit(good).alias("good"), order.alias("at"), F.col(pupil).alias("view"))
            chosen = some if chosen is None else chosen.union(some)
        taught: dict[str, list] = {"_text_view": [], "_meta_view": []}
        for r in sorted(chosen.collect(), key=lambda r: (r["pupil"], r["at"], r["good"], r["view"])):
            taught[r["pupil"]].append((r["good"], r["view"]))

        def more(x: np.ndarray, found: list) -> tuple[np.ndarray, np.ndarray]:
            if not found:
                return x[kept], y[kept]
            new = np.stack([np.frombuffer(v, np.float32) for _, v in found])
            return np.concatenate([x[kept], new]), np.concatenate([y[kept], [g for g, _ in found]])

        text_model = _fit(*more(a, taught["_text_view"]), a[held], y[held])
        meta_model = _fit(*more(b, taught["_meta_view"]), b[held], y[held])
    both = held if held.any() else kept
    logits = np.column_stack([text_model.logit(a[both]), meta_model.logit(b[both])])
    combine = _logistic(logits, y[both], ridge=1e-2) if len(np.unique(y[both])) > 1 else np.array([1.0, 0.0, 0.0])
    return Model(text_model, meta_model, combine)


def classified(df: DataFrame, model: Model, text: str = "text", least: float = 0.5) -> DataFrame:
    """``df`` with ``text_score``, ``meta_score``, ``score`` (probabilities of good quality) and
    ``kept`` (score >= least).

    Every row is scored, on its whole text; null and empty texts and null metadata are values
    like others. Repeated rows get the same score; columns called like the results are replaced.
    """

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        one, two, both = model.scores(*_views(batch, text))
        return [pa.array(one), pa.array(two), pa.array(both), pa.array(both >= least)]

    return add_columns(df, "text_score double, meta_score double, score double, kept boolean", run)
