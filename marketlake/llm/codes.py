"""Vector code compression: codes of vector parts from exact integer arithmetic.

Vectors become integers, so distances, means and ties do not depend on the order of additions nor
on the machine. Products go through floating-point matrix products all the same: integers are split into
limbs so small that a product of limb matrices stays below 2^53, where doubles are exact, and the
products of limbs are put together again as 64-bit integers.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import durable
from .arrow import add_columns

SCALE = 256
MOST = (1 << 63) - 1


def limbs(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """Integers as sums of limb * 2^(bits * place): the last limb bears the sign, all others are
    0 to 2^bits - 1."""
    out = []
    while len(values) and (values.max() >= 1 << bits or values.min() < -(1 << bits)):
        out.append((values & ((1 << bits) - 1)).astype(np.float64))
        values = values >> bits
    return [*out, values.astype(np.float64)]


def exact_dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of two integer matrices, exact while the result fits 64 bits."""
    bits = (53 - (a.shape[1] - 1).bit_length()) // 2
    total = np.zeros((len(a), len(b)), np.int64)
    for i, x in enumerate(limbs(a, bits)):
        for j, y in enumerate(limbs(b, bits)):
            total += (x @ y.T).astype(np.int64) << np.int64(bits * (i + j))
    return total


def fits(values: np.ndarray) -> bool:
    """Whether squared distances between rows with such components stay below 2^63."""
    most = max(int(values.max(initial=0)), -int(values.min(initial=0)))
    return 4 * values.shape[-1] * most * most < MOST


def assigned(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of integers the nearest row of ``book`` (ties: the first) and the squared distance.

    Integers beyond what 64-bit distances hold (an object array) are compared as Python numbers.
    """
    if parts.dtype != object and book.dtype != object and fits(parts) and fits(book):
        far = (parts**2).sum(axis=1)[:, None] - 2 * exact_dot(parts, book) + (book**2).sum(axis=1)[None, :]
    else:
        wide = book.astype(object)
        far = np.stack([((parts.astype(object) - entry) ** 2).sum(axis=1) for entry in wide], axis=1)
    code = far.argmin(axis=1)
    return code, far[np.arange(len(code)), code]


def integers(column: pa.Array, size: int) -> np.ndarray:
    """floor(256 x) of every component, one row a vector; Python numbers where 64 bits are short."""
    x = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE).reshape(len(column), size)
    if np.abs(x).max(initial=0.0) < 2.0**62:
        return x.astype(np.int64)
    return np.array([[int(v) for v in row] for row in x], object).reshape(x.shape)


def usable(df: DataFrame, vector: str, parts: int) -> tuple[DataFrame, int]:
    """Rows whose vector is finite throughout, and its length: that of most (ties: the longer),
    which must be a multiple of ``parts``; other lengths take no part."""
    v = F.col(vector)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * SCALE) < float("inf")))
    kept = df.where(v.isNotNull() & F.coalesce(fine, F.lit(False)) & (F.size(v) % parts == 0) & (F.size(v) > 0))
    common = kept.groupBy(F.size(v).alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    size = common["size"] if common else 0
    return kept.where(F.size(v) == size), size


def first_book(kept: DataFrame, id: str, vector: str, entries: int, parts: int, size: int) -> np.ndarray:
    """The codebook of each part: that part of the vectors with the smallest ids (ties: the smaller vector)."""
    rows = kept.where(F.col(id).isNotNull()).select(id, vector).orderBy(id, vector).limit(entries).toArrow()
    column = rows.column(vector)
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return integers(column, size).reshape(len(column), parts, size // parts).swapaxes(0, 1)


def next_book(kept: DataFrame, vector: str, book: np.ndarray) -> np.ndarray:
    """Every entry replaced by the floored mean of the parts nearest to it; unused entries stay.

    Tasks send one row for each used entry and component, so what is shuffled and fetched is
    bounded by the size of the codebook.
    """
    parts, entries, width = book.shape

    def run(batches):
        sums, counts = np.zeros(book.shape, object), np.zeros(book.shape[:2], np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = integers(batch.column(0), parts * width).reshape(-1, parts, width)
            for p in range(parts):
                code, _ = assigned(rows[:, p], book[p])
                counts[p] += np.bincount(code, minlength=entries)
                order = np.argsort(code, kind="stable")
                used, at = np.unique(code[order], return_index=True)
                small = rows.dtype != object and int(np.abs(rows).max(initial=0)) * len(rows) < MOST
                own = rows[order, p] if small else rows[order, p].astype(object)
                sums[p][used] += np.add.reduceat(own, at, axis=0).astype(object)
        p, e = np.nonzero(counts)
        told = [[str(v) for v in sums[a, b]] for a, b in zip(p, e, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(counts[p, e]), pa.array(told, pa.list_(pa.string()))],
            ["part", "entry", "n", "sums"],
        )

    told = kept.select(vector).mapInArrow(run, "part int, entry int, n long, sums array<string>")
    each = told.select("part", "entry", "n", F.posexplode("sums").alias("place", "value"))
    # components of floats may pass 64 bits: such sums are kept apart and added as Python numbers
    total = each.groupBy("part", "entry", "place").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.length("value") <= 18, F.col("value").cast("decimal(20,0)"))).alias("sum"),
        F.collect_list(F.when(F.length("value") > 18, F.col("value"))).alias("wide"),
    )
    out = book.astype(object)
    for r in total.collect():
        out[r["part"], r["entry"], r["place"]] = (int(r["sum"] or 0) + sum(map(int, r["wide"]))) // r["n"]
    return out if _wide(out) else out.astype(np.int64)


def _wide(values: np.ndarray) -> bool:
    return any(abs(int(v)) >= 1 << 62 for v in values.flat)


def codebook(df: DataFrame, id: str = "vec_id", vector: str = "embedding", parts: int = 16, entries: int = 64, rounds: int = 2):
    """The usable rows of ``df`` and the codebook (part, entry, component) after all rounds."""
    kept, size = usable(df, vector, parts)
    if not size:
        return kept, np.zeros((parts, 0, 0), np.int64)
    book = first_book(kept, id, vector, entries, parts, size)
    for _ in range(rounds if book.shape[1] else 0):
        book = next_book(kept, vector, book)
    return kept, book


def book_digest(book: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and place, as decimal numbers joined by commas."""
    return hashlib.sha256(",".join(str(int(v)) for v in book.reshape(-1)).encode()).hexdigest()


def coded(df: DataFrame, book: np.ndarray, vector: str = "embedding") -> DataFrame:
    """``df`` (usable rows) with ``code``, two hexadecimal digits a part, and ``error``, the
    squared distances to the entries summed over parts; beyond 64 bits the largest long."""
    parts, _, width = book.shape

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        rows = integers(batch.column(vector), parts * width).reshape(-1, parts, width)
        codes, error = np.zeros((len(rows), parts), np.uint8), np.zeros(len(rows), object)
        for p in range(parts):
            codes[:, p], far = assigned(rows[:, p], book[p])
            error += far.astype(object)
        told = [bytes(row).hex() for row in codes]
        return [pa.array(told, pa.string()), pa.array([min(int(e), MOST) for e in error], pa.int64())]

    return add_columns(df, "code string, error long", run)


def compressed(
    df: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = 16,
    entries: int = 64,
    rounds: int = 2,
) -> DataFrame:
    """``id``, ``code``, ``error``, ``label_error`` (error summed over equal labels, nulls
    together) and ``codebooks_sha256`` of every row of ``df`` with a usable vector.

    Vectors that are null, empty or hold null or non-finite components (also once multiplied by
    256) take no part, nor do those of another length than most. Rows with null or repeated ids
    are coded like all others; null ids start no codebook, and without any id or row there is no
    result. Up to 256 entries.
    """
    if entries > 256:
        raise ValueError("a code has two hexadecimal digits")
    kept, book = codebook(df, id, vector, parts, entries, rounds)
    own = kept.select(F.col(id).alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    if not book.shape[1]:
        own = own.where("false").select("id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    else:
        own = coded(own, book, "vector").select("id", "label", "code", "error")
    told = durable(own)
    # summed as decimals: a third of all rows may have one label
    exact = F.sum(F.col("error").cast("decimal(20,0)"))
    sums = told.groupBy("label").agg(F.least(exact, F.lit(MOST).cast("decimal(38,0)")).cast("long").alias("label_error"))
    sums = durable(sums.withColumnRenamed("label", "of"))
    joined = told.join(sums, told["label"].eqNullSafe(sums["of"]))
    return joined.select(F.col("id").alias(id), "code", "error", "label_error", F.lit(book_digest(book)).alias("codebooks_sha256"))
