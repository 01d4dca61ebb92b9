"""Arrow batches: new columns beside the old ones, and texts as bytes without Python strings."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

Added = Callable[[pa.RecordBatch], list[pa.Array]]


def add_columns(df: DataFrame, schema: str, fn: Added, drop: tuple[str, ...] = ()) -> DataFrame:
    """``df`` without ``drop`` and without columns named as in ``schema``, and the columns of
    ``schema`` that ``fn`` makes of every batch."""
    fields = StructType.fromDDL(schema)
    stay = [f for f in df.schema if f.name not in fields.names and f.name not in drop]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = fn(batch)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(f.name) for f in stay] + made, [f.name for f in stay] + fields.names
                )

    return df.mapInArrow(run, StructType(stay + fields.fields))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each begins and the last ends; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data and data.size else np.zeros(0, np.uint8)), at


def blocks(at: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` bytes together, a longer text on its own."""
    first = 0
    while first < len(at) - 1:
        last = max(first + 1, int(np.searchsorted(at, at[first] + most, "right")) - 1)
        yield first, last
        first = last


def runs(inside: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the runs of True; a run ends where a text ends. ``at`` counts from 0."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(len(inside) + 1, bool)
    edge[at] = True  # the first place of a text
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1
