"""Vector bin packing of examples into sequences under several limits at once."""

from __future__ import annotations

import os
import re
import sys
import types
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .arrow import blocks, runs, utf8

IS_WHITE = np.zeros(256, bool)
IS_WHITE[[32, *range(9, 14)]] = True
BLOCK = 1 << 22  # bytes of texts whose parts are looked up together
# Letters below U+0250 but the one whose small form is no letter, then marks: what the tokenizer
# divides there as well, whatever stands around it.
WORD = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+)([!-/:-@\[-`{-~]*)")
TOGETHER = 200
MOST_BYTES = 96 << 20  # remembered at a time, with about 160 bytes for each part
LONGEST = 256  # characters of a part that is remembered
TASK_BITS = 33


@dataclass(frozen=True)
class Limits:
    """What a sequence may hold: tokens, segments and loss-bearing tokens."""

    tokens: int = 4096
    segments: int = 128
    loss: int = 4096

    @property
    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.segments, self.loss], np.int64)


class Encoder:
    """Token ids of texts as little-endian bytes, by the tokenizer in a file.

    The tokenizer splits at white space before anything else, so the ids of a text are those of
    its parts between white space. Parts are looked up. New ones that are a word, or a word and
    marks behind it, are encoded as one text and told apart by the ids that end a word; all
    others are encoded on their own.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has the cores already
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for word, i in vocabulary.items() if word.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}
        self.size = 0

    @staticmethod
    def of_worker(path: str) -> Encoder:
        """The encoder of this Python worker for a file: tasks that follow know its words.

        Kept in a module of its own, as this one comes anew with every task.
        """
        holder = sys.modules.setdefault("_marketlake_encoders", types.ModuleType("_marketlake_encoders"))
        if path not in holder.__dict__:
            setattr(holder, path, Encoder(path))
        return getattr(holder, path)

    def _learn(self, parts: list[str]) -> None:
        found = self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)
        self.known.update(zip(parts, [array("I", x.ids).tobytes() for x in found], strict=True))

    def _learn_words(self, words: list[str]) -> None:
        parts = [words[at : at + TOGETHER] for at in range(0, len(words), TOGETHER)]
        found = self.tokenizer.encode_batch_fast([" ".join(p) for p in parts], add_special_tokens=False)
        for part, x in zip(parts, found, strict=True):
            ids = np.array(x.ids, "<u4")
            stops = 4 * (np.flatnonzero(self.ends[ids]) + 1)
            if len(stops) != len(part):  # a tokenizer that divides words
                self._learn(part)
                continue
            data, begin = ids.tobytes(), 0
            for word, stop in zip(part, stops.tolist(), strict=True):
                self.known[word] = data[begin:stop]
                begin = stop

    def _of_parts(self, parts: list[str]) -> list[bytes]:
        """Ids of different parts."""
        if self.size > MOST_BYTES:
            self.known.clear()
            self.size = 0
        known = self.known
        found = [known.get(p) for p in parts]
        new = [p for p, ids in zip(parts, found, strict=True) if ids is None]
        if not new:
            return found
        marked, words, rest = [], set(), set()
        for part in new:
            m = WORD.fullmatch(part)
            if m is None:
                rest.add(part)
            elif m[2]:
                marked.append((part, m[1], m[2]))
                words.add(m[1])
                rest.add(m[2])
            else:
                words.add(part)
        self._learn_words(list(words.difference(known)))
        self._learn(list(rest.difference(known)))
        for part, word, marks in marked:
            known[part] = known[word] + known[marks]
        out = [known[p] if ids is None else ids for p, ids in zip(parts, found, strict=True)]
        for part in words.union(rest, new):
            if len(part) > LONGEST:
                del known[part]
            else:
                self.size += 160 + len(part) + len(known[part])
        return out

    def columns(self, column: pa.Array) -> Iterator[bytes]:
        """Ids of every text of a column: the different parts of a block of texts are looked up
        once each, and the ids of texts are put together from theirs as arrays."""
        data, at = utf8(column)
        for first, last in blocks(at, BLOCK):
            here, places = data[at[first] : at[last]], at[first : last + 1] - at[first]
            inside = ~IS_WHITE[here]
            begins, ends = runs(inside, places)
            bounds = pa.py_buffer(np.concatenate([[0], np.cumsum(ends - begins)]).astype(np.int64))
            parts = pa.LargeStringArray.from_buffers(len(begins), bounds, pa.py_buffer(here[inside])).dictionary_encode()
            found = self._of_parts(parts.dictionary.to_pylist())
            sizes = np.array([len(x) // 4 for x in found], np.int64)
            flat, begin = np.frombuffer(b"".join(found), "<u4"), np.cumsum(sizes) - sizes
            which = parts.indices.to_numpy()
            total = np.concatenate([[0], np.cumsum(sizes[which])]) if len(which) else np.zeros(1, np.int64)
            ids = flat[np.repeat(begin[which] - total[:-1], sizes[which]) + np.arange(total[-1])].tobytes() if total[-1] else b""
            stops = 4 * total[np.searchsorted(begins, places)]
            for a, b in zip(stops[:-1].tolist(), stops[1:].tolist(), strict=True):
                yield ids[a:b]

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        return list(self.columns(pa.array(texts, pa.large_string())))


def fill(
    tokens: np.ndarray, loss: np.ndarray, limits: Limits, cut: bool = True
) -> tuple[list[list[tuple[int, int, int]]], list[tuple[int, int, int]]]:
    """Sequences of pieces (example, start, length), and the pieces of the one left unfilled.

    An example needs (tokens, 1, loss) of what a sequence has. The next one is that which fits
    and whose need has the largest dot product with what is left, both as shares of the limits.
    Where none fits and ``cut`` holds, the longest example is cut to what is left. The loss of
    an example sits at its end, so the first part of a cut one bears what the end leaves over.
    Without ``cut`` examples beyond a limit are refused with ValueError.
    """
    cap = limits.vector
    start = np.zeros(len(tokens), np.int64)
    need = np.stack([tokens, np.ones(len(tokens), np.int64), loss], axis=1).astype(np.int64)
    alive = need[:, 0] > 0
    if not cut and (need > cap).any():
        raise ValueError("an example is longer than a sequence")
    done: list[list[tuple[int, int, int]]] = []
    pieces: list[tuple[int, int, int]] = []
    left = cap.copy()

    def take(i: int, n: int, bears: int) -> None:
        pieces.append((i, int(start[i]), n))
        left[:] -= (n, 1, bears)
        start[i] += n
        need[i, 0] -= n
        need[i, 2] -= bears
        alive[i] = need[i, 0] > 0

    def room(i: int) -> int:
        """Tokens of example ``i`` from its start on that fit."""
        t, _, bears = need[i]
        return int(min(t, left[0], t - bears + left[2]))

    index = np.flatnonzero(alive)
    weighed = need / cap
    while len(index):
        fits = (need[index] <= left).all(axis=1)
        if fits.any():
            able = index[fits]
            i = int(able[np.argmax(weighed[able] @ (left / cap))])
            take(i, int(need[i, 0]), int(need[i, 2]))
        else:
            i = int(index[np.argmax(need[index, 0])])
            n = room(i) if cut and left[1] > 0 else 0
            if n > 0:
                t, bears = int(need[i, 0]), int(need[i, 2])
                take(i, n, max(0, n - (t - bears)))
                weighed[i] = need[i] / cap
            else:
                done.append(pieces)
                pieces, left = [], cap.copy()
                continue
        if not alive[i]:
            index = index[index != i]
        if left[0] == 0:
            done.append(pieces)
            pieces, left = [], cap.copy()
    return done, pieces


def _halves(pieces: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """The pieces cut to sequences whose lengths are powers of two, the longest first."""
    out = []
    total = sum(n for _, _, n in pieces)
    queue = list(reversed(pieces))
    for bit in reversed(range(total.bit_length())):
        if not total >> bit & 1:
            continue
        room, row = 1 << bit, []
        while room:
            i, start, n = queue.pop()
            row.append((i, start, min(n, room)))
            if n > room:
                queue.append((i, start + room, n - room))
            room -= min(n, room)
        out.append(row)
    return out


FIELDS = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def packed(
    df: DataFrame,
    tokenizer: str,
    id: str = "doc_id",
    text: str = "text",
    end: int = 2,
    limits: Limits = Limits(),  # noqa: B008
    ids: bool = False,
) -> DataFrame:
    """One row per piece: ``id``, ``start`` (ids of its document before it), ``length``,
    ``ids_crc32`` of its ids as little-endian unsigned 32-bit numbers, ``doc_tokens`` (ids of its
    document, with the id ``end`` that closes it), ``sequence_id``, ``offset`` in the sequence,
    and with ``ids`` the token ids themselves.

    Every row of ``df`` is a document, also repeated ones; null and empty texts are the closing
    id alone. All tokens bear loss. Documents are packed a batch at a time inside their task,
    nothing is shuffled, and a task holds one batch and the ids of one unfilled sequence. That
    one goes on to the next batch; what a task has left at its end is cut to powers of two, which
    need no padding. Sequence ids hold the task above 33 bits. ``tokenizer`` is the path of a
    tokenizer file on the executors. A task that is run again reads the same rows and packs
    them the same way.
    """
    cap = limits
    kind = f"`{id}` {dict(df.dtypes)[id]}, {FIELDS}" + (", ids array<long>" if ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, number = Encoder.of_worker(tokenizer), TaskContext.get().partitionId() << TASK_BITS
        names, whole, places, bodies = [], [], [], []  # of the pieces not yet placed

        def told(rows: list[list[tuple[int, int, int]]]) -> pa.RecordBatch:
            nonlocal number
            columns: list[list] = [[] for _ in range(8 if ids else 7)]
            for row in rows:
                offset = 0
                for i, start, n in row:
                    body = bodies[i][4 * start : 4 * (start + n)]
                    values = (names[i], places[i] + start, n, zlib.crc32(body), whole[i], number, offset)
                    for column, value in zip(columns, values, strict=False):
                        column.append(value)
                    if ids:
                        columns[7].append(np.frombuffer(body, "<u4").astype(np.int64))
                    offset += n
                number += 1
            kinds = [id_type] + [pa.int64()] * 6 + ([pa.list_(pa.int64())] if ids else [])
            labels = [id, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + (["ids"] if ids else [])
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], labels)

        rest: list[tuple[int, int, int]] = []
        for batch in batches:
            id_type = batch.column(id).type
            # of the sequence left unfilled only what is not placed yet is kept
            names = [names[i] for i, _, _ in rest]
            whole = [whole[i] for i, _, _ in rest]
            places, bodies = (
                [places[i] + start for i, start, _ in rest],
                [bodies[i][4 * start : 4 * (start + n)] for i, start, n in rest],
            )
            found = [x + end.to_bytes(4, "little") for x in encode.columns(batch.column(text))]
            names += batch.column(id).to_pylist()
            whole += [len(x) // 4 for x in found]
            places += [0] * len(found)
            bodies += found
            sizes = np.array([len(x) // 4 for x in bodies], np.int64)
            rows, rest = fill(sizes, sizes, cap)
            if rows:
                yield told(rows)
        if rest:
            yield told(_halves(rest))

    return df.select(id, text).mapInArrow(run, kind)
