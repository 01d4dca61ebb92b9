"""Words and word shingles of texts as 64-bit hashes, a block of texts at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from .arrow import blocks, runs

SEED = 20240101
SHINGLE = 5


def _odd(count: int, stream: int) -> np.ndarray:
    """Fixed random odd 64-bit numbers, the same on every machine."""
    return np.random.Generator(np.random.PCG64([SEED, stream])).integers(0, 1 << 64, count, np.uint64) | np.uint64(1)


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_WORD = np.ones(256, bool)
IS_WORD[[32, *range(9, 14)]] = False
BYTE = _odd(256, 1)[LOWER]
PLACE = _odd(SHINGLE + 1, 2)
STEP = int(_odd(1, 3)[0])


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit over all bits (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(most: int) -> np.ndarray:
    """STEP to the powers 0 to ``most``."""
    out = np.full(most + 1, STEP, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def words_of(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A hash of every word, letters A-Z as a-z, the first word of each text (and the end), and
    where the words begin and end."""
    inside = IS_WORD[data]
    begins, ends = runs(inside, at)
    first = np.searchsorted(begins, at)
    if not len(begins):
        return np.zeros(0, np.uint64), first, begins, ends
    sizes = ends - begins
    place = np.arange(len(data))
    place[begins[0] :] -= np.repeat(begins, np.diff(np.append(begins, len(data))))
    place[~inside] = 0
    values = BYTE[data] * powers(int(sizes.max()))[place]
    values[~inside] = 0
    return mix(np.add.reduceat(values, begins) + sizes.astype(np.uint64)), first, begins, ends


def shingle_hashes(words: np.ndarray, first: np.ndarray) -> Iterator[np.ndarray]:
    """The distinct shingles of each text, ascending: runs of five words, or all its words as
    one if there are fewer, or none."""
    n = len(words)
    long = np.zeros(0, np.uint64)
    if n >= SHINGLE:
        long = words[: n - SHINGLE + 1] * PLACE[0]
        for k in range(1, SHINGLE):
            long = long + words[k : n - SHINGLE + 1 + k] * PLACE[k]
        long = mix(long + np.uint64(SHINGLE))
    for a, b in zip(first[:-1], first[1:], strict=True):
        size = int(b - a)
        if size >= SHINGLE:
            own = np.sort(long[a : b - SHINGLE + 1])
            keep = np.ones(len(own), bool)
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            yield own[keep]
        elif size:
            whole = (words[a:b] * PLACE[:size]).sum(dtype=np.uint64) + np.uint64(size)
            yield mix(np.array([whole], np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def shingle_sets(data: np.ndarray, at: np.ndarray) -> Iterator[np.ndarray]:
    """The shingle set of every text."""
    for first, last in blocks(at):
        words, firsts, _, _ = words_of(data[at[first] : at[last]], at[first : last + 1] - at[first])
        yield from shingle_hashes(words, firsts)
