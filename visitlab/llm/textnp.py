"""Whole-batch text handling on Arrow buffers with numpy: words, hashes, shingle sets.

A word is a maximal run of bytes other than space and 0x09-0x0D; A-Z are lower-cased before hashing.  All hashes are
64 bits, equal on every machine, and computed from the UTF-8 bytes, so results agree between runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = np.random.RandomState(20240).randint(0, 2**63 - 1, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[ord("A"):ord("Z") + 1] = _BYTE[ord("a"):ord("z") + 1]
_BASE = np.uint64(0x9E3779B97F4A7C17)  # odd and 3 modulo 4
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SPAN = 1 << 20  # bytes hashed at a time
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in short batches, so that what is made of one stays small on both sides."""
    for b in batches:
        for a in range(0, b.num_rows, rows):
            yield b.slice(a, rows)


def small(batches: Iterator[pa.RecordBatch], text: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``most`` bytes of text (or one row), so working memory stays small."""
    for b in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(b.column(text)), 0).to_numpy(zero_copy_only=False)
                         ) if b.num_rows else np.zeros(0)
        a, done = 0, 0
        while a < b.num_rows:
            z = max(a + 1, int(np.searchsorted(size, done + most, side="right")))
            yield b.slice(a, z - a)
            a, done = z, size[z - 1]
    pa.default_memory_pool().release_unused()  # an idle worker keeps no buffers


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows and the row offsets into them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return (data[offsets[0]:offsets[-1]], offsets - offsets[0]) if len(offsets) else (data[:0], np.zeros(1, np.int64))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of every word, and the offsets of each row's words."""
    inside = ~_BLANK[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = offsets[:-1][offsets[:-1] < len(data)]  # words end where a row ends
    first[cuts] = inside[cuts]
    cuts = cuts[cuts > 0]
    last[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", _BASE_INV)):
            p = np.full(max(n, _SPAN + 1), base, np.uint64)
            p[0] = 1
            _powers[name] = np.cumprod(p)
    return _powers["up"], _powers["down"]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, base + _SPAN, side="right")))
        up, down = _power(int(ends[j - 1] - base) + 1)
        total = np.zeros(int(ends[j - 1] - base) + 1, np.uint64)
        np.cumsum(_BYTE[data[base:ends[j - 1]]] * up[:len(total) - 1], out=total[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
        i = j
    return out


def shingle_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """Per row the sorted distinct hashes of its k-word shingles.

    Fewer than k words: the whole sequence as one shingle; no word: an empty set.
    """
    data, offsets = buffers(column)
    starts, ends, at = words(data, offsets)
    h = word_hashes(data, starts, ends)
    rolled = h[:max(0, len(h) - k + 1)] + np.uint64(k)
    for i in range(1, k):
        rolled = mix(rolled) * _BASE + h[i:len(h) - k + 1 + i]
    rolled = mix(rolled)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= k:
            yield np.unique(rolled[a:b - k + 1])
        elif b > a:
            x = h[a:a + 1] + np.uint64(b - a)
            for i in range(a + 1, b):
                x = mix(x) * _BASE + h[i]
            yield mix(x)
        else:
            yield h[:0]
