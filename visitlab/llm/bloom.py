"""A Bloom filter of fixed size over long keys: a broadcast whose bound is a parameter, not the data.

It only saves work: rows it lets through wrongly meet an exact join afterwards, and when it fills up at very large
sizes every row takes the exact way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlab.llm import blobs
from visitlab.llm.textnp import mix, pieces

BITS = 25  # 2^25 bits: 4 MB
BROADCAST_KEYS = 500_000  # keys that are broadcast as they are: some 30 MB
_PIECE = 1 << 16  # bytes merged at a time


def _places(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    h = mix(keys.astype(np.int64).view(np.uint64))
    mask = np.uint64((1 << bits) - 1)
    return [((h >> np.uint64(s)) & mask).astype(np.int64) for s in (0, 20, 39)]


def build(keys: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """Bit set (uint8 array of 2^bits / 8) of the non-null keys, made and merged on the executors."""
    size = (1 << bits) // 8

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits_set = None
        for b in batches:
            if not b.num_rows:
                continue
            bits_set = np.zeros(size, np.uint8) if bits_set is None else bits_set
            for p in _places(b.column(0).to_numpy(zero_copy_only=False), bits):
                p = np.unique(p)
                at, first = np.unique(p >> 3, return_index=True)
                bits_set[at] |= np.bitwise_or.reduceat((128 >> (p & 7)).astype(np.uint8), first)
        if bits_set is not None:
            used = [i for i in range(0, size, _PIECE) if bits_set[i:i + _PIECE].any()]
            yield pa.RecordBatch.from_arrays([pa.array([i // _PIECE for i in used], pa.int32()), pa.array(
                [blobs.packed(bits_set[i:i + _PIECE]) for i in used], pa.binary())], ["chunk", "counts"])

    ids = keys.select(F.col(column).cast("long").alias("k")).where("k is not null")
    out = np.zeros(size, np.uint8)
    for i, piece in blobs.merge(ids.mapInArrow(mark, "chunk int, counts binary"), "u1", "or").items():
        out[i * _PIECE:i * _PIECE + len(piece)] = piece
    return out


def holds(filter_bytes: np.ndarray, keys: pa.Array, bits: int = BITS) -> np.ndarray:
    """Per key: may it be in the set?  Null: never."""
    null = np.asarray(keys.is_null())
    k = keys.fill_null(0).to_numpy(zero_copy_only=False)
    found = ~null
    for p in _places(k, bits):
        found &= (filter_bytes[p >> 3] >> (7 - (p & 7)) & 1).astype(bool)
    return found


def split(df: DataFrame, key: str, filter_bytes: np.ndarray, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """(rows whose key may be in the set, rows whose key surely is not); both are scans without a shuffle."""
    shared = df.sparkSession.sparkContext.broadcast(filter_bytes)

    def keep(wanted: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in pieces(batches):
                hit = holds(shared.value, b.column(key), bits)
                yield b.filter(pa.array(hit if wanted else ~hit))
        return run

    return df.mapInArrow(keep(True), df.schema), df.mapInArrow(keep(False), df.schema)


def rows_of(df: DataFrame, key: str, ids: DataFrame, count: int) -> DataFrame:
    """Rows of ``df`` whose key may be among ``ids`` (one long column, ``count`` rows, null never): exactly those if the
    ids are few enough to be broadcast, else those the Bloom filter lets through."""
    ids = ids.toDF(key)
    if count <= BROADCAST_KEYS:
        return df.join(F.broadcast(ids), key, "left_semi").select(*df.columns)
    return split(df, key, build(ids, key))[0]


def rows_but(df: DataFrame, key: str, ids: DataFrame, count: int) -> DataFrame:
    """Rows of ``df`` whose key is not among ``ids``; only rows that may be are shuffled."""
    ids = ids.toDF(key)
    if count <= BROADCAST_KEYS:
        return df.join(F.broadcast(ids), key, "left_anti").select(*df.columns)
    maybe, kept = split(df, key, build(ids, key))
    return kept.union(maybe.join(ids, key, "left_anti").select(*df.columns))
