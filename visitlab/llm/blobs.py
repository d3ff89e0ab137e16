"""Element-wise merging of binary pieces on the executors: a running result per piece number, never a group at once."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlab.llm.scratch import small_batches

SALTS = 16  # parts in which the pieces of one number are merged first


def packed(x: np.ndarray) -> bytes:
    """A piece as it is shuffled: the places in use and their values if they are few, else all values compressed."""
    used = np.flatnonzero(x)
    if 4 * len(used) < len(x):
        return packed_places(used, x[used], len(x))
    return b"d" + zlib.compress(x.tobytes(), 1)


def packed_places(places: np.ndarray, values: np.ndarray, length: int) -> bytes:
    """The packed piece of ``length`` values that are zero but at ``places`` (no place twice)."""
    return b"s" + struct.pack("<II", length, len(places)) + places.astype("<u4").tobytes() + values.tobytes()


def _fold(total: np.ndarray | None, blob: bytes, kind: str, join) -> np.ndarray:
    if blob[:1] == b"d":
        x = np.frombuffer(zlib.decompress(blob[1:]), kind)
        return x.copy() if total is None else join(total, x, out=total)
    length, n = struct.unpack_from("<II", blob, 1)
    places = np.frombuffer(blob, "<u4", n, 9)
    total = np.zeros(length, kind) if total is None else total
    total[places] = join(total[places], np.frombuffer(blob, kind, n, 9 + 4 * n))
    return total


def unpacked(blob: bytes, kind: str) -> np.ndarray:
    return _fold(None, blob, kind, np.add)


def merge(pieces: DataFrame, kind: str, how: str) -> dict[int, np.ndarray]:
    """Piece number -> merged array, from rows (chunk int, counts: a packed piece); how is ``sum`` or ``or``.

    The caller bounds the number and length of the pieces; that is what the driver gets.  Pieces are merged in at most a
    task per core.
    """
    cores = max(8, pieces.sparkSession.sparkContext.defaultParallelism)
    join = np.add if how == "sum" else np.bitwise_or

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(chunk: int, total: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([packed(total)], pa.binary())],
                                              ["chunk", "counts"])

        chunk = total = None
        for b in batches:
            for c, blob in zip(b.column("chunk").to_pylist(), b.column("counts"), strict=True):
                if c != chunk:
                    if chunk is not None:
                        yield out(chunk, total)
                    chunk, total = c, None
                total = _fold(total, blob.as_py(), kind, join)
        if chunk is not None:
            yield out(chunk, total)

    schema = "chunk int, counts binary"
    salt = F.pmod(F.xxhash64("counts"), F.lit(SALTS))
    first = (pieces.select("chunk", "counts").withColumn("salt", salt).repartition("chunk", "salt").coalesce(cores)
             .sortWithinPartitions("chunk", "salt").select("chunk", "counts").mapInArrow(fold, schema))
    last = first.repartition("chunk").coalesce(cores).sortWithinPartitions("chunk").mapInArrow(fold, schema)
    with small_batches(pieces.sparkSession):
        return {r[0]: unpacked(bytes(r[1]), kind) for r in last.collect()}
