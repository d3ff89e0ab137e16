"""Embedding whitening by polarisation covariance.

An entry c becomes the whole number ``x = floor(1024 * c) + 100000``.  Variances are sums of exact squares: for every
dimension, and for the sum of every pair of dimensions, the squares of the centred values are added up in whole numbers,
and ``cov(i, j) = (var(x_i + x_j) - var(x_i) - var(x_j)) / 2`` gives all cross-covariances without any product of two
dimensions and without rounding.  Values are centred at the whole number next to their mean before they are squared; the
remainder of the mean is put right exactly afterwards (sum of (n*x - S)^2 = n^2 * sum of d^2 - n * r^2 for
d = x - m, r = S - n * m).  The matrix is rounded to doubles once, for ``eigh`` on the driver.

Every pass is a scan: a task adds its rows into one number per dimension or pair, Spark adds up the tasks'.  The driver
gets the dimensions' sums and the matrix, whose size is the square of the dimension whatever the number of vectors.

Defined results: rows whose vector is null or holds a null, NaN or infinite entry are left out, and so are vectors
whose length is not the commonest (of equally common ones the longest).  Repeated rows count each; a null id is carried.
An empty table, or one of empty vectors, gives no rows.  A component without variance has whitened values 0 and does not
count in ``identity_error``; with no variance at all ``explained`` is 0.  An entry of 2^19 or more in size, no embedding,
raises ValueError, as exact sums would not be sure.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlab.llm.scratch import store

SCALE, SHIFT = 1024, 100_000
LARGEST = 1 << 29  # of |x - SHIFT|: squares of pair sums then fit 63 bits
_ROWS = 2048  # vectors worked on at a time
_LOW = np.int64((1 << 32) - 1)
_FLAT = 1e-12  # of the trace: an eigenvalue below is rounding, not variance


def whole_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v array<double>): the vectors that take part, of any length."""
    v = F.col("v")
    wrong = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return (df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
            .where(v.isNotNull() & ~wrong))


def _numbers(column: pa.Array, dim: int) -> np.ndarray:
    """The rows' x as (rows, dim)."""
    c = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim) * SCALE
    if c.size and np.abs(c).max() >= LARGEST:
        raise ValueError("an entry of an embedding is 2^19 or more in size")
    return np.floor(c).astype(np.int64) + SHIFT


def _sums(vectors: DataFrame) -> tuple[int, int, list[int]]:
    """(dimension, n, S): the commonest length, its number of vectors, and the sum of x per dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for b in batches:
            v = b.column("v")
            sizes = np.asarray(v.value_lengths())
            for d in np.unique(sizes[sizes > 0]).tolist():
                x = _numbers(v.filter(pa.array(sizes == d)), d)
                t = total.setdefault(d, [0, np.zeros(d, np.int64)])
                t[0] += len(x)
                t[1] += x.sum(0)
        for d, (n, s) in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()),
                                              pa.array([n] * d, pa.int64()), pa.array(s)], ["d", "i", "n", "s"])

    parts = (vectors.select("v").mapInArrow(run, "d int, i int, n long, s long").groupBy("d", "i")
             .agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")))
    found = store(parts, "whitening-sums")
    best = found.where("i = 0").orderBy(F.desc("n"), F.desc("d")).first()
    if best is None:
        return 0, 0, []
    return best.d, best.n, [int(r.s) for r in found.where(F.col("d") == best.d).orderBy("i").collect()]


def covariance(vectors: DataFrame, dim: int, n: int, sums: list[int]) -> np.ndarray:
    """The covariance of x (divisor n), each entry the double next to the exact value."""
    middle = [round(Fraction(s, n)) for s in sums]
    rest = [s - n * m for s, m in zip(sums, middle, strict=True)]
    centre = np.array(middle, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low, any_row = np.zeros((dim, dim), np.int64), np.zeros((dim, dim), np.int64), False
        for b in batches:
            for a in range(0, b.num_rows, _ROWS):
                any_row = True
                d = _numbers(b.column("v").slice(a, _ROWS), dim) - centre
                for i in range(dim):
                    t = d[:, i:] + d[:, i:i + 1]
                    t[:, 0] = d[:, i]  # the dimension by itself
                    t *= t
                    high[i, i:] += (t >> 32).sum(0)
                    low[i, i:] += (t & _LOW).sum(0)
        if any_row:
            i, j = np.triu_indices(dim)
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                                              pa.array(high[i, j]), pa.array(low[i, j])], ["i", "j", "high", "low"])

    whole = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    rows = (vectors.where(F.size("v") == dim).select("v").mapInArrow(run, "i int, j int, high long, low long")
            .groupBy("i", "j").agg(*whole).collect())  # dim * (dim + 1) / 2 rows
    squares = {(r.i, r.j): (int(r.high) << 32) + int(r.low) for r in rows}

    def centred(i: int, j: int) -> int:
        """Sum of (n*y - sum of y)^2 over y = x_i, or x_i + x_j."""
        r = rest[i] if i == j else rest[i] + rest[j]
        return n * n * squares[i, j] - n * r * r

    out = np.zeros((dim, dim))
    for i in range(dim):
        out[i, i] = float(Fraction(centred(i, i), n ** 3))
        for j in range(i + 1, dim):
            out[i, j] = out[j, i] = float(Fraction(centred(i, j) - centred(i, i) - centred(j, j), 2 * n ** 3))
    return out


def components(cov: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors in columns) of the k greatest, the largest entry of each vector positive."""
    e, w = np.linalg.eigh(cov)
    e, w = np.maximum(e[::-1][:k], 0), w[:, ::-1][:, :k]
    return e, w * np.sign(w[np.abs(w).argmax(0), np.arange(w.shape[1])])


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 8) -> DataFrame:
    """(id column, component int, n long, deviation decimal(38,0), whitened, explained, identity_error): a row per
    remaining vector and component 1 to ``min(k, dimension)``."""
    spark = df.sparkSession
    vectors = whole_vectors(df, id_col, vector_col)
    kind = vectors.schema["id"].dataType.simpleString()
    names = [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"]
    dim, n, sums = _sums(vectors)
    if not n:
        return spark.createDataFrame([], f"{id_col} {kind}, component int, n long, deviation decimal(38,0), "
                                         "whitened double, explained double, identity_error double")
    cov = covariance(vectors, dim, n, sums)
    values, axes = components(cov, k)
    real = values > _FLAT * np.trace(cov)
    scaled = np.where(real, axes / np.sqrt(np.where(real, values, 1)), 0)
    middle = [round(Fraction(s, n)) for s in sums]
    rest = [s - n * m for s, m in zip(sums, middle, strict=True)]
    centre, left = np.array(middle, np.int64), np.array(rest, np.int64)
    lean = left / n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a in range(0, b.num_rows, _ROWS):
                p = b.slice(a, _ROWS)
                d = _numbers(p.column("v"), dim) - centre
                if n * (float(np.abs(d).max(initial=0)) + 1) * dim ** 0.5 < 2.0 ** 31:
                    deviation = pa.array(((d * n - left) ** 2).sum(1)).cast(pa.decimal128(38, 0))
                else:  # beyond 63 bits: whole numbers of any size
                    deviation = pa.array([Decimal(sum((c * n - r) ** 2 for c, r in zip(row, rest, strict=True)))
                                          for row in d.tolist()], pa.decimal128(38, 0))
                w = (d - lean) @ scaled
                yield pa.RecordBatch.from_arrays(
                    [p.column("id"), deviation,
                     pa.ListArray.from_arrays(pa.array(np.arange(0, w.size + 1, w.shape[1]), pa.int32()), w.ravel())],
                    ["id", "deviation", "w"])

    placed = store(vectors.where(F.size("v") == dim)
                   .mapInArrow(run, f"id {kind}, deviation decimal(38,0), w array<double>"), "whitening-rows")
    used = [i for i in range(len(values)) if real[i]]
    pairs = [(i, j) for i in used for j in used if i <= j]
    m = placed.agg(F.count(F.lit(1)), *[F.avg(F.col("w")[i]).alias(f"m{i}") for i in used],
                   *[F.avg(F.col("w")[i] * F.col("w")[j]).alias(f"p{i}_{j}") for i, j in pairs]).first()
    error = max((abs(m[f"p{i}_{j}"] - m[f"m{i}"] * m[f"m{j}"] - (i == j)) for i, j in pairs), default=0.0)
    share = [float(v / np.trace(cov)) if real.any() else 0.0 for v in values]
    return placed.select("id", "deviation", F.posexplode("w").alias("at", "whitened")).select(
        F.col("id").alias(id_col), (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
        "whitened", F.element_at(F.array(*[F.lit(s) for s in share]), F.col("at") + 1).alias("explained"),
        F.lit(float(error)).alias("identity_error")).select(*names)
