"""Broadcast only what has a proven size bound.

``bounded_broadcast(df, max_rows, max_bytes)`` measures the candidate side (rows and
bytes; only partial sums are shuffled) and hints a broadcast when both bounds
hold; otherwise the frame is returned unchanged and Catalyst / AQE pick a shuffle
join.  Hand it a stored frame: measuring runs its plan.  Sides whose size is bounded
by construction (a ``limit(k)`` result, a parameter list, a fixed 25-row dimension)
use :func:`broadcast_fixed`.  Derived tables of unknown size get no hint at all: AQE
measures the finished shuffle stage and converts the join to a broadcast only when
that measured size is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

DEFAULT_MAX_ROWS = 1_000_000
DEFAULT_MAX_BYTES = 256 << 20
_FIXED = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "float": 4, "date": 4}  # other plain types: 8


def _row_bytes(df: DataFrame) -> Column:
    """Size of a row's values: text by its bytes, nested values by their JSON."""
    size = F.lit(0).cast("long")
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (StringType, BinaryType)):
            n = F.octet_length(c)
        elif isinstance(f.dataType, (ArrayType, MapType, StructType)):
            n = F.octet_length(F.to_json(F.struct(c)))
        else:
            n = F.lit(_FIXED.get(f.dataType.simpleString(), 8))
        size = size + F.coalesce(n, F.lit(0))
    return size


def measured(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes of their values)."""
    r = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(_row_bytes(df)), F.lit(0)).alias("b")).first()
    return r.n, r.b


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    return df.count() <= max_rows


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS, max_bytes: int = DEFAULT_MAX_BYTES) -> DataFrame:
    """Broadcast hint if ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes, else ``df`` as is."""
    rows, size = measured(df)
    return F.broadcast(df) if rows <= max_rows and size <= max_bytes else df


def broadcast_fixed(df: DataFrame) -> DataFrame:
    """Broadcast a side whose size is bounded by construction (caller's proof)."""
    return F.broadcast(df)
