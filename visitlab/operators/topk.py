"""Top-k rows per group with a total order.

``row_number() <= k`` over a window lets Spark insert a partial
``WindowGroupLimit`` before the shuffle: each map task keeps at most ``k`` rows
per group, so a group holding a third of the data sends only ``k`` rows per
task to its reducer.  Spark does so for limits up to
``spark.sql.optimizer.windowGroupLimitThreshold`` (1000 by default; ``get_spark``
raises it).  Ties are broken by the ``tie_break`` columns, so the
result is deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(cols: Sequence) -> list[Column]:
    out = []
    for c in cols:
        out.append(F.col(c) if isinstance(c, str) else c)
    return out


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence, k: int,
                    rank_col: str | None = None) -> DataFrame:
    """Keep the first ``k`` rows of each group under ``order`` (a full total order)."""
    w = Window.partitionBy(*group).orderBy(*_order(order))
    tmp = rank_col or "_rn"
    out = df.withColumn(tmp, F.row_number().over(w)).filter(F.col(tmp) <= k)
    return out if rank_col else out.drop(tmp)


def top_k(df: DataFrame, order: Sequence, k: int) -> DataFrame:
    """Global top-k (TakeOrderedAndProject: per-partition top-k, then merge)."""
    return df.orderBy(*_order(order)).limit(k)
