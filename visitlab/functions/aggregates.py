"""Aggregate expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def group_concat_distinct(c, sep: str = ",") -> Column:
    """Distinct values of a group, sorted as strings, joined by ``sep``.

    ``collect_set`` is a partial (map-side) aggregate whose buffer holds only
    distinct values, so the cost is bounded by the group's distinct count, not
    its row count; nulls are skipped.
    """
    return F.array_join(F.array_sort(F.collect_set(_col(c).cast("string"))), sep)


def concat_distinct_by(df: DataFrame, keys: Sequence[str], column: str, out: str, sep: str = ",") -> DataFrame:
    """U5 per group in two levels: (keys, out).

    Values are made distinct per (group, value) first, over all tasks, and each is then sent to its group once.  With
    ``collect_set`` alone every map task sends its whole set of a large group to the one task that has it."""
    value = F.col(column).cast("string").alias("_value")
    return (df.select(*keys, value).distinct().groupBy(*keys)
            .agg(F.array_join(F.array_sort(F.collect_list("_value")), sep).alias(out)))
