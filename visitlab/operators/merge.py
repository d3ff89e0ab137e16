"""Keyed table merges as pure DataFrame operations: they take the current table and the
new rows and return the next version.  Null keys equal each other everywhere."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def null_safe_join(left: DataFrame, right: DataFrame, keys, how: str) -> DataFrame:
    """Equi-join in which null keys equal each other; the result has ``left``'s columns
    (and, but for semi and anti joins, the other columns of ``right``)."""
    keys = _keys(keys)
    right = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = None
    for k in keys:
        term = left[k].eqNullSafe(right[f"_r_{k}"])
        cond = term if cond is None else cond & term
    return left.join(right, cond, how).drop(*[f"_r_{k}" for k in keys])


def merge_replace(old: DataFrame, new: DataFrame, keys) -> DataFrame:
    """K3: upsert that replaces -- rows of ``new`` win, other old rows stay.  Null keys equal each other."""
    return null_safe_join(old, new.select(*_keys(keys)).distinct(), keys, "left_anti") \
        .unionByName(new.select(*old.columns))


def merge_add(old: DataFrame, delta: DataFrame, keys, value: str) -> DataFrame:
    """K4: upsert that adds ``value`` by key (partial aggregation before the shuffle)."""
    keys = _keys(keys)
    return (old.select(*keys, value).unionByName(delta.select(*keys, value))
            .groupBy(*keys).agg(F.sum(value).alias(value)))


def replace_group(old: DataFrame, new: DataFrame, group_keys) -> DataFrame:
    """K5: delete every group present in ``new``, then insert all of ``new``.  Null keys equal each other."""
    return null_safe_join(old, new.select(*_keys(group_keys)).distinct(), group_keys, "left_anti") \
        .unionByName(new.select(*old.columns))


def lookup_total(df: DataFrame, totals: DataFrame, keys, value: str, out: str | None = None) -> DataFrame:
    """K6: attach the running total of each row's key (0 when absent).  Null keys equal each other."""
    name = out or value
    t = totals.select(*_keys(keys), F.col(value).alias(name))
    return null_safe_join(df, t, keys, "left").withColumn(name, F.coalesce(F.col(name), F.lit(0).cast("long")))


def append(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """K1/K2: append rows to a table folder (the writer batches per partition)."""
    w = df.write.mode("append").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
