"""Previous-row pairing inside ordered groups (``lag``), safe for huge groups.

A plain ``lag`` window hash-partitions by the group key, so one group with a
third of all rows is sorted and scanned by a single task.  The skew-safe form
never puts more than one range partition's worth of rows in a task:

1. ``repartitionByRange(group + order)``: the sampled range bounds split a hot
   group across many partitions, each holding a contiguous run of its rows.
2. A bucket is (group, range partition).  ``lag`` inside a bucket needs only
   that bucket's rows (bounded by the partition size).
3. The first row of a bucket takes the last value of the previous bucket of
   the same group: a ``lag`` over the table of first rows (one per bucket,
   about groups + partitions rows; a hot group has at most one per range
   partition), so no join is needed.

Both steps are plain DataFrame operators; the range exchange is computed once
and reused by the two branches of the plan, and the range bounds are fixed for
the query, so a task re-run after an executor loss yields the same buckets.

Range partitioning costs a sampling pass and a second shuffle, so by default
only the hot groups take that path: one partial-aggregated count per group
finds the groups above ``max_group_rows`` (the same isolate-the-heavy-keys
pattern as the skew join), and every other row gets a plain ``lag``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitlab.operators.broadcast import bounded_broadcast
from visitlab.session import checkpoint_root

# A group above this many rows is split over range partitions (about the rows
# one task sorts comfortably for the narrow rows used here).
DEFAULT_MAX_GROUP_ROWS = 2_000_000
MAX_HOT_GROUPS = 1_000_000


def with_previous_plain(df: DataFrame, group: Sequence[str], order: Sequence[str], value: str,
                        out: str) -> DataFrame:
    """``lag`` over ``partitionBy(group).orderBy(order)`` (one task per group)."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(out, F.lag(value).over(w))


def with_previous(df: DataFrame, group: Sequence[str], order: Sequence[str], value: str, out: str,
                  num_ranges: int | None = None, skew_safe: bool = True,
                  max_group_rows: int | None = DEFAULT_MAX_GROUP_ROWS) -> DataFrame:
    """Add ``out`` = ``value`` of the previous row of the same group under ``order``
    (null for a group's first row).  ``order`` must be a total order within a group.

    ``max_group_rows`` set: groups above that many rows (found by one partial
    count per group) take the range-bucketed path and all others a plain
    ``lag``; ``None``: every row takes the range-bucketed path;
    ``skew_safe=False``: plain ``lag`` only."""
    if not skew_safe:
        return with_previous_plain(df, group, order, value, out)
    if max_group_rows is not None:
        return _with_previous_isolated(df, group, order, value, out, num_ranges, max_group_rows)
    return _with_previous_ranged(df, group, order, value, out, num_ranges)


def _with_previous_isolated(df: DataFrame, group: Sequence[str], order: Sequence[str], value: str,
                            out: str, num_ranges: int | None, max_group_rows: int) -> DataFrame:
    group = list(group)
    hot = (df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
           .filter(F.col("_n") > max_group_rows).select(*group).withColumn("_hot", F.lit(True)))
    # Materialize the (small) hot-key table once, then broadcast it only after
    # checking its size on the stored copy; beyond the bound it stays a shuffle join.
    checkpoint_root(df.sparkSession)
    hot = hot.checkpoint(eager=True)
    if hot.limit(1).count() == 0:  # no hot group: the plain plan, no second branch
        return with_previous_plain(df, group, order, value, out)
    tagged = df.join(bounded_broadcast(hot, MAX_HOT_GROUPS), group, "left")
    cold_rows = tagged.filter(F.col("_hot").isNull()).drop("_hot")
    hot_rows = tagged.filter(F.col("_hot")).drop("_hot")
    plain = with_previous_plain(cold_rows, group, order, value, out)
    ranged = _with_previous_ranged(hot_rows, group, order, value, out, num_ranges)
    return plain.unionByName(ranged.select(*plain.columns))


def _with_previous_ranged(df: DataFrame, group: Sequence[str], order: Sequence[str], value: str,
                          out: str, num_ranges: int | None) -> DataFrame:
    group, order = list(group), list(order)
    n = num_ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cols = df.columns
    ranged = (df.repartitionByRange(n, *[F.col(c) for c in group + order])
              .withColumn("_pid", F.spark_partition_id()))
    w = Window.partitionBy(*group, "_pid").orderBy(*order)
    w_all = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    local = (ranged
             .withColumn(out, F.lag(value).over(w))
             .withColumn("_rn", F.row_number().over(w))
             .withColumn("_last", F.last(value).over(w_all)))
    # The first row of each bucket takes the last value of the bucket before it
    # in the same group: a lag over the first rows only (one per bucket; a hot
    # group has at most one per range partition).
    firsts = (local.filter(F.col("_rn") == 1)
              .withColumn(out, F.lag("_last").over(Window.partitionBy(*group).orderBy("_pid"))))
    rest = local.filter(F.col("_rn") > 1)
    keep = cols + [out]
    return rest.select(*keep).unionByName(firsts.select(*keep))
