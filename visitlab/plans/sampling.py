"""Stratified random extraction of sessions by start hour.

Of ``n`` sessions in total, each day gets ``n div days``; an hour gets its
share of the day, ``count * per_day div day_total``, capped at the hour's
count.  Inside an hour the sessions are ranked by ``md5(seed || session_id)``
(ties by session_id), which is a seeded, reproducible random order that does
not depend on partitioning or recomputation.

Plan: sessions are ranked inside their hour and cut at ``row_number() <= n``
-- a literal upper bound of every quota -- so Spark puts a partial
WindowGroupLimit before the shuffle and even an hour with a third of all
sessions ships at most ``n`` rows per map task.  The per-hour counts are a
small table (24 rows per day) joined to those survivors; AQE turns that join
into a broadcast from the measured size, else it stays a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitlab.functions.dates import date_hour
from visitlab.functions.numbers import int_div
from visitlab.operators.broadcast import broadcast_fixed
from visitlab.plans.sessions import DETAIL_COLUMNS
from visitlab.session import checkpoint_root

EXTRACT_COLUMNS = ["session_id", "start_time", "search_keywords", "click_category_ids"]
BROADCAST_MAX_IDS = 1_000_000


def with_hour(sessions: DataFrame) -> DataFrame:
    dh = date_hour("start_time")
    return sessions.withColumn("date", F.substring(dh, 1, 10)).withColumn("hour", F.substring(dh, 12, 2))


def sessions_per_hour(sessions: DataFrame) -> DataFrame:
    """Sessions per (date, hour) and per date."""
    per_hour = with_hour(sessions).groupBy("date", "hour").agg(F.count(F.lit(1)).alias("hour_count"))
    # One row per (date, hour): bounded by 24 rows per day of data.
    return per_hour.withColumn("day_count", F.sum("hour_count").over(Window.partitionBy("date")))


def sessions_rollup(sessions: DataFrame) -> DataFrame:
    """Sessions per (date, hour), per date and in all, from one shuffle: (date, hour, sessions, level), level 0
    for an hour, 1 for a day (hour is null), 3 for the total (both are null)."""
    return (with_hour(sessions).rollup("date", "hour")
            .agg(F.count(F.lit(1)).alias("sessions"), F.grouping_id().cast("int").alias("level")))


def hour_quotas(sessions: DataFrame, n: int) -> DataFrame:
    """(date, hour, quota) of every hour."""
    # One row per hour, at most 24 a day: the number of days comes from the same rows, not from a second count.
    hours = sessions_per_hour(sessions).withColumn("days", F.size(F.collect_set("date").over(Window.partitionBy(F.lit(1)))))
    per_day = int_div(F.lit(n), F.col("days"))
    quota = F.least(F.col("hour_count"), int_div(F.col("hour_count") * per_day, F.col("day_count")))
    return hours.select("date", "hour", quota.alias("quota"))


def session_random_extract(sessions: DataFrame, n: int = 100, seed: int = 42,
                           materialize: bool = False) -> DataFrame:
    """About ``n`` sessions, stratified by day and hour.

    The sessions feed two branches (ranking and hour counts).  With
    ``materialize`` they are written once with a reliable ``checkpoint()`` into
    the shared checkpoint folder, so the actions are scanned and shuffled once
    instead of twice."""
    if materialize:
        checkpoint_root(sessions.sparkSession)
        sessions = sessions.checkpoint(eager=True)
    w = Window.partitionBy("date", "hour").orderBy("_rk", "session_id")
    # Rank first and cut at the literal bound n (partial WindowGroupLimit before
    # the shuffle), then meet the per-hour quota on at most n rows per hour.
    ranked = (with_hour(sessions)
              .withColumn("_rk", F.md5(F.concat(F.lit(str(seed)), F.col("session_id"))))
              .withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") <= n))
    return (ranked.join(hour_quotas(sessions, n), ["date", "hour"], "inner")
            .filter(F.col("_rn") <= F.col("quota"))
            .select(*EXTRACT_COLUMNS))


def extracted_session_detail(actions: DataFrame, extracted: DataFrame, n: int) -> DataFrame:
    """JN3: actions of the extracted sessions.

    The quotas of all hours of a day add up to at most ``n div days``, so the
    extraction holds at most ``n`` ids: up to ``BROADCAST_MAX_IDS`` they are
    broadcast (bounded by the parameter); a larger ``n`` keeps a shuffle join."""
    ids = extracted.select("session_id")
    if n <= BROADCAST_MAX_IDS:
        ids = broadcast_fixed(ids)
    return actions.join(ids, "session_id", "left_semi").select(*DETAIL_COLUMNS)
