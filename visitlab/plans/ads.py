"""Ad-click analytics on a parsed click DataFrame (batch forms of the stream jobs).

Input lines are ``epoch_ms province city user_id ad_id``; :func:`parse_ad_log`
turns any DataFrame with a ``value`` column (batch or streaming) into typed
columns.  Every function here is a plain DataFrame transformation, so the same
code runs on a static table, inside ``foreachBatch``, or (where it is a
streaming-supported operator) directly on a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlab.operators.broadcast import bounded_broadcast
from visitlab.operators.topk import top_k_per_group
from visitlab.session import checkpoint_root

DEFAULT_BLACKLIST_THRESHOLD = 100

CLICK_COLUMNS = ["ts_ms", "date", "province", "city", "user_id", "ad_id"]
# Blocked users are few; up to this many they are broadcast to the click side.
MAX_BROADCAST_USERS = 1_000_000


def _small_user_side(df: DataFrame) -> DataFrame:
    """A per-user table derived by aggregating on user_id.  Joined as is, Spark
    would reuse that partitioning and a user with a third of the clicks would
    land in one task (AQE cannot split it).  It is stored once (reliable
    checkpoint), and broadcast after a size check; beyond the bound it stays a
    shuffle join."""
    checkpoint_root(df.sparkSession)
    return bounded_broadcast(df.checkpoint(eager=True), MAX_BROADCAST_USERS)


def parse_ad_log(lines: DataFrame, keep: str | None = None) -> DataFrame:
    """Split on single spaces; fields 0..4 -> ts_ms, province, city, user_id, ad_id.

    Malformed or short lines give nulls instead of failing the job; :func:`split_lines`
    takes them out.  ``keep`` names a column to carry along.

    ``ts`` is the click time (UTC timestamp) and ``date`` its ``yyyy-MM-dd``."""
    parts = F.split(F.col("value"), " ")

    def field(i: int):
        return F.get(parts, i)  # null (not an error) when the line is short

    return (lines
            .select(field(0).try_cast("long").alias("ts_ms"),
                    field(1).alias("province"),
                    field(2).alias("city"),
                    field(3).try_cast("long").alias("user_id"),
                    field(4).try_cast("long").alias("ad_id"), *([keep] if keep else []))
            .withColumn("ts", F.timestamp_millis("ts_ms"))
            .withColumn("date", F.date_format("ts", "yyyy-MM-dd")))


REJECT_COLUMNS = ["value", "reason"]


def split_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clicks, rejects): a line without a readable time, user or ad is no click; it goes to
    the rejects with the first reason that applies, so nothing is lost uncounted."""
    parsed = parse_ad_log(lines.select("value").withColumn("_line", F.col("value")), keep="_line")
    reason = (F.when(F.col("ts_ms").isNull(), "no_time").when(F.col("user_id").isNull(), "no_user")
              .when(F.col("ad_id").isNull(), "no_ad"))
    parsed = parsed.withColumn("reason", reason)
    rejects = parsed.filter(F.col("reason").isNotNull()).select(F.col("_line").alias("value"), "reason")
    return parsed.filter(F.col("reason").isNull()).drop("_line", "reason"), rejects


def reject_counts(lines: DataFrame) -> DataFrame:
    """Rejected lines per reason."""
    return split_lines(lines)[1].groupBy("reason").agg(F.count(F.lit(1)).alias("lines"))


def daily_user_ad_clicks(clicks: DataFrame) -> DataFrame:
    """Clicks per (date, user, ad)."""
    return clicks.groupBy("date", "user_id", "ad_id").agg(F.count(F.lit(1)).alias("click_count"))


def blacklist_users(daily_counts: DataFrame, threshold: int = DEFAULT_BLACKLIST_THRESHOLD) -> DataFrame:
    """Distinct users with at least ``threshold`` clicks on one ad in one day."""
    return daily_counts.filter(F.col("click_count") >= threshold).select("user_id").distinct()


def blacklist_filter(clicks: DataFrame, blacklist: DataFrame) -> DataFrame:
    """JN9: drop the clicks of blacklisted users (anti join)."""
    return clicks.join(_small_user_side(blacklist.select("user_id")), "user_id", "left_anti")


def kept_clicks(clicks: DataFrame, threshold: int = DEFAULT_BLACKLIST_THRESHOLD) -> DataFrame:
    """Batch equivalent of the dynamic blacklist when batches are whole days in order.

    A user is blocked from the first day on which some ad reaches ``threshold``
    clicks (counts restart each day, and the user's earlier days are all kept),
    and the blacklist takes effect from the next batch: kept clicks are those
    on or before that day."""
    block = _small_user_side(daily_user_ad_clicks(clicks).filter(F.col("click_count") >= threshold)
                             .groupBy("user_id").agg(F.min("date").alias("_block_day")))
    return (clicks.join(block, "user_id", "left")
            .filter(F.col("_block_day").isNull() | (F.col("date") <= F.col("_block_day")))
            .drop("_block_day"))


def ad_stat(clicks: DataFrame) -> DataFrame:
    """R5 batch form: running total per (date, province, city, ad)."""
    return clicks.groupBy("date", "province", "city", "ad_id").agg(F.count(F.lit(1)).alias("click_count"))


def province_ad_clicks(stat: DataFrame) -> DataFrame:
    """Roll city totals up to (date, province, ad)."""
    return stat.groupBy("date", "province", "ad_id").agg(F.sum("click_count").alias("click_count"))


def ad_stat_rollup(clicks: DataFrame) -> DataFrame:
    """A15 with R5: city totals and province totals from one shuffle, as grouping sets: (date, province, city, ad_id,
    click_count, level), level 0 per city, 2 per province (city is null)."""
    keys = [F.col(c) for c in ("date", "province", "city", "ad_id")]
    return clicks.groupingSets([keys, [keys[0], keys[1], keys[3]]], *keys).agg(
        F.count(F.lit(1)).alias("click_count"), F.grouping_id().cast("int").alias("level"))


def ad_province_top3(stat: DataFrame, k: int = 3, per_day: bool = True) -> DataFrame:
    """Top ``k`` ads per (date, province) by clicks, ties by ad_id.

    ``per_day=False`` ranks per province across all days (days compete)."""
    prov = province_ad_clicks(stat)
    group = ["date", "province"] if per_day else ["province"]
    return top_k_per_group(prov, group, [F.col("click_count").desc(), F.col("ad_id").asc()], k) \
        .select("date", "province", "ad_id", "click_count")


def ad_click_trend(clicks: DataFrame) -> DataFrame:
    """R7 batch form: clicks per (minute, ad) with the minute split into date / hour / minute."""
    minute = F.date_trunc("minute", F.col("ts"))
    return (clicks.groupBy(minute.alias("_m"), "ad_id").agg(F.count(F.lit(1)).alias("click_count"))
            .select(F.date_format("_m", "yyyy-MM-dd").alias("date"),
                    F.date_format("_m", "HH").alias("hour"),
                    F.date_format("_m", "mm").alias("minute"),
                    "ad_id", "click_count"))


PANE_MS = 10_000
_DAY_MS = 86_400_000


def pane_start(ts_ms, pane_ms: int = PANE_MS) -> Column:
    """Start of the pane of ``pane_ms`` milliseconds a click time falls in."""
    return F.col(ts_ms) - F.pmod(F.col(ts_ms), F.lit(pane_ms))


def click_panes(clicks: DataFrame, pane_ms: int = PANE_MS) -> DataFrame:
    """(pane_ms, ad_id, clicks): clicks per pane and ad."""
    return (clicks.groupBy(pane_start("ts_ms", pane_ms).alias("pane_ms"), "ad_id")
            .agg(F.count(F.lit(1)).alias("clicks")))


def trend_of_panes(panes: DataFrame) -> DataFrame:
    """The minute trend from panes that divide a minute."""
    minute = F.timestamp_millis(pane_start("pane_ms", 60_000))
    return (panes.groupBy(minute.alias("_m"), "ad_id").agg(F.sum("clicks").alias("click_count"))
            .select(F.date_format("_m", "yyyy-MM-dd").alias("date"), F.date_format("_m", "HH").alias("hour"),
                    F.date_format("_m", "mm").alias("minute"), "ad_id", "click_count"))


def sliding_clicks(panes: DataFrame, window_ms: int = 3_600_000, slide_ms: int = PANE_MS) -> DataFrame:
    """Clicks per ad in every window of ``window_ms`` that ends at a multiple of ``slide_ms``, from panes of
    ``slide_ms``: (date, ad_id, first_end, last_end, click_count).

    A row stands for all windows that end from ``first_end`` to ``last_end`` (UTC times, steps of ``slide_ms``) on
    ``date``: the count only changes when a pane comes into the window or leaves it, so a pane makes two changes instead
    of a copy per window.  Windows without a click have no row.  Counts run within (ad, day of the window's end); what
    is still in the window at midnight is carried to the next day as a change of its own, so no task needs more than a
    day of an ad.  Windows of up to a day."""
    if window_ms > _DAY_MS or window_ms % slide_ms or _DAY_MS % slide_ms:
        raise ValueError("a window is a multiple of the slide, up to a day")
    came, went = F.col("pane_ms") + slide_ms, F.col("pane_ms") + window_ms + slide_ms
    midnight = went - F.pmod(went, F.lit(_DAY_MS))

    def change(at: Column, n: Column) -> Column:
        return F.struct(at.alias("at"), n.cast("long").alias("n"))

    n = F.col("clicks")
    changes = F.when(came >= midnight, F.array(change(came, n), change(went, -n))).otherwise(
        F.array(change(came, n), change(midnight, n), change(went, -n)))
    day = F.col("at") - F.pmod(F.col("at"), F.lit(_DAY_MS))
    net = (panes.select("ad_id", F.explode(changes).alias("c")).select("ad_id", "c.at", "c.n").withColumn("day", day)
           .groupBy("ad_id", "day", "at").agg(F.sum("n").alias("n")).where("n <> 0"))
    w = Window.partitionBy("ad_id", "day").orderBy("at")
    level = net.select("ad_id", "day", "at", F.sum("n").over(w).alias("click_count"),
                       F.coalesce(F.lead("at").over(w), F.col("day") + _DAY_MS).alias("until"))

    def shown(ms: Column) -> Column:
        return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd HH:mm:ss")

    return level.where("click_count > 0").select(
        F.date_format(F.timestamp_millis("day"), "yyyy-MM-dd").alias("date"), "ad_id",
        shown(F.col("at")).alias("first_end"), shown(F.col("until") - slide_ms).alias("last_end"), "click_count")


def trend_last_hour(trend: DataFrame, now_ts, minutes: int = 60) -> DataFrame:
    """The per-minute trend of the ``minutes`` before ``now_ts`` (a timestamp
    literal or column).  Counts are stored in full per (minute, ad); "the last
    hour" is a filter on read instead of a window that rewrites old minutes."""
    now = F.lit(now_ts).cast("timestamp") if not hasattr(now_ts, "alias") else now_ts
    minute_ts = F.to_timestamp(F.concat_ws(" ", "date", F.concat_ws(":", "hour", "minute")), "yyyy-MM-dd HH:mm")
    return trend.filter((minute_ts > now - F.expr(f"INTERVAL {minutes} MINUTES")) & (minute_ts <= now))
