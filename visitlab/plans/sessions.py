"""Session analysis: per-session aggregate, user profile join, filter, histograms.

Plan shape (one DataFrame chain, never leaving Catalyst)::

    visits --date filter (pushed to scan)--> groupBy(session_id)  [partial + final agg]
           --> join users on user_id (AQE picks broadcast / sort-merge, splits skew)
           --> session filter --> one-pass conditional aggregation (histogram)

All per-session state is bounded: min/max/count are scalars, and the two
``collect_set`` buffers hold distinct search words / category ids only, so a
session with a third of all rows is still combined map-side before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from visitlab.functions import filters
from visitlab.functions.dates import parse_time
from visitlab.functions.numbers import ratio_half_up
from visitlab.session import scratch_path
from visitlab.sources.params import TaskParams

SESSION_AGG_COLUMNS = ["session_id", "user_id", "search_keywords", "click_category_ids",
                       "visit_length", "step_length", "start_time"]

DETAIL_COLUMNS = ["user_id", "session_id", "page_id", "action_time", "search_keyword",
                  "click_category_id", "click_product_id", "order_category_ids",
                  "order_product_ids", "pay_category_ids", "pay_product_ids"]

# Histogram buckets (name, low, high), bounds inclusive, high None = open.
# Visit length in seconds (0 s falls in no bucket), then step length in actions.
VISIT_BUCKETS = [("1s_3s", 1, 3), ("4s_6s", 4, 6), ("7s_9s", 7, 9), ("10s_30s", 10, 30),
                 ("30s_60s", 31, 60), ("1m_3m", 61, 180), ("3m_10m", 181, 600),
                 ("10m_30m", 601, 1800), ("30m", 1801, None)]
STEP_BUCKETS = [("1_3", 1, 3), ("4_6", 4, 6), ("7_9", 7, 9), ("10_30", 10, 30),
                ("30_60", 31, 60), ("60", 61, None)]


def actions_in_range(visits: DataFrame, params: TaskParams | None) -> DataFrame:
    """Actions whose ``date`` lies in the inclusive range (string compare)."""
    if params is None:
        return visits
    return filters.apply(visits, [filters.between("date", params.start_date, params.end_date)])


def session_agg(actions: DataFrame) -> DataFrame:
    """A1: one row per session."""
    t = F.unix_seconds(parse_time("action_time"))
    return (actions
            .groupBy("session_id")
            .agg(F.min("user_id").alias("user_id"),
                 F.array_join(F.array_sort(F.collect_set(
                     F.when(F.col("search_keyword") != "", F.col("search_keyword")))), ",")
                 .alias("search_keywords"),
                 F.array_join(F.array_sort(F.collect_set("click_category_id")), ",")
                 .alias("click_category_ids"),
                 (F.max(t) - F.min(t)).alias("visit_length"),
                 F.count(F.lit(1)).alias("step_length"),
                 F.min("action_time").alias("start_time")))


def session_full_info(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """C1 / JN1: session aggregate joined to the user profile (unknown users drop out)."""
    u = users.select("user_id", "age", "professional", "city", "sex")
    return sessions.join(u, "user_id", "inner").select(*SESSION_AGG_COLUMNS, "age", "professional",
                                                       "city", "sex")


def session_filter(full: DataFrame, params: TaskParams | None) -> DataFrame:
    """Age, professional, city, sex, keywords, category ids -- each optional, ANDed."""
    if params is None:
        return full
    return filters.apply(full, [
        filters.between("age", params.start_age, params.end_age),
        filters.in_list("professional", params.professionals),
        filters.in_list("city", params.cities),
        filters.equal("sex", params.sex),
        filters.overlaps(F.split("search_keywords", ","), params.keywords),
        filters.overlaps(F.split("click_category_ids", ","), params.category_ids),
    ])


def filtered_sessions(visits: DataFrame, users: DataFrame, params: TaskParams | None) -> DataFrame:
    return session_filter(session_full_info(session_agg(actions_in_range(visits, params)), users), params)


def _bucket_cond(col: str, lo: int, hi: int | None):
    c = F.col(col)
    return (c >= lo) if hi is None else c.between(lo, hi)


def histogram_columns() -> list[Column]:
    """A2/A3: session count and both histograms as aggregates over filtered sessions."""
    out = [F.count(F.lit(1)).alias("session_count")]
    for name, lo, hi in VISIT_BUCKETS:
        out.append(F.count(F.when(_bucket_cond("visit_length", lo, hi), 1)).alias(f"visit_length_{name}"))
    for name, lo, hi in STEP_BUCKETS:
        out.append(F.count(F.when(_bucket_cond("step_length", lo, hi), 1)).alias(f"step_length_{name}"))
    return out


def session_aggr_counts(sessions: DataFrame) -> DataFrame:
    """A2/A3 as a pass of their own (one output row)."""
    return sessions.agg(*histogram_columns())


def stat_of_counts(counts: DataFrame) -> DataFrame:
    """A4: bucket shares of the session count, 2 decimals half-up."""
    cols = [F.col("session_count")]
    for name, _, _ in VISIT_BUCKETS:
        cols.append(ratio_half_up(f"visit_length_{name}", "session_count").alias(f"visit_length_{name}_ratio"))
    for name, _, _ in STEP_BUCKETS:
        cols.append(ratio_half_up(f"step_length_{name}", "session_count").alias(f"step_length_{name}_ratio"))
    return counts.select(*cols)


def session_aggr_stat(sessions: DataFrame) -> DataFrame:
    """The histogram ratios of the filtered sessions."""
    return stat_of_counts(session_aggr_counts(sessions))


def stored_sessions(sessions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(the filtered sessions, their ratios as by :func:`session_aggr_stat`).

    The sessions are written once, into the shared checkpoint folder, and the histogram is observed by that write: no
    pass of its own.  The tasks that write are the ones that count, each once, so a task run again counts once too."""
    spark, seen = sessions.sparkSession, Observation()
    path = scratch_path(spark, "sessions")
    columns = histogram_columns()
    sessions.observe(seen, *columns).write.parquet(path)
    stored = spark.read.schema(sessions.schema).parquet(path)
    got = seen.get
    names = ["session_count", *[f"visit_length_{b[0]}" for b in VISIT_BUCKETS], *[f"step_length_{b[0]}" for b in STEP_BUCKETS]]
    counts = spark.createDataFrame([tuple(int(got.get(n) or 0) for n in names)], ", ".join(f"{n} long" for n in names))
    return stored, stat_of_counts(counts)


def session_detail(actions: DataFrame, sessions: DataFrame, stored: bool = False) -> DataFrame:
    """JN2: the actions of the filtered sessions (a semi join: session ids are
    unique on the filter side, so it equals the inner join keeping the actions).

    ``stored`` sessions (:func:`stored_sessions`) have a known size, so Spark puts a runtime Bloom filter of the ids in
    front of the shuffle of the actions once these are large (``get_spark`` sets its bounds): few actions of other
    sessions are shuffled.  Spark only builds one from a side with a selecting predicate, hence the comparison that holds
    for every id.  Else the session side is an aggregate on the join key, whose partitioning Spark would reuse; then AQE
    could not split a skewed partition of the action side.  The rebalance deals the (small) id table anew, so that both
    sides meet through exchanges of the join's own.  Either way a hot session's actions are split."""
    ids = sessions.select("session_id")
    ids = ids.where(F.col("session_id") >= "") if stored else ids.hint("rebalance")
    return actions.join(ids, "session_id", "left_semi").select(*DETAIL_COLUMNS)
