"""

``entry(spark)`` runs the flagship query (area top-3 products) on sf0.001.
``(spark, sf_dir) -> DataFrame``; ``oracle_sql()`` gives the independent DuckDB
SQL for the same key (omitted only where the result is not SQL-expressible).
Each query reads the whole given tables (or data Spark derives from them).
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from visitlab.functions import dates as DT  # noqa: E402
from visitlab.functions import strings as ST  # noqa: E402
from visitlab.operators import broadcast as BC  # noqa: E402
from visitlab.operators import merge as MG  # noqa: E402
from visitlab.operators import skew as SK  # noqa: E402
from visitlab.plans import ads as AD  # noqa: E402
from visitlab.plans import categories as C  # noqa: E402
from visitlab.plans import funnel as FN  # noqa: E402
from visitlab.plans import jobs as JB  # noqa: E402
from visitlab.plans import products as PR  # noqa: E402
from visitlab.plans import sampling as SM  # noqa: E402
from visitlab.plans import sessions as S  # noqa: E402
from visitlab.plans import sql_jobs as SQ  # noqa: E402
from visitlab.session import checkpoint_root  # noqa: E402
from visitlab.sources.params import TaskParams, parse_task_params  # noqa: E402
from visitlab.streaming import ad_streams as AS  # noqa: E402
from visitlab.sources.tables import Tables  # noqa: E402

import oracle_sql as O  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"

# Parameter sets of the registered queries (the "tasks" a user would submit).
P_RANGE = TaskParams(start_date="2024-01-05", end_date="2024-01-25")
P_STAT = TaskParams(start_date="2024-01-01", end_date="2024-01-31", start_age=10, end_age=50)
P_SESSION = TaskParams(start_date="2024-01-03", end_date="2024-01-28", start_age=10, end_age=50,
                       professionals="BUILDING,MACHINERY,HOUSEHOLD", sex="male",
                       keywords="火锅,蛋糕,温泉")
P_DETAIL = TaskParams(start_date="2024-01-01", end_date="2024-01-31", start_age=10, end_age=50, sex="male")
P_AREA = TaskParams(start_date="2024-01-01", end_date="2024-01-31")
P_FLOW = TaskParams(start_date="2024-01-01", end_date="2024-01-31", target_page_flow="1,2,3,4,5")
SAMPLE_N = 900
SAMPLE_SEED = 42
# The reference blocks at 100 clicks per (day, user, ad); the test data peaks at
# 4, so the registered queries use 3 to produce a non-empty blacklist.
AD_THRESHOLD = 3


def _t(spark: SparkSession, sf_dir: str) -> Tables:
    spark.conf.set("spark.sql.session.timeZone", "UTC")  # the contract hands over a bare session
    return Tables(spark, sf_dir)


def _visits(spark: SparkSession, sf_dir: str, p: TaskParams) -> DataFrame:
    """The actions of a task's date range; the scan is cut to the events that can be in it."""
    return S.actions_in_range(_t(spark, sf_dir).visits(p.start_date, p.end_date), p)


# ---------------------------------------------------------------- sessions

def q_action_date_range(spark, sf):
    return _visits(spark, sf, P_RANGE)


def q_session_agg(spark, sf):
    return S.session_agg(_t(spark, sf).visits())


def q_session_full_info(spark, sf):
    t = _t(spark, sf)
    return S.session_full_info(S.session_agg(t.visits()), t.users())


def _full(spark, sf):
    t = _t(spark, sf)
    return S.session_full_info(S.session_agg(t.visits()), t.users())


def q_filter_between(spark, sf):
    return S.session_filter(_full(spark, sf), TaskParams(start_age=10, end_age=50))


def q_filter_in(spark, sf):
    return S.session_filter(_full(spark, sf), TaskParams(professionals="BUILDING,MACHINERY",
                                                         category_ids="1,11,15"))


def q_filter_equal(spark, sf):
    return S.session_filter(_full(spark, sf), TaskParams(sex="female"))


def q_session_filter(spark, sf):
    t = _t(spark, sf)
    return S.filtered_sessions(t.visits(P_SESSION.start_date, P_SESSION.end_date), t.users(), P_SESSION)


def q_session_aggr_counts(spark, sf):
    t = _t(spark, sf)
    return S.session_aggr_counts(S.filtered_sessions(t.visits(), t.users(), P_STAT))


def q_session_aggr_stat(spark, sf):
    t = _t(spark, sf)
    return S.session_aggr_stat(S.filtered_sessions(t.visits(), t.users(), P_STAT))


def q_session_detail(spark, sf):
    t = _t(spark, sf)
    actions = S.actions_in_range(t.visits(), P_DETAIL)
    return S.session_detail(actions, S.filtered_sessions(t.visits(), t.users(), P_DETAIL))


def q_session_detail_stored(spark, sf):
    """The same with the sessions stored first: Spark can put a Bloom filter of their ids before the shuffle."""
    t = _t(spark, sf)
    sessions, _ = S.stored_sessions(S.filtered_sessions(t.visits(), t.users(), P_DETAIL))
    return S.session_detail(S.actions_in_range(t.visits(), P_DETAIL), sessions, stored=True)


def q_session_stat_observed(spark, sf):
    """The histogram ratios as observed while the filtered sessions are written."""
    t = _t(spark, sf)
    return S.stored_sessions(S.filtered_sessions(t.visits(), t.users(), P_STAT))[1]


def q_task_params(spark, sf):
    return parse_task_params(_t(spark, sf).tasks())


# ---------------------------------------------------------------- area products

def _clicks(spark, sf):
    return PR.click_actions(_t(spark, sf).visits(P_AREA.start_date, P_AREA.end_date), P_AREA)


def q_click_actions(spark, sf):
    return _clicks(spark, sf)


def q_click_product_basic(spark, sf):
    return PR.click_product_basic(_clicks(spark, sf), _t(spark, sf).cities())


def q_area_product_clicks(spark, sf):
    return PR.area_product_clicks(_clicks(spark, sf), _t(spark, sf).cities())


def q_area_product_full(spark, sf):
    t = _t(spark, sf)
    return PR.area_product_full(PR.area_product_clicks(_clicks(spark, sf), t.cities()), t.products())


def q_area_top3_product(spark, sf):
    t = _t(spark, sf)
    return PR.area_top3_product(t.visits(), t.cities(), t.products(), P_AREA)


def q_area_top3_product_sql(spark, sf):
    return SQ.area_top3_product_sql(spark, _t(spark, sf), P_AREA.start_date, P_AREA.end_date)


def q_area_level_map(spark, sf):
    return _t(spark, sf).cities().select("city_id", "area", PR.area_level("area").alias("area_level"))


def q_product_status(spark, sf):
    return _t(spark, sf).products().select("product_id", PR.product_status().alias("product_status"))


def q_group_concat_distinct(spark, sf):
    from visitlab.functions.aggregates import concat_distinct_by
    basic = PR.click_product_basic(_clicks(spark, sf), _t(spark, sf).cities())
    return concat_distinct_by(basic, ["area"], "city_name", "city_names")


# ---------------------------------------------------------------- categories

def _detail(spark, sf):
    t = _t(spark, sf)
    actions = S.actions_in_range(t.visits(), P_DETAIL)
    return S.session_detail(actions, S.filtered_sessions(t.visits(), t.users(), P_DETAIL))


def _detail_with_id(spark, sf):
    t = _t(spark, sf)
    actions = S.actions_in_range(t.visits(), P_DETAIL)
    sess = S.filtered_sessions(t.visits(), t.users(), P_DETAIL)
    return actions.join(sess.select("session_id"), "session_id", "left_semi")


def q_explode_category_ids(spark, sf):
    return C.explode_category_ids(_t(spark, sf).visits(), "order_category_ids")


def q_visited_categories(spark, sf):
    return C.visited_categories(_detail(spark, sf))


def q_category_counts(spark, sf):
    return C.category_counts(_detail(spark, sf))


def q_category_counts_join(spark, sf):
    checkpoint_root(spark)
    return C.category_counts_join(_detail_with_id(spark, sf).select(
        "action_id", "session_id", "click_category_id", "order_category_ids", "pay_category_ids").checkpoint())


def q_top10_category(spark, sf):
    return C.top10_category(_detail(spark, sf))


def q_session_category_clicks(spark, sf):
    return C.session_category_clicks(_detail(spark, sf))


def q_top10_session(spark, sf):
    _, top_sessions = C.top_categories_and_sessions(_detail(spark, sf))
    return top_sessions


def q_top10_session_detail(spark, sf):
    checkpoint_root(spark)
    d = _detail(spark, sf).checkpoint()  # stored once, read by both branches
    _, top_sessions = C.top_categories_and_sessions(d)
    return C.top10_session_detail(d, top_sessions)


# ---------------------------------------------------------------- page funnel

def q_page_split_pv(spark, sf):
    return FN.page_split_pv(spark, _t(spark, sf).visits(), P_FLOW)


def q_start_page_pv(spark, sf):
    return FN.start_page_pv(_t(spark, sf).visits(), P_FLOW)


def q_page_convert_rate(spark, sf):
    return FN.page_convert_rate(spark, _t(spark, sf).visits(), P_FLOW)


def q_page_convert_string(spark, sf):
    return FN.page_convert_string(spark, _t(spark, sf).visits(), P_FLOW)


# ---------------------------------------------------------------- sampling

def _stat_sessions(spark, sf):
    t = _t(spark, sf)
    return S.filtered_sessions(t.visits(), t.users(), P_STAT)


def q_sessions_per_hour(spark, sf):
    return SM.sessions_per_hour(_stat_sessions(spark, sf))


def q_sessions_rollup(spark, sf):
    return SM.sessions_rollup(_stat_sessions(spark, sf))


def q_session_random_extract(spark, sf):
    return SM.session_random_extract(_stat_sessions(spark, sf), SAMPLE_N, SAMPLE_SEED, materialize=True)


def q_extracted_session_detail(spark, sf):
    t = _t(spark, sf)
    ext = SM.session_random_extract(_stat_sessions(spark, sf), SAMPLE_N, SAMPLE_SEED, materialize=True)
    return SM.extracted_session_detail(S.actions_in_range(t.visits(), P_STAT), ext, SAMPLE_N)


# ---------------------------------------------------------------- expressions

def q_date_exprs(spark, sf):
    v = _t(spark, sf).visits()
    ts = DT.parse_time("action_time")
    return v.select(
        "action_id", "action_time",
        DT.date_hour("action_time").alias("date_hour"),
        DT.format_date(ts).alias("date_fmt"),
        DT.format_date_key(ts).alias("date_key"),
        DT.format_time_minute(ts).alias("minute_key"),
        F.date_format(DT.parse_date_key(DT.format_date_key(ts)), "yyyy-MM-dd").alias("parsed_date"),
        DT.before("action_time", F.lit("2024-01-15 00:00:00")).alias("is_before"),
        DT.after("action_time", F.lit("2024-01-15 00:00:00")).alias("is_after"),
        DT.minus_seconds("action_time", F.concat(F.col("date"), F.lit(" 00:00:00"))).alias("secs_into_day"),
        DT.minus_seconds("search_keyword", "action_time").alias("bad_minus"),
        DT.yesterday(F.col("date")).alias("prev_date"),
        DT.today(F.col("date")).alias("same_date"),
    )


def q_string_exprs(spark, sf):
    s = S.session_agg(_t(spark, sf).visits())
    rec = F.concat_ws("|",
                      F.concat(F.lit("sessionid="), "session_id"),
                      F.concat(F.lit("searchKeywords="), "search_keywords"),
                      F.concat(F.lit("clickCategoryIds="), "click_category_ids"),
                      F.concat(F.lit("visitLength="), F.col("visit_length").cast("string")),
                      F.concat(F.lit("stepLength="), F.col("step_length").cast("string")))
    salted = ST.add_prefix("session_id", F.pmod(F.col("step_length"), F.lit(10)))
    return s.select(
        "session_id",
        rec.alias("record"),
        ST.get_field(rec, "clickCategoryIds").alias("category_field"),
        ST.get_field(rec, "searchKeywords").alias("keyword_field"),
        ST.set_field(rec, "visitLength", F.col("visit_length") * 2).alias("record_updated"),
        ST.trim_comma(F.concat(F.lit(","), F.col("click_category_ids"), F.lit(","))).alias("trimmed"),
        ST.is_empty("search_keywords").alias("no_keywords"),
        salted.alias("salted_id"),
        ST.remove_prefix(salted).alias("unsalted_id"),
        ST.concat_sep("user_id", "session_id", ":").alias("user_session"),
    )


# ---------------------------------------------------------------- skew operators

def _sessions_users(spark, sf):
    t = _t(spark, sf)
    return S.session_agg(t.visits()), t.users()


def q_join_broadcast(spark, sf):
    sess, users = _sessions_users(spark, sf)
    return S.session_full_info(sess, BC.bounded_broadcast(users, max_rows=1_000_000))  # counts one column of a scan


def q_join_salted(spark, sf):
    t = _t(spark, sf)
    acts = t.visits().select("action_id", "user_id", "session_id", "page_id")
    users = t.users().select("user_id", "age", "sex")
    return SK.salted_join(acts, users, "user_id", "inner", n=10)


def q_heavy_keys(spark, sf):
    return SK.heavy_keys(_t(spark, sf).visits(), "user_id", top_n=5, fraction=0.1, seed=9,
                         id_col="action_id")


def q_heavy_keys_sketch(spark, sf):
    return SK.heavy_keys_sketch(_t(spark, sf).visits(), "user_id", top_n=5)


def q_join_skew_isolate(spark, sf):
    t = _t(spark, sf)
    acts = t.visits().select("action_id", "user_id", "session_id", "page_id")
    users = t.users().select("user_id", "age", "sex")
    heavy = SK.heavy_keys(t.visits(), "user_id", top_n=5, fraction=0.1, seed=9, id_col="action_id")
    return SK.skew_isolate_join(acts, users, "user_id", heavy, "inner", n=20)


def q_agg_two_stage(spark, sf):
    t = _t(spark, sf)
    clicks = (S.actions_in_range(t.visits(), P_AREA).filter(F.col("click_product_id").isNotNull())
              .select("action_id", "city_id", F.col("click_product_id").alias("product_id")))
    return SK.two_stage_agg(clicks.join(t.cities(), "city_id"), ["area", "product_id"], None, n=10, out="click_count",
                            salt_by=["action_id"])


def q_join_salted_sql(spark, sf):
    return SQ.join_salted_sql(spark, _t(spark, sf), P_AREA.start_date, P_AREA.end_date, salts=10)


def q_agg_two_stage_sql(spark, sf):
    return SQ.agg_two_stage_sql(spark, _t(spark, sf), P_AREA.start_date, P_AREA.end_date, salts=10)


# ---------------------------------------------------------------- ad clicks (J4), batch

def _ad_clicks(spark, sf):
    return AD.parse_ad_log(_t(spark, sf).ad_logs())


def q_ad_log_parse(spark, sf):
    return _ad_clicks(spark, sf).select(*AD.CLICK_COLUMNS)


def q_daily_user_ad_clicks(spark, sf):
    return AD.daily_user_ad_clicks(_ad_clicks(spark, sf))


def q_blacklist_users(spark, sf):
    return AD.blacklist_users(AD.daily_user_ad_clicks(_ad_clicks(spark, sf)), AD_THRESHOLD)


def q_blacklist_filter(spark, sf):
    c = _ad_clicks(spark, sf)
    return AD.blacklist_filter(c, AD.blacklist_users(AD.daily_user_ad_clicks(c), AD_THRESHOLD)) \
        .select(*AD.CLICK_COLUMNS)


def q_ad_stat(spark, sf):
    return AD.ad_stat(_ad_clicks(spark, sf))


def q_ad_stat_rollup(spark, sf):
    return AD.ad_stat_rollup(_ad_clicks(spark, sf))


def q_province_ad_clicks(spark, sf):
    return AD.province_ad_clicks(AD.ad_stat(_ad_clicks(spark, sf)))


def q_ad_province_top3(spark, sf):
    return AD.ad_province_top3(AD.ad_stat(_ad_clicks(spark, sf)))


def q_ad_click_trend(spark, sf):
    return AD.ad_click_trend(_ad_clicks(spark, sf))


# ---------------------------------------------------------------- merges (sinks)

def _days(df, lo, hi):
    return df.filter(F.col("date").between(lo, hi))


def q_merge_replace(spark, sf):
    c = _ad_clicks(spark, sf)
    old = AD.ad_stat(_days(c, "2024-01-01", "2024-01-20"))
    new = AD.ad_stat(_days(c, "2024-01-11", "2024-01-30"))
    return MG.merge_replace(old, new, ["date", "province", "city", "ad_id"])


def q_merge_add(spark, sf):
    c = _ad_clicks(spark, sf)
    old = AD.daily_user_ad_clicks(_days(c, "2024-01-01", "2024-01-15"))
    delta = AD.daily_user_ad_clicks(_days(c, "2024-01-10", "2024-01-30"))
    return MG.merge_add(old, delta, ["date", "user_id", "ad_id"], "click_count")


def q_replace_group(spark, sf):
    c = _ad_clicks(spark, sf)
    old = AD.ad_province_top3(AD.ad_stat(_days(c, "2024-01-01", "2024-01-20")))
    new = AD.ad_province_top3(AD.ad_stat(_days(c, "2024-01-15", "2024-01-30")))
    return MG.replace_group(old, new, ["date", "province"])


def q_lookup_total(spark, sf):
    c = _ad_clicks(spark, sf)
    totals = AD.daily_user_ad_clicks(_days(c, "2024-01-01", "2024-01-20"))
    batch = AD.daily_user_ad_clicks(_days(c, "2024-01-16", "2024-01-31")) \
        .withColumnRenamed("click_count", "batch_count")
    return MG.lookup_total(batch, totals, ["date", "user_id", "ad_id"], "click_count", "prior_total")


def q_sink_append(spark, sf):
    from visitlab.session import scratch_path
    c = _ad_clicks(spark, sf)
    path = scratch_path(spark, "sink_append")
    MG.append(AD.daily_user_ad_clicks(_days(c, "2024-01-01", "2024-01-15")), path)
    MG.append(AD.daily_user_ad_clicks(_days(c, "2024-01-16", "2024-01-31")), path)
    return spark.read.parquet(path)


# ---------------------------------------------------------------- ad clicks (J4), streaming
# The stream input is the ad log laid out as a few text files per day and read one day
# per trigger.  The keys that read outputs of the one ad job share a run; a key called
# again in the same session, or in another session, gets a fresh one.

_RUNS: dict = {}
FILES_PER_DAY = 4


def _day_stream(spark, sf, path):
    """The log as a stream of days, in a session whose state has a partition per core."""
    glob = AS.write_day_files(spark, _t(spark, sf).ad_logs(), path, FILES_PER_DAY)
    return AS.text_stream(AS.stream_session(spark), glob, max_files_per_trigger=FILES_PER_DAY)


def _ad_job(spark, sf, key):
    at = (spark.sparkContext.applicationId, sf)
    run = _RUNS.get(at)
    if run is None or key in run[1]:
        out, ck = AS.new_run_dirs(spark, "ad_job")
        job = JB.start_ad_job(spark, _day_stream(spark, sf, f"{out}-days"), out, AD_THRESHOLD, {"availableNow": True})
        run = _RUNS[at] = (AS.AdTables(spark, job.tables.root), set())
    run[1].add(key)
    return run[0]


def q_stream_parse(spark, sf):
    out, ck = AS.new_run_dirs(spark, "parsed")
    glob = AS.write_day_files(spark, _t(spark, sf).ad_logs(), f"{out}-days", FILES_PER_DAY)
    AS.run_parse_stream(AS.text_stream(spark, glob, max_files_per_trigger=10 * FILES_PER_DAY), out, ck)
    return spark.read.schema(AS.CLICK_SCHEMA).parquet(out)


def q_stream_blacklist(spark, sf):
    """Per user: clicks kept by the dynamic blacklist, and whether the user ended blacklisted."""
    tables = _ad_job(spark, sf, "blacklist")
    kept = AS.counts_table(tables).groupBy("user_id").agg(F.sum("click_count").alias("kept_clicks"))
    bl = AS.blacklist_table(tables).withColumn("blacklisted", F.lit(True))
    return (kept.join(bl, "user_id", "left")
            .select("user_id", "kept_clicks", F.coalesce("blacklisted", F.lit(False)).alias("blacklisted")))


def q_stream_ad_job(spark, sf):
    """The kept clicks of the whole job, as a user of ``start_ad_job`` reads them."""
    return AS.kept_table(_ad_job(spark, sf, "ad_job"))


def q_stream_ad_stat(spark, sf):
    return AS.ad_stat_table(_ad_job(spark, sf, "ad_stat"))


def q_stream_province_top3(spark, sf):
    return AS.province_top3_table(_ad_job(spark, sf, "top3"))


def q_stream_click_trend(spark, sf):
    return AS.trend_table(_ad_job(spark, sf, "trend"))


def q_stream_sliding_hour(spark, sf):
    """Clicks per ad in the last 60 minutes, every 10 seconds, from the stream's panes."""
    return AS.sliding_hour_table(_ad_job(spark, sf, "sliding"))


def q_trend_sliding_hour(spark, sf):
    return AD.sliding_clicks(AD.click_panes(_ad_clicks(spark, sf)))


def q_trend_last_hour(spark, sf):
    """The trend of the hour before the newest click (one value read first)."""
    c = _ad_clicks(spark, sf)
    newest = c.agg(F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss")).first()[0]
    return AD.trend_last_hour(AD.ad_click_trend(c), newest)


def q_ad_log_rejects(spark, sf):
    """Rejected lines per reason when the raw event payloads, of clicks without a number in front,
    are mixed into the ad log."""
    t = _t(spark, sf)
    number = F.when(F.col("event_type") != "click", F.col("event_id").cast("string"))
    return AD.reject_counts(t.ad_logs().select("value").unionByName(
        t.raw("events").select(F.concat_ws(" ", number, "props").alias("value"))))


# ---------------------------------------------------------------- contract

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "action_date_range": q_action_date_range,
    "session_agg": q_session_agg,
    "session_full_info": q_session_full_info,
    "filter_between": q_filter_between,
    "filter_in": q_filter_in,
    "filter_equal": q_filter_equal,
    "session_filter": q_session_filter,
    "session_aggr_counts": q_session_aggr_counts,
    "session_aggr_stat": q_session_aggr_stat,
    "session_stat_observed": q_session_stat_observed,
    "session_detail": q_session_detail,
    "session_detail_stored": q_session_detail_stored,
    "task_params": q_task_params,
    "click_actions": q_click_actions,
    "click_product_basic": q_click_product_basic,
    "area_product_clicks": q_area_product_clicks,
    "area_product_full": q_area_product_full,
    "area_top3_product": q_area_top3_product,
    "area_top3_product_sql": q_area_top3_product_sql,
    "area_level_map": q_area_level_map,
    "product_status": q_product_status,
    "group_concat_distinct": q_group_concat_distinct,
    "explode_category_ids": q_explode_category_ids,
    "visited_categories": q_visited_categories,
    "category_counts": q_category_counts,
    "category_counts_join": q_category_counts_join,
    "top10_category": q_top10_category,
    "session_category_clicks": q_session_category_clicks,
    "top10_session": q_top10_session,
    "top10_session_detail": q_top10_session_detail,
    "page_split_pv": q_page_split_pv,
    "start_page_pv": q_start_page_pv,
    "page_convert_rate": q_page_convert_rate,
    "page_convert_string": q_page_convert_string,
    "sessions_per_hour": q_sessions_per_hour,
    "sessions_rollup": q_sessions_rollup,
    "session_random_extract": q_session_random_extract,
    "extracted_session_detail": q_extracted_session_detail,
    "date_exprs": q_date_exprs,
    "string_exprs": q_string_exprs,
    "join_broadcast": q_join_broadcast,
    "join_salted": q_join_salted,
    "heavy_keys": q_heavy_keys,
    "heavy_keys_sketch": q_heavy_keys_sketch,
    "join_skew_isolate": q_join_skew_isolate,
    "agg_two_stage": q_agg_two_stage,
    "agg_two_stage_sql": q_agg_two_stage_sql,
    "join_salted_sql": q_join_salted_sql,
    "ad_log_parse": q_ad_log_parse,
    "daily_user_ad_clicks": q_daily_user_ad_clicks,
    "blacklist_users": q_blacklist_users,
    "blacklist_filter": q_blacklist_filter,
    "ad_stat": q_ad_stat,
    "ad_stat_rollup": q_ad_stat_rollup,
    "province_ad_clicks": q_province_ad_clicks,
    "ad_province_top3": q_ad_province_top3,
    "ad_click_trend": q_ad_click_trend,
    "trend_last_hour": q_trend_last_hour,
    "trend_sliding_hour": q_trend_sliding_hour,
    "ad_log_rejects": q_ad_log_rejects,
    "merge_replace": q_merge_replace,
    "merge_add": q_merge_add,
    "replace_group": q_replace_group,
    "lookup_total": q_lookup_total,
    "sink_append": q_sink_append,
    "stream_parse": q_stream_parse,
    "stream_blacklist": q_stream_blacklist,
    "stream_ad_job": q_stream_ad_job,
    "stream_ad_stat": q_stream_ad_stat,
    "stream_province_top3": q_stream_province_top3,
    "stream_click_trend": q_stream_click_trend,
    "stream_sliding_hour": q_stream_sliding_hour,
}


# The language-model data operators live in one removable subpackage.
try:
    import corpus_pipeline as _pipeline
    from visitlab.llm import queries as _llm
except ImportError:
    _pipeline = _llm = None
else:
    _QUERIES.update(_llm.QUERIES)
    _QUERIES["pipeline"] = _pipeline.run


def entry(spark: SparkSession) -> DataFrame:
    return q_area_top3_product(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    sql = O.build_oracle()
    if _llm is not None:
        sql.update(_llm.SQL)
        if _pipeline.ORACLE_SQL:
            sql["pipeline"] = _pipeline.ORACLE_SQL
    return sql
