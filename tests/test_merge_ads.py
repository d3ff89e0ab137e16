import os
import tempfile

from pyspark.sql import functions as F

from conftest import rows
from visitlab.operators import merge as MG
from visitlab.operators.tables import DatePartitionedTable
from visitlab.plans import ads as AD

STAT = "date string, province string, city string, ad_id long, click_count long"


def test_merge_replace_add_group_lookup(spark):
    old = spark.createDataFrame([("d1", "P", "c", 1, 5), ("d1", "P", "c", 2, 1)], STAT)
    new = spark.createDataFrame([("d1", "P", "c", 1, 7), ("d2", "P", "c", 1, 2)], STAT)
    keys = ["date", "province", "city", "ad_id"]
    assert rows(MG.merge_replace(old, new, keys), keys) == [("d1", "P", "c", 1, 7), ("d1", "P", "c", 2, 1),
                                                             ("d2", "P", "c", 1, 2)]
    added = rows(MG.merge_add(old, new, keys, "click_count"), keys)
    assert added == [("d1", "P", "c", 1, 12), ("d1", "P", "c", 2, 1), ("d2", "P", "c", 1, 2)]
    # replace_group drops the whole (date, province) group of d1/P, keeps nothing else of it
    grp = rows(MG.replace_group(old, new.filter("date = 'd1'"), ["date", "province"]), keys)
    assert grp == [("d1", "P", "c", 1, 7)]
    look = MG.lookup_total(new.select("date", "province", "city", "ad_id"), old, keys, "click_count", "prior")
    assert rows(look, keys) == [("d1", "P", "c", 1, 5), ("d2", "P", "c", 1, 0)]


def test_null_keys_merge_once(spark):
    x = spark.createDataFrame([(None, "P", "c", 1, 5), ("d1", None, "c", None, 1), ("d1", "P", "c", 2, 2)], STAT)
    keys = ["date", "province", "city", "ad_id"]
    assert MG.merge_replace(x, x, keys).count() == 3
    assert MG.replace_group(x, x, ["date", "province"]).count() == 3
    assert rows(MG.lookup_total(x.select(*keys), x, keys, "click_count", "t").select("t"), ["t"]) == [(1,), (2,), (5,)]
    path = os.path.join(tempfile.mkdtemp(prefix="nul-"), "t")
    t = DatePartitionedTable(spark, path, "province string, city string, ad_id long, click_count long, date string")
    t.upsert_replace(x, keys)
    t.upsert_replace(x.withColumn("click_count", F.col("click_count") + 10), keys)
    assert rows(t.read().select("click_count"), ["click_count"]) == [(11,), (12,), (15,)]
    t.replace_groups(x.filter("date is null"), ["date"])
    assert rows(t.read().select("click_count"), ["click_count"]) == [(5,), (11,), (12,)]


def test_one_day_upsert_is_written_by_several_tasks(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="day-"), "t")
    t = DatePartitionedTable(spark, path, "ad_id long, click_count long, date string")
    day = spark.range(0, 20_000, 1, 8).select(F.col("id").alias("ad_id"), F.lit(1).cast("long").alias("click_count"),
                                              F.lit("d1").alias("date"))
    t.upsert_replace(day, ["date", "ad_id"])
    assert len([f for f in os.listdir(f"{path}/date=d1") if f.endswith(".parquet")]) > 1 and t.read().count() == 20_000


def test_date_partitioned_upsert_is_idempotent(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="dpt-"), "t")
    t = DatePartitionedTable(spark, path, "province string, city string, ad_id long, click_count long, date string")
    keys = ["date", "province", "city", "ad_id"]
    t.upsert_replace(spark.createDataFrame([("d1", "P", "c", 1, 5), ("d2", "P", "c", 1, 1)], STAT), keys)
    upd = spark.createDataFrame([("d1", "P", "c", 1, 9)], STAT)
    t.upsert_replace(upd, keys)
    t.upsert_replace(upd, keys)  # a replayed batch changes nothing
    got = rows(t.read().select(*keys, "click_count"), keys)
    assert got == [("d1", "P", "c", 1, 9), ("d2", "P", "c", 1, 1)]


def _lines(spark, data):
    return spark.createDataFrame([(v,) for v in data], "value string")


def test_parse_and_daily_counts(spark):
    c = AD.parse_ad_log(_lines(spark, ["1704067200000 P1 NATION_1 7 3", "1704153599999 P1 NATION_1 7 3"]))
    r = c.select(*AD.CLICK_COLUMNS).orderBy("ts_ms").collect()
    assert tuple(r[0]) == (1704067200000, "2024-01-01", "P1", "NATION_1", 7, 3)
    assert r[1].date == "2024-01-01"
    assert rows(AD.daily_user_ad_clicks(c)) == [("2024-01-01", 7, 3, 2)]


def test_blacklist_threshold_two_ads_and_kept_clicks(spark):
    day1 = 1704067200000
    day2 = day1 + 86_400_000
    data = [f"{day1 + i} P1 N 1 {ad}" for i, ad in enumerate([1, 1, 1, 2, 2, 2])]  # user 1 hot on 2 ads
    data += [f"{day2 + i} P1 N 1 1" for i in range(2)]                             # dropped (blocked)
    data += [f"{day1 + i} P1 N 2 1" for i in range(2)]                             # user 2 below
    c = AD.parse_ad_log(_lines(spark, data))
    bl = AD.blacklist_users(AD.daily_user_ad_clicks(c), threshold=3)
    assert rows(bl) == [(1,)]
    assert AD.blacklist_filter(c, bl).count() == 2
    kept = AD.kept_clicks(c, threshold=3)
    assert kept.filter("user_id = 1").count() == 6 and kept.filter("user_id = 2").count() == 2


def test_top3_and_trend(spark):
    stat = spark.createDataFrame([("d", "P", "c1", a, n) for a, n in [(1, 5), (2, 5), (3, 4), (4, 9)]] +
                                 [("d", "P", "c2", 3, 2)], STAT)
    top = rows(AD.ad_province_top3(stat), ["click_count", "ad_id"])
    assert sorted(top) == sorted([("d", "P", 4, 9), ("d", "P", 3, 6), ("d", "P", 1, 5)])
    c = AD.parse_ad_log(_lines(spark, ["1704067260000 P1 N 1 1", "1704067319999 P1 N 2 1", "1704067320000 P1 N 2 1"]))
    assert rows(AD.ad_click_trend(c), ["minute"]) == [("2024-01-01", "00", "01", 1, 2), ("2024-01-01", "00", "02", 1, 1)]


def test_malformed_lines_do_not_fail(spark):
    c = AD.parse_ad_log(_lines(spark, ["oops", "1704067200000 P1 N x 3", "1704067200000 P1 N 4 3"]))
    got = rows(c.select("user_id", "ad_id"), ["user_id"])
    assert got == [(None, None), (None, 3), (4, 3)]


def test_top3_literal_per_province_and_last_hour(spark):
    stat = spark.createDataFrame([("d1", "P", "c", 1, 5), ("d2", "P", "c", 2, 9), ("d2", "P", "c", 1, 1),
                                  ("d1", "P", "c", 3, 4), ("d2", "P", "c", 4, 4)], STAT)
    lit = rows(AD.ad_province_top3(stat, k=3, per_day=False), ["click_count"])
    assert sorted(lit) == sorted([("d2", "P", 2, 9), ("d1", "P", 1, 5), ("d1", "P", 3, 4)])  # ad 3 beats ad 4 on id
    trend = spark.createDataFrame([("2024-01-01", "10", "00", 1, 3), ("2024-01-01", "10", "59", 1, 2),
                                   ("2024-01-01", "11", "00", 1, 7), ("2024-01-01", "11", "01", 1, 1)],
                                  "date string, hour string, minute string, ad_id long, click_count long")
    got = rows(AD.trend_last_hour(trend, "2024-01-01 11:00:00"), ["hour", "minute"])
    assert got == [("2024-01-01", "10", "59", 1, 2), ("2024-01-01", "11", "00", 1, 7)]


def test_hour_partitioned_upsert_rewrites_only_touched_hours(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="dph-"), "t")
    schema = "minute string, ad_id long, click_count long, date string, hour string"
    t = DatePartitionedTable(spark, path, schema, ("date", "hour"))
    keys = ["date", "hour", "minute", "ad_id"]
    cols = "date string, hour string, minute string, ad_id long, click_count long"
    t.upsert_replace(spark.createDataFrame([("d1", "10", "00", 1, 1), ("d1", "11", "00", 1, 2)], cols), keys)
    before = sorted(os.listdir(f"{path}/date=d1/hour=10"))
    t.upsert_replace(spark.createDataFrame([("d1", "11", "00", 1, 5), ("d1", "11", "01", 1, 1)], cols), keys)
    assert sorted(os.listdir(f"{path}/date=d1/hour=10")) == before  # untouched hour kept as is
    got = rows(t.read().select(*keys, "click_count"), keys)
    assert got == [("d1", "10", "00", 1, 1), ("d1", "11", "00", 1, 5), ("d1", "11", "01", 1, 1)]


def test_split_lines_counts_every_bad_line(spark):
    lines = _lines(spark, ["1704067200000 P1 N 1 1", "garbage", "1704067200000 P1 N x 1", "1704067200000 P1 N 1", "", None])
    clicks, rejects = AD.split_lines(lines)
    assert clicks.count() == 1
    assert rows(AD.reject_counts(lines), ["reason"]) == [("no_ad", 1), ("no_time", 3), ("no_user", 1)]
    assert "garbage" in [r.value for r in rejects.collect()]
