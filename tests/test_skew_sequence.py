import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from visitlab.operators import skew as SK
from visitlab.operators.broadcast import bounded_broadcast, row_count_at_most
from visitlab.operators.sequence import with_previous, with_previous_plain
from visitlab.operators.topk import top_k_per_group


def _skewed(spark, n=3000):
    # key 0 holds a third of the rows
    return spark.range(n).select(F.col("id").alias("rid"),
                                 F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"),
                                 (F.col("id") * 7 % 13).alias("v"))


def _small(spark):
    return spark.range(0, 40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_salted_join_equals_plain(spark):
    big, small = _skewed(spark), _small(spark)
    plain = big.join(small, "k")
    assert _same(SK.salted_join(big, small, "k", n=7).select(*plain.columns), plain)
    left = big.join(small, "k", "left")
    assert _same(SK.salted_join(big, small, "k", "left", n=5).select(*left.columns), left)


def test_skew_isolate_join_equals_plain(spark):
    big, small = _skewed(spark), _small(spark)
    heavy = SK.heavy_keys(big, "k", top_n=2, fraction=0.5, id_col="rid")
    assert heavy.first()["k"] == 0
    plain = big.join(small, "k")
    assert _same(SK.skew_isolate_join(big, small, "k", heavy, n=11).select(*plain.columns), plain)


def test_skew_joins_without_auto_broadcast(spark):
    """The salted shuffle itself runs, and nothing unchecked is broadcast."""
    big, small = _skewed(spark), _small(spark)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain = big.join(small, "k")
        salted = SK.salted_join(big, small, "k", n=7)
        isolated = SK.skew_isolate_join(big, small, "k", big.select("k").distinct(), n=5, max_heavy=1)
        for df in (salted, isolated):
            assert _same(df.select(*plain.columns), plain)
            assert "Broadcast" not in df._jdf.queryExecution().sparkPlan().toString()
            assert "strategy=broadcast" not in df._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_salted_copies_are_never_broadcast(spark):
    """Spark sees the copies of the small side at the size of one: they are shuffled whatever the threshold."""
    big, small = _skewed(spark), _small(spark)
    for how in ("inner", "left"):
        plan = SK.salted_join(big, small, "k", how, n=1000)._jdf.queryExecution().sparkPlan().toString()
        assert "Broadcast" not in plan and "SortMergeJoin" in plan


def test_two_stage_agg_equals_plain(spark):
    big = _skewed(spark)
    plain = big.groupBy("k").agg(F.sum("v").alias("total"))
    assert _same(SK.two_stage_agg(big, ["k"], "v", n=9, salt_by=["rid"]), plain)
    cnt = big.groupBy("k").agg(F.count(F.lit(1)).alias("total"))
    assert _same(SK.two_stage_agg(big, ["k"], None, n=9, salt_by=["rid"]), cnt)
    with pytest.raises(ValueError):
        SK.two_stage_agg(big, ["k"], None, salt_by=["k"])


def test_two_stage_agg_spreads_equal_rows_and_keeps_the_set(spark):
    df = spark.range(100_000).select(F.lit("hot").alias("k"), F.concat(F.lit("c"), F.col("id") % 3).alias("city"), "id")
    assert df.select(SK.salt_column(df, 10, ["id"])).distinct().count() == 10
    got = SK.two_stage_agg(df, ["k"], None, n=10, salt_by=["id"], collect="city").first()
    assert (got.total, got.citys) == (100_000, "c0,c1,c2")


def test_hash_sample_is_deterministic(spark):
    big = _skewed(spark)
    a = SK.hash_sample(big, "rid", 0.2, seed=3)
    assert _same(a, SK.hash_sample(big, "rid", 0.2, seed=3))
    assert 400 < a.count() < 800


def test_skew_safe_lag_equals_plain_with_hot_group(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(
        (F.col("id") % 97).cast("string")).alias("g"), (F.col("id") * 31 % 1000).alias("t"),
        F.col("id").alias("tie"), (F.col("id") % 10).alias("val"))
    b = with_previous_plain(df, ["g"], ["t", "tie"], "val", "prev")
    a = with_previous(df, ["g"], ["t", "tie"], "val", "prev", num_ranges=13, max_group_rows=None)
    assert _same(a.select(*b.columns), b)
    iso = with_previous(df, ["g"], ["t", "tie"], "val", "prev", num_ranges=13, max_group_rows=100)
    assert _same(iso.select(*b.columns), b)  # "hot" (2500 rows) ranged, the rest plain


def test_top_k_per_group_total_order(spark):
    df = spark.createDataFrame([("a", 5, 3), ("a", 5, 1), ("a", 4, 0), ("b", 1, 9)], "g string, v int, id int")
    got = sorted(tuple(r) for r in top_k_per_group(df, ["g"], [F.desc("v"), "id"], 2).collect())
    assert got == [("a", 5, 1), ("a", 5, 3), ("b", 1, 9)]


def test_bounded_broadcast(spark):
    small = _small(spark)
    assert row_count_at_most(small, 40) and not row_count_at_most(small, 39)
    assert bounded_broadcast(small, 10) is small  # over the bound: no hint


def test_broadcast_is_bounded_in_bytes_too(spark):
    from visitlab.operators.broadcast import measured

    wide = spark.range(50).select(F.col("id").alias("k"), F.repeat(F.lit("é"), 1000).alias("w"),
                                  F.array(F.lit(1), F.lit(2)).alias("a"), F.lit(None).cast("string").alias("none"))
    rows, size = measured(wide)
    assert rows == 50 and 50 * 2008 < size < 50 * 2100
    assert bounded_broadcast(wide, 50, size - 1) is wide and bounded_broadcast(wide, 50, size) is not wide
    assert measured(wide.where("k < 0")) == (0, 0)


def test_heavy_keys_sketch_on_zipf(spark):
    """Keys above the stated share are found, their counts exact, with a sketch far smaller than the number of keys."""
    rng = random.Random(3)
    keys = [int(rng.paretovariate(0.9)) for _ in range(40_000)] + [10**9 + i for i in range(20_000)] + [None] * 500
    rng.shuffle(keys)
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(7)
    exact = Counter(k for k in keys if k is not None)
    assert len(exact) > 20_000
    share = SK.sketch_error(200)
    sure = sum(n > share * len(keys) for n in exact.values())
    assert share == 3.5 / 512 and sure >= 3
    want = sorted(exact.items(), key=lambda x: (-x[1], x[0]))[:sure]
    assert [tuple(r) for r in SK.heavy_keys_sketch(df, "k", top_n=sure, tracked=200).collect()] == want
    assert SK.heavy_keys_sketch(df.where("false"), "k").count() == 0


def test_heavy_keys_bernoulli_sample(spark):
    hk = SK.heavy_keys(_skewed(spark, 6000), "k", top_n=1, fraction=0.3, seed=5)
    assert rows_of(hk) == [0]


def rows_of(df):
    return [r[0] for r in df.collect()]


def test_with_previous_against_pandas(spark):
    import pandas as pd

    rnd = random.Random(11)
    data = [(rnd.choice(["a", "b", "c", None]), rnd.randint(0, 30), i, rnd.choice([None, 1, 2, 3]))
            for i in range(400)]
    df = spark.createDataFrame(data, "g string, t int, tie long, val int")
    pdf = pd.DataFrame(data, columns=["g", "t", "tie", "val"]).sort_values(["t", "tie"])
    pdf["prev"] = pdf.groupby("g", dropna=False)["val"].shift(1)
    want = {r.tie: (None if pd.isna(r.prev) else int(r.prev)) for r in pdf.itertuples()}
    for kw in ({"max_group_rows": None, "num_ranges": 7}, {"max_group_rows": 50, "num_ranges": 5},
               {"skew_safe": False}):
        got = {r.tie: r.prev for r in with_previous(df, ["g"], ["t", "tie"], "val", "prev", **kw).collect()}
        assert got == want, kw
