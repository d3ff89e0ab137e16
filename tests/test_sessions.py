import tempfile

from pyspark.sql import functions as F

from conftest import VISIT_SCHEMA, rows, visit
from visitlab.functions import filters
from visitlab.functions.numbers import ratio_half_up
from visitlab.plans import sessions as S
from visitlab.sources.params import TaskParams


def _visits(spark, data):
    return spark.createDataFrame(data, VISIT_SCHEMA)


def test_session_agg_distinct_sorted_and_zero_length(spark):
    v = _visits(spark, [
        visit(1, "a", "2024-01-01 10:00:00", kw="k2", click_cat=11),
        visit(2, "a", "2024-01-01 10:00:05", kw="k1", click_cat=1),
        visit(3, "a", "2024-01-01 10:00:07", kw="k2", click_cat=11),
        visit(4, "a", "2024-01-01 10:00:03"),
        visit(5, "b", "2024-01-02 09:00:00", user_id=2),  # one action: visit length 0
    ])
    out = {r.session_id: r for r in S.session_agg(v).collect()}
    a = out["a"]
    assert a.search_keywords == "k1,k2"
    assert a.click_category_ids == "1,11"  # 1 is kept although 11 contains it
    assert a.visit_length == 7 and a.step_length == 4 and a.start_time == "2024-01-01 10:00:00"
    b = out["b"]
    assert b.visit_length == 0 and b.search_keywords == "" and b.click_category_ids == ""


def test_histogram_bucket_edges(spark):
    lengths = [0, 1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61, 180, 181, 600, 601, 1800, 1801]
    sess = spark.createDataFrame([(f"s{i}", v, 1) for i, v in enumerate(lengths)],
                                 "session_id string, visit_length long, step_length long")
    r = S.session_aggr_counts(sess).first().asDict()
    assert r["session_count"] == len(lengths)
    expect = {"1s_3s": 2, "4s_6s": 2, "7s_9s": 2, "10s_30s": 2, "30s_60s": 2, "1m_3m": 2,
              "3m_10m": 2, "10m_30m": 2, "30m": 1}
    for k, n in expect.items():
        assert r[f"visit_length_{k}"] == n, k
    assert sum(r[f"visit_length_{k}"] for k in expect) == len(lengths) - 1  # 0 s is in no bucket
    assert r["step_length_1_3"] == len(lengths)


def test_step_bucket_edges(spark):
    steps = [1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61, 1000]
    sess = spark.createDataFrame([(f"s{i}", 5, v) for i, v in enumerate(steps)],
                                 "session_id string, visit_length long, step_length long")
    r = S.session_aggr_counts(sess).first().asDict()
    assert [r[f"step_length_{k}"] for k in ("1_3", "4_6", "7_9", "10_30", "30_60", "60")] == [2, 2, 2, 2, 2, 2]


def test_ratio_half_up_exact_ties_and_zero(spark):
    df = spark.createDataFrame([(29, 200), (1, 3), (2, 3), (0, 0), (5, 5), (1, 8)], "n long, d long")
    got = [r[0] for r in df.select(ratio_half_up("n", "d")).collect()]
    assert got == [0.15, 0.33, 0.67, None, 1.0, 0.13]


def test_empty_input_gives_zero_count_and_null_ratios(spark):
    sess = spark.createDataFrame([], "session_id string, visit_length long, step_length long")
    r = S.session_aggr_stat(sess).first().asDict()
    assert r["session_count"] == 0 and r["visit_length_1s_3s_ratio"] is None


def test_optional_filters(spark):
    df = spark.createDataFrame([(1, 15, "a,b"), (2, None, "c"), (3, 60, None)], "id long, age int, kws string")
    assert filters.between("age", 10, None) is None  # one bound missing: no filter
    assert rows(filters.apply(df, [filters.between("age", 10, 50)]).select("id")) == [(1,)]  # null fails
    got = filters.apply(df, [filters.overlaps(F.split("kws", ","), "b,z")]).select("id")
    assert rows(got) == [(1,)]
    assert filters.all_of([None, None]) is None
    assert filters.in_list("kws", "") is None


def test_session_filter_and_detail(spark):
    v = _visits(spark, [
        visit(1, "a", "2024-01-01 10:00:00", user_id=1, kw="hot"),
        visit(2, "a", "2024-01-01 10:00:01", user_id=1),
        visit(3, "b", "2024-01-01 11:00:00", user_id=2, kw="cold"),
        visit(4, "c", "2024-01-01 12:00:00", user_id=99, kw="hot"),  # unknown user drops out
    ])
    users = spark.createDataFrame([(1, 20, "P", "c1", "male"), (2, 70, "P", "c1", "male")],
                                  "user_id long, age int, professional string, city string, sex string")
    p = TaskParams(start_date="2024-01-01", end_date="2024-01-01", start_age=10, end_age=50, keywords="hot")
    f = S.filtered_sessions(v, users, p)
    assert [r.session_id for r in f.collect()] == ["a"]
    d = S.session_detail(S.actions_in_range(v, p), f)
    assert sorted(r.action_time for r in d.collect()) == ["2024-01-01 10:00:00", "2024-01-01 10:00:01"]


def test_ratio_half_up_matches_exact_decimal_rounding(spark):
    import random
    from decimal import ROUND_HALF_UP, Decimal

    rnd = random.Random(7)
    pairs = [(rnd.randint(0, 5000), rnd.randint(1, 5000)) for _ in range(3000)]
    pairs += [(n, 200) for n in range(0, 201)] + [(1, 8), (3, 8), (5, 8), (7, 8)]  # exact x.xx5 ties
    df = spark.createDataFrame(pairs, "n long, d long")
    got = {(r.n, r.d): r.q for r in df.select("n", "d", ratio_half_up("n", "d").alias("q")).collect()}
    for n, d in pairs:
        want = float((Decimal(n) / Decimal(d)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))
        assert got[(n, d)] == want, (n, d)


def test_concat_skips_null_parts(spark):
    from visitlab.functions.strings import concat_sep

    df = spark.createDataFrame([(None, "x"), (3, None), (4, "y")], "a long, b string")
    assert [r[0] for r in df.select(concat_sep("a", "b", ":")).collect()] == ["x", "3", "4:y"]


def test_histogram_sums_on_real_data(spark):
    from visitlab.sources.tables import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    sess = S.session_agg(t.visits())
    r = S.session_aggr_counts(sess).first().asDict()
    zero = sess.filter("visit_length = 0").count()
    visit = sum(v for k, v in r.items() if k.startswith("visit_length_"))
    step = sum(v for k, v in r.items() if k.startswith("step_length_"))
    assert visit + zero == r["session_count"] and step == r["session_count"]


def test_session_detail_splits_a_hot_session(spark):
    from visitlab.sources.tables import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    v = t.visits()
    # one session holding a third of the actions
    v = v.withColumn("session_id", F.when(F.col("action_id") % 3 == 0, F.lit("hot")).otherwise(F.col("session_id")))
    sess = S.session_full_info(S.session_agg(v), t.users())
    got = S.session_detail(v, sess)
    want = v.join(sess.select("session_id"), "session_id", "left_semi").select(*S.DETAIL_COLUMNS)
    assert got.filter("session_id = 'hot'").count() > 50
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, x in conf.items():
            spark.conf.set(k, x)
        split = S.session_detail(v.repartition(8), sess)
        split.collect()
        assert "isSkewJoin=true" in split._jdf.queryExecution().toString() or "skew=true" in \
            split._jdf.queryExecution().toString()
    finally:
        for k, x in old.items():
            spark.conf.unset(k) if x is None else spark.conf.set(k, x)


def _shuffled_rows(df):
    """Rows written by the shuffles of an executed plan, by the plan's own counters."""
    out, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "ShuffleExchangeExec":
            out.append(node.metrics().apply("shuffleRecordsWritten").value())
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return out


def test_bloom_filter_cuts_the_shuffle_of_actions(spark):
    """Stored sessions: Spark filters the actions by a Bloom filter of the ids before it shuffles them."""
    v = spark.range(40_000).select(
        F.col("id").alias("action_id"), F.lit("2024-01-01").alias("date"), (F.col("id") % 7).alias("user_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("id") % 4000)).alias("session_id"),
        *[F.lit(None).cast(t).alias(c) for c, t in (
            ("page_id", "long"), ("action_time", "string"), ("search_keyword", "string"), ("click_category_id", "long"),
            ("click_product_id", "long"), ("order_category_ids", "string"), ("order_product_ids", "string"),
            ("pay_category_ids", "string"), ("pay_product_ids", "string"))])
    path = tempfile.mkdtemp(prefix="bloom-")
    v.write.parquet(f"{path}/v")
    v = spark.read.parquet(f"{path}/v")
    v.select("session_id").distinct().where("session_id = 'hot' or session_id like 's1__'").write.parquet(f"{path}/s")
    sess = spark.read.parquet(f"{path}/s")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, x in conf.items():
            spark.conf.set(k, x)
        got = S.session_detail(v, sess, stored=True)
        found = got.collect()
        assert "might_contain" in got._jdf.queryExecution().optimizedPlan().toString()
        most = max(_shuffled_rows(got))
    finally:
        for k, x in old.items():
            spark.conf.unset(k) if x is None else spark.conf.set(k, x)
    assert len(found) == v.join(sess, "session_id", "left_semi").count() > 13_000
    assert most < 1.1 * len(found)  # of 40,000 actions


def test_stored_sessions_observe_the_histogram(spark):
    sess = S.session_agg(spark.createDataFrame(
        [visit(i, f"s{i % 40}", f"2024-01-01 10:{i % 60:02d}:00") for i in range(400)], VISIT_SCHEMA))
    for df in (sess, sess.where("session_id = 'none'")):
        stored, stat = S.stored_sessions(df)
        assert stored.exceptAll(df).count() == 0 and stored.count() == df.count()
        assert stat.collect() == S.session_aggr_stat(df).collect() and stat.columns == S.session_aggr_stat(df).columns


def test_distinct_values_meet_their_group_once(spark):
    """Each distinct value of a hot group is shuffled to it once, not once per map task."""
    from visitlab.functions.aggregates import concat_distinct_by, group_concat_distinct

    df = spark.range(0, 6000, 1, 12).select(F.lit("hot").alias("g"), (F.col("id") % 50).alias("v")).union(
        spark.createDataFrame([("a", 2), ("a", 1), ("a", None), ("n", None)], "g string, v long"))
    got = concat_distinct_by(df, ["g"], "v", "vs")
    assert sorted(rows(got)) == sorted(rows(df.groupBy("g").agg(group_concat_distinct("v").alias("vs"))))
    assert min(_shuffled_rows(got)) <= 54  # 50 values of the hot group, and the others
