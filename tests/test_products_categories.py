from pyspark.sql import functions as F

from conftest import VISIT_SCHEMA, rows, visit
from visitlab.plans import categories as C
from visitlab.plans import products as PR
from visitlab.plans import sql_jobs as SQ
from visitlab.sources.params import TaskParams


def test_product_status_bad_json_is_third_party(spark):
    p = spark.createDataFrame([(1, '{"product_status": 0}'), (2, '{"product_status": 1}'), (3, "not json"),
                               (4, None)], "product_id long, extend_info string")
    got = rows(p.select("product_id", PR.product_status().alias("s")), ["product_id"])
    assert got == [(1, "self"), (2, "Third Party"), (3, "Third Party"), (4, "Third Party")]


def test_area_level_default(spark):
    df = spark.createDataFrame([("AFRICA",), ("ASIA",), ("EUROPE",), ("MARS",)], "area string")
    assert [r[0] for r in df.select(PR.area_level("area")).collect()] == ["A level", "B level", "C level", "D level"]


def test_area_top3_ties_unknown_city_and_city_list(spark):
    data = []
    aid = 0
    # product 5: 2 clicks (cities 1, 2); products 1..4: 1 click each in city 1; city 9 unknown
    for prod, city in [(5, 1), (5, 2), (1, 1), (2, 1), (3, 1), (4, 1), (7, 9), (7, 9), (7, 9)]:
        aid += 1
        data.append(visit(aid, "s", "2024-01-01 10:00:00", click_cat=1, click_prod=prod, city_id=city))
    v = spark.createDataFrame(data, VISIT_SCHEMA)
    cities = spark.createDataFrame([(1, "c1", "ASIA"), (2, "c2", "ASIA")], "city_id long, city_name string, area string")
    products = spark.createDataFrame([(i, f"p{i}", '{"product_status": 0}') for i in range(10)],
                                     "product_id long, product_name string, extend_info string")
    out = PR.area_top3_product(v, cities, products, TaskParams())
    got = [(r.product_id, r.click_count, r.city_infos) for r in out.orderBy(F.desc("click_count"), "product_id").collect()]
    assert got == [(5, 2, "1:c1,2:c2"), (1, 1, "1:c1"), (2, 1, "1:c1")]


def test_category_counts_multi_ids_and_zero_fill(spark):
    v = spark.createDataFrame([
        visit(1, "s", "2024-01-01 10:00:00", click_cat=3),
        visit(2, "s", "2024-01-01 10:00:01", order_cats="3,4"),
        visit(3, "s", "2024-01-01 10:00:02", pay_cats="4"),
        visit(4, "s", "2024-01-01 10:00:03", order_cats="11"),
        visit(5, "s", "2024-01-01 10:00:04"),
    ], VISIT_SCHEMA)
    expect = [(3, 1, 1, 0), (4, 0, 1, 1), (11, 0, 1, 0)]
    assert rows(C.category_counts(v), ["category_id"]) == expect
    assert rows(C.category_counts_join(v), ["category_id"]) == expect
    assert rows(C.visited_categories(v), ["category_id"]) == [(3,), (4,), (11,)]
    assert rows(C.explode_category_ids(v).select("category_id"), ["category_id"]) == [(3,), (4,), (11,)]


def test_top10_category_order_and_ties(spark):
    counts = [(c, 5, 1, 1) for c in range(12)] + [(99, 6, 0, 0)]
    v_rows = []
    aid = 0
    for cat, clicks, _, _ in counts:
        for _ in range(clicks):
            aid += 1
            v_rows.append(visit(aid, "s", "2024-01-01 10:00:00", click_cat=cat))
    v = spark.createDataFrame(v_rows, VISIT_SCHEMA)
    top = [r.category_id for r in C.top10_category(v).collect()]
    assert top == [99] + list(range(9))


def test_top10_session_per_category(spark):
    data = []
    aid = 0
    for sess, n in [("a", 3), ("b", 3), ("c", 1)]:
        for _ in range(n):
            aid += 1
            data.append(visit(aid, sess, "2024-01-01 10:00:00", click_cat=7))
    v = spark.createDataFrame(data, VISIT_SCHEMA)
    top = C.top10_session(v, C.top10_category(v), k=2)
    assert rows(top, ["session_id"]) == [(7, "a", 3), (7, "b", 3)]
    det = C.top10_session_detail(v, top)
    assert det.count() == 6


def test_bad_category_text_is_skipped(spark):
    v = spark.createDataFrame([visit(1, "s", "2024-01-01 10:00:00", order_cats="2,x,,3")], VISIT_SCHEMA)
    assert rows(C.category_counts(v).filter("category_id IS NOT NULL"), ["category_id"]) == [(2, 0, 1, 0), (3, 0, 1, 0)]


def test_shared_counts_equal_separate_plans(spark):
    from visitlab.sources.tables import Tables
    d = Tables(spark, "/root/testdata/sf0.001").visits()
    cats, sess = C.top_categories_and_sessions(d)
    assert rows(cats, ["category_id"]) == rows(C.top10_category(d), ["category_id"])
    assert rows(sess, ["category_id", "session_id"]) == rows(C.top10_session(d, C.top10_category(d)),
                                                               ["category_id", "session_id"])


def test_salted_products_in_sql_are_shuffled(spark):
    """Products replicated per salt are not broadcast, however small Spark thinks they are."""
    class Views:
        def register_views(self, prefix):
            spark.createDataFrame([visit(i, "s", "2024-01-01 10:00:00", click_cat=1, click_prod=i % 3, city_id=1 + i % 2)
                                   for i in range(9)], VISIT_SCHEMA).createOrReplaceTempView(f"{prefix}visits")
            spark.createDataFrame([(1, "c1", "ASIA"), (2, "c2", "EUROPE")], "city_id long, city_name string, area string") \
                .createOrReplaceTempView(f"{prefix}cities")
            (spark.range(2).select(F.col("id").alias("product_id"), F.lit("p").alias("product_name"),
                                   F.lit('{"product_status": 0}').alias("extend_info"))
             .createOrReplaceTempView(f"{prefix}products"))  # of known size

    out = SQ.join_salted_sql(spark, Views(), "2024-01-01", "2024-01-02", salts=1000, prefix="salted_")
    plan = out._jdf.queryExecution().sparkPlan()
    assert "SortMergeJoin" in plan.toString().splitlines()[1]  # the last join; the cities' one may be broadcast
    assert rows(out.select("area", "product_id", "click_count", "product_status"), ["area", "product_id"]) == [
        ("ASIA", 0, 2, "self"), ("ASIA", 1, 1, "self"), ("EUROPE", 0, 1, "self"), ("EUROPE", 1, 2, "self")]
