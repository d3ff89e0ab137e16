import pytest
from pyspark.sql import functions as F

from visitlab.sources.params import load_task, parse_task_params
from visitlab.sources.tables import Tables

SF = "/root/testdata/sf0.001"


def test_task_params_missing_and_empty(spark):
    tasks = spark.createDataFrame([
        (1, '{"startDate":["2024-01-02"],"endDate":["2024-01-09"],"startAge":["10"],"sex":[]}'),
        (2, '{"targetPageFlow":["3,1,2"],"cities":[""]}'),
    ], "task_id long, task_param string")
    got = {r.task_id: r for r in parse_task_params(tasks).collect()}
    assert got[1].start_date == "2024-01-02" and got[1].end_age is None and got[1].sex is None
    assert got[2].cities is None and got[2].target_page_flow == "3,1,2"
    p = load_task(tasks, 2)
    assert p.page_flow == [3, 1, 2] and p.start_date is None
    with pytest.raises(LookupError):
        load_task(tasks, 7)


def test_derived_task_table(spark):
    p = load_task(Tables(spark, SF).tasks(), 1)
    assert (p.start_date, p.end_date, p.start_age, p.end_age) == ("2024-01-03", "2024-01-22", 15, 45)
    assert p.keywords.count(",") == 3 and p.page_flow == [2, 3, 4, 5]


def test_sql_over_registered_views(spark):
    """SQL users get the same answers through temp views."""
    from visitlab.plans import products as PR
    from visitlab.sources.params import TaskParams

    t = Tables(spark, SF)
    t.register_views()
    sql = spark.sql("""
        SELECT area, product_id, click_count FROM (
          SELECT area, product_id, click_count,
                 row_number() OVER (PARTITION BY area ORDER BY click_count DESC, product_id) AS rn
          FROM (SELECT c.area, v.click_product_id AS product_id, count(*) AS click_count
                FROM visits v JOIN cities c ON v.city_id = c.city_id
                WHERE v.click_product_id IS NOT NULL GROUP BY c.area, v.click_product_id) a) r
        WHERE rn <= 3""")
    df = PR.area_top3_product(t.visits(), t.cities(), t.products(), TaskParams()) \
        .select("area", "product_id", "click_count")
    assert sql.exceptAll(df).count() == 0 and df.exceptAll(sql).count() == 0


def test_visits_view_shape(spark):
    v = Tables(spark, SF).visits()
    assert v.columns[:3] == ["action_id", "date", "user_id"]
    one_kind = (F.col("search_keyword").isNotNull().cast("int") + F.col("click_category_id").isNotNull().cast("int")
                + F.col("order_category_ids").isNotNull().cast("int") + F.col("pay_category_ids").isNotNull().cast("int"))
    assert v.filter(one_kind > 1).count() == 0  # one action kind per row


def test_sql_functions(spark):
    from visitlab.functions.sql_functions import register_sql_functions

    register_sql_functions(spark)
    r = spark.sql("""
        SELECT concat_long_string(3, 'x', ':') AS a,
               get_json_field('{"product_status": 0}', 'product_status') AS b,
               get_json_field('bad', 'product_status') AS c,
               remove_random_prefix(random_prefix('abc', 10, 'r')) AS d,
               trim_comma(',1,2,') AS e,
               get_field('sessionid=s1|clickCategoryIds=|age=3', 'clickCategoryIds') AS f,
               get_field('sessionid=s1|age=3', 'age') AS g,
               date_hour('2024-01-02 07:08:09') AS h,
               CAST(substring_index(random_prefix('abc', 10, 'r'), '_', 1) AS INT) BETWEEN 0 AND 9 AS i
    """).first()
    assert tuple(r) == ("3:x", "0", None, "abc", "1,2", None, "3", "2024-01-02_07", True)


def test_random_prefix_spreads_equal_values(spark):
    from visitlab.functions.sql_functions import register_sql_functions

    register_sql_functions(spark)
    n = spark.sql("SELECT count(DISTINCT random_prefix('hot', 10, CAST(id AS STRING))) AS n FROM range(1000)").first().n
    assert n == 10


def test_native_tables_prune_and_check(spark, tmp_path):
    import pytest

    from conftest import visit
    from visitlab.plans import sessions as S
    from visitlab.sources.params import TaskParams

    rows = [visit(i, f"s{i % 3}", f"2024-01-0{i % 5 + 1} 10:00:0{i % 10}", user_id=i % 3) for i in range(30)]
    names = ["action_id", "date", "user_id", "session_id", "page_id", "action_time", "search_keyword", "click_category_id",
             "click_product_id", "order_category_ids", "order_product_ids", "pay_category_ids", "pay_product_ids", "city_id"]
    from conftest import VISIT_SCHEMA
    df = spark.createDataFrame(rows, VISIT_SCHEMA).select(*names).drop("action_id")
    df.write.partitionBy("date").parquet(f"{tmp_path}/actions")
    spark.createDataFrame([(i, "u", "n", 20 + i, "p", "c", "male") for i in range(3)], "user_id long, username string, "
                          "name string, age int, professional string, city string, sex string").write.parquet(f"{tmp_path}/users")
    t = Tables.from_paths(spark, {"visits": f"{tmp_path}/actions", "users": f"{tmp_path}/users"})
    p = TaskParams(start_date="2024-01-02", end_date="2024-01-03")
    got = S.actions_in_range(t.visits(), p)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and got.count() == 12
    assert S.filtered_sessions(t.visits(), t.users(), p).count() == 3
    with pytest.raises(ValueError):
        Tables.from_paths(spark, {"orders": "x/y"})
    with pytest.raises(LookupError):
        t.cities()
    df.drop("city_id").createOrReplaceTempView("short_actions")
    with pytest.raises(ValueError):
        Tables.from_paths(spark, {"visits": "short_actions"}).visits()


def test_date_range_reaches_the_event_scan(spark):
    t = Tables(spark, SF)
    cut = t.visits("2024-01-05", "2024-01-10")
    assert "GreaterThanOrEqual(ts," in cut._jdf.queryExecution().executedPlan().toString()
    keep = F.col("date").between("2024-01-05", "2024-01-10")
    assert cut.filter(keep).exceptAll(t.visits().filter(keep)).count() == 0
    assert t.visits().filter(keep).exceptAll(cut.filter(keep)).count() == 0


def test_set_field_with_null_empties_the_field(spark):
    from visitlab.functions.strings import set_field

    r = spark.range(1).select(set_field(F.lit("a=1|b=2"), "a", F.lit(None)).alias("s")).first()
    assert r.s == "a=|b=2"
