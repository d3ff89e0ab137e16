from conftest import VISIT_SCHEMA, rows, visit
from visitlab.plans import funnel as FN
from visitlab.plans import sampling as SM
from visitlab.sources.params import TaskParams


def _v(spark, data):
    return spark.createDataFrame(data, VISIT_SCHEMA)


def test_splits_ordered_by_time_then_id_and_missing_split(spark):
    v = _v(spark, [
        visit(2, "s", "2024-01-01 10:00:00", page_id=2),
        visit(1, "s", "2024-01-01 10:00:00", page_id=1),  # same time: action_id orders 1 before 2
        visit(3, "s", "2024-01-01 10:00:05", page_id=3),
        visit(4, "t", "2024-01-01 10:00:00", page_id=1),
        visit(5, "t", "2024-01-01 10:00:09", page_id=2),
    ])
    p = TaskParams(target_page_flow="1,2,3,4")
    assert rows(FN.page_split_pv(spark, v, p), ["position"]) == [(1, "1_2", 2), (2, "2_3", 1), (3, "3_4", 0)]
    assert FN.start_page_pv(v, p).first()[0] == 2
    rates = rows(FN.page_convert_rate(spark, v, p), ["position"])
    assert rates == [(1, "1_2", 2, 1.0), (2, "2_3", 1, 0.5), (3, "3_4", 0, 0.0)]
    assert FN.page_convert_string(spark, v, p).first()[0] == "1_2=1.0|2_3=0.5|3_4=0.0"


def test_first_page_never_seen_gives_null_rate(spark):
    v = _v(spark, [visit(1, "s", "2024-01-01 10:00:00", page_id=2), visit(2, "s", "2024-01-01 10:00:01", page_id=3)])
    rates = rows(FN.page_convert_rate(spark, v, TaskParams(target_page_flow="1,2,3")), ["position"])
    assert rates == [(1, "1_2", 0, None), (2, "2_3", 1, None)]


def test_stratified_extract_quota(spark):
    # day 1: 6 sessions at 10h, 2 at 11h; day 2: 4 sessions at 09h.  n=8 -> 4 per day.
    sess = [(f"a{i}", "2024-01-01 10:00:00") for i in range(6)] + \
           [(f"b{i}", "2024-01-01 11:30:00") for i in range(2)] + \
           [(f"c{i}", "2024-01-02 09:00:00") for i in range(4)]
    df = spark.createDataFrame([(s, t, "", "") for s, t in sess],
                               "session_id string, start_time string, search_keywords string, click_category_ids string")
    hours = {(r.date, r.hour): (r.hour_count, r.day_count) for r in SM.sessions_per_hour(df).collect()}
    assert hours[("2024-01-01", "10")] == (6, 8) and hours[("2024-01-02", "09")] == (4, 4)
    out = SM.session_random_extract(df, n=8, seed=1)
    got = [r.session_id for r in out.collect()]
    # quotas: 10h -> 6*4 div 8 = 3, 11h -> 2*4 div 8 = 1, day 2 09h -> min(4, 4*4 div 4) = 4
    assert sum(s.startswith("a") for s in got) == 3
    assert sum(s.startswith("b") for s in got) == 1
    assert sum(s.startswith("c") for s in got) == 4
    assert sorted(got) == sorted(r.session_id for r in SM.session_random_extract(df, n=8, seed=1).collect())


def test_extract_empty_input(spark):
    df = spark.createDataFrame([], "session_id string, start_time string, search_keywords string, click_category_ids string")
    assert SM.session_random_extract(df, n=100).count() == 0
