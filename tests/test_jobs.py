import os
import tempfile

from conftest import rows
from visitlab.plans import ads as AD
from visitlab.plans import categories as C
from visitlab.plans import jobs as J
from visitlab.plans import products as PR
from visitlab.plans import sessions as S
from visitlab.sources.params import load_task
from visitlab.sources.tables import Tables
from visitlab.streaming import ad_streams as AS

SF = "/root/testdata/sf0.001"


def test_session_job_writes_task_tagged_outputs(spark):
    t = Tables(spark, SF)
    out = tempfile.mkdtemp(prefix="job-")
    paths = J.run_session_job(t, 4, out, sample_n=300)
    assert set(paths) == {"session_aggr_stat", "session_random_extract", "session_detail", "top10_category",
                          "top10_session"}
    stat = spark.read.parquet(paths["session_aggr_stat"])
    assert stat.columns[0] == "task_id" and rows(stat.select("task_id")) == [(4,)]
    p = load_task(t.tasks(), 4)
    direct = S.session_aggr_stat(S.filtered_sessions(t.visits(), t.users(), p))
    assert rows(stat.drop("task_id")) == rows(direct)
    cats = spark.read.parquet(paths["top10_category"]).drop("task_id")
    detail = S.session_detail(S.actions_in_range(t.visits(), p), S.filtered_sessions(t.visits(), t.users(), p))
    assert rows(cats, ["category_id"]) == rows(C.top10_category(detail), ["category_id"])


def test_page_and_product_jobs(spark):
    t = Tables(spark, SF)
    out = tempfile.mkdtemp(prefix="job-")
    pp = J.run_page_job(t, 0, out)
    conv = spark.read.parquet(pp["page_split_convert_rate"]).first()
    assert conv.task_id == 0 and conv.convert_rate.startswith("1_2=")
    pr = J.run_product_job(t, 1, out)
    top = spark.read.parquet(pr["area_top3_product"]).drop("task_id")
    want = PR.area_top3_product(t.visits(), t.cities(), t.products(), load_task(t.tasks(), 1))
    assert top.exceptAll(want).count() == 0 and want.exceptAll(top).count() == 0


def test_ad_job_is_the_closed_form(spark):
    """One file (day) per trigger at threshold 3 on sf0.01: every output equals its batch form."""
    root = tempfile.mkdtemp(prefix="adjob-")
    glob = AS.write_day_files(spark, Tables(spark, "/root/testdata/sf0.01").ad_logs(), os.path.join(root, "days"))
    job = J.start_ad_job(spark, AS.text_stream(spark, glob, 1), f"{root}/out", threshold=3,
                         trigger={"availableNow": True})
    clicks = AD.parse_ad_log(spark.read.text(glob))
    want = AD.kept_clicks(clicks, 3)
    kept = AS.kept_table(job.tables)
    assert kept.count() == 8272 and _same(kept, want.select(*AD.CLICK_COLUMNS))
    stat = AS.ad_stat_table(job.tables)
    assert stat.count() == 4944 and _same(stat, AD.ad_stat(want))
    assert _same(AS.province_top3_table(job.tables), AD.ad_province_top3(AD.ad_stat(want)))
    assert _same(AS.blacklist_table(job.tables), AD.blacklist_users(AD.daily_user_ad_clicks(clicks), 3))
    assert _same(AS.trend_table(job.tables), AD.ad_click_trend(clicks))
    assert job.tables.rejects.count() == 0


def _same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
