import os
import random
import tempfile
from collections import Counter
from datetime import datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from conftest import rows
from visitlab.operators.tables import DatePartitionedTable
from visitlab.plans import ads as AD
from visitlab.streaming import ad_streams as AS

@pytest.fixture(scope="module")
def spark(spark):
    """A session whose streams keep their state in two partitions."""
    return AS.stream_session(spark, 2)


DAY = 86_400_000
T0 = 1704067200000


def _files(spark, root, days):
    """One text file per list of lines, read in that order."""
    df = spark.createDataFrame([(v, f"{i:03d}") for i, lines in enumerate(days) for v in lines], "value string, day string")
    return AS.write_day_files(spark, df, os.path.join(root, "days"))


def _day_lines():
    days = []
    for d in range(3):
        base = T0 + d * DAY
        # user 1: 3 clicks on ad 1 on day 0 -> blocked from day 1
        lines = [f"{base + i} P1 N 1 1" for i in range(3 if d == 0 else 1)]
        days.append(lines + [f"{base + 10 + i} P2 M 2 {i % 2}" for i in range(2)])
    return days


def _same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _tables(tables):
    return {"kept": AS.kept_table(tables), "counts": AS.counts_table(tables), "blacklist": AS.blacklist_table(tables),
            "stat": AS.ad_stat_table(tables), "top3": AS.province_top3_table(tables), "trend": AS.trend_table(tables),
            "sliding": AS.sliding_hour_table(tables), "rejects": tables.rejects}


def _state(tables):
    return {k: sorted((tuple(r) for r in t.collect()), key=str) for k, t in _tables(tables).items()}


def test_ad_stream_filters_then_counts(spark):
    root = tempfile.mkdtemp(prefix="bl-")
    glob = _files(spark, root, _day_lines())
    tables, _ = AS.run_ad_stream(AS.text_stream(spark, glob, 1), f"{root}/out", f"{root}/ck", threshold=3)
    assert rows(AS.blacklist_table(tables)) == [(1,)]
    assert rows(AS.counts_table(tables).filter("user_id = 1")) == [("2024-01-01", 1, 1, 3)]  # later days were dropped
    assert _same(AS.kept_table(tables), AD.kept_clicks(AD.parse_ad_log(spark.read.text(glob)), 3))
    assert rows(AS.ad_stat_table(tables).filter("province = 'P1'")) == [("2024-01-01", "P1", "N", 1, 3)]
    top = AS.province_top3_table(tables)
    assert top.count() == 7  # 3 days x P2 (2 ads), plus P1 on day 1
    assert rows(top.filter("province = 'P2' AND date = '2024-01-02'").select("ad_id", "click_count"),
                ["ad_id"]) == [(0, 1), (1, 1)]


def test_bad_lines_are_set_aside_and_the_stream_goes_on(spark):
    root = tempfile.mkdtemp(prefix="bad-")
    days = [[f"{T0} P1 N 1 1", "garbage"], ["", f"{T0 + DAY} P1 N x 1", f"{T0 + DAY} P1 N 2 7"]]
    tables, _ = AS.run_ad_stream(AS.text_stream(spark, _files(spark, root, days), 1), f"{root}/out", f"{root}/ck")
    assert AS.kept_table(tables).count() == 2 and AS.ad_stat_table(tables).count() == 2
    assert sorted(r.reason for r in tables.rejects.collect()) == ["no_time", "no_time", "no_user"]


def test_a_future_click_changes_nothing_for_others(spark):
    root = tempfile.mkdtemp(prefix="fut-")
    days = _day_lines()
    days[0].append("4102444800000 P9 Z 9 9")  # the year 2100
    glob = _files(spark, root, days)
    tables, _ = AS.run_ad_stream(AS.text_stream(spark, glob, 1), f"{root}/out", f"{root}/ck", threshold=3)
    assert AS.kept_table(tables).filter("user_id = 1").count() == 3
    assert AS.kept_table(tables).filter("user_id = 9").count() == 1


def test_a_block_counts_from_the_next_batch_and_comes_once(spark):
    """Clicks of the batch that blocks a user are kept, whatever their order; several ads over the threshold, one block;
    clicks without a province are counted too."""
    root = tempfile.mkdtemp(prefix="blk-")
    days = [[f"{T0 + i} P1 N 5 {ad}" for i in range(2) for ad in (1, 2)],
            [f"{T0 + 9} P1 N 5 1", f"{T0 + 9} P1 N 5 2", f"{T0 + 9} P1 N 5 3", f"{T0}  N 6 1"],
            [f"{T0 + 10} P1 N 5 4", f"{T0 + 11} P1 N 6 1"], [f"{T0 + 12} P1 N 5 4"]]
    tables, _ = AS.run_ad_stream(AS.text_stream(spark, _files(spark, root, days), 1), f"{root}/out", f"{root}/ck",
                                 threshold=3)
    assert rows(AS.blacklist_table(tables)) == [(5,)]
    kept = AS.kept_table(tables)
    assert kept.filter("user_id = 5").count() == 7 and kept.filter("user_id = 6").count() == 2
    assert AS.counts_table(tables).filter("user_id = 5").agg({"click_count": "sum"}).first()[0] == 7


def test_groups_of_users_are_decided_like_single_users(spark):
    """Random micro-batches with late dates: clicks, counts and blocks as by a loop over users; the state has a row per
    group of users, not per user."""
    rng = random.Random(7)
    root = tempfile.mkdtemp(prefix="grp-")
    batches = [[(T0 + rng.randrange(4) * DAY + rng.randrange(DAY), rng.randrange(2000) if rng.random() < 0.5 else
                 rng.randrange(60), rng.randrange(3)) for _ in range(1500)] for _ in range(4)]
    blocked, kept, counts = set(), Counter(), Counter()
    for batch in batches:
        for ms, u, ad in batch:
            if u not in blocked:
                day = f"2024-01-0{(ms - T0) // DAY + 1}"
                kept[ms, u, ad] += 1
                counts[day, u, ad] += 1
        blocked |= {u for (_, u, _), n in counts.items() if n >= 5}
    assert 20 < len(blocked) < len({u for _, u, _ in counts}) and kept.total() < 5900
    glob = _files(spark, root, [[f"{ms} P{u % 5} C{u % 7} {u} {ad}" for ms, u, ad in batch] for batch in batches])
    for owners in (8, AS.OWNERS):
        tables = AS.AdTables(spark, f"{root}/out{owners}")
        q = AS.start_filter(AS.text_stream(spark, glob, 1), tables, f"{root}/ck{owners}", 5, {"availableNow": True}, owners)
        q.awaitTermination()
        assert Counter(rows(AS.kept_table(tables).select("ts_ms", "user_id", "ad_id"))) == kept
        assert {r[:3]: r[3] for r in rows(AS.counts_table(tables))} == counts
        assert sorted(rows(AS.blacklist_table(tables))) == sorted((u,) for u in blocked)
        assert max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]) <= owners


def test_panes_of_any_year_have_their_date(spark):
    root = tempfile.mkdtemp(prefix="yr-")
    glob = _files(spark, root, [[f"{T0 + DAY - 1} P N 1 1", "-1 P N 1 1", "32503679999999 P N 1 1"]])  # up to 2999
    tables = AS.run_click_trend_stream(AS.text_stream(spark, glob, 1), f"{root}/trend", f"{root}/ck")
    assert sorted(rows(tables.panes.select("date", "pane_ms"))) == [
        ("1969-12-31", -10_000), ("2024-01-01", T0 + DAY - 10_000), ("2999-12-31", 32503679990000)]


def test_top3_from_raised_totals_equals_full_recomputation(spark):
    """Random batches: the top 3 of the old top 3 and the raised totals is the top 3 of all totals."""
    rng = random.Random(11)
    root = tempfile.mkdtemp(prefix="inc-")
    tables, total = AS.AdTables(spark, root), Counter()
    for _ in range(6):
        batch = Counter((f"2024-01-0{rng.randint(1, 2)}", rng.choice(["P", "Q"]), rng.choice("cd"), rng.randrange(9))
                        for _ in range(rng.randrange(1, 40)))
        total += batch
        province = Counter()
        for (d, p, _, a), n in total.items():
            province[d, p, a] += n
        raised = [(*k, total[k], 0) for k in batch]
        raised += [(d, p, None, a, province[d, p, a], 2) for d, p, a in {(d, p, a) for d, p, _, a in batch}]
        df = spark.createDataFrame(raised, "date string, province string, city string, ad_id long, click_count long, level long")
        for _ in range(2):  # a batch that is run again changes nothing
            AS.publish_totals(df, tables)
        want = []
        for g in {(d, p) for d, p, _ in province}:
            best = sorted(((n, -a) for (d, p, a), n in province.items() if (d, p) == g), reverse=True)[:3]
            want += [(*g, -a, n) for n, a in best]
        assert sorted(rows(AS.province_top3_table(tables))) == sorted(want)
        assert sorted(rows(AS.ad_stat_table(tables))) == sorted((*k, n) for k, n in total.items())


def _fails_after_first_write(monkeypatch, at_call):
    """The totals' micro-batch fails between its two tables, once."""
    whole, calls = DatePartitionedTable.replace_groups, []

    def failing(self, *args):
        calls.append(1)
        if len(calls) == at_call:
            raise RuntimeError("injected")
        return whole(self, *args)
    monkeypatch.setattr(DatePartitionedTable, "replace_groups", failing)


def test_restart_from_the_checkpoint_equals_an_undisturbed_run(spark, monkeypatch):
    """Every query is stopped by a fault in the middle of the log and started again from its checkpoint: the filter, the
    trend and the rejects by a line that cannot be read, the totals between their two tables."""
    days = _day_lines() + [[f"{T0 + 3 * DAY + i} P2 M 2 0" for i in range(4)]]
    done = {}
    for way in ("whole", "broken"):
        root = tempfile.mkdtemp(prefix=f"{way}-")
        glob = _files(spark, root, days)
        lines = AS.text_stream(spark, glob, 1)
        tables, now = AS.AdTables(spark, f"{root}/out"), {"availableNow": True}
        if way == "broken":
            poison = F.when(F.col("value").contains(str(T0 + 2 * DAY)), F.raise_error("injected")).otherwise(F.col("value"))
            bad = lines.select(poison.cast("string").alias("value"))
            for start in (lambda: AS.start_filter(bad, tables, f"{root}/ck", 3, now),
                          lambda: AS.start_trend(bad, tables, f"{root}/ck", now),
                          lambda: AS.start_rejects(bad, tables, f"{root}/ck", now)):
                with pytest.raises(StreamingQueryException, match="injected"):
                    start().awaitTermination()
            assert AS.counts_table(tables).count() > 0  # some batches came through
            AS.run_ad_stream(lines, f"{root}/out", f"{root}/ck", 3, max_files_per_trigger=2)
            with monkeypatch.context() as m:
                _fails_after_first_write(m, 2)
                with pytest.raises(StreamingQueryException, match="injected"):
                    AS.start_totals(AS.AdTables(spark, f"{root}/out"), f"{root}/ck2", now, 2).awaitTermination()
            AS.start_totals(AS.AdTables(spark, f"{root}/out"), f"{root}/ck2", now, 2).awaitTermination()
        else:
            AS.run_ad_stream(lines, f"{root}/out", f"{root}/ck", 3, max_files_per_trigger=2)
        done[way] = _state(tables)
    assert done["broken"] == done["whole"] and all(done["whole"][k] for k in done["whole"] if k != "rejects")


def test_trend_keeps_late_clicks(spark):
    root = tempfile.mkdtemp(prefix="tr-")
    hour = 3_600_000
    days = [[f"{T0 + h * hour + i * 1000} P N {i} 1" for i in range(n)] for h, n in ((6, 3), (7, 2), (1, 3))]
    glob = _files(spark, root, days)
    clicks = AD.parse_ad_log(spark.read.text(glob))
    tables = AS.run_click_trend_stream(AS.text_stream(spark, glob, 1), f"{root}/trend", f"{root}/ck")
    got = AS.trend_table(tables)
    assert _same(got, AD.ad_click_trend(clicks)) and got.agg({"click_count": "sum"}).first()[0] == 8
    assert rows(AS.late_panes(tables)) == [("2024-01-01", 1, 3)]  # five hours behind, counted all the same
    assert _same(AS.sliding_hour_table(tables), AD.sliding_clicks(AD.click_panes(clicks)))


def test_sliding_windows_against_every_window(spark):
    rng = random.Random(4)
    near = [T0 + DAY - rng.randrange(0, 1200) * 10_000 - rng.randrange(10_000) for _ in range(60)]  # around midnight
    clicks = [(t, rng.randrange(3)) for t in near + [T0, T0 + DAY - 1, T0 + DAY, T0 + DAY + 5, T0 + 10_000]]
    df = spark.createDataFrame(clicks, "ts_ms long, ad_id long")
    for window in (3_600_000, 20_000, DAY):
        want = {}
        for ad in range(3):
            for e in range(T0 - 20_000, T0 + 3 * DAY, 10_000) if window < DAY else range(T0, T0 + 3 * DAY, 10_000):
                n = sum(a == ad and e - window <= t < e for t, a in clicks)
                if n:
                    want[ad, e] = n
        got = {}
        for r in AD.sliding_clicks(AD.click_panes(df), window).collect():
            lo, hi = (int(datetime.fromisoformat(x + "+00:00").timestamp()) * 1000 for x in (r.first_end, r.last_end))
            assert r.date == r.first_end[:10] == r.last_end[:10] and lo <= hi
            for e in range(lo, hi + 1, 10_000):
                assert (r.ad_id, e) not in got
                got[r.ad_id, e] = r.click_count
        assert got == want
    for window in (15_000, 2 * DAY):
        with pytest.raises(ValueError):
            AD.sliding_clicks(AD.click_panes(df), window)


def test_day_files_are_several_and_replay_day_by_day(spark):
    root = tempfile.mkdtemp(prefix="df-")
    df = spark.createDataFrame([(f"{d} {i}", f"2024-01-0{d}") for d in (1, 2, 3) for i in range(2 if d == 2 else 40)],
                               "value string, day string")
    glob = AS.write_day_files(spark, df, f"{root}/days", 3)
    seen = {}
    q = (AS.text_stream(spark, glob, 3).writeStream.option("checkpointLocation", f"{root}/ck").trigger(availableNow=True)
         .foreachBatch(lambda b, i: seen.update({i: sorted(r.value for r in b.collect())})).start())
    q.awaitTermination()
    assert [len(seen[i]) for i in sorted(seen)] == [40, 2, 40] and seen[1] == ["2 0", "2 1"]


def test_parse_stream_writes_every_line_once(spark):
    root = tempfile.mkdtemp(prefix="ps-")
    glob = _files(spark, root, _day_lines())
    AS.run_parse_stream(AS.text_stream(spark, glob, 2), f"{root}/out", f"{root}/ck")
    got = spark.read.schema(AS.CLICK_SCHEMA).parquet(f"{root}/out")
    assert _same(got, AD.parse_ad_log(spark.read.text(glob)).select(*AD.CLICK_COLUMNS))
