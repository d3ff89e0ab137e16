"""Structured Streaming jobs over ad-click log lines.

Every job takes a *streaming* DataFrame with a ``value`` column (Kafka, a socket, or a file source).  The ad job is four
queries, each with Spark's own checkpoint and state:

* ``filter`` (:func:`start_filter`) -- R4, the one query whose order matters.  Its state holds, per group of users (by
  the hash of their id), the blocked users, and of the others the clicks per (user, date, ad) so far, as packed arrays:
  one call decides all users of a group, instead of a call per user.  A user who reaches the threshold is emitted once,
  when it happens, and the clicks of later micro-batches are dropped.  Clicks are counted within each Arrow batch before
  they are shuffled, so a user with a third of the clicks sends few rows; the single clicks pass the state by.  A
  micro-batch rewrites the state of the groups it touches: with short triggers on many users, more ``owners`` (fixed
  when the query first starts) keep that small.  A file sink writes clicks, counts and blocks exactly once.
* ``totals`` (:func:`start_totals`) -- R5 and R6 from the kept counts of the first query.  One streaming aggregation over
  two grouping sets keeps the totals per (date, province, city, ad) and per (date, province, ad); the totals that a
  micro-batch raised overwrite the date partitions they fall in.  Totals only grow, so the top 3 of a group is the top 3
  of its old top 3 and the raised totals: no other total is read again.
* ``trend`` (:func:`start_trend`) -- R7: clicks per 10-second pane and ad of all readable lines, exactly once.  The
  minute trend and the sliding hour are sums of panes.  A pane older than ``late_after`` before its ad's newest one is
  marked late: it counts like any other, and :func:`late_panes` says how many there were.
* ``rejects`` (:func:`start_rejects`) -- unreadable lines with their reason.

No query has a watermark: a click counts under its own date and minute however late it comes.  Blocking goes by
micro-batch, so a click with an odd time affects nobody else.  State lives in as many partitions as the session has
shuffle partitions when a query first starts.

``trigger`` is ``processingTime`` in production (5 s in the original job) and ``availableNow`` in tests and replays.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from visitlab.operators.broadcast import bounded_broadcast
from visitlab.operators.merge import merge_replace, null_safe_join
from visitlab.operators.tables import DatePartitionedTable, make_folder
from visitlab.operators.topk import top_k_per_group
from visitlab.plans import ads as AD
from visitlab.session import checkpoint_root, scratch_path

CLICK_SCHEMA = "ts_ms long, date string, province string, city string, user_id long, ad_id long"
FILTERED_SCHEMA = ("batch_time timestamp, ts_ms long, date string, province string, city string, user_id long, "
                   "ad_id long, clicks long, kind string")
PANE_SCHEMA = "pane_ms long, ad_id long, clicks long, late boolean, date string"
STAT_KEYS = ["date", "province", "city", "ad_id"]
OWNERS = 256  # groups of users by their hash: the filter's state has a row per group, a call decides a whole group
LATE_AFTER_MS = 3_600_000


def _start(writer, trigger: dict):
    return writer.trigger(**trigger).start()


def _finish(query, trigger: dict) -> None:
    if trigger.get("availableNow") or trigger.get("once"):
        query.awaitTermination()
        if query.exception() is not None:
            raise RuntimeError(str(query.exception()))


def text_stream(spark: SparkSession, path_glob: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Log lines from text files; files are taken in modification-time order."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path_glob)


# ---------------------------------------------------------------- S8 / S9

def run_parse_stream(lines: DataFrame, out_path: str, checkpoint: str,
                     trigger: dict | None = None):
    trigger = trigger or {"availableNow": True}
    q = _start(AD.parse_ad_log(lines).select(*AD.CLICK_COLUMNS).writeStream
               .format("parquet").option("path", out_path).option("checkpointLocation", checkpoint)
               .outputMode("append"), trigger)
    _finish(q, trigger)
    return q


# ---------------------------------------------------------------- tables

@dataclass
class AdTables:
    """The tables of the ad job under one folder."""
    spark: SparkSession
    root: str

    def at(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def _read(self, name: str, schema: str) -> DataFrame:
        make_folder(self.spark, self.at(name))
        return self.spark.read.schema(schema).parquet(self.at(name))

    @property
    def filtered(self) -> DataFrame:
        return self._read("filtered", FILTERED_SCHEMA)

    @property
    def rejects(self) -> DataFrame:
        return self._read("rejects", "value string, reason string")

    @property
    def panes(self) -> DataFrame:
        return self._read("panes", PANE_SCHEMA)

    @property
    def stat(self) -> DatePartitionedTable:
        return DatePartitionedTable(self.spark, self.at("ad_stat"),
                                    "province string, city string, ad_id long, click_count long, date string")

    @property
    def top3(self) -> DatePartitionedTable:
        return DatePartitionedTable(self.spark, self.at("ad_province_top3"),
                                    "province string, ad_id long, click_count long, date string")


def blocks(tables: AdTables) -> DataFrame:
    """(user_id, block_time): blocked users and the micro-batch that blocked them; each appears once."""
    return tables.filtered.where("kind = 'block'").select("user_id", F.col("batch_time").alias("block_time"))


def blacklist_table(tables: AdTables) -> DataFrame:
    return blocks(tables).select("user_id")


def counts_table(tables: AdTables) -> DataFrame:
    """K4: kept clicks per (date, user, ad)."""
    return (tables.filtered.where("kind = 'count'").groupBy("date", "user_id", "ad_id")
            .agg(F.sum("clicks").alias("click_count")))


def kept_table(tables: AdTables) -> DataFrame:
    """The single clicks that were kept: those no later than the micro-batch that blocked their user."""
    side = bounded_broadcast(blocks(tables), AD.MAX_BROADCAST_USERS)
    return (tables.filtered.where("kind = 'click'").join(side, "user_id", "left")
            .where(F.col("block_time").isNull() | (F.col("batch_time") <= F.col("block_time")))
            .select(*AD.CLICK_COLUMNS))


def ad_stat_table(tables: AdTables) -> DataFrame:
    return tables.stat.read().select(*STAT_KEYS, "click_count")


def province_top3_table(tables: AdTables) -> DataFrame:
    return tables.top3.read().select("date", "province", "ad_id", "click_count")


def pane_table(tables: AdTables) -> DataFrame:
    """(pane_ms, ad_id, clicks), late ones included."""
    return tables.panes.groupBy("pane_ms", "ad_id").agg(F.sum("clicks").alias("clicks"))


def late_panes(tables: AdTables) -> DataFrame:
    """Late clicks per (date, ad): they are part of every other table too."""
    return tables.panes.where("late").groupBy("date", "ad_id").agg(F.sum("clicks").alias("late_clicks"))


def trend_table(tables: AdTables) -> DataFrame:
    return AD.trend_of_panes(pane_table(tables))


def sliding_hour_table(tables: AdTables) -> DataFrame:
    return AD.sliding_clicks(pane_table(tables))


# ---------------------------------------------------------------- R4: blacklist and kept clicks

def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each Arrow batch the clicks per (user, date, province, city, ad)."""
    for b in batches:
        yield from pa.Table.from_batches([b]).group_by(_COUNTED).aggregate([([], "count_all")]).select(
            [*_COUNTED, "count_all"]).rename_columns([*_COUNTED, "clicks"]).to_batches()


_COUNTED = ["owner", "batch_time", "date", "province", "city", "user_id", "ad_id"]
_COUNTS = ("owner long, batch_time timestamp, date string, province string, city string, user_id long, ad_id long, "
           "clicks long")
_FILTERED = [c.split()[0] for c in FILTERED_SCHEMA.split(", ")]
# Blocked user ids; the dates that ``counts`` numbers; an _ENTRY per (user, date, ad) of the users that are not blocked.
_STATE = "blocked binary, dates array<string>, counts binary"
_ENTRY = np.dtype([("user", "<i8"), ("ad", "<i8"), ("n", "<i8"), ("day", "<i4")])


def _entries(seen: list[pd.DataFrame], dates: list[str]) -> np.ndarray:
    """The clicks of ``seen`` as entries; dates that ``dates`` lacks are appended to it."""
    f = pd.concat(seen)
    code, found = pd.factorize(f["date"])
    number = {d: i for i, d in enumerate(dates)}
    for d in found:
        if d not in number:
            number[d] = len(dates)
            dates.append(d)
    new = np.empty(len(f), _ENTRY)
    new["user"], new["ad"], new["n"] = f["user_id"], f["ad_id"], f["clicks"]
    new["day"] = np.array([number[d] for d in found], "<i4")[code]
    return new


def _summed(e: np.ndarray) -> np.ndarray:
    """One entry per (user, date, ad)."""
    e = e[np.lexsort((e["ad"], e["day"], e["user"]))]
    first = np.ones(len(e), bool)
    first[1:] = (e["user"][1:] != e["user"][:-1]) | (e["day"][1:] != e["day"][:-1]) | (e["ad"][1:] != e["ad"][:-1])
    out = e[first]
    out["n"] = np.add.reduceat(e["n"], np.flatnonzero(first))
    return out


def _decide(threshold: int):
    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        blocked, dates, counts = state.get if state.exists else (b"", [], b"")
        blocked, dates, counts = np.frombuffer(blocked, "<i8"), list(dates), np.frombuffer(counts, _ENTRY)
        seen, last = [], None
        for f in frames:
            f = f[~np.isin(f["user_id"], blocked)].assign(kind="count", ts_ms=0)
            if len(f):
                last = f.iloc[:1]
                seen.append(f[["date", "user_id", "ad_id", "clicks"]])
                yield f[_FILTERED]
        if not seen:
            return
        new = _entries(seen, dates)
        touched = np.isin(counts["day"], np.unique(new["day"]))  # only their totals can have risen
        touched[touched] = np.isin(counts["user"][touched], new["user"])
        raised = _summed(np.concatenate([counts[touched], new]))
        counts = np.concatenate([counts[~touched], raised])
        over = np.unique(raised["user"][raised["n"] >= threshold])
        if len(over):
            counts, blocked = counts[~np.isin(counts["user"], over)], np.concatenate([blocked, over])
            yield last.loc[last.index.repeat(len(over))].assign(
                user_id=over, kind="block", ts_ms=0, clicks=0, ad_id=0, date="", province="", city="")[_FILTERED]
        state.update((blocked.tobytes(), dates, counts.tobytes()))
    return run


def start_filter(lines: DataFrame, tables: AdTables, checkpoint: str, threshold: int, trigger: dict, owners: int = OWNERS):
    clicks = AD.split_lines(lines)[0].select(*AD.CLICK_COLUMNS, F.current_timestamp().alias("batch_time"))
    owner = F.pmod(F.xxhash64("user_id"), F.lit(owners)).alias("owner")
    counts = (clicks.select(owner, *_COUNTED[1:]).mapInArrow(_count, _COUNTS).groupBy("owner")
              .applyInPandasWithState(_decide(threshold), FILTERED_SCHEMA, _STATE, "append", GroupStateTimeout.NoTimeout))
    single = clicks.withColumns({"clicks": F.lit(1).cast("long"), "kind": F.lit("click")}).select(*_FILTERED)
    return _start(counts.union(single).writeStream.format("parquet").option("path", tables.at("filtered")).partitionBy("kind")
                  .option("checkpointLocation", f"{checkpoint}/filter").outputMode("append").queryName("ad_filter"), trigger)


# ---------------------------------------------------------------- R5, R6: running totals and top 3

def publish_totals(raised: DataFrame, tables: AdTables, k: int = 3) -> None:
    """Write the totals a micro-batch raised: rows (STAT_KEYS, click_count, level), level 0 per city, 2 per province.

    Totals are absolute, so a micro-batch that is run again leaves the same tables."""
    tables.stat.upsert_replace(raised.where("level = 0").drop("level"), STAT_KEYS)
    group = ["date", "province"]
    province = raised.where("level = 2").select(*group, "ad_id", "click_count")
    old = null_safe_join(province_top3_table(tables), province.select(*group).distinct(), group, "left_semi")
    best = top_k_per_group(merge_replace(old, province, [*group, "ad_id"]), group,
                           [F.col("click_count").desc(), F.col("ad_id").asc()], k)
    tables.top3.replace_groups(best, group)


def start_totals(tables: AdTables, checkpoint: str, trigger: dict, max_files_per_trigger: int | None = None):
    make_folder(tables.spark, tables.at("filtered"))
    reader = tables.spark.readStream.schema(FILTERED_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    totals = (reader.parquet(tables.at("filtered")).where("kind = 'count'")
              .groupingSets([[F.col(c) for c in STAT_KEYS], [F.col(c) for c in STAT_KEYS if c != "city"]], *STAT_KEYS)
              .agg(F.sum("clicks").alias("click_count"), F.grouping_id().alias("level")))

    def write(raised: DataFrame, batch_id: int) -> None:
        raised.persist()
        try:
            publish_totals(raised, tables)
        finally:
            raised.unpersist()

    return _start(totals.writeStream.foreachBatch(write).outputMode("update").queryName("ad_totals")
                  .option("checkpointLocation", f"{checkpoint}/totals"), trigger)


# ---------------------------------------------------------------- R7: panes

def _panes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Clicks per (pane, ad) of each Arrow batch."""
    for b in batches:
        counts = pa.Table.from_batches([b]).group_by(["pane_ms", "ad_id"]).aggregate([([], "count_all")])
        yield from counts.select(["pane_ms", "ad_id", "count_all"]).rename_columns(["pane_ms", "ad_id", "clicks"]).to_batches()


def _mark_late(late_after: int):
    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        newest = state.get[0] if state.exists else None
        top = newest
        for f in frames:
            f = f.groupby("pane_ms", as_index=False)["clicks"].sum()
            late = f["pane_ms"] < newest - late_after if newest is not None else False
            top = max(int(f["pane_ms"].max()), top if top is not None else int(f["pane_ms"].max()))
            yield f.assign(ad_id=key[0], late=late)[["pane_ms", "ad_id", "clicks", "late"]]
        state.update((top,))
    return run


def start_trend(lines: DataFrame, tables: AdTables, checkpoint: str, trigger: dict, late_after: int = LATE_AFTER_MS):
    clicks = AD.split_lines(lines)[0].select(AD.pane_start("ts_ms").alias("pane_ms"), "ad_id")
    panes = (clicks.mapInArrow(_panes, "pane_ms long, ad_id long, clicks long").groupBy("ad_id")
             .applyInPandasWithState(_mark_late(late_after), "pane_ms long, ad_id long, clicks long, late boolean",
                                     "newest long", "append", GroupStateTimeout.NoTimeout)
             .withColumn("date", F.expr("string(date_from_unix_date(int(floor(pane_ms / 86400000))))")))
    return _start(panes.writeStream.format("parquet").option("path", tables.at("panes")).partitionBy("date")
                  .option("checkpointLocation", f"{checkpoint}/trend").outputMode("append").queryName("ad_trend"), trigger)


def start_rejects(lines: DataFrame, tables: AdTables, checkpoint: str, trigger: dict):
    return _start(AD.split_lines(lines)[1].writeStream.format("parquet").option("path", tables.at("rejects"))
                  .option("checkpointLocation", f"{checkpoint}/rejects").outputMode("append").queryName("ad_rejects"), trigger)


# ---------------------------------------------------------------- the whole job

def run_ad_stream(lines: DataFrame, root: str, checkpoint: str, threshold: int = AD.DEFAULT_BLACKLIST_THRESHOLD,
                  trigger: dict | None = None, max_files_per_trigger: int | None = None):
    """Start the job's queries; returns (tables, queries).  With an ``availableNow`` trigger it also waits for the end:
    first for the filter, whose output the totals read.  ``max_files_per_trigger`` bounds a micro-batch of the totals."""
    trigger = trigger or {"availableNow": True}
    tables = AdTables(lines.sparkSession, root)
    queries = [start_filter(lines, tables, checkpoint, threshold, trigger), start_trend(lines, tables, checkpoint, trigger),
               start_rejects(lines, tables, checkpoint, trigger)]
    _finish(queries[0], trigger)
    queries.append(start_totals(tables, checkpoint, trigger, max_files_per_trigger))
    for q in queries:
        _finish(q, trigger)
    return tables, queries


def run_click_trend_stream(lines: DataFrame, root: str, checkpoint: str, trigger: dict | None = None,
                           late_after: int = LATE_AFTER_MS) -> AdTables:
    """R7 alone: panes of all readable lines, late ones under their own time."""
    trigger = trigger or {"availableNow": True}
    tables = AdTables(lines.sparkSession, root)
    _finish(start_trend(lines, tables, checkpoint, trigger, late_after), trigger)
    return tables


# ---------------------------------------------------------------- replay input

def write_day_files(spark: SparkSession, ad_logs: DataFrame, path: str, files_per_day: int = 1) -> str:
    """Lay ``ad_logs`` (value, day) out as ``files_per_day`` text files per day, with file modification times ascending
    by day, so a file source with ``maxFilesPerTrigger=files_per_day`` replays the log one day per micro-batch.  Lines are
    dealt over a day's files by their hash; a day too small for that gets empty files.  Returns the glob to read."""
    part = F.pmod(F.xxhash64("value"), F.lit(files_per_day))
    (ad_logs.select("value", "day", part.alias("part")).repartition("day", "part")
     .write.mode("overwrite").partitionBy("day", "part").text(path))
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    day_dirs = sorted((st.getPath() for st in fs.listStatus(root) if st.isDirectory()),
                      key=lambda p: p.getName())
    base = 1_600_000_000_000
    for i, d in enumerate(day_dirs):  # metadata calls only, a handful per day
        for k in range(files_per_day):
            folder = jvm.org.apache.hadoop.fs.Path(d, f"part={k}")
            if not fs.exists(folder):
                fs.create(jvm.org.apache.hadoop.fs.Path(folder, "part-empty")).close()
            for st in fs.listStatus(folder):
                if st.getPath().getName().startswith("part-"):
                    fs.setTimes(st.getPath(), base + i * 1000, -1)
    return f"{path}/day=*/part=*/part-*"


def new_run_dirs(spark: SparkSession, name: str) -> tuple[str, str]:
    """Fresh (output, checkpoint) folders under the shared checkpoint root."""
    checkpoint_root(spark)
    base = scratch_path(spark, name)
    return f"{base}/out", f"{base}/_checkpoint"


def stream_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A session of the same application whose streams keep their state in ``partitions`` partitions (default: the
    application's cores); a stateful query cannot change that number later."""
    s = spark.newSession()
    for k in ("spark.sql.session.timeZone", "spark.sql.sources.partitionOverwriteMode"):
        if spark.conf.get(k, None):
            s.conf.set(k, spark.conf.get(k))
    s.conf.set("spark.sql.shuffle.partitions", str(partitions or spark.sparkContext.defaultParallelism))
    return s
