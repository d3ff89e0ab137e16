"""Readers for the input tables and the derived views of the data model.

The analytics work on five logical tables: ``visits`` (one row per user
action), ``users``, ``products``, ``cities`` and ``ad_logs`` (text lines
``epoch_ms province city user_id ad_id``), plus a ``tasks`` table holding JSON
job parameters.  Here they are derived from the raw parquet tables with
narrow projections only (no shuffle), so every rule below runs inside the scan
stage and keeps column pruning / filter pushdown intact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RAW_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
              "events", "documents", "embeddings", "pages", "benchmark", "labels",
              "conversations")

# The ten search words of the reference data model, in order.
SEARCH_KEYWORDS = ["火锅", "蛋糕", "重庆辣子鸡", "重庆小面", "呷哺呷哺",
                   "新辣道鱼火锅", "国贸大厦", "太古商场", "日本料理", "温泉"]

# Fixed values of the visit fixture: session window (seconds) by user_id % 4
# and in-session time stretch (seconds) by user_id % 10.
SESSION_WINDOWS = [86400, 259200, 864000, 2592000]
SESSION_SPANS = [2, 5, 8, 20, 50, 150, 500, 1500, 5000, 40000]
EPOCH_2024 = 1704067200

VISIT_COLUMNS = ["action_id", "date", "user_id", "session_id", "page_id", "action_time",
                 "search_keyword", "click_category_id", "click_product_id",
                 "order_category_ids", "order_product_ids", "pay_category_ids",
                 "pay_product_ids", "city_id"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(values: list, index: Column) -> Column:
    """values[index] for a small fixed list (index is 0-based)."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)


def _event_k() -> Column:
    return F.get_json_object("props", "$.k").cast("long")


def visits_from_events(events: DataFrame) -> DataFrame:
    """user_visit_action rows derived from ``events`` (see FIXTURES.md §3)."""
    k = F.col("_k")
    uid = F.col("user_id")
    win = F.col("_win")
    et = F.col("event_type")
    df = (events
          .select("event_id", "ts", "user_id", "event_type", "props")
          .withColumn("_k", _event_k())
          .withColumn("_o", F.expr("unix_micros(cast(ts as timestamp)) div 1000000") - F.lit(EPOCH_2024))
          .withColumn("_win", _pick(SESSION_WINDOWS, uid % 4).cast("long"))
          .withColumn("_span", _pick(SESSION_SPANS, uid % 10).cast("long"))
          .withColumn("_sn", F.expr("_o div _win"))
          .withColumn("_a", F.lit(EPOCH_2024) + F.col("_sn") * win + (uid % 23) * 3600
                      + F.expr("((_o % _win) * _span) div _win"))
          .withColumn("_ats", F.timestamp_seconds(F.col("_a"))))
    is_click = et == "click"
    is_order = et == "purchase"
    is_pay = et == "error"
    return df.select(
        F.col("event_id").alias("action_id"),
        F.date_format("_ats", "yyyy-MM-dd").alias("date"),
        uid.alias("user_id"),
        F.concat_ws("-", uid.cast("string"), F.col("_sn").cast("string")).alias("session_id"),
        (k % 10).alias("page_id"),
        F.date_format("_ats", "yyyy-MM-dd HH:mm:ss").alias("action_time"),
        F.when(et == "signup", _pick(SEARCH_KEYWORDS, k % 10)).alias("search_keyword"),
        F.when(is_click, k % 20).alias("click_category_id"),
        F.when(is_click, k).alias("click_product_id"),
        F.when(is_order, F.concat((k % 20).cast("string"),
                                  F.when(k % 2 == 0, F.concat(F.lit(","), ((k + 7) % 20).cast("string")))
                                  .otherwise(F.lit("")))).alias("order_category_ids"),
        F.when(is_order, k.cast("string")).alias("order_product_ids"),
        F.when(is_pay, (k % 20).cast("string")).alias("pay_category_ids"),
        F.when(is_pay, k.cast("string")).alias("pay_product_ids"),
        ((uid * 3 + k) % 25).alias("city_id"),
    )


def users_from_customer(customer: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    return customer.select(
        key.alias("user_id"),
        F.concat(F.lit("user"), key.cast("string")).alias("username"),
        F.col("c_name").alias("name"),
        ((key * 7) % 60).cast("int").alias("age"),
        F.col("c_mktsegment").alias("professional"),
        F.concat(F.lit("city"), F.col("c_nationkey").cast("string")).alias("city"),
        F.when(key % 2 == 0, "male").otherwise("female").alias("sex"),
    )


def products_from_part(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.concat(F.lit('{"product_status": '), (F.col("p_size") % 2).cast("string"), F.lit("}"))
        .alias("extend_info"),
    )


def cities_from_nation(nation: DataFrame, region: DataFrame) -> DataFrame:
    # region is a fixed 5-row dimension: the broadcast size is bounded by definition.
    return (nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
            .select(F.col("n_nationkey").cast("long").alias("city_id"),
                    F.col("n_name").alias("city_name"),
                    F.col("r_name").alias("area")))


def ad_logs_from_events(events: DataFrame, nation: DataFrame) -> DataFrame:
    """Ad-click log lines ``epoch_ms province city user_id ad_id`` in a ``value`` column.

    Also keeps ``day`` (yyyy-MM-dd of the click) so the lines can be laid out as one
    file per day for stream replay.
    """
    ev = (events.select("ts", "user_id", "props")
          .withColumn("_nk", (F.col("user_id") % 25).cast("int")))
    # nation is a fixed 25-row dimension: bounded broadcast.
    joined = ev.join(F.broadcast(nation.select("n_nationkey", "n_name", "n_regionkey")),
                     F.col("_nk") == F.col("n_nationkey"))
    epoch_ms = F.expr("unix_millis(cast(ts as timestamp))")
    return joined.select(
        F.concat_ws(" ", epoch_ms.cast("string"),
                    F.concat(F.lit("P"), F.col("n_regionkey").cast("string")),
                    F.col("n_name"),
                    F.col("user_id").cast("string"),
                    (_event_k() % 10).cast("string")).alias("value"),
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd").alias("day"),
    )


def tasks_from_region(region: DataFrame) -> DataFrame:
    """A task table (task_id, task_name, ..., task_param JSON) derived from ``region``.

    Task r filters dates 2024-01-(1+2r) .. 2024-01-(20+2r), ages 10+5r .. 40+5r;
    even tasks add professionals and sex, task 1 adds keywords and category ids,
    and every task carries a page flow.  Missing keys exercise the "parameter
    absent -> no filter" rule.
    """
    r = F.col("r_regionkey").cast("int")
    even = r % 2 == 0
    param = F.struct(
        F.array(F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), r * 2), "yyyy-MM-dd")).alias("startDate"),
        F.array(F.date_format(F.date_add(F.lit("2024-01-20").cast("date"), r * 2), "yyyy-MM-dd")).alias("endDate"),
        F.array((r * 5 + 10).cast("string")).alias("startAge"),
        F.array((r * 5 + 40).cast("string")).alias("endAge"),
        F.when(even, F.array(F.lit("BUILDING,MACHINERY,HOUSEHOLD"))).alias("professionals"),
        F.when(r == 3, F.array(F.lit("city1,city2,city3,city4,city5,city6,city7"))).alias("cities"),
        F.when(even, F.array(F.lit("male"))).alias("sex"),
        F.when(r == 1, F.array(F.lit(",".join(SEARCH_KEYWORDS[:4])))).alias("keywords"),
        F.when(r == 1, F.array(F.lit("1,3,5,11,13"))).alias("categoryIds"),
        F.array(F.concat_ws(",", (r + 1).cast("string"), (r + 2).cast("string"),
                            (r + 3).cast("string"), (r + 4).cast("string"))).alias("targetPageFlow"),
    )
    return region.select(
        F.col("r_regionkey").cast("long").alias("task_id"),
        F.concat(F.lit("task_"), F.lower("r_name")).alias("task_name"),
        F.lit("2024-01-01 00:00:00").alias("create_time"),
        F.lit("2024-01-01 00:00:00").alias("start_time"),
        F.lit("2024-01-01 00:00:00").alias("finish_time"),
        F.lit("session").alias("task_type"),
        F.lit("finished").alias("task_status"),
        F.to_json(param).alias("task_param"),
    )


# How far a fixture action's time may lie from its event's ``ts`` (seconds): later by the
# start shift and the longest stretch, earlier by the longest session window.
MAX_LATER = 22 * 3600 + max(SESSION_SPANS)
MAX_EARLIER = max(SESSION_WINDOWS)

# Column types of the native tables, as their owner declares them.
NATIVE_SCHEMAS = {
    "visits": ("date string, user_id long, session_id string, page_id long, action_time string, "
               "search_keyword string, click_category_id long, click_product_id long, order_category_ids string, "
               "order_product_ids string, pay_category_ids string, pay_product_ids string, city_id long"),
    "users": "user_id long, username string, name string, age int, professional string, city string, sex string",
    "products": "product_id long, product_name string, extend_info string",
    "cities": "city_id long, city_name string, area string",
    "tasks": ("task_id long, task_name string, create_time string, start_time string, finish_time string, "
              "task_type string, task_status string, task_param string"),
    "ad_logs": "value string",
}


class Tables:
    """Lazy accessor for raw tables and derived views of one data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        # Times of the data model are UTC wall-clock values.
        zone = spark.conf.get("spark.sql.session.timeZone")
        if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
            raise ValueError(f"spark.sql.session.timeZone is {zone}: the tables need UTC (get_spark sets it)")
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    @staticmethod
    def from_paths(spark: SparkSession, paths: dict[str, str]) -> NativeTables:
        """Tables that are stored as such: view name -> parquet folder or catalog table."""
        return NativeTables(spark, paths)

    def raw(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    def visits(self, start_date: str | None = None, end_date: str | None = None) -> DataFrame:
        """All actions.  With both dates the scan is also cut to the events that can have an
        action in that range; the exact date filter stays the caller's."""
        events = self.raw("events")
        if start_date and end_date:
            low = F.lit(start_date).cast("timestamp_ntz") - F.expr(f"INTERVAL {MAX_LATER} SECONDS")
            high = F.lit(end_date).cast("timestamp_ntz") + F.expr(f"INTERVAL {MAX_EARLIER + 86400} SECONDS")
            events = events.filter((F.col("ts") >= low) & (F.col("ts") <= high))
        return visits_from_events(events)

    def users(self) -> DataFrame:
        return users_from_customer(self.raw("customer"))

    def products(self) -> DataFrame:
        return products_from_part(self.raw("part"))

    def cities(self) -> DataFrame:
        return cities_from_nation(self.raw("nation"), self.raw("region"))

    def ad_logs(self) -> DataFrame:
        return ad_logs_from_events(self.raw("events"), self.raw("nation"))

    def tasks(self) -> DataFrame:
        return tasks_from_region(self.raw("region"))

    def register_views(self, prefix: str = "") -> None:
        """Register the derived views as temp views (``<prefix><name>``) for SQL users."""
        for name in ("visits", "users", "products", "cities", "ad_logs", "tasks"):
            getattr(self, name)().createOrReplaceTempView(prefix + name)


class NativeTables(Tables):
    """The same views over stored tables with the data model's own schemas.

    A table partitioned by ``date`` is pruned by the date filters of the plans.  A path
    (with a ``/``) is read as parquet, another name from the catalog; columns are checked."""

    def __init__(self, spark: SparkSession, paths: dict[str, str]):
        super().__init__(spark, "")
        unknown = set(paths) - set(NATIVE_SCHEMAS)
        if unknown:
            raise ValueError(f"no such view: {sorted(unknown)}; known: {sorted(NATIVE_SCHEMAS)}")
        self.paths = dict(paths)

    def raw(self, name: str) -> DataFrame:
        if name not in self.paths:
            raise LookupError(f"no path was given for {name}")
        path = self.paths[name]
        if "/" in path:  # the declared schema: a date partition stays a string
            return self.spark.read.schema(NATIVE_SCHEMAS[name]).parquet(path)
        df = self.spark.table(path)
        wanted = [c.strip().split(" ") for c in NATIVE_SCHEMAS[name].split(",")]
        missing = [c for c, _ in wanted if c not in df.columns]
        if missing:
            raise ValueError(f"{path} lacks the columns {missing} of {name}")
        return df.select(*[F.col(c).cast(t) for c, t in wanted])

    def visits(self, start_date: str | None = None, end_date: str | None = None) -> DataFrame:
        """All actions, with a row hash as ``action_id`` (the tie-break of equal times)."""
        df = self.raw("visits")
        if start_date and end_date:
            df = df.filter(F.col("date").between(start_date, end_date))
        return df.select(F.xxhash64(*df.columns).alias("action_id"), *df.columns)

    def users(self) -> DataFrame:
        return self.raw("users")

    def products(self) -> DataFrame:
        return self.raw("products")

    def cities(self) -> DataFrame:
        return self.raw("cities")

    def ad_logs(self) -> DataFrame:
        return self.raw("ad_logs")

    def tasks(self) -> DataFrame:
        return self.raw("tasks")

    def register_views(self, prefix: str = "") -> None:
        for name in self.paths:
            getattr(self, name)().createOrReplaceTempView(prefix + name)
