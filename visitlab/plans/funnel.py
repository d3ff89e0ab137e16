"""Page-flow conversion along a target flow such as ``1,2,3,4,5``.

Each action is paired with the previous action of its session in time order
(ties by action_id); the pair ``prev_cur`` is a page split.  One aggregate counts
the flow's first page and each of its splits (0 for those nobody took).  Conversion: first split pv / start
page pv, later splits pv / previous split pv; 2 decimals half-up; divisor 0 ->
null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from visitlab.functions import filters
from visitlab.functions.numbers import ratio_half_up
from visitlab.operators.sequence import with_previous
from visitlab.sources.params import TaskParams


def flow_splits(spark: SparkSession, flow: list[int]) -> DataFrame:
    """(position, page_split, from_page, to_page) for consecutive flow pages."""
    rows = [(i + 1, f"{a}_{b}", int(a), int(b)) for i, (a, b) in enumerate(zip(flow, flow[1:]))]
    return spark.createDataFrame(rows, "position int, page_split string, from_page long, to_page long")


def _actions(visits: DataFrame, params: TaskParams) -> DataFrame:
    return filters.apply(visits, [filters.between("date", params.start_date, params.end_date)])


def paired_actions(actions: DataFrame) -> DataFrame:
    """Every action with ``prev_page``, the page of the previous action of its
    session in (action_time, action_id) order (null for a session's first action)."""
    return with_previous(actions.select("session_id", "action_time", "action_id", "page_id"),
                         group=["session_id"], order=["action_time", "action_id"],
                         value="page_id", out="prev_page")


def page_pairs(actions: DataFrame) -> DataFrame:
    """(session_id, prev_page, page_id) for every action with a predecessor."""
    return (paired_actions(actions).filter(F.col("prev_page").isNotNull())
            .select("session_id", "prev_page", "page_id"))


def _position_counts(spark: SparkSession, paired: DataFrame, params: TaskParams) -> DataFrame:
    """(position, page_split, pv): position 0 counts the flow's first page, position i its i-th split.

    One global aggregate with a counter per position, so the paired actions are read once;
    its single row is laid out as one row per position (parameter-sized)."""
    flow = params.page_flow
    counters = [F.count_if(F.col("page_id") == flow[0])]
    names = [None]
    for a, b in zip(flow, flow[1:]):
        counters.append(F.count_if((F.col("prev_page") == a) & (F.col("page_id") == b)))
        names.append(f"{a}_{b}")
    row = paired.agg(*[c.alias(f"c{i}") for i, c in enumerate(counters)])
    items = [F.struct(F.lit(i).alias("position"), F.lit(n).cast("string").alias("page_split"), F.col(f"c{i}").alias("pv"))
             for i, n in enumerate(names)]
    return row.select(F.inline(F.array(*items)))


def page_split_pv(spark: SparkSession, visits: DataFrame, params: TaskParams) -> DataFrame:
    """Pv of every split of the flow (0 when never taken)."""
    return _position_counts(spark, paired_actions(_actions(visits, params)), params).filter(F.col("position") >= 1)


def start_page_pv(visits: DataFrame, params: TaskParams) -> DataFrame:
    """Number of views of the flow's first page (one row)."""
    first = params.page_flow[0]
    return _actions(visits, params).agg(F.count_if(F.col("page_id") == first).alias("start_page_pv"))


def page_convert_rate(spark: SparkSession, visits: DataFrame, params: TaskParams) -> DataFrame:
    """One row per split: position, page_split, pv, convert_rate.

    Split counts and the start-page count come from one aggregate over the paired
    actions: besides the check for hot sessions, the actions are scanned once."""
    counts = _position_counts(spark, paired_actions(_actions(visits, params)), params)
    # Position 0 carries the start-page pv, so "previous pv" is a lag over the
    # flow positions.  The table has one row per flow page (parameter-sized),
    # so this unpartitioned window is bounded.
    w = Window.orderBy("position")
    return (counts.withColumn("convert_rate", ratio_half_up("pv", F.lag("pv").over(w)))
            .filter(F.col("position") >= 1)
            .select("position", "page_split", "pv", "convert_rate"))


def convert_string(rates: DataFrame) -> DataFrame:
    """C6, stored form: ``1_2=0.5|2_3=0.33|...`` in flow order (one row)."""
    item = F.struct("position", F.concat_ws("=", "page_split", F.col("convert_rate").cast("string")).alias("s"))
    return rates.agg(F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["s"]), "|")
                     .alias("convert_rate"))


def page_convert_string(spark: SparkSession, visits: DataFrame, params: TaskParams) -> DataFrame:
    return convert_string(page_convert_rate(spark, visits, params))
