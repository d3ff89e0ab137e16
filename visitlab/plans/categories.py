"""Top-10 categories by (click, order, pay) counts and the top-10 sessions in each.

Category ids come from three places of an action row: ``click_category_id``
(scalar), ``order_category_ids`` and ``pay_category_ids`` (comma lists).  All
three are turned into one long (category_id, kind) stream with ``explode``, so
visited categories and all three counts come out of a single grouped
aggregation -- one shuffle, map-side combined, no joins.  The three
left-outer-join form is kept as :func:`category_counts_join`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlab.functions.strings import comma_items
from visitlab.operators.broadcast import broadcast_fixed
from visitlab.operators.topk import top_k, top_k_per_group
from visitlab.plans.sessions import DETAIL_COLUMNS

COUNT_COLUMNS = ["category_id", "click_count", "order_count", "pay_count"]


def explode_category_ids(actions: DataFrame, column: str = "order_category_ids") -> DataFrame:
    """One row per item of a comma list column (null / empty lists give no row)."""
    return actions.select("action_id", "session_id",
                          F.explode(comma_items(column)).alias("category_id")) \
        .withColumn("category_id", F.col("category_id").try_cast("long"))


def _category_events(actions: DataFrame, *keep: str) -> DataFrame:
    """(category_id, kind) per category occurrence; kind 0 click, 1 order, 2 pay."""
    events = F.concat(
        F.when(F.col("click_category_id").isNotNull(),
               F.array(F.struct(F.col("click_category_id").cast("long").alias("category_id"),
                                F.lit(0).alias("kind"))))
        .otherwise(F.array().cast("array<struct<category_id:bigint,kind:int>>")),
        F.transform(comma_items("order_category_ids"),
                    lambda x: F.struct(x.try_cast("long").alias("category_id"), F.lit(1).alias("kind"))),
        F.transform(comma_items("pay_category_ids"),
                    lambda x: F.struct(x.try_cast("long").alias("category_id"), F.lit(2).alias("kind"))),
    )
    return actions.select(*keep, F.inline(events))


def visited_categories(actions: DataFrame) -> DataFrame:
    """Distinct category ids clicked, ordered or paid."""
    return _category_events(actions).select("category_id").distinct()


def category_counts(actions: DataFrame) -> DataFrame:
    """A8 / JN8: click, order and pay counts of every visited category (0 if none)."""
    ev = _category_events(actions)
    return ev.groupBy("category_id").agg(
        F.count(F.when(F.col("kind") == 0, 1)).alias("click_count"),
        F.count(F.when(F.col("kind") == 1, 1)).alias("order_count"),
        F.count(F.when(F.col("kind") == 2, 1)).alias("pay_count"))


def category_counts_join(actions: DataFrame) -> DataFrame:
    """JN8, join form: visited categories left-joined to the three per-kind counts."""
    clicks = (actions.filter(F.col("click_category_id").isNotNull())
              .groupBy(F.col("click_category_id").cast("long").alias("category_id"))
              .agg(F.count(F.lit(1)).alias("click_count")))
    orders = (explode_category_ids(actions, "order_category_ids")
              .groupBy("category_id").agg(F.count(F.lit(1)).alias("order_count")))
    pays = (explode_category_ids(actions, "pay_category_ids")
            .groupBy("category_id").agg(F.count(F.lit(1)).alias("pay_count")))
    out = (visited_categories(actions)
           .join(clicks, "category_id", "left")
           .join(orders, "category_id", "left")
           .join(pays, "category_id", "left"))
    return out.select("category_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c)
                                       for c in ("click_count", "order_count", "pay_count")])


def top10_category(actions: DataFrame, k: int = 10) -> DataFrame:
    """C4: categories by click, then order, then pay count, all descending; ties by id."""
    return top_k(category_counts(actions),
                 [F.col("click_count").desc(), F.col("order_count").desc(),
                  F.col("pay_count").desc(), F.col("category_id").asc()], k)


def session_category_clicks(actions: DataFrame) -> DataFrame:
    """A10: clicks per (session, category)."""
    return (actions.filter(F.col("click_category_id").isNotNull())
            .groupBy("session_id", F.col("click_category_id").cast("long").alias("category_id"))
            .agg(F.count(F.lit(1)).alias("click_count")))


def top10_session(actions: DataFrame, top_categories: DataFrame, k: int = 10) -> DataFrame:
    """In each top category, the k sessions with most clicks (ties: session_id).

    ``top_categories`` is a top-k result (at most 10 rows), so broadcasting it is
    bounded by construction."""
    cats = broadcast_fixed(top_categories.select(F.col("category_id").alias("click_category_id")))
    # Keep only clicks of the top categories before the (session, category) shuffle.
    per = session_category_clicks(actions.join(cats, "click_category_id", "left_semi"))
    return top_k_per_group(per, ["category_id"],
                           [F.col("click_count").desc(), F.col("session_id").asc()], k) \
        .select("category_id", "session_id", "click_count")


def session_category_kind_counts(actions: DataFrame) -> DataFrame:
    """Clicks per (session, category), orders and pays per category (no session), as (session_id, category_id, kind, n):
    one partial + final aggregate from which both the category ranking and the per-session clicks follow."""
    events = _category_events(actions, "session_id")
    return (events.withColumn("session_id", F.when(F.col("kind") == 0, F.col("session_id")))
            .groupBy("session_id", "category_id", "kind").agg(F.count(F.lit(1)).alias("n")))


def top_categories_and_sessions(actions: DataFrame, k_categories: int = 10, k_sessions: int = 10):
    """C4 + C5 from one scan of the actions.

    Both results are computed from the same counts, kept per session for clicks
    only, so the plan shuffles the actions once and the second branch reuses
    that exchange."""
    per = session_category_kind_counts(actions)
    counts = per.groupBy("category_id").agg(
        *[F.sum(F.when(F.col("kind") == i, F.col("n")).otherwise(F.lit(0))).cast("long").alias(c)
          for i, c in enumerate(("click_count", "order_count", "pay_count"))])
    top_cats = top_k(counts, [F.col("click_count").desc(), F.col("order_count").desc(),
                              F.col("pay_count").desc(), F.col("category_id").asc()], k_categories)
    clicks = (per.filter(F.col("kind") == 0)
              .join(broadcast_fixed(top_cats.select("category_id")), "category_id", "left_semi")
              .select("category_id", "session_id", F.col("n").alias("click_count")))
    top_sess = top_k_per_group(clicks, ["category_id"],
                               [F.col("click_count").desc(), F.col("session_id").asc()], k_sessions)
    return top_cats, top_sess


def top10_session_detail(actions: DataFrame, top_sessions: DataFrame) -> DataFrame:
    """JN5: detail rows of the top sessions, each action once (at most 100 ids, broadcast)."""
    ids = broadcast_fixed(top_sessions.select("session_id").distinct())
    return actions.join(ids, "session_id", "left_semi").select(*DETAIL_COLUMNS)
