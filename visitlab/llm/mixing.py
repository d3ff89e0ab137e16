"""Mixing sources to target weights by entropy balancing.

Each document gets a rate r in [0, cap].  Among all rates that meet every source's word target, those nearest to one
copy of each document, in the sense of least sum of r ln r - r + 1, are r = min(cap, exp(lambda_source * x)) with x
the document's size over the mean size of its source.  The lambdas maximise a concave dual; each Newton step sums the
gradient and curvature of all sources over the (source, size) histogram in one Spark aggregation, and a bracket
guards it.  Rates become whole copies by carrying each size's rounding error on to the next smaller size.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitlab.llm.scratch import store

WORD = r"[^\x20\x09-\x0D]+"
SALTS = 1024  # parts of one (source, size) cell when its documents are ranked
STEPS = 60


def _ranked(sources: DataFrame) -> DataFrame:
    """Adds rank: the place of each source by code point, null last.  No task sees more than its sorted range."""
    ordered = store(sources.orderBy(F.col("source").asc_nulls_last())
                    .withColumn("at", F.monotonically_increasing_id()), "op8-sources")
    part = F.shiftright("at", 33)
    counts = ordered.groupBy(part.alias("part")).count().collect()  # one row per partition
    before, offsets = 0, []
    for p, n in sorted((r[0], r[1]) for r in counts):
        offsets.append((p, before))
        before += n
    offsets = ordered.sparkSession.createDataFrame(offsets or [(0, 0)], "part long, before long")
    return (ordered.withColumn("part", part).join(F.broadcast(offsets), "part")
            .withColumn("rank", F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)))
            .drop("part", "before", "at"))


def targets(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0
            ) -> DataFrame:
    """(source, source_size, docs, rank, target) from (source, size).

    Sources in code point order, null last, take the weights in turn and share ``share`` of all words by weight.
    A target stops at cap times its source's size; what is over is shared anew by weight until none is above.
    """
    s = _ranked(sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs")))
    w = F.array(*[F.lit(float(x)) for x in weights])[F.pmod("rank", F.lit(len(weights))).cast("int")]
    s = store(s.withColumn("weight", w), "op8-weights")
    total = share * (s.agg(F.sum("source_size")).first()[0] or 0)
    level, stopped = 0.0, -1
    while True:  # each round stops at least one more source
        over = F.lit(level) * F.col("weight") >= cap * F.col("source_size") if stopped >= 0 else F.lit(False)
        r = s.agg(F.sum(over.cast("long")), F.sum(F.when(over, cap * F.col("source_size")).otherwise(0.0)),
                  F.sum(F.when(over, 0.0).otherwise(F.col("weight")))).first()
        if r[0] is None or r[0] == stopped or not r[2]:
            break
        stopped, level = r[0], max(0.0, total - r[1]) / r[2]
    if share >= cap:
        level = float("inf")
    return s.withColumn("target", F.least(F.lit(level) * F.col("weight"), cap * F.col("source_size"))).drop("weight")


def balance(cells: DataFrame, goals: DataFrame, cap: float = 2.0, tolerance: float = 1e-7, steps: int = STEPS
            ) -> DataFrame:
    """(src, lam, x_unit) for cells (src, size, n) and goals (src, target, mean): the dual's optimum by Newton."""
    state = store(goals.where("target > 0 and target < full").select(
        "src", "target", F.col("mean").alias("x_unit"), F.log(F.col("target") / F.col("full") * cap).alias("lam"),
        F.lit(-1e6).alias("lo"), F.lit(1e6).alias("hi"), F.lit(False).alias("done")), "op8-lambda")
    words = F.col("n") * F.col("size")
    x = F.col("size") / F.col("x_unit")
    rate = F.least(F.lit(float(cap)), F.exp(F.least(F.col("lam") * x, F.lit(50.0))))
    for _ in range(steps):
        sums = (cells.join(state, "src").where(~F.col("done")).groupBy("src")
                .agg(F.sum(words * rate).alias("got"),
                     F.sum(F.when(rate < cap, words * rate * x).otherwise(0.0)).alias("slope")))
        step = state.join(sums, "src", "left")
        lo = F.when(F.col("got") <= F.col("target"), F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(F.col("got") > F.col("target"), F.col("lam")).otherwise(F.col("hi"))
        step = (step.withColumn("newton", F.col("lam") + (F.col("target") - F.col("got")) / F.col("slope"))
                .withColumn("lo", lo).withColumn("hi", hi)
                .withColumn("done", F.col("done") | (F.abs(F.col("got") / F.col("target") - 1) < tolerance)))
        middle = (F.when(F.col("lo") <= -1e6, 2 * F.col("lam") - F.abs("lam") - 1)  # no lower bracket yet
                  .when(F.col("hi") >= 1e6, F.col("lam") + F.abs("lam") + 1)
                  .otherwise((F.col("lo") + F.col("hi")) / 2))
        inside = F.col("newton").isNotNull() & (F.col("newton") > F.col("lo")) & (F.col("newton") < F.col("hi")) & (
            F.abs(F.col("newton") - F.col("lam")) < 2 + 2 * F.abs("lam"))
        state = store(step.withColumn("lam", F.when(F.col("done"), F.col("lam")).when(inside, F.col("newton"))
                                      .otherwise(middle)).drop("newton", "got", "slope"), "op8-lambda")
        if not state.where(~F.col("done")).take(1):
            break
    return state.select("src", "lam", "x_unit")


def _copies(cap: float):
    """Copies of each size of one source, largest first, carrying the missing words on.

    A group holds one row per distinct size: at most sqrt(2 * words of the source) rows.
    """
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("size", ascending=False)
        size, n, rate = (rows[c].to_numpy() for c in ("size", "n", "rate"))
        out, carry = np.zeros(len(rows), np.int64), 0.0
        for i in range(len(rows)):
            carry += float(n[i]) * rate[i] * size[i]
            out[i] = min(max(int(np.floor(carry / size[i] + 0.5)), 0), int(cap * n[i]))
            carry -= float(out[i]) * size[i]
        return pd.DataFrame({"src": rows["src"].to_numpy(), "size": size, "all_copies": out, "n": n, "rate": rate})
    return run


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(doc_id, source, size, source_size, target, rate, copies, taken), one row per input row.

    size: words of the text (null: 0).  Documents of size 0 and sources of target 0 get no copies.  Null sources are
    one source.  Ties of a size are broken by a hash of doc_id, so reruns agree; repeated rows are separate
    documents.  An empty table gives an empty result.  cap is a whole number.
    """
    sizes = store(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                              F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long").alias("size")),
                  "op8-sizes")
    goals = (targets(sizes, weights, share, cap).withColumnRenamed("rank", "src")
             .withColumn("mean", F.col("source_size") / F.col("docs")).withColumn("full", cap * F.col("source_size")))
    goals = store(goals, "op8-goals")
    keys = goals.select(F.col("source").alias("s"), "src")
    counts = (sizes.where("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")))
    cells = store(counts.join(keys, counts["source"].eqNullSafe(keys["s"])).select("src", "size", "n"), "op8-cells")
    lam = balance(cells, goals, float(cap))
    rate = (F.when(F.col("target") >= F.col("full"), F.lit(float(cap))).when(F.col("target") <= 0, F.lit(0.0))
            .otherwise(F.least(F.lit(float(cap)), F.exp(F.least(F.col("lam") * F.col("size") / F.col("x_unit"),
                                                                F.lit(50.0))))))
    cells = (cells.join(goals.select("src", "target", "full"), "src").join(lam, "src", "left")
             .select("src", "size", "n", rate.alias("rate")))
    cells = store(cells.groupBy("src").applyInPandas(
        _copies(cap), "src long, size long, all_copies long, n long, rate double"), "op8-copies")

    # the documents of one cell, in hash order, take the cell's copies; a cell is ranked in SALTS parts
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))
    g = goals.select(F.col("source").alias("s"), "src", "source_size", "target")
    tagged = store(sizes.join(g, sizes["source"].eqNullSafe(g["s"])).drop("s").withColumn("salt", salt), "op8-tagged")
    parts = tagged.where("size > 0").groupBy("src", "size", "salt").agg(F.count(F.lit(1)).alias("m"))
    ahead = F.sum("m").over(Window.partitionBy("src", "size").orderBy("salt").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)) - F.col("m")
    parts = store(parts.select("src", "size", "salt", ahead.alias("ahead")).join(cells, ["src", "size"]), "op8-parts")
    place = F.row_number().over(Window.partitionBy("src", "size", "salt").orderBy(F.xxhash64("doc_id", F.lit(8)),
                                                                                 "doc_id")) - 1
    ranked = tagged.withColumn("place", place).join(parts, ["src", "size", "salt"], "left")
    each = F.floor(F.col("all_copies") / F.col("n"))
    extra = (F.col("ahead") + F.col("place") < F.col("all_copies") - each * F.col("n")).cast("long")
    copies = F.coalesce(each + extra, F.lit(0)).cast("long")
    return ranked.select("doc_id", "source", "size", "source_size", "target",
                         F.coalesce("rate", F.lit(0.0)).alias("rate"), copies.alias("copies"),
                         (copies * F.col("size")).alias("taken"))
