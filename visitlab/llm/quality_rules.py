"""Quality rules with risk-controlled cutoffs; DataFrame functions only.

Every rule scores a document (higher is worse) and rejects scores above a cutoff from a fixed grid.  All rules of a
stratum are tightened together along one path, and one test per step controls what they reject together:

* A third of the labelled documents (by a hash of doc_id) shapes the path: per stratum and rule, the cutoff that gains
  most there (labelled bad documents rejected, less PRICE per good one).  Step t of STEPS takes every rule t/STEPS of the
  way from its most lenient cutoff to that one; a rule without a gain stays out.
* The other labelled good documents are the holdout.  With k of n of them rejected by any rule at a step, the exact
  binomial tail P(X <= k | n, alpha) <= delta proves that the step's false rejection rate is at most alpha (this is the
  Clopper-Pearson upper bound, turned round).  The path is walked from lenient to strict up to the first failure
  (fixed-sequence testing, no correction within a stratum); delta is divided by the number of strata (Bonferroni).
* Of the proven steps the one that gains most is taken.  A stratum with too few labels to prove anything (alpha 0.05
  and five strata take 90 good documents in the holdout) rejects nothing beyond the base rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlab.llm.scratch import store

BLANK = r"[\x20\x09-\x0D]+"
NOT_BLANK = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
# Rule, the most lenient cutoff; the others follow at 0.9 of the one before.
RULES = {"symbols_per_word": 5.0, "dup_line_share": 1.0, "repeat_word_share": 1.0, "chars_per_word": 100.0,
         "capital_share": 1.0}
GRID = STEPS = 60
SHAPING = 3  # one in so many labelled documents shapes the path
ALPHA, DELTA, PRICE = 0.05, 0.05, 10.0
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
_PLACE = (1 << 26) - 1  # bits for a word's place; the others hold its window's hash
_NONE = "\x00"


def _repeat_words(w: Column) -> Column:
    """Words inside 3-word windows that occur twice or more.

    Windows whose hash bits meet are candidates (a sort of longs); they are then compared word by word, so equal
    hashes of different windows do not count.
    """
    def at(i: Column, k: int) -> Column:
        return F.get(w, i.cast("int") + F.lit(k - 1))

    last = F.size(w) - 2
    keys = F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(at(i, 0), at(i, 1), at(i, 2))
                       .bitwiseAND(F.lit(~_PLACE)).bitwiseOR(i.cast("long")))
    return F.when(last >= 1, F.sort_array(keys)).otherwise(F.array().cast("array<bigint>"))


def _neighbours(s: Column, of) -> Column:
    """The items of a sorted array that are equal, by ``of``, to the one before or after."""
    return F.filter(s, lambda x, i: F.coalesce(of(x) == of(F.get(s, i - 1)), F.lit(False))
                    | F.coalesce(of(x) == of(F.get(s, i + 1)), F.lit(False)))


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """(doc_id, stratum, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, rule scores) per row."""
    t = F.col("text")
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(stratum_col).cast("string").alias("stratum"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    d = d.select("doc_id", "stratum", "text", F.array_remove(F.split(t, BLANK), "").alias("w"),
                 F.filter(F.split(t, "\n"), lambda x: x.rlike(NOT_BLANK)).alias("lines"),
                 F.regexp_count(t, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
                 F.regexp_count(t, F.lit("[A-Z]")).cast("long").alias("n_capitals"))
    d = d.select("doc_id", "stratum", "w", F.size("w").cast("long").alias("n_words"),
                 F.length(F.array_join("w", "")).cast("long").alias("word_chars"), "n_symbols", "n_capitals",
                 F.size("lines").alias("n_lines"),
                 (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                 _repeat_words(F.col("w")).alias("keys"))
    w = F.col("w")
    met = _neighbours(F.col("keys"), lambda x: F.shiftright(x, 26))
    place = F.transform(met, lambda x: x.bitwiseAND(F.lit(_PLACE)).cast("int"))
    d = d.withColumn("place", place).drop("keys")
    windows = F.sort_array(F.transform("place", lambda p: F.struct(
        F.concat_ws(" ", F.get(w, p - 1), F.get(w, p), F.get(w, p + 1)).alias("k"), p.alias("p"))))
    d = d.withColumn("windows", windows).drop("w", "place")
    d = d.withColumn("hits", F.sort_array(F.transform(_neighbours(F.col("windows"), lambda x: x["k"]),
                                                      lambda x: x["p"]))).drop("windows")
    covered = F.aggregate("hits", F.struct(F.lit(0).alias("n"), F.lit(-3).alias("p")),
                          lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["p"])).alias("n"), p.alias("p")),
                          lambda a: a["n"].cast("long"))
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return d.withColumn("n_repeat_words", covered).select(
        "doc_id", "stratum", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("n_symbols") / words).alias("symbols_per_word"),
        (F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))).alias("dup_line_share"),
        (F.col("n_repeat_words") / words).alias("repeat_word_share"),
        (F.col("word_chars") / words).alias("chars_per_word"),
        (F.col("n_capitals") / F.greatest(F.col("word_chars"), F.lit(1))).alias("capital_share"))


def allowed_rejections(n: Column, alpha: Column, delta: Column) -> Column:
    """The largest k with P(X <= k | n, alpha) <= delta, or -1: terms of the tail are summed from their logarithms."""
    first = n * F.log(1 - alpha)
    odds = F.log(alpha / (1 - alpha))

    def add(a: Column, i: Column) -> Column:
        log_term = F.when(i == 0, first).otherwise(a["t"] + F.log((n - i + 1) / i) + odds)
        total = a["s"] + F.exp(log_term)
        return F.struct(log_term.alias("t"), total.alias("s"), F.when(total <= delta, i).otherwise(a["k"]).alias("k"))

    start = F.struct(F.lit(0.0).alias("t"), F.lit(0.0).alias("s"), F.lit(-1).cast("long").alias("k"))
    return F.aggregate(F.sequence(F.lit(0).cast("long"), F.ceil(n * alpha)), start, add, lambda a: a["k"])


def cutoffs(scored: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
            alpha: float = ALPHA, delta: float = DELTA, price: float = PRICE) -> DataFrame:
    """(stratum, one cutoff column per rule; null: no cutoff) from scored documents and 0/1 labels.

    Rows without id or label are left out; a doc_id labelled more than once counts once, by its lowest label.
    """
    marks = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("good"))
             .where("doc_id is not null and good is not null").groupBy("doc_id").agg(F.min("good").alias("good")))
    grid = {r: [top * 0.9 ** i for i in range(GRID)] for r, top in RULES.items()}

    def first(rule: str) -> Column:
        """The most lenient cutoff, 0 to GRID - 1, that rejects the document; GRID if none does."""
        return F.size(F.filter(F.array(*[F.lit(c) for c in grid[rule]]), lambda c: ~(F.col(rule) > c)))

    held = store(scored.join(marks, "doc_id").select(
        F.coalesce("stratum", F.lit(_NONE)).alias("stratum"), (F.col("good") >= 1).cast("long").alias("g"),
        (F.pmod(F.xxhash64("doc_id", F.lit(4)), F.lit(SHAPING)) == 0).alias("shapes"),
        *[first(r).alias(f"i_{r}") for r in RULES]), "op4-held")
    strata = held.agg(F.countDistinct("stratum")).first()[0] or 1
    good, bad = F.sum("g").alias("good"), F.sum(1 - F.col("g")).alias("bad")
    gain = F.col("hit") - price * F.col("k")

    # the end of the path: per stratum and rule the cutoff of the greatest gain
    own = (held.where("shapes").select("stratum", "g", F.explode(F.array(*[F.struct(
        F.lit(r).alias("rule"), F.col(f"i_{r}").alias("i")) for r in RULES])).alias("x")).select("stratum", "g", "x.*")
        .where(F.col("i") < GRID).groupBy("stratum", "rule", "i").agg(good, bad))
    up = Window.partitionBy("stratum", "rule").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = (own.withColumn("k", F.sum("good").over(up)).withColumn("hit", F.sum("bad").over(up)).where(gain > 0)
            .groupBy("stratum", "rule").agg(F.max_by("i", F.struct(gain, -F.col("i"))).alias("i")))
    ends = store(ends.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r, F.col("i"))).alias(f"end_{r}")
                                               for r in RULES]), "op4-ends")

    # the step at which a document is rejected first, by any rule
    def step(rule: str) -> Column:
        i, end = F.col(f"i_{rule}"), F.col(f"end_{rule}")
        return F.when(i <= end, F.greatest(F.lit(1), F.ceil(i * STEPS / F.greatest(end, F.lit(1)))))

    walked = (held.join(ends, "stratum").withColumn("t", F.least(*[step(r) for r in RULES]).cast("int"))
              .groupBy("stratum", "t", "shapes").agg(good, bad))
    walked = store(walked.groupBy("stratum", "t").agg(
        F.sum(F.when(~F.col("shapes"), F.col("good")).otherwise(0)).alias("proof"),
        F.sum("good").alias("good"), F.sum("bad").alias("bad")), "op4-path")
    n = walked.groupBy("stratum").agg(F.sum("proof").alias("n")).withColumn(
        "most", allowed_rejections(F.col("n"), F.lit(alpha), F.lit(delta / strata)))
    up = Window.partitionBy("stratum").orderBy("t").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    best = (walked.where("t is not null").withColumn("tested", F.sum("proof").over(up))
            .withColumn("k", F.sum("good").over(up)).withColumn("hit", F.sum("bad").over(up)).join(n, "stratum")
            .where((F.col("tested") <= F.col("most")) & (gain > 0))
            .groupBy("stratum").agg(F.max_by("t", F.struct(gain, -F.col("t"))).alias("t")))

    def cutoff(rule: str, top: float) -> Column:
        end = F.col(f"end_{rule}")  # null: the rule stays out
        return F.when(end.isNotNull(), F.lit(top) * F.pow(F.lit(0.9), F.floor(end * F.col("t") / STEPS))).alias(f"cut_{rule}")

    return best.join(ends, "stratum").select("stratum", *[cutoff(r, top) for r, top in RULES.items()])


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          stratum_col: str = "lang", **options: float) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept), one row per row.

    Null and empty texts have no words and fail the base.  Documents without a stratum are a stratum of their own.
    """
    scored = store(features(docs, id_col, text_col, stratum_col), "op4-features")
    cut = store(cutoffs(scored, labels, **options), "op4-cutoffs").withColumnRenamed("stratum", "key")
    d = scored.withColumn("key", F.coalesce("stratum", F.lit(_NONE))).join(cut, "key", "left")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    above = F.lit(False)
    for r in RULES:
        above = above | F.coalesce(F.col(r) > F.col(f"cut_{r}"), F.lit(False))
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    failed.alias("base_failed"), (~failed & ~above).alias("kept"))
