"""Target-distribution importance resampling over hashed n-grams.

Features are hashed into buckets; an array holds each bucket's gain, the log ratio of its smoothed frequencies in the
target texts and in the corpus.  A document's weight is the mean gain of its features; its score adds Gumbel noise, drawn
from a hash of its id, so the highest scores are a sample without replacement in proportion to the weights' exponentials.

* One scan counts the buckets per task, Spark adds them up, the driver gets ``buckets`` numbers.  A second scan scores.
* The cutoff, the key of the last document drawn, is found exactly by weighted medians of medians: each partition of the
  scores gives the median of its remaining keys and their number; the median of these, weighted by the numbers, is the
  pivot.  Partitions hold at least half of their keys on either side of their own median, so every round puts a quarter
  of what remains on either side of the pivot for certain, and one side goes.  The round that counts around a pivot also
  gives the medians of both sides.  When few keys are left (``FINISH``) they are sorted by themselves.
* Only the documents down to the cutoff are sorted; their ranks are places in the range partitions of that sort.

Defined results: null text or none of the words: weight 0.  The hash of a null id is that of an empty string, and it
comes last among ties.  Repeated rows are documents of their own; rows equal in score and id are drawn in a fixed but
arbitrary order.  An empty target or corpus gives the gains that smoothing alone leaves; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlab.llm.scratch import store

FINISH = 1024  # remaining keys that the driver may sort
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_OTHER = re.compile(rb"[^0-9a-z\x80-\xff]")
_SPAN = 1 << 20  # bytes of a text whose words are in memory at a time
_MEMO = 400_000  # features whose bucket a task remembers
_LAST = (1 << 63) - 1  # stands for a null id in keys


class Buckets(dict):
    """Feature -> bucket, remembered for as many features as ``_MEMO``."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        bucket = zlib.crc32(feature) % self.buckets
        if len(self) >= _MEMO:
            self.clear()
        if len(feature) <= 64:
            self[feature] = bucket
        return bucket


def _spans(text: str) -> Iterator[list[bytes]]:
    """The words of a text, in lists of bounded size."""
    data = text.encode("utf-8", "surrogatepass").lower()
    at = 0
    while at < len(data):
        cut = _OTHER.search(data, at + _SPAN) if len(data) - at > _SPAN else None
        end = cut.start() if cut else len(data)
        yield _WORD.findall(data, at, end)
        at = end


def features(text: str, buckets: Buckets, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(words, buckets of the runs of 1 to ``n`` words that end in them), part by part."""
    tail: list[bytes] = []
    for words in _spans(text):
        found = [np.fromiter(map(buckets.__getitem__, words), np.int64, len(words))]
        if n > 1:
            joined = tail + words
            for k in range(2, n + 1):
                first = max(0, len(tail) - k + 1)
                runs = [b" ".join(joined[i:i + k]) for i in range(first, len(joined) - k + 1)]
                found.append(np.fromiter(map(buckets.__getitem__, runs), np.int64, len(runs)))
            tail = joined[-(n - 1):]
        yield len(words), np.concatenate(found)


def bucket_counts(df: DataFrame, text_col: str, buckets: int, n: int) -> np.ndarray:
    """Features per bucket over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, known = np.zeros(buckets, np.int64), Buckets(buckets)
        for b in batches:
            for text in b.column(0):
                for _, found in features(text.as_py() or "", known, n):
                    total += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    counts = (df.select(F.col(text_col).alias("text")).mapInArrow(run, "bucket long, n long")
              .groupBy("bucket").agg(F.sum("n").alias("n")).collect())
    out = np.zeros(buckets, np.int64)
    for r in counts:
        out[r.bucket] = r.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket ``floor(1000 * ln of the ratio)`` of the smoothed frequencies, as whole numbers."""
    s, t, b = float(corpus.sum()), float(target.sum()), float(len(corpus))
    return np.array([math.floor(1000 * math.log((x + 1) * (s + b) / ((c + 1) * (t + b))))
                     for c, x in zip(corpus.astype(float).tolist(), target.astype(float).tolist(), strict=True)], np.int64)


def noise(id_col: str, seed: int) -> Column:
    """``floor(-1000 * ln(-ln u))`` with u in (0, 1) from the first 32 bits of sha256(``seed:id``)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    u = (F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double") + 0.5) / F.lit(2.0 ** 32)
    return F.floor(-1000 * F.log(-F.log(u))).cast("long")


def score(docs: DataFrame, gain: np.ndarray, n: int = 1, seed: int = 2024, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(id column, n_words, n_features, weight, score) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # one number per bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain, known = shared.value, Buckets(len(shared.value))
        for b in batches:
            words, many, weight = (np.zeros(b.num_rows, np.int64) for _ in range(3))
            for i, text in enumerate(b.column("text")):
                total = 0
                for w, found in features(text.as_py() or "", known, n):
                    words[i] += w
                    many[i] += len(found)
                    total += int(gain[found].sum())
                weight[i] = total // int(many[i]) if many[i] else 0
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(words), pa.array(many), pa.array(weight)],
                                             ["id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return (rows.mapInArrow(run, f"id {kind}, n_words long, n_features long, weight long")
            .withColumn("score", F.col("weight") + noise("id", seed)).withColumnRenamed("id", id_col))


@dataclass(frozen=True)
class Cutoff:
    """Rows drawn have ``(-score, id) <= (low, id)``; ``rounds`` says how many counting jobs it took."""

    low: int
    id: int
    drawn: int
    rounds: int


def _median(low: np.ndarray, ids: np.ndarray) -> tuple[int, int]:
    """The lower median of keys (low, id)."""
    k = (len(low) - 1) // 2
    m = int(np.partition(low, k)[k])
    same = ids[low == m]
    k -= int((low < m).sum())
    return m, int(np.partition(same, k)[k])


def _round(keys: DataFrame, pivot: tuple[int, int] | None) -> list:
    """Per partition: keys before and after the pivot with their medians, and those equal to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(b.column("low").to_numpy(), b.column("id").to_numpy()) for b in batches if b.num_rows]
        if not held:
            return
        low, ids = (np.concatenate(x) for x in zip(*held, strict=True))
        before = np.zeros(len(low), bool)
        after = ~before
        if pivot is not None:
            before = (low < pivot[0]) | ((low == pivot[0]) & (ids < pivot[1]))
            after = (low > pivot[0]) | ((low == pivot[0]) & (ids > pivot[1]))
        row = []
        for side in (before, after):
            m = _median(low[side], ids[side]) if side.any() else (None, None)
            row += [pa.array([int(side.sum())], pa.int64()), *[pa.array([x], pa.int64()) for x in m]]
        equal = pa.array([len(low) - int(before.sum()) - int(after.sum())], pa.int64())
        yield pa.RecordBatch.from_arrays([*row, equal], ["nb", "lb", "ib", "na", "la", "ia", "equal"])

    return keys.mapInArrow(run, "nb long, lb long, ib long, na long, la long, ia long, equal long").collect()


def _weighted(medians: list[tuple[int, int, int]]) -> tuple[int, int]:
    """The median of (low, id, weight) by weight."""
    total, seen = sum(m[2] for m in medians), 0
    for low, i, w in sorted(medians):
        seen += w
        if 2 * seen >= total:
            return low, i
    raise ValueError("no keys")


def find_cutoff(keys: DataFrame, permille: int, finish: int = FINISH) -> Cutoff | None:
    """The cutoff of the first ``floor(permille * N / 1000)`` of keys (low, id), both long and not null; None: no row.

    The keys left are written anew once they are an eighth of the table that is read.
    """
    found = _round(keys, None)
    left = held = sum(r.na for r in found)
    k = drawn = left * permille // 1000
    if not k:
        return None
    rounds, rest = 1, keys
    medians = [(r.la, r.ia, r.na) for r in found]
    while left > finish:
        pivot = _weighted(medians)
        found = _round(rest, pivot)
        rounds += 1
        before, equal = sum(r.nb for r in found), sum(r.equal for r in found)
        here, key = (F.col("low") == pivot[0]), F.col("low")
        if k <= before:
            medians = [(r.lb, r.ib, r.nb) for r in found if r.nb]
            rest, left = rest.where((key < pivot[0]) | (here & (F.col("id") < pivot[1]))), before
        elif k <= before + equal:
            return Cutoff(pivot[0], pivot[1], drawn, rounds)
        else:
            medians = [(r.la, r.ia, r.na) for r in found if r.na]
            rest, left = rest.where((key > pivot[0]) | (here & (F.col("id") > pivot[1]))), left - before - equal
            k -= before + equal
        if left * 8 <= held and left > finish:
            rest, held = store(rest.coalesce(max(1, len(found) // 8)), "resampling-keys"), left
    low, i = sorted((r.low, r.id) for r in rest.collect())[k - 1]
    return Cutoff(low, i, drawn, rounds)


def ranked(rows: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """``rows`` with their place (1, 2, 3...) in ``order``: a range-partitioned sort written once, then one number per
    range partition to start from."""
    at = store(rows.orderBy(*order).withColumn("at", F.monotonically_increasing_id()), "resampling-sorted")
    part = F.shiftright("at", 33)
    sizes = sorted(at.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())  # a row per partition
    first = [0, *itertools.accumulate(r.n for r in sizes)]
    starts = rows.sparkSession.createDataFrame([(r.part, f) for r, f in zip(sizes, first, strict=False)],
                                               "part long, first long")
    place = (F.col("first") + F.col("at") - F.shiftleft("part", 33) + 1).alias(name)
    return (at.withColumn("part", part).join(F.broadcast(starts), "part")
            .select(*[c for c in rows.columns], place))


def resample(docs: DataFrame, target: DataFrame, buckets: int = 10_000, n: int = 1, least_words: int = 20,
             permille: int = 100, seed: int = 2024, id_col: str = "doc_id", text_col: str = "text",
             target_col: str = "text") -> DataFrame:
    """(id column, n_words, n_features, weight, score, rank): every document; those drawn have a rank by (score falling,
    id).  The id column holds whole numbers; of N documents with ``least_words`` words, ``floor(permille * N / 1000)`` are
    drawn."""
    gain = gains(bucket_counts(docs, text_col, buckets, n), bucket_counts(target, target_col, buckets, n))
    scored = store(score(docs, gain, n, seed, id_col, text_col).withColumn("row", F.monotonically_increasing_id()),
                   "resampling-scores")
    enough = F.col("n_words") >= least_words
    low, number = -F.col("score"), F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST))
    names = [id_col, "n_words", "n_features", "weight", "score"]
    undrawn = F.lit(None).cast("long").alias("rank")
    cut = find_cutoff(scored.where(enough).select(low.alias("low"), number.alias("id")), permille)
    if cut is None:
        return scored.select(*names, undrawn)
    top = enough & ((low < cut.low) | ((low == cut.low) & (number <= cut.id)))
    order = [F.desc("score"), F.asc_nulls_last(id_col), F.asc("n_features"), F.asc("weight"), F.asc("row")]
    winners = ranked(scored.where(top), order)
    rank = F.when(F.col("rank") <= cut.drawn, F.col("rank")).alias("rank")
    return winners.select(*names, rank).union(scored.where(~top).select(*names, undrawn))
