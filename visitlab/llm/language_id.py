"""Language identification: averaged hashed subword embeddings with a linear softmax, trained by SGD in numpy.

A text's bytes are folded (A-Z lower-cased, other ASCII than letters to one blank); every 2- to 4-gram of bytes with
no blank inside it is a subword, hashed to one of BUCKETS embeddings; their average goes through a linear softmax.
As nothing non-linear stands between embedding and softmax, the trained model is folded to one table of
BUCKETS x languages, and a prediction averages its rows.

Training takes a bounded sample of labelled documents (MAX_DOCS, spread evenly over the languages, chosen by a hash
of doc_id): each whole text and a few short windows of it, so that short texts are learned too.  A fifth of the
sample is kept for calibration: the temperature that minimises its log loss, and the score under which a prediction
is rejected: the quantile of right predictions in that fifth that lets the share REJECT of them fall under it, and
nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitlab.llm.textnp import buffers, small

BUCKETS = 1 << 13
DIMS = 16
GRAMS = (2, 3, 4)
MAX_DOCS = 2000
AHEAD = 4
WINDOWS = (3, 8, 25, 80)  # words of the short training windows
EPOCHS, BATCH, RATE = 8, 64, 0.5
BOOST = 200  # embeddings learn faster: one subword is a small share of its text
REJECT = 0.001
UNKNOWN = "und"
_PIECE = 1 << 20  # bytes looked at together

_FOLD = np.full(256, 32, np.uint8)
_FOLD[128:] = np.arange(128, 256)
for _c in range(26):
    _FOLD[65 + _c] = _FOLD[97 + _c] = 97 + _c


class Model(NamedTuple):
    languages: list[str]
    table: np.ndarray  # BUCKETS x languages: embeddings times softmax weights
    bias: np.ndarray
    temperature: float
    threshold: float


def _grams(folded: np.ndarray, first: int, last: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, buckets) of the n-grams that begin in folded[first:last]; they may reach beyond last."""
    for n in GRAMS:
        x = folded[first:min(len(folded), last + n - 1)].astype(np.uint32)
        m = len(x) - n + 1
        if m <= 0:
            continue
        h = np.full(m, n, np.uint32)
        ok = np.ones(m, bool)
        letters = np.zeros(m, bool)
        for i in range(n):
            c = x[i:m + i]
            h = (h ^ c) * np.uint32(0x01000193)
            letters |= c != 32
            if 0 < i < n - 1:
                ok &= c != 32
        ok &= letters & ~((x[:m] == 32) & (x[n - 1:] == 32) & (n == 2))
        at = np.flatnonzero(ok)
        h = h[at]
        h = h ^ (h >> np.uint32(15))
        yield at + first, ((h * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - 13)).astype(np.int64)


def _joined(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Folded bytes with a blank before each row and one at the end, and each row's first place."""
    data, offsets = buffers(column)
    n = len(offsets) - 1
    out = np.full(len(data) + n + 1, 32, np.uint8)
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True), 1):
        out[a + i:b + i] = _FOLD[data[a:b]]
    return out, offsets + np.arange(n + 1)


def features(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text: the buckets that occur, and their share of its subwords."""
    folded, starts = _joined(pa.array(texts, pa.string()))
    out = []
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        count = np.zeros(BUCKETS, np.int64)
        for p in range(a, b, _PIECE):
            for _, bucket in _grams(folded[:b + 1], p, min(b, p + _PIECE)):
                count += np.bincount(bucket, minlength=BUCKETS)
        at = np.flatnonzero(count)
        out.append((at.astype(np.int32), (count[at] / max(1, count.sum())).astype(np.float32)))
    return out


def scores(column: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(probabilities, subwords) per row; whole texts, in pieces of bounded size."""
    folded, starts = _joined(column)
    rows = len(column)
    total, count = np.zeros((rows, len(model.languages))), np.zeros(rows, np.int64)
    for p in range(0, int(starts[-1]), _PIECE):
        for at, bucket in _grams(folded, p, min(int(starts[-1]), p + _PIECE)):
            if len(at) == 0:
                continue
            row = np.searchsorted(starts, at, side="right") - 1
            heads = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            total[row[heads]] += np.add.reduceat(model.table[bucket], heads, axis=0)
            count[row[heads]] += np.diff(np.r_[heads, len(row)])
    logits = (total / np.maximum(count, 1)[:, None] + model.bias) / model.temperature
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True), count


def _batch(examples: list, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets, shares and example numbers of a batch, end to end."""
    at = np.concatenate([examples[i][0] for i in pick])
    return at, np.concatenate([examples[i][1] for i in pick]), np.repeat(np.arange(len(pick)),
                                                                        [len(examples[i][0]) for i in pick])


def fit(examples: list[tuple[np.ndarray, np.ndarray]], labels: list[str], holdout: np.ndarray, seed: int = 7) -> Model:
    """Train on the examples outside the holdout mask, calibrate on those inside it."""
    languages = sorted(set(labels))
    k = len(languages)
    if k == 0:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0), 1.0, 0.0)
    y = np.array([languages.index(v) for v in labels])
    rng = np.random.RandomState(seed)
    e = (rng.randn(BUCKETS, DIMS) * 0.1).astype(np.float32)
    w, bias = (rng.randn(DIMS, k) * 0.1).astype(np.float32), np.zeros(k, np.float32)
    train = np.flatnonzero(~holdout) if (~holdout).any() else np.arange(len(y))
    weight = (len(train) / np.maximum(np.bincount(y[train], minlength=k), 1) / k).astype(np.float32)
    steps, done = EPOCHS * -(-len(train) // BATCH), 0
    for _ in range(EPOCHS):
        order = rng.permutation(train)
        for a in range(0, len(order), BATCH):
            pick = order[a:a + BATCH]
            lr = RATE * (1 - done / steps) + 0.01
            done += 1
            at, share, row = _batch(examples, pick)
            heads = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            h = np.add.reduceat(e[at] * share[:, None], heads, axis=0)
            z = h @ w + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(pick)), y[pick]] -= 1
            p *= weight[y[pick]][:, None] / len(pick)
            gh = p @ w.T
            w -= lr * (h.T @ p)
            bias -= lr * p.sum(axis=0)
            pull = lr * BOOST * share[:, None] * gh[row]
            for d in range(DIMS):
                e[:, d] -= np.bincount(at, weights=pull[:, d], minlength=BUCKETS)
    table = (e @ w).astype(np.float32)

    check = np.flatnonzero(holdout) if holdout.any() else train
    z = np.stack([(table[examples[i][0]] * examples[i][1][:, None]).sum(axis=0) + bias for i in check]).astype(float)

    def prob(t: float) -> np.ndarray:
        q = np.exp((z - z.max(axis=1, keepdims=True)) / t)
        return q / q.sum(axis=1, keepdims=True)

    grid = np.geomspace(0.05, 5, 60)
    loss = [-np.log(prob(t)[np.arange(len(check)), y[check]] + 1e-12).mean() for t in grid]
    temperature = float(grid[int(np.argmin(loss))])
    best = prob(temperature)
    right = np.sort(best.max(axis=1)[best.argmax(axis=1) == y[check]])
    threshold = float(right[int(REJECT * len(right))]) if len(right) else 0.0
    return Model(languages, table, bias.astype(float), temperature, threshold)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          max_docs: int = MAX_DOCS) -> Model:
    """Fit on at most max_docs labelled rows, spread evenly over the languages; all-null labels give an empty model.

    The features of the sample are made on the executors; the driver gets at most max_docs * (1 + windows) sparse rows.
    """
    labelled = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                           F.col(lang_col).alias("lang")).where("lang is not null and doc_id is not null")
    # The first of each language by a hash.  Of a large language only ids whose hash is low enough to be among them are
    # looked at: AHEAD times as many as are taken, by its (approximate) number of ids (a row per language; the model holds them all too).
    order = [F.xxhash64("doc_id", F.lit(5)), "doc_id"]
    sizes = labelled.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("ids"))
    low = (order[0] / F.lit(2.0 ** 64) + 0.5) * F.col("ids") <= AHEAD * max_docs
    chosen = (labelled.select("doc_id", "lang").join(F.broadcast(sizes), "lang").where(low).select("doc_id", "lang").distinct()
              .withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
              .where(F.col("place") <= max_docs)
              .orderBy("place", "lang", "doc_id").limit(max_docs).select("doc_id").distinct())
    sample = labelled.where("text is not null").join(F.broadcast(chosen), "doc_id").orderBy("doc_id").limit(max_docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc_id, text, lang in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "lang")), strict=True):
                words, rng = text.split(), np.random.RandomState(doc_id % (2**31))
                parts = [text]
                for n in WINDOWS:
                    a = rng.randint(0, max(1, len(words) - n))
                    parts.append(" ".join(words[a:a + n]))
                rows += [(doc_id, lang, i.tobytes(), v.tobytes()) for i, v in features(parts) if len(i)]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                columns, (pa.int64(), pa.string(), pa.binary(), pa.binary()), strict=True)],
                ["doc_id", "lang", "at", "share"])

    rows = sample.select("doc_id", "text", "lang").mapInArrow(run, "doc_id long, lang string, at binary, share binary"
                                                              ).collect()
    rows = sorted(rows, key=lambda r: (r[0], r[1], bytes(r[2]), bytes(r[3])))
    examples = [(np.frombuffer(r[2], np.int32), np.frombuffer(r[3], np.float32)) for r in rows]
    ids = np.array([r[0] for r in rows], np.int64)
    return fit(examples, [r[1] for r in rows], (ids * 2654435761 >> 8) % 5 == 0)


def _lettered(column: pa.Array, counts: np.ndarray) -> np.ndarray:
    """Rows with a letter.  Subwords need a letter or a byte over 127; only the latter is looked at again."""
    out = counts > 0
    data, offsets = buffers(column)
    high = np.concatenate([[0], np.cumsum(data >= 128)])
    ascii_letter = np.concatenate([[0], np.cumsum((_FOLD[data] != 32) & (data < 128))])
    doubt = out & (high[offsets[1:]] > high[offsets[:-1]]) & (ascii_letter[offsets[1:]] == ascii_letter[offsets[:-1]])
    for i in np.flatnonzero(doubt):
        out[i] = any(map(str.isalpha, column[int(i)].as_py()))
    return out


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of every row, from its text alone.

    Null, empty or letterless texts: ``und`` with score 0, rejected.  rejected is also true where the calibrated
    score is under the model's threshold.  With a model of no language every row is ``und``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        names = np.array([*model.languages, UNKNOWN], dtype=object)
        for b in small(batches, "text"):
            if model.languages:
                p, n = scores(b.column(1), model)
                known = _lettered(b.column(1), n)
                best, top = np.where(known, p.argmax(axis=1), len(model.languages)), np.where(known, p.max(axis=1), 0.0)
            else:
                best, top = np.zeros(b.num_rows, int), np.zeros(b.num_rows)
                known = np.zeros(b.num_rows, bool)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(names[best], pa.string()), pa.array(top),
                 pa.array(~known | (top < model.threshold))], ["doc_id", "lang_pred", "score", "rejected"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, lang_pred string, score double, rejected boolean")


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows whose language is not rejected, all columns as they came; one scan, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for b in small(batches, text_col):
            if model.languages:
                text = b.column(text_col)
                p, n = scores(text, model)
                keep = _lettered(text, n) & (p.max(axis=1) >= model.threshold)
            else:
                keep = np.zeros(b.num_rows, bool)
            yield b.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
