"""Packing, whitening and resampling against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from visitlab.llm import packing as P
from visitlab.llm import resampling as R
from visitlab.llm import whitening as W

BPE = public_tokenizers.path("byte_bpe_50k.json")


# ---------------------------------------------------------------- packing

def slow_ids(texts):
    t = Tokenizer.from_file(BPE)
    t.encode_special_tokens = True
    return [[*t.encode(x or "", add_special_tokens=False).ids, 1] for x in texts]


def odd_texts():
    rng = random.Random(3)
    space = [" ", "  ", "\n", " \n", "\t", "\t ", "\xa0", "\x1c", "　 ", "\x85"]
    bits = ["don't", "naïve", "日本語", "<|endoftext|>", "x" * 60, "12,5", "!?", "🙂", "a", "\x00", "WORD", "'s"]
    made = ["".join(rng.choice(bits) + rng.choice(space) for _ in range(rng.randrange(12))) for _ in range(300)]
    return [*made, *["".join(rng.choice(space) for _ in range(4)) + "end" for _ in range(30)], " ", "\n", " a", "a ", ""]


@pytest.mark.parametrize("way", ["by rank", "by piece", "whole"])
def test_encoder_equals_whole_texts(way):
    encoder = P.Encoder(open(BPE, encoding="utf-8").read())
    assert encoder.by_piece and encoder.ranks is not None
    encoder.by_piece = way != "whole"
    encoder.ranks = encoder.ranks if way == "by rank" else None
    texts = odd_texts()
    for a in range(0, len(texts), 50):
        found = encoder(pa.array([None, *texts[a:a + 50]]).slice(1))
        for text, ids, want in zip(texts[a:a + 50], found, slow_ids(texts[a:a + 50]), strict=True):
            assert np.frombuffer(ids, encoder.dtype).tolist() == want[:-1], repr(text)


def slow_assign(sizes, capacity, cost=P.Cost()):
    """The greedy rule on single tails: longest first, to the sequence of lowest cost with room, else cut."""
    total = sum(sizes)
    rooms = [capacity] * (total // capacity) + [1 << b for b in reversed(range(12)) if (total % capacity) >> b & 1]
    spent = [0] * len(rooms)
    todo = sorted(sizes, reverse=True)
    while todo:
        n = todo.pop(0)
        fit = [i for i, r in enumerate(rooms) if r >= n]
        if fit:
            i = min(fit, key=lambda j: (spent[j], j))
        else:
            i = max(range(len(rooms)), key=lambda j: (rooms[j], -spent[j]))
        k = min(n, rooms[i])
        rooms[i] -= k
        spent[i] += cost(k)
        if k < n:
            todo = sorted([*todo, n - k], reverse=True)
    return sorted(spent)


@pytest.mark.parametrize("seed", range(6))
def test_assign_is_the_greedy_rule(seed):
    rng = random.Random(seed)
    capacity = rng.choice([16, 64])
    sizes = [rng.choice([1, 2, capacity // 2, rng.randrange(1, capacity)]) for _ in range(rng.randrange(1, 120))]
    tails = defaultdict(int)
    for n in sizes:
        tails[n] += 1
    plan = P.assign(tails, capacity)
    placed, covered = defaultdict(list), defaultdict(list)
    for level, tail, rank, count, start, length, seq, offset in plan.tolist():
        for i in range(count):
            placed[seq + i].append((offset, length))
            covered[tail, rank + i].append((start, length))
    assert sorted(covered) == sorted((n, i) for n, c in tails.items() for i in range(c))
    for (tail, _), runs in covered.items():
        at = 0
        for start, length in sorted(runs):
            assert start == at
            at += length
        assert at == tail
    for runs in placed.values():
        assert [o for o, _ in sorted(runs)] == list(np.cumsum([0] + [n for _, n in sorted(runs)])[:-1])
        n = sum(n for _, n in runs)
        assert n == capacity or n & (n - 1) == 0
    cost = P.Cost()
    assert sorted(sum(cost(n) for _, n in runs) for runs in placed.values()) == slow_assign(sizes, capacity)


def test_plan_does_not_grow_with_the_corpus():
    rng = random.Random(1)
    tails = {n: rng.randrange(1, 40) for n in range(1, 2048)}
    few, many = P.assign(tails, 2048), P.assign({n: c * 1_000_000 for n, c in tails.items()}, 2048)
    assert len(many) < 3 * len(few)


def test_pack_covers_every_id_once(spark):
    texts = [*odd_texts(), None, "word " * 5000, "word " * 5000, "tok" * 3000, *["tail of a text"] * 40]
    rows = [(None if i == 7 else i, x, i, "x") for i, x in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, length int, ids string").repartition(5)
    got = P.pack(df, BPE, capacity=256).collect()
    ids = dict(zip([r[0] for r in rows], slow_ids(texts), strict=True))
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in got:
        assert r.doc_tokens == len(ids[r.doc_id])
        assert np.frombuffer(r.ids, "<u4").tolist() == ids[r.doc_id][r.start:r.start + r.length]
        by_doc[r.doc_id].append((r.start, r.length))
        by_seq[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(ids)
    for d, runs in by_doc.items():
        runs.sort()
        assert [s for s, _ in runs] == list(np.cumsum([0] + [n for _, n in runs])[:-1]) and sum(n for _, n in runs) == len(ids[d])
    for runs in by_seq.values():
        runs.sort()
        n = sum(n for _, n in runs)
        assert [o for o, _ in runs] == list(np.cumsum([0] + [n for _, n in runs])[:-1]) and (n == 256 or n & (n - 1) == 0)


def test_pack_empty_and_repeated(spark):
    schema = "doc_id long, text string"
    assert P.pack(spark.createDataFrame([], schema), BPE).count() == 0
    got = P.pack(spark.createDataFrame([(1, "a b"), (1, "a b"), (2, None)], schema), BPE).collect()
    assert sorted((r.doc_id, r.length, r.doc_tokens) for r in got if r.start == 0)[-1] == (2, 1, 1)
    assert sum(r.length for r in got) == 7


# ---------------------------------------------------------------- whitening

def exact_covariance(x):
    n = len(x)
    s = [sum(c) for c in zip(*x, strict=True)]
    c = [[n * a - b for a, b in zip(row, s, strict=True)] for row in x]
    return np.array([[float(Fraction(sum(r[i] * r[j] for r in c), n ** 3)) for j in range(len(s))] for i in range(len(s))])


def test_whitening_against_exact_sums(spark):
    rng = np.random.default_rng(5)
    made = (rng.normal(size=(80, 5)) @ rng.normal(size=(5, 5)) * 3).astype(np.float32)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(made)]
    rows += [(3, rows[3][1]), (None, [0.5, -0.25, 1.0, 2.0, 3.0])]
    bad = [(900, None), (901, [1.0, None, 1.0, 1.0, 1.0]), (902, [float("nan")] * 5), (903, [float("inf")] * 5),
           (904, []), (905, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows + bad],
                               "vec_id long, embedding array<float>, n int, whitened double").repartition(6)
    got = W.whiten(df, k=4).collect()
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in rows]
    n = len(x)
    cov = exact_covariance(x)
    sums = [sum(c) for c in zip(*x, strict=True)]
    assert np.array_equal(W.covariance(W.whole_vectors(df, "vec_id", "embedding"), 5, n, sums), cov)
    assert len(got) == 4 * n and {r.n for r in got} == {n} and got[0].identity_error < 1e-9
    e, u = np.linalg.eigh(cov)
    centred = np.array(x) - np.array(sums) / n
    want = centred @ u[:, ::-1][:, :4] / np.sqrt(e[::-1][:4])
    for c in range(4):
        own = sorted((str(r.vec_id), r.whitened) for r in got if r.component == c + 1)
        ref = [sorted((str(i), s * w) for (i, _), w in zip(rows, want[:, c], strict=True)) for s in (1, -1)]
        assert any(np.allclose([w for _, w in own], [w for _, w in r], atol=1e-9) for r in ref)
        assert abs(next(r.explained for r in got if r.component == c + 1) - e[::-1][c] / e.sum()) < 1e-12
    deviation = {str(i): sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for (i, _), v in zip(rows, x, strict=True)}
    assert all(int(r.deviation) == deviation[str(r.vec_id)] for r in got)


def test_whitening_without_rows_or_variance(spark):
    schema = "vec_id long, embedding array<double>"
    assert W.whiten(spark.createDataFrame([], schema)).count() == 0
    assert W.whiten(spark.createDataFrame([(1, []), (2, None)], schema)).count() == 0
    got = W.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect()
    assert len(got) == 4 and all(r.whitened == 0 and r.explained == 0 and r.identity_error == 0 for r in got)
    line = W.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(9)], schema)).collect()
    assert all((r.whitened == 0) == (r.component == 2 or r.vec_id == 4) and r.identity_error < 1e-9 for r in line)
    with pytest.raises(Exception, match="2\\^19"):
        W.whiten(spark.createDataFrame([(1, [1e9])], schema)).count()


def test_deviation_beyond_63_bits(spark):
    rows = [(i, [500_000.0 * (-1) ** i, float(i)]) for i in range(6000)]
    got = W.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=1).where("vec_id < 2").collect()
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x, strict=True)]
    for r in got:
        assert int(r.deviation) == sum((6000 * c - s) ** 2 for c, s in zip(x[r.vec_id], sums, strict=True)) > 1 << 63


# ---------------------------------------------------------------- resampling

def slow_resample(docs, target, buckets, n, least, permille, seed):
    def feats(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        return len(w), [zlib.crc32(" ".join(w[i:i + k]).encode()) % buckets for k in range(1, n + 1) for i in range(len(w) - k + 1)]

    s, t = [0] * buckets, [0] * buckets
    for side, texts in ((s, [d[1] for d in docs]), (t, target)):
        for x in texts:
            for b in feats(x)[1]:
                side[b] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (sum(s) + buckets) / ((s[b] + 1.0) * (sum(t) + buckets))))
            for b in range(buckets)]
    out = []
    for i, text in docs:
        words, f = feats(text)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, words, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32)))))
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    ranks = {}
    for place, r in enumerate(able[:permille * len(able) // 1000], 1):
        ranks.setdefault(r, []).append(place)
    return [(*r, ranks[r].pop(0) if ranks.get(r) else None) for r in sorted(out, key=str)]


def texts(seed, n):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "ΓΑΜΜΑ", "x9", "naïve", "日本", "the", "of", "Of"]
    return [" ".join(rng.choices(words, k=rng.randrange(30))) + rng.choice(["", ".", "-end", "\n\x00"]) for _ in range(n)]


@pytest.mark.parametrize("n", [1, 3])
def test_resample_equals_brute_force(spark, n):
    rows = list(enumerate(texts(1, 400))) + [(400, None), (401, ""), (None, "alpha " * 9), (402, "the of " * 300)]
    rows += [(5, rows[5][1]), (402, "the of " * 300), (7, "another text of five words")]
    target = texts(2, 20) + [None]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, score int, rank string")
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    got = R.resample(df.repartition(7), goal, buckets=50, n=n, least_words=5, permille=300)
    want = slow_resample(rows, target, 50, n, 5, 300, 2024)
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))


def test_long_texts_are_read_in_spans(monkeypatch):
    known, text = R.Buckets(97), "Some Wörds, and 日本 more of them " * 50
    whole = sorted(np.concatenate([f for _, f in R.features(text, known, 3)]).tolist())
    monkeypatch.setattr(R, "_SPAN", 40)
    parts = list(R.features(text, known, 3))
    assert len(parts) > 10 and sorted(np.concatenate([f for _, f in parts]).tolist()) == whole


@pytest.mark.parametrize("case", ["spread", "ties", "one key"])
def test_cutoff_is_exact(spark, case):
    rng = random.Random(case)
    low = {"spread": lambda: rng.randrange(-10**6, 10**6), "ties": lambda: rng.randrange(3), "one key": lambda: 7}[case]
    keys = [(low(), rng.randrange(5000) if case != "one key" else 1) for _ in range(6000)]
    df = spark.createDataFrame(keys, "low long, id long").repartition(9)
    for permille in (1, 333, 1000) if case == "spread" else (333,):
        cut = R.find_cutoff(df, permille, finish=16)
        assert (cut.low, cut.id) == sorted(keys)[6000 * permille // 1000 - 1] and cut.drawn == 6 * permille
        assert cut.rounds <= 3 + math.log(6000) / math.log(4 / 3)
    assert R.find_cutoff(df.where("false"), 500) is None


def test_resample_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert R.resample(none, none).count() == 0
    one = spark.createDataFrame([(1, "word " * 30)], "doc_id long, text string")
    assert [r["rank"] for r in R.resample(one, none, permille=1000).collect()] == [1]
