"""Mixing and decontamination against brute force."""

import random
import re

from pyspark.sql import functions as F

from visitlab.llm import decontamination as D
from visitlab.llm import mixing as M


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    names = sorted([s for s in sizes if s is not None], key=lambda s: s.encode()) + [s for s in sizes if s is None]
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, stopped, out = share * sum(sizes.values()), set(), {}
    while True:
        left = total - sum(cap * sizes[s] for s in stopped)
        free = sum(w[s] for s in names if s not in stopped)
        out = {s: cap * sizes[s] if s in stopped else left * w[s] / free for s in names}
        over = {s for s in names if s not in stopped and out[s] > cap * sizes[s]}
        if not over:
            return out
        stopped |= over


def docs(spark, seed=2, n=600):
    rng = random.Random(seed)
    rows = [(i, " ".join(["w"] * int(rng.paretovariate(0.8)) if rng.random() > 0.05 else []),
             rng.choice(["a", "a", "a", "B", "é", None, "zz"]), 1.0, "x") for i in range(n)]
    rows += [(n, None, "a", 1.0, "x"), (n + 1, "w w", "small", 1.0, "x"), (n + 1, "w w", "small", 1.0, "x"), (None, "w", "B", 1.0, "x")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string, rate double, size string")


def test_mix(spark):
    rows, df = docs(spark)
    got = M.mix(df.repartition(6)).collect()
    assert len(got) == len(rows)
    size = {}
    for _, t, s, *_ in rows:
        size[s] = size.get(s, 0) + len((t or "").split())
    want = brute_targets(size)
    for s, target in want.items():
        own = [r for r in got if r["source"] == s]
        assert all(abs(r["target"] - target) < 1e-6 * max(1, target) and r["source_size"] == size[s] for r in own)
        taken = sum(r["taken"] for r in own)
        assert abs(taken - target) <= max(2, 0.002 * target), (s, taken, target)
        assert all(r["taken"] == r["copies"] * r["size"] <= 2 * r["size"] for r in own)
    key = lambda r: str(tuple(r))
    assert sorted(got, key=key) == sorted(M.mix(df.repartition(3)).collect(), key=key)


def test_mix_rates_solve_the_dual(spark):
    rows, df = docs(spark, 4, 400)
    got = [r for r in M.mix(df).collect() if r["size"] > 0]
    for s in {r["source"] for r in got}:
        own = [r for r in got if r["source"] == s]
        assert abs(sum(r["rate"] * r["size"] for r in own) / own[0]["target"] - 1) < 1e-6
        if own[0]["target"] < 2 * own[0]["source_size"]:  # r = min(2, exp(lambda * size)): one lambda
            import math
            lam = [math.log(r["rate"]) / r["size"] for r in own if 1e-12 < r["rate"] < 2]
            assert max(lam) - min(lam) < 1e-9


def test_mix_edges(spark):
    schema = "doc_id long, text string, source string"
    assert M.mix(spark.createDataFrame([], schema)).count() == 0
    only = M.mix(spark.createDataFrame([(1, None, None), (2, "", "a")], schema)).collect()
    assert [(r["size"], r["target"], r["copies"], r["taken"]) for r in only] == [(0, 0.0, 0, 0)] * 2
    one = M.mix(spark.createDataFrame([(1, "a b c d", "s")], schema)).first()
    assert (one["target"], one["taken"]) == (6.0, 8) or one["taken"] == 4


def edit(a, b):
    """Least distance of a to any substring of b."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_myers_and_pieces():
    rng = random.Random(1)
    for _ in range(200):
        a = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 80)))
        b = "".join(rng.choice("abc ") for _ in range(rng.randint(0, 120)))
        assert D.myers(a, b)[0] == edit(a, b)
    assert "".join(p for p, _ in D.pieces("abcdefghij", 3)) == "abcdefghij"


def test_contaminated_equals_brute_force(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdeghilnorst") for _ in range(rng.randint(2, 7)))
    items = [(i, " ".join(word() for _ in range(rng.randint(6, 30)))) for i in range(12)] + [(90, None), (91, "short"), (None, "x" * 40)]
    rows = []
    for i in range(80):
        text = [word() for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.6:
            t = list(items[rng.randrange(12)][1])
            for _ in range(rng.randint(0, len(t) // 8)):
                p = rng.randrange(len(t))
                t[p:p + 1] = rng.choice([[], ["z"], [t[p], "q"]])
            text.insert(rng.randint(0, len(text)), "".join(t))
        joined = rng.choice([" ", "\n", ", "]).join(text)
        rows.append((i, joined.upper() if rng.random() < 0.3 else joined, "x"))
    rows += [(200, None, "x"), (201, "", "x"), (202, items[0][1], "x"), (202, items[0][1], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, item_id string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = D.contaminated(df, bench).collect()
    want = {}
    for i, t, _ in rows:
        for j, item in items[:12]:
            a = D.normalise(item)
            d = edit(a, D.normalise(t or ""))
            if d <= int(D.RATE * len(a)):
                want[i, j] = d
    assert {(r["doc_id"], r["item_id"]): r["distance"] for r in got} == want and len(want) > 20
    assert sum(r["doc_id"] == 202 for r in got) == 2 * sum(k[0] == 202 for k in want)
    text = {i: t for i, t, _ in rows}
    for r in got:
        span = D.normalise(text[r["doc_id"]][r["start"]:r["end"]])
        assert edit(D.normalise(dict(items)[r["item_id"]]), span) == r["distance"]
    # in blocks of one item or so: the same matches
    blocks = D.contaminated(df, bench, block_chars=200).collect()
    assert sorted(map(tuple, blocks)) == sorted(map(tuple, got))
    clean = {r["doc_id"] for r in D.decontaminate(df, bench).collect()}
    assert clean == {i for i, *_ in rows} - {k[0] for k in want}
    assert D.decontaminate(df, bench, block_chars=200).count() == D.decontaminate(df, bench).count()
    loose = df.withColumn("doc_id", F.lit(None).cast("long"))  # ids are not needed to drop
    assert D.decontaminate(loose, bench).count() == sum(i not in {k[0] for k in want} for i, *_ in rows)
    assert D.contaminated(df, bench.where("false")).count() == 0
    assert D.contaminated(df.where("false"), bench).count() == 0


def test_short_items_and_items_without_id(spark):
    rows = [(1, "say Forty-two apples now"), (2, "forty two applesauce"), (3, "xforty two apples"), (4, "forty twoo apples"),
            (5, "forty two apples"), (6, "an item that has no id of its own, in here"), (7, None), (8, "no")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, "Forty two apples!"), (None, "An item that has no id of its own"), (3, " ?! ")],
                                  "item_id long, text string")
    got = sorted(tuple(r) for r in D.contaminated(df, bench).collect())
    assert got == [(1, 1, 4, 20, 0), (5, 1, 0, 16, 0)]
    assert {r["doc_id"] for r in D.decontaminate(df, bench).collect()} == {2, 3, 4, 7, 8}


def test_normalise():
    for t in ["É\u2019tude \u2014 d'Été!", "a_b  c\n\nD9", "", "\u00bfQué?", "x\u00a0y"]:
        assert D.normalise(t) == " ".join(re.findall(r"[^\W_]+", t.lower()))
