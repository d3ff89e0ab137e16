"""N-gram Jaccard join against brute force; text hashing; components; Bloom split."""

import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from visitlab.llm import bloom, ngram_join
from visitlab.llm.components import connected_components
from visitlab.llm.textnp import shingle_sets, small, word_hashes, words

SCHEMA = "doc_id long, text string, node long, n long, lang string"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def sets(text, k=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(rows, num=85, den=100):
    """doc_id -> (set sizes, component)."""
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    made = [(i, sets(t)) for i, t in rows]
    for (i, a), (j, b) in combinations(made, 2):
        if a and b and den * len(a & b) >= num * len(a | b):
            x, y = find(i), find(j)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in rows}, made


def variants(seed, count):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)]
    rows, base = [], []
    for i in range(count):
        kind = rng.random()
        if kind < 0.45 or not base:
            base.append([rng.choice(vocab) for _ in range(rng.choice([1, 2, 3, 4, 5, 20, 60, 150]))])
            rows.append((i, " ".join(base[-1])))
        else:
            w = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            text = rng.choice([" ", "\n", "\t "]).join(w)
            rows.append((i, text.upper() if rng.random() < 0.2 else text))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = variants(seed, 160) + [(1000, None), (1001, ""), (1002, " \n\t "), (1003, "é Ü x"), (1004, "É Ü x")]
    want, made = brute(rows)
    df = spark.createDataFrame([(i, t, 7, 9, None) for i, t in rows], SCHEMA).repartition(5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"])
           for r in ngram_join.ngram_jaccard_join(df, sketch_bits=16).documents.collect()}
    assert got == {i: (len(s), want[i]) for i, s in made}


def test_near_copy_group_makes_few_pairs(spark):
    rng = random.Random(5)
    base = [f"v{rng.randrange(10**6)}" for _ in range(120)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.choice([0, 1, 2, 9])):
            w[rng.randrange(len(w))] = f"u{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    want, _ = brute(rows)
    result = ngram_join.ngram_jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"), sketch_bits=16)
    assert {r["doc_id"]: r["component_id"] for r in result.documents.collect()} == want
    assert result.links.count() < 150 * 10


@pytest.mark.parametrize(("seed", "block"), [(3, 512), (4, 3)])
def test_all_links_equal_brute_force(spark, seed, block):
    rng = random.Random(seed)
    base = [f"g{i}" for i in range(150)]
    group = [" ".join([*base[:i], f"x{rng.randrange(10**6)}", *base[i + 1:]]) for i in range(0, 150, 5)]
    rows = variants(seed, 120) + [(2000 + i, t) for i, t in enumerate(group)] + [
        (2000, group[0]), (3000, group[4].upper()), (3001, group[5]), (3001, group[6] + " tail"), (3002, group[6] + " tail"),
        (1000, None), (1001, ""), (None, group[1])]
    made = [(i, sets(t)) for i, t in rows if i is not None]
    node = {}
    for i, s in made:
        if s:
            node[s] = min(i, node.get(s, i))
    links, near = set(), {s: {s} for s in node}
    for x, y in combinations(node, 2):
        if 100 * len(x & y) >= 85 * len(x | y):
            near[x].add(y)
            near[y].add(x)
            (a, na, _), (b, nb, _) = sorted([(node[x], len(x), 0), (node[y], len(y), 0)])
            links.add((a, b, na, nb, len(x & y)))
    holders = {s: {i for i, t in made if t == s} for s in node}
    want = [(i, len(s), node.get(s, i), len(set().union(*(holders[y] for y in near[s])) - {i}) if s else 0)
            for i, s in made] + [(None, len(sets(group[1])), None, None)]
    out = ngram_join.ngram_jaccard_links(spark.createDataFrame(rows, "doc_id long, text string").repartition(5),
                                         sketch_bits=16, block=block)
    got = [tuple(r) for r in out.links.select("a", "b", "n_a", "n_b", "overlap").collect()]
    assert len(links) >= 435 and sorted(got) == sorted(links)  # the group alone has 435
    got = [tuple(r) for r in out.documents.select("doc_id", "n_shingles", "class_id", "n_links").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_all_links_of_nothing(spark):
    for rows in ([], [(1, None)], [(1, "a b c d e")]):
        out = ngram_join.ngram_jaccard_links(spark.createDataFrame(rows, "doc_id long, text string"), sketch_bits=16)
        assert out.links.count() == 0 and [r["n_links"] for r in out.documents.collect()] == [0] * len(rows)


def test_nulls_repeats_and_empty(spark):
    rows = [(None, "a b c d e"), (1, "a b c d e"), (1, "a b c d e"), (2, "p q r s t"), (2, "a b c d e"), (3, "p q r s t"),
            (4, None)]
    out = ngram_join.ngram_jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"), sketch_bits=16)
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out.documents.collect()), key=str)
    # doc_id 2 has two texts, so it ties their classes; the row without an id takes no part
    assert got == sorted([(None, 2, None), (1, 2, 1), (1, 2, 1), (2, 2, 1), (2, 2, 1), (3, 2, 1), (4, 0, 4)], key=str)
    empty = ngram_join.ngram_jaccard_join(spark.createDataFrame([], "doc_id long, text string"), sketch_bits=16)
    assert empty.documents.count() == 0 and empty.links.count() == 0


def brute_documents(rows, num=85):
    """doc_id -> component, where the rows of a doc_id are one document with several sets."""
    root = {i: i for i, _ in rows if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    made = [(i, sets(t)) for i, t in rows if i is not None]
    for (i, a), (j, b) in combinations(made, 2):
        if a and b and 100 * len(a & b) >= num * len(a | b):
            x, y = find(i), find(j)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in root}


def test_a_doc_id_with_several_texts_loses_no_link(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    four = [(1, a), (1, b), (2, a + " x"), (3, b + " y")]
    rng = random.Random(9)
    many = [(rng.randrange(40), t) for _, t in variants(7, 120)]  # texts of equal size under one doc_id abound
    many += [(-i, t) for i, t in many[:20]]
    for rows in (four, [(5, a), (5, b), (7, b + " y"), (1, a)], many):
        out = ngram_join.ngram_jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), sketch_bits=16)
        got = out.documents.select("doc_id", "component_id").collect()
        want = brute_documents(rows)
        assert len(got) == len(rows) and {tuple(r) for r in got} == set(want.items())


def test_long_text_and_words():
    text = "x" * 3_000_000 + " " + "ab cd " * 500_000
    a, = shingle_sets(pa.array([text]), 4)
    assert len(a) == len(sets(text))
    texts = ["A b\u00a0c", None, "", "a", " lead", "tail ", "b a", "a b", "ab"]
    col = pa.array(texts).slice(0)
    from visitlab.llm.textnp import buffers
    data, off = buffers(col)
    s, e, at = words(data, off)
    h = word_hashes(data, s, e)
    per = [h[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)]
    assert [len(p) for p in per] == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]
    assert per[3] == per[6][1:] == per[7][:1] and per[8] not in (per[3], per[6])
    parts = list(small(iter([pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])]), "text", 4))
    assert [x for p in parts for x in p.column(0).to_pylist()] == texts and len(parts) > 2


def test_runs_across_batches_and_partitions():
    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["h", "node", "n", "pos"])
    rows = [(1, 1, 9, 0), (2, 1, 9, 1), (2, 2, 9, 1), (2, 3, 9, 1), (3, 1, 9, 2), (4, 4, 9, 0), (4, 5, 9, 0)]
    want = [(1, 1, 1), (2, 1, 1), (2, 2, 1), (2, 3, 1), (4, 4, 4), (4, 5, 4)]  # the first run always comes out
    for cuts in ([7], [1, 6], [2, 5], [3, 4], [1] * 7, [6, 1]):
        at, parts = 0, []
        for n in cuts:
            parts.append(batch(rows[at:at + n]))
            at += n
        got = [r for b in ngram_join._runs(iter(parts)) for r in zip(*(b.column(i).to_pylist() for i in (0, 1, 4)), strict=True)]
        assert sorted(got) == want, cuts
    alone = [r for b in ngram_join._runs(iter([batch(rows[:1])])) for r in b.column(0).to_pylist()]
    assert alone == [1]
    last = [r for b in ngram_join._runs(iter([batch(rows[:5])])) for r in b.column(0).to_pylist()]
    assert last == [1, 2, 2, 2, 3]  # so does the last


def test_packed_pieces_add_up():
    from functools import reduce

    from visitlab.llm import blobs
    rng = np.random.default_rng(2)
    pieces = [np.where(rng.random(500) < share, rng.integers(1, 9, 500), 0).astype("<i8") for share in (0.01, 0.9, 0.0, 0.2)]
    packs = [blobs.packed(p) for p in pieces]
    assert {b[:1] for b in packs} == {b"s", b"d"}
    assert all((blobs.unpacked(b, "<i8") == p).all() for b, p in zip(packs, pieces, strict=True))
    assert (reduce(lambda t, b: blobs._fold(t, b, "<i8", np.add), packs, None) == sum(pieces)).all()


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(500, i) for i in range(501, 560)] + [(None, 1)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {r[0]: r[1] for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bloom_split(spark, monkeypatch):
    df = spark.createDataFrame([(i, "x") for i in range(2000)] + [(None, "y")], "doc_id long, text string")
    keys = df.where("doc_id % 50 = 3")
    maybe, no = bloom.split(df, "doc_id", bloom.build(keys, "doc_id"))
    inside, outside = {r[0] for r in maybe.collect()}, {r[0] for r in no.collect()}
    assert {i for i in range(2000) if i % 50 == 3} <= inside and len(inside) < 60 and None in outside
    assert len(inside) + len(outside) == 2001
    assert not bloom.build(df.where("false"), "doc_id").any()
    ids, every = keys.select("doc_id"), {i for i in range(2000)} | {None}
    for most in (10**6, 0):
        monkeypatch.setattr(bloom, "BROADCAST_KEYS", most)
        got = {r[0] for r in bloom.rows_of(df, "doc_id", ids, 40).collect()}
        assert {i for i in range(2000) if i % 50 == 3} <= got and len(got) < 60
        assert {r[0] for r in bloom.rows_but(df, "doc_id", ids, 40).collect()} == every - {i for i in range(2000) if i % 50 == 3}
    assert np.asarray(bloom.holds(bloom.build(keys, "doc_id"), pa.array([3, None]))).tolist() == [True, False]
