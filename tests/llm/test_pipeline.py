"""The corpus pipeline, stage by stage against brute force on sf0.001."""

import importlib.util
import os
from itertools import combinations

import pytest

import corpus_pipeline as P
from test_ngram_join import sets
from tests_llm_helpers import brute, edit
from visitlab.llm import decontamination as D
from visitlab.llm import language_id, secret_scan

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_stages(spark, docs):
    by_name = dict(P.STAGES)
    assert [n for n, _ in P.STAGES] == ["language_id", "ngram_jaccard_join", "benchmark_decontamination", "secret_scans", "mixing"]
    kept = by_name["language_id"](spark, docs, SF)
    assert kept.columns == COLUMNS
    model = language_id.train(docs)
    want = {r["doc_id"] for r in language_id.predict(docs, model).where("not rejected").collect()}
    rows = kept.collect()
    assert {r["doc_id"] for r in rows} == want and len(rows) == len(want)

    text = {r["doc_id"]: r["text"] for r in rows}
    group, _ = brute(list(text.items()))
    unique = by_name["ngram_jaccard_join"](spark, kept, SF)
    assert unique.columns == COLUMNS and {r["doc_id"] for r in unique.collect()} == {i for i, c in group.items() if i == c}

    clean = by_name["benchmark_decontamination"](spark, unique, SF)
    items = [D.normalise(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    ids = {r["doc_id"] for r in clean.collect()}
    for i in {r["doc_id"] for r in unique.collect()}:
        whole = D.normalise(text[i])
        if i not in ids:
            assert any(edit(x, whole) <= int(D.RATE * len(x)) for x in items)
        else:
            assert not any(x in whole for x in items)

    red = by_name["secret_scans"](spark, clean, SF)
    assert red.columns == COLUMNS
    field = secret_scan.train(clean)
    for r in red.collect():
        before = text[r["doc_id"]]
        assert r["text"] == (secret_scan.redact(before, secret_scan.spans(before, field)) if before else before)
        assert r["n_chars"] == len(r["text"])

    mixed = by_name["mixing"](spark, red, SF).collect()
    size = {r["doc_id"]: len((r["text"] or "").split()) for r in red.collect()}
    assert {r["doc_id"] for r in mixed} <= set(size) and all(r["taken"] == r["copies"] * r["size"] for r in mixed)
    assert abs(sum(r["taken"] for r in mixed) / (1.5 * sum(size.values())) - 1) < 0.01


def test_near_copies_share_80_percent_of_5_words(spark, docs):
    text = [f"v{i}" for i in range(51)]
    edited = [*text[:25], "other", *text[26:]]  # 4 words: 44 of 52 shared; 5 words: 42 of 52
    made = [(10**6, " ".join(text)), (10**6 + 1, " ".join(edited)), (10**6 + 2, " ".join(text[:40]))]
    both = docs.union(spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in made], docs.schema))
    rows = [(r["doc_id"], sets(r["text"], 5)) for r in both.collect()]
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (i, a), (j, b) in combinations(rows, 2):
        if a and b and 100 * len(a & b) >= 80 * len(a | b):
            x, y = find(i), find(j)
            root[max(x, y)] = min(x, y)
    got = {r["doc_id"] for r in P.drop_near_copies(spark, both, SF).collect()}
    assert got == {i for i in root if find(i) == i} and 10**6 + 1 not in got and 10**6 + 2 in got


def test_repeated_rows_stay_once(spark, docs):
    some = docs.orderBy("doc_id").limit(50)
    once = {r["doc_id"] for r in P.drop_near_copies(spark, some, SF).collect()}
    got = P.drop_near_copies(spark, some.union(some), SF)
    assert got.columns == COLUMNS and sorted(r["doc_id"] for r in got.collect()) == sorted(once)
    two = spark.createDataFrame([(1, "b " * 9, "en", "s", 1), (1, "a text of its own", "de", None, 2), (None, "x", "en", "s", 1),
                                 (None, "x", "en", "s", 1)], docs.schema)
    assert sorted((r["doc_id"] or 0, r["text"]) for r in P.drop_near_copies(spark, two, SF).collect()) == [
        (0, "x"), (0, "x"), (1, "a text of its own")]


def test_run_and_registration(spark, docs):
    got = P.run(spark, SF)
    assert got.columns == ["doc_id", "source", "size", "copies", "taken"] and got.count() > 100
    entry = os.path.join(os.path.dirname(os.path.abspath(P.__file__)), "__spark_entry__.py")
    spec = importlib.util.spec_from_file_location("entry_llm", entry)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    names = module.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14))


def test_empty_and_null_rows(spark, docs):
    none = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "s", 0)], docs.schema)
    for name, stage in P.STAGES:
        for df in (docs.where("false"), none):
            assert stage(spark, df, SF).count() <= df.count(), name
