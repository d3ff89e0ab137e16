"""A corpus pipeline of five stages over ``documents``; each stage is one operator of ``visitlab.llm``.

language ID -> n-gram Jaccard join -> benchmark decontamination -> secret scans -> mixing.  Every stage works on all
documents its predecessor kept, written as Parquet and read again.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlab.llm import bloom, decontamination, language_id, mixing, ngram_join, secret_scan
from visitlab.llm.scratch import store


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model does not reject; it learns from their own labels."""
    return language_id.keep_identified(docs, language_id.train(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest doc_id, of each group linked by the n-gram Jaccard join.

    Near copies share 80 % of their 5-word shingles, the general rule of near-duplicate stages; op9's query has its own
    contract of 4 words and 85 %.  Rows of one doc_id are one document: of those that stay, the first in the order of
    their columns does.  Rows without a doc_id stay.  Only rows that may be dropped are shuffled.
    """
    found = store(ngram_join.ngram_jaccard_components(docs, k=5, num=80).documents.where("doc_id is not null")
                  .groupBy("doc_id").agg(F.min("component_id").alias("component_id"), F.count(F.lit(1)).alias("n")),
                  "pipeline-components")
    gone = store(found.where("component_id <> doc_id").select("doc_id"), "pipeline-copies")
    repeated = store(found.where("component_id = doc_id and n > 1").select("doc_id"), "pipeline-repeated")
    rest = bloom.rows_but(docs, "doc_id", gone, gone.count())
    n = repeated.count()
    if not n:
        return rest
    others = [c for c in docs.columns if c != "doc_id"]
    first = (bloom.rows_of(rest, "doc_id", repeated, n).join(repeated, "doc_id", "left_semi").groupBy("doc_id")
             .agg(F.min(F.struct(*others)).alias("row")).select("doc_id", "row.*").select(*docs.columns))
    return bloom.rows_but(rest, "doc_id", repeated, n).union(first)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item in them."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark."""
    return secret_scan.redact_secrets(docs, secret_scan.train(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, size, copies, taken) of the documents the mix takes at least once."""
    return mixing.mix(docs).where("copies > 0").select("doc_id", "source", "size", "copies", "taken")


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", decontaminate),
    ("secret_scans", redact_secrets),
    ("mixing", mix_sources),
]

#: Trained models and edit distances have no SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
