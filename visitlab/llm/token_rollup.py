"""Token totals by source, language and tokenizer version, kept up to date by signed changes.

A change is an insert, a delete or a revised count of one document under one tokenizer version.  A batch of changes
becomes one small table of signed sums per key, written to the folder ``batch=<id>``; the totals are the sum over all
committed batches.  Sums are additive, so batches may come in any order, and a batch committed again replaces its own
folder: the totals do not move.  ``compact`` folds committed batches into one snapshot and remembers their ids, so a
late replay of one of them changes nothing either.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ["source", "lang", "version"]
SUMS = ["docs", "tokens"]
_DELTA = "source string, lang string, version string, docs long, tokens long"


def word_count(text_col: str = "text"):
    """Column: runs of other characters than space and 0x09-0x0D; null: 0."""
    return F.coalesce(F.regexp_count(text_col, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def byte_count(text_col: str = "text"):
    """Column: UTF-8 bytes, the tokens of a byte-level vocabulary; null: 0."""
    return F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long")


def bpe_counts(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
               ) -> DataFrame:
    """(doc_id, tokens) under a byte-pair vocabulary file of base64 ranks; the file must be readable on the driver."""
    import base64

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    shared = docs.sparkSession.sparkContext.broadcast((pattern, ranks))  # a vocabulary file: its size is its bound

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        pattern, ranks = shared.value
        enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        for b in batches:
            n = [len(enc.encode_ordinary(t)) if t else 0 for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64())], ["doc_id", "tokens"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, tokens long")


def deltas(changes: DataFrame) -> DataFrame:
    """Signed sums per key of changes (op, source, lang, version, tokens, old_tokens).

    insert: one document and its tokens more; delete: one and its tokens less; revise: tokens - old_tokens.  Null
    tokens count 0; null keys are a key; rows of another or no op are left out.  Keys whose sums are all 0 go.
    """
    n, old = F.coalesce("tokens", F.lit(0)), F.coalesce("old_tokens", F.lit(0))
    sign = F.when(F.col("op") == "insert", 1).when(F.col("op") == "delete", -1).otherwise(0)
    tokens = F.when(F.col("op") == "revise", n - old).otherwise(sign * n)
    return (changes.where(F.col("op").isin("insert", "delete", "revise")).groupBy(*KEYS)
            .agg(F.sum(sign).cast("long").alias("docs"), F.sum(tokens).cast("long").alias("tokens"))
            .where("docs <> 0 or tokens <> 0"))


class Rollup:
    """Committed batches and a snapshot under one shared folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm

    def _fs(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _names(self, path: str) -> list[str]:
        fs, p = self._fs(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def _done(self, path: str) -> bool:
        fs, p = self._fs(f"{path}/_SUCCESS")
        return fs.exists(p)

    def snapshots(self) -> list[int]:
        return [n for n in (int(x.split("=")[1]) for x in self._names(f"{self.path}/snapshot"))
                if self._done(f"{self.path}/snapshot/n={n}/totals") and self._done(f"{self.path}/snapshot/n={n}/ids")]

    def folded(self) -> set[str]:
        """Ids inside the newest snapshot: one short string per batch since the start."""
        n = max(self.snapshots(), default=None)
        if n is None:
            return set()
        return {r[0] for r in self.spark.read.schema("id string").parquet(f"{self.path}/snapshot/n={n}/ids").collect()}

    def committed(self) -> list[str]:
        """Ids of batches written whole (marked by their writer) and not yet in the snapshot."""
        folded = self.folded()
        return [b for b in (x.split("=", 1)[1] for x in self._names(f"{self.path}/batch"))
                if b not in folded and self._done(f"{self.path}/batch/id={b}")]

    def commit(self, batch_id: str, changes: DataFrame) -> None:
        """Write a batch; again under the same id: the folder is replaced, or left alone once it is folded."""
        if not batch_id.replace("-", "").replace("_", "").isalnum():
            raise ValueError("a batch id is made of letters, digits, - and _")
        if batch_id not in self.folded():
            deltas(changes).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
                f"{self.path}/batch/id={batch_id}")

    def _parts(self) -> DataFrame:
        out = self.spark.createDataFrame([], _DELTA)
        n = max(self.snapshots(), default=None)
        paths = [] if n is None else [f"{self.path}/snapshot/n={n}/totals"]
        paths += [f"{self.path}/batch/id={b}" for b in self.committed()]
        return out.union(self.spark.read.schema(_DELTA).parquet(*paths)) if paths else out

    def totals(self) -> DataFrame:
        """(source, lang, version, docs, tokens); keys that came down to nothing are left out."""
        return (self._parts().groupBy(*KEYS).agg(*[F.sum(c).cast("long").alias(c) for c in SUMS])
                .where("docs <> 0 or tokens <> 0"))

    def compact(self) -> None:
        """Fold every committed batch into a new snapshot; readers at work on older files keep them."""
        ids = sorted(self.folded() | set(self.committed()))
        n = max(self.snapshots(), default=0) + 1
        base = f"{self.path}/snapshot/n={n}"
        self.totals().write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{base}/totals")
        self.spark.createDataFrame([(i,) for i in ids], "id string").coalesce(1).write.mode("overwrite").option(
            "partitionOverwriteMode", "static").parquet(f"{base}/ids")
