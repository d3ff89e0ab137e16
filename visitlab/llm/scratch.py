"""Intermediate tables in the shared folder named by ``spark.checkpoint.dir``."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from visitlab.session import scratch_path


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession, size: str = "8m") -> Iterator[None]:
    """Hand rows to Python in small Arrow batches while a job runs: several are in memory on both sides."""
    old = spark.conf.get(BATCH_BYTES, None)
    spark.conf.set(BATCH_BYTES, size)
    try:
        yield
    finally:
        spark.conf.unset(BATCH_BYTES) if old is None else spark.conf.set(BATCH_BYTES, old)


ROWS_PER_TASK = 50_000


def store(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` once to a fresh shared folder and read it back: cuts lineage, survives lost executors.

    ``rows``, a bound on its number of rows, lets small tables be made by few tasks: one per ``ROWS_PER_TASK``."""
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // ROWS_PER_TASK)))
    with small_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
