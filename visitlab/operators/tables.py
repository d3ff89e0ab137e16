"""Date-partitioned result tables with keyed upserts (no table format needed).

An upsert touches only the partitions (by default days) that occur in the new rows:
those partitions are read, merged with the new rows, checkpointed (the lineage
must not point at files about to be replaced) and written back with dynamic
partition overwrite.  Cost per call is the size of the touched days, not of
the table; a re-run of the same upsert gives the same table.

Streams publish the totals of their state through the same upserts
(:mod:`visitlab.streaming.ad_streams`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlab.operators.merge import merge_replace, null_safe_join, replace_group
from visitlab.session import checkpoint_root


WRITE_SPLIT = 32  # salts over which the rows of one partition are dealt for writing, at most
ROWS_PER_SALT = 5_000  # a small upsert needs fewer


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def make_folder(spark: SparkSession, path: str) -> None:
    """Create ``path`` if need be, so a table that nobody has written yet reads as empty."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)


class DatePartitionedTable:
    """Parquet table at ``path`` partitioned by ``date`` (a ``yyyy-MM-dd`` string),
    or by ``partition_cols`` starting with ``date`` for finer upsert units.

    A null ``date`` is a partition of its own."""

    def __init__(self, spark: SparkSession, path: str, schema: str,
                 partition_cols: Sequence[str] = ("date",)):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.partition_cols = list(partition_cols)

    def read(self) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path)

    def _touched(self, new: DataFrame) -> DataFrame | None:
        """Current rows of the partitions ``new`` touches, or None when ``new`` is empty.

        Two dates come to the driver: their range prunes the scan; a null-safe semi-join
        with the touched partitions does the rest."""
        lo, hi, n = new.agg(F.min("date"), F.max("date"), F.count(F.lit(1))).first()
        if not n:
            return None
        current = self.read().filter(F.col("date").between(lo, hi) | F.col("date").isNull())
        return null_safe_join(current, new.select(*self.partition_cols).distinct(), self.partition_cols, "left_semi")

    def _write(self, merged: DataFrame, columns: Sequence[str]) -> None:
        checkpoint_root(self.spark)  # make sure a checkpoint folder is set
        stable = merged.select(*columns).checkpoint(eager=True)
        # Rows of a partition are dealt over up to WRITE_SPLIT salts, so one large day is not one task.
        salt = F.pmod(F.xxhash64(*columns), F.lit(min(WRITE_SPLIT, 1 + stable.count() // ROWS_PER_SALT)))
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        (stable.repartition(tasks, *self.partition_cols, salt).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .partitionBy(*self.partition_cols).parquet(self.path))

    def upsert_replace(self, new: DataFrame, keys: Sequence[str]) -> None:
        """K3 on the touched partitions: rows of ``new`` replace rows with the same key."""
        old = self._touched(new)
        if old is not None:
            cols = self.read().columns
            self._write(merge_replace(old, new.select(*cols), keys), cols)

    def replace_groups(self, new: DataFrame, group_keys: Sequence[str]) -> None:
        """K5 on the touched partitions: groups present in ``new`` are replaced wholesale."""
        old = self._touched(new)
        if old is not None:
            cols = self.read().columns
            self._write(replace_group(old, new.select(*cols), group_keys), cols)
