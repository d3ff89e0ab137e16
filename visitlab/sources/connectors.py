"""External sources and sinks: JDBC tables and Kafka topics.

Both go through Spark's own connectors; nothing here talks to a database or a
broker directly.  The JDBC reader splits the scan into ranges of a numeric
column so it runs in parallel; the writer batches inserts per partition.
The Kafka reader needs the ``spark-sql-kafka`` package on the classpath.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_jdbc(spark: SparkSession, url: str, table: str, user: str | None = None,
              password: str | None = None, partition_column: str | None = None,
              lower_bound: int | None = None, upper_bound: int | None = None,
              num_partitions: int | None = None, fetch_size: int = 10_000) -> DataFrame:
    """A JDBC table as a DataFrame (parallel range scan when a partition column is given)."""
    r = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
         .option("fetchsize", str(fetch_size)))
    if user is not None:
        r = r.option("user", user)
    if password is not None:
        r = r.option("password", password)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", str(lower_bound))
             .option("upperBound", str(upper_bound)).option("numPartitions", str(num_partitions or 8)))
    return r.load()


def write_jdbc(df: DataFrame, url: str, table: str, user: str | None = None,
               password: str | None = None, mode: str = "append", batch_size: int = 1_000) -> None:
    """K1/K2: append rows to a JDBC table, inserts batched per partition."""
    w = (df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
         .option("batchsize", str(batch_size)))
    if user is not None:
        w = w.option("user", user)
    if password is not None:
        w = w.option("password", password)
    w.save()


def kafka_lines(spark: SparkSession, bootstrap_servers: str, topics: str,
                starting_offsets: str = "latest", max_offsets_per_trigger: int | None = None) -> DataFrame:
    """A Kafka topic list (comma separated) as a stream of ``value`` strings.

    ``max_offsets_per_trigger`` caps a micro-batch (rate limiting after downtime)."""
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap_servers)
         .option("subscribe", topics)
         .option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return r.load().select(F.col("value").cast("string").alias("value"))
