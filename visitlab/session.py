"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. Times in the data model are wall-clock strings
# and TIMESTAMP_NTZ values, so the session zone is pinned to UTC.
_DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Keep the partial per-group cut for large k as well.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000000",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Runtime Bloom filters in front of a large shuffled side, from id sides of up to 1 GB (the default of 10 MB is
    # a few hundred thousand ids) and 64 million ids.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1GB",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "64000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": "536870912",
    # Reliable checkpoints written by upserts are removed once unreferenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "visitlab",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library expects."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    # getOrCreate may return an existing session: enforce the SQL settings.
    for k, v in _DEFAULT_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    On a cluster this is ``spark.checkpoint.dir`` (a shared file system the
    cluster names).  Only when it is unset -- local runs and tests -- a fresh
    folder is created and registered on the session.
    """
    known = spark.sparkContext.getCheckpointDir()
    conf = spark.sparkContext.getConf()
    local = spark.sparkContext.master.startswith("local")
    root = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir", None)
    if not root and known:  # set by code: Spark appends a folder of its own
        root = known.rsplit("/", 1)[0]
    if not root:
        if not local or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="visitlab-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the checkpoint root (never reused)."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"

