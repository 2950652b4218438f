"""Spark session defaults and the shared work folder.

Jobs never pick storage locations on their own: scratch tables, stream
checkpoints and lineage cuts all live under the folder the cluster names in
``spark.checkpoint.dir``. A private folder is only created when that setting is
unset *and* Spark runs in local mode (tests, laptops).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Defaults applied by ``build_session`` where neither the cluster's defaults,
# nor ``--conf``, nor a running session has set a value; explicit arguments of
# ``build_session`` always apply.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only on measured sizes: no planning-time broadcast from file
    # size estimates (they undercount derived and decompressed rows); AQE
    # converts a join to broadcast after the shuffle stage has measured the
    # small side. Explicit, size-checked hints still apply.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    # Streaming state holds one row per key of a whole table: keep it in
    # RocksDB (off-heap, spills to local disk, checkpointed incrementally)
    # rather than in executor heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app_name: str = "changelake",
                  shuffle_partitions: int | None = None,
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    active = SparkSession.getActiveSession()
    given = SparkConf()   # spark-defaults.conf, --conf, earlier builder settings

    def unset(key: str) -> bool:
        if active is not None and active.conf.get(key, None) is not None:
            return False
        return not given.contains(key)

    conf = {k: v for k, v in DEFAULT_CONF.items() if unset(k)}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder from ``spark.checkpoint.dir``.

    On a cluster the setting must be present (a machine-local folder would be
    lost with its executor). In local mode an unset value is filled with a
    fresh temporary folder, and Spark's RDD checkpoint folder is pointed there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at shared storage "
                "(HDFS/object store) before running changelake jobs on a cluster")
        root = tempfile.mkdtemp(prefix="changelake-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"
