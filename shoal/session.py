"""Spark session settings and the shared checkpoint folder.

``job_session`` is for jobs under a launcher: it sets only what right results
need (UTC session time, the RocksDB state store of ``transformWithState``) and,
where the launcher says nothing, adaptive execution; master, memory, shuffle
partitions and all else are the launcher's. ``build_session`` is for tests, the
bench and local runs, and sets all of it.
"""

from __future__ import annotations

import posixpath
import tempfile

from pyspark.sql import SparkSession

# Settings without which results would differ or jobs not start.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}
# Set by a job only where the launcher has not set them.
ADVISED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Settings of local sessions.
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str = "local[8]", app: str = "shoal",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Session for tests, the bench and local runs."""
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def job_session(app: str = "shoal") -> SparkSession:
    """The launcher's session, with the settings the jobs need."""
    spark = SparkSession.builder.appName(app).getOrCreate()
    given = {k for k, _ in spark.sparkContext.getConf().getAll()}
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    for k, v in ADVISED_CONF.items():
        if k not in given:
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and lineage cuts, from ``spark.checkpoint.dir``.

    Only a local session (tests, the bench), where all tasks see the driver's
    disk, gets a scratch folder when it is unset; elsewhere that is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local[") and master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="shoal-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    return posixpath.join(checkpoint_dir(spark), name)


def scale_conf(shuffle_bytes: int, target_partition_bytes: int = 128 << 20,
               max_partition_bytes: int = 256 << 20) -> dict:
    """Settings sized to the bytes a job shuffles: enough initial shuffle
    partitions that each holds about ``target_partition_bytes`` before AQE
    coalesces small ones, and scan splits of ``max_partition_bytes``.

    For 100 TB of input shuffled once this gives ~800k initial partitions,
    which AQE coalesces at run time; skewed partitions above five times the
    median (and 256 MB) are split by the skew-join rule.
    """
    n = max(200, -(-shuffle_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(max_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 << 20),
    }
