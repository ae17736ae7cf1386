"""Spark session construction and the shared working folder.

Library code never builds its own session: every function takes the
caller's ``SparkSession``. ``build_session`` exists for tests, ``bench.py``
and command-line use on a single machine.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the medallion jobs rely on. On a cluster these belong in the
# cluster's spark-defaults; here they are applied only when the local
# builder is used.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", app: str = "sentinela",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def input_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files below ``path``, from file metadata (no data is read)."""
    from pyspark.sql import functions as F
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
             .select("length"))
    return int(files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0])


def sized_settings(total_input_bytes: int, target_partition_bytes: int = 200 << 20,
                   min_partitions: int = 8) -> dict[str, str]:
    """Shuffle and scan settings for an input of ``total_input_bytes``.

    About one shuffle partition per ``target_partition_bytes`` of input (AQE
    coalesces downward when a stage shrinks), scan splits of 256 MB, and an advisory partition size that keeps tasks spill-friendly.
    """
    parts = max(min_partitions, -(-total_input_bytes // target_partition_bytes))
    split = 256 << 20
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
    }


def apply_sized_settings(spark: SparkSession, path: str) -> dict[str, str]:
    """Measure the input below ``path`` and set the sized settings on the session."""
    conf = sized_settings(input_bytes(spark, path))
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    The setting is read from the session. Only a local session without the
    setting gets a fresh folder under the system temp dir (tests); a cluster
    session without it is an error, because a machine-local folder would not
    be visible to the other executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="sentinela-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder name below the shared root for one job's output.

    All of an application's folders lie in one folder of its own, which the
    file system removes when the application ends.
    """
    root = shared_root(spark)
    own = f"{root}/sentinela/{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(own)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        fs.mkdirs(path)
    fs.deleteOnExit(path)
    return f"{own}/{name}-{uuid.uuid4().hex[:12]}"


#: Spark removes an execution's shuffle files at its end; by default they stay until the driver collects garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Writes run and streams started inside leave no shuffle files when they, or a batch of theirs, have ended."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


__all__ = ["build_session", "shared_root", "scratch_path", "shuffles_removed", "DEFAULT_CONF",
           "input_bytes", "sized_settings", "apply_sized_settings"]
