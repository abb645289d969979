"""Session construction and the shared work folder.

Durable intermediate tables (raw, fact, summary, stream checkpoints) live under
the folder the cluster names in ``spark.checkpoint.dir``. We only pick our own
folder when that setting is unset (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every tidemart job relies on. AQE re-plans joins from runtime sizes
# (a dimension is broadcast only after its shuffle stage proved it small) and
# splits skewed join partitions even where that costs an extra shuffle.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # raw records are stored with a column per path, so that a path reads its own column only
    "spark.sql.variant.writeShredding.enabled": "true",
    "spark.sql.variant.inferShreddingSchema": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_spark(master: str | None = None, app: str = "tidemart",
              shuffle_partitions: int | None = None,
              extra_conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_job_conf(spark: SparkSession) -> None:
    """Session-level settings a caller-made session may lack (runtime-settable only)."""
    for k in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled",
              "spark.sql.adaptive.forceOptimizeSkewedJoin", "spark.sql.session.timeZone"):
        spark.conf.set(k, DEFAULT_CONF[k])


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for durable state: ``spark.checkpoint.dir`` if the cluster set it.

    Only a ``local[...]`` master, whose driver is its one executor, may go without the setting and
    gets a temporary folder; anywhere else a folder of the driver's machine would be lost to executors.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tidemart-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the checkpoint root for one run of one job."""
    return f"{checkpoint_root(spark)}/tidemart/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What is written inside has its shuffle files deleted as soon as the write has ended.

    Otherwise they stay until the driver's JVM happens to collect the objects that stand for them; one with
    memory to spare may not for half an hour, and the files of one step lie beside the next one's.
    """
    before = spark.conf.get(FREE_SHUFFLES)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python code in tests can open the path."""
    if path.startswith("file:"):
        path = path[5:]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)


def scale_conf(input_bytes: int, total_cores: int,
               target_partition_bytes: int = 128 * 1024 ** 2) -> dict:
    """Settings sized to the data so that partitions fit executor memory.

    Shuffle partitions start at about one per ``target_partition_bytes`` of
    input (never fewer than 2 per core); AQE then merges small ones toward the
    advisory size and splits skewed ones. Scan splits are 256 MB. For 100 TB on
    1,000 executors x 8 cores this gives ~800,000 initial shuffle partitions,
    which AQE merges down at run time.
    """
    parts = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 ** 2),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(16 * 1024 ** 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        # a dimension is broadcast only when AQE measured it below this size
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 ** 2),
    }


def apply_scale_conf(spark: SparkSession, input_bytes: int, total_cores: int) -> dict:
    conf = scale_conf(input_bytes, total_cores)
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf
