"""Session construction and the shared scratch folder.

Library code never builds its own session; it takes the caller's.  These
helpers are for tests, ``bench.py`` and command-line use.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in this package is written for.  AQE re-plans joins and
# coalesces shuffle partitions at run time; skew-join splits hot partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # the request decoder keeps the last of duplicate keys, as a JSON map
    # decoder does
    "spark.sql.variant.allowDuplicateKeys": "true",
    # remove checkpoint files of materialised intermediates once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app: str = "logflow", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int,
                 target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a cluster run over ``input_bytes`` of input.

    Shuffle partitions are sized so that each holds about
    ``target_partition_bytes`` (a size a task sorts in memory without
    spilling much), and never fewer than two waves of the cluster's cores;
    AQE then coalesces small ones and splits skewed ones at that same size.
    Input splits use the same size.  100 TB on 1000 executors x 8 cores gives
    409,600 shuffle partitions of 256 MB.
    """
    cores = max(1, executors * cores_per_executor)
    parts = max(2 * cores, -(-input_bytes // target_partition_bytes))
    size = str(target_partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` (or an already set SparkContext checkpoint dir) is
    used as is.  Only when neither is set -- local runs and tests -- a private
    folder is created and registered.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a Connect session: the server owns the setting
        return spark.conf.get("spark.checkpoint.dir", "")
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):  # a folder of one machine would be lost with it
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="logflow-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tables", f"{name}-{uuid.uuid4().hex[:12]}")


def allow_duplicate_json_keys(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
