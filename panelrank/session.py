"""Spark session helpers.

Cluster jobs get their settings from the submit command; ``get_spark`` only
fills in what is missing, so tests and the bench run the same code on
``local[N]``.
"""

from __future__ import annotations

import os
import tempfile

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files of collected DataFrames are removed, so the shared folder does not grow per run
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None, app: str = "panelrank") -> SparkSession:
    """The running session, or a new one: submitted settings win, then the arguments, then the defaults above."""
    running = SparkSession.getActiveSession()
    if running is not None:
        ensure_checkpoint_dir(running)
        return running
    heap = {}
    if master and master.startswith("local") and not master.startswith("local-cluster"):
        # a local driver's heap is fixed when its JVM starts; a submitted size still wins
        heap = {"spark.driver.memory": os.environ.get("PANELRANK_DRIVER_MEMORY", "16g")}
    SparkContext._ensure_initialized(conf=SparkConf(loadDefaults=False).setAll(list(heap.items())))
    submitted = SparkConf()  # what the submit command set
    wanted = dict(DEFAULTS)
    if shuffle_partitions is not None:
        wanted["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    given = submitted.get("spark.master", None)
    master = given if given and given != "local[*]" else master or given  # local[*] is what submit assumes without one
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in wanted.items():
        if not submitted.contains(k):
            builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is used as is; without it this raises.
    Only on a local master (tests) a fresh scratch folder is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="panelrank-ckpt-", dir="/tmp")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def cluster_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a large run, to pass to ``spark-submit --conf`` (sizes, not code paths).

    Shuffle partitions start at ~input / 1 GB, between 2x the cores and 100,000
    (map-output tracking grows with maps x reducers), and AQE coalesces them per
    stage toward 256 MB; scans split files into 256 MB partitions; a shuffle
    partition over 5x the median and 1 GB is split by AQE's skew join.
    """
    shuffle = min(100_000, max(2 * total_cores, input_bytes // (1 << 30)))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(int(shuffle)),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1 << 30),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
