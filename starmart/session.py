"""Session helpers: a local session, the shared scratch folder and shuffle sizing."""

from __future__ import annotations

import math
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

LOCAL_MASTER = re.compile(r"local(\[[^\]]*\])?")
SHUFFLE_INPUT_BYTES = 256 * 1024 * 1024
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def local_session(app: str, cores: str = "*", memory: str = "8g") -> SparkSession:
    """Session for tests and the bench. On a cluster the master comes from spark-submit."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """New folder name for an intermediate table, under the cluster's shared checkpoint folder.

    Where the session names none, a folder of our own is set if everything runs in this one process
    (tests, local runs); on a cluster that would be a different folder on each machine, so it fails.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not LOCAL_MASTER.fullmatch(spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="starmart-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def size_shuffles(spark: SparkSession, input_bytes: int) -> None:
    """Raise the first shuffle partition count to fit the input; AQE merges small ones again.

    AQE can coalesce partitions but not split those of an aggregation, so the first number has
    to grow with the data. It is never lowered below what the session was given.
    """
    given = int(spark.conf.get("spark.sql.shuffle.partitions"))
    current = int(spark.conf.get(INITIAL_PARTITIONS, None) or given)
    wanted = math.ceil(input_bytes / SHUFFLE_INPUT_BYTES)
    if wanted > current:
        spark.conf.set(INITIAL_PARTITIONS, str(wanted))
