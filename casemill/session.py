"""Session helpers: shared scratch folder and recommended settings."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a deployment should carry (spark-defaults or the job's builder).
# They are recommendations for the cluster; library code changes no setting of
# a session it is handed, but for `llm.common.shuffles_dropped`, which puts one back.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # plan-time estimates never choose a broadcast; at run time only a side
    # measured below the adaptive threshold is broadcast, sort-merge above it
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
}


def recommended_conf(input_bytes: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Deployment settings sized for an input of `input_bytes`.

    The initial shuffle partition count gives every shuffle partition about
    `target_partition_bytes` before AQE coalesces small ones (a 100 TB input
    starts near 400,000 partitions), so sorts and aggregations fit executor
    memory and spill only at the edges.
    """
    parts = max(8, -(-input_bytes // target_partition_bytes))
    conf = dict(RECOMMENDED_CONF)
    conf["spark.sql.shuffle.partitions"] = str(parts)
    return conf


_LOCAL_ROOTS: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`.

    Only a local master, where the driver and the tasks are one process, may
    leave it unset: it then gets one private folder per application.  On a
    cluster a missing setting is an error, because no machine-local folder is
    seen by the other executors.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        return conf_dir.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.conf.get("spark.app.id")
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="casemill-ckpt-")
    return _LOCAL_ROOTS[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "casemill",
                  min_partition_size: str = "256KB") -> SparkSession:
    """Single-machine session for tests and the benchmark.

    Test-scale shuffles are a few MB; with AQE's default 1 MB minimum per
    coalesced partition most stages would shrink to one task while the work
    per row (JSON parsing, array sorts) is CPU-heavy.  A 256 KB minimum keeps
    the local cores busy (measured best among 64 KB-1 MB at sf0.1).  Cluster
    jobs keep Spark's defaults.
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("CASEMILL_DRIVER_MEMORY", "8g"))
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", min_partition_size)
    )
    for k, v in RECOMMENDED_CONF.items():
        if k != "spark.sql.adaptive.advisoryPartitionSizeInBytes":
            builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark
