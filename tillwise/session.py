"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings the library relies on.  AQE re-plans joins at every shuffle boundary (broadcast
# conversion from observed sizes, skew-join splitting, partition coalescing), which is what keeps
# the star-schema joins right at any scale without hand-scheduling.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Static broadcast only for sides the planner can prove small from file statistics; anything
    # larger is sort-merge joined (and may still become a broadcast at runtime through AQE).
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    # Checkpoint files go when the result that reads them is no longer referenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  extra: dict[str, str] | None = None, app_name: str = "tillwise") -> SparkSession:
    """A session with the library's defaults; used by tests and the bench, never on a cluster
    where the deployment owns the configuration."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def cluster_conf(input_bytes: int, total_cores: int,
                 partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Sizing for a cluster run over ``input_bytes`` of table data on ``total_cores`` cores.

    Scan splits and post-shuffle partitions target ``partition_bytes`` each, small enough to
    sort and aggregate in executor memory without heavy spilling.  The shuffle partition count
    is an upper bound for AQE, which coalesces it down to what each exchange actually carries;
    it is at least two waves of the cores.  A partition more than four times the advisory size and over 1 GB counts as
    skewed and is split by AQE's skew join.
    """
    wanted = -(-input_bytes // partition_bytes)
    shuffle_partitions = max(2 * total_cores, wanted)
    return {
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(max(partition_bytes * 4, 1 << 30)),
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, honouring ``spark.checkpoint.dir``.

    On a cluster the folder must be shared storage named by the deployment; only a local-mode
    session (tests, bench) may fall back to a fresh folder of its own.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server's spark.checkpoint.dir applies
        return spark.conf.get("spark.checkpoint.dir", "")
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
    folder = tempfile.mkdtemp(prefix="tillwise-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()
