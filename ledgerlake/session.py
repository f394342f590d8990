"""Session-level settings the engine relies on, and the shared work folder.

Library code never builds a session: the caller owns it.  These helpers only
read it, or fill in a setting that is still unset.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings the operators are designed around (see README "Scale").  AQE
# re-plans joins from runtime sizes, splits skewed join partitions and
# coalesces small shuffle partitions; they are Spark 4 defaults and are listed
# so a cluster profile can pin them.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


# Bytes per shuffle partition to aim for: large enough that task overhead is
# small, small enough that a partition's hash table or sort buffer fits in an
# executor core's share of memory without spilling much.
TARGET_PARTITION_BYTES = 256 * 1024 * 1024


# Beyond this many, the map outputs a driver has to track (map tasks times
# partitions) cost more than larger partitions, which may spill.
MAX_SHUFFLE_PARTITIONS = 32_768


def shuffle_partitions_for(shuffled_bytes: int, total_cores: int,
                           target_bytes: int = TARGET_PARTITION_BYTES) -> int:
    """``spark.sql.shuffle.partitions`` for a job whose largest shuffle moves ``shuffled_bytes``.

    What counts is what is left after column pruning and partial aggregation,
    not what is read: the questions shuffle one row per group and map task,
    the merchant join (when it isn't a broadcast) the 24 Gold columns.  At
    least two waves of tasks, at most ``MAX_SHUFFLE_PARTITIONS``; AQE coalesces
    partitions that turn out small.  E.g. 2 TB moved on 1000 executors × 8
    cores → 16,000 partitions.
    """
    by_size = -(-max(shuffled_bytes, 0) // target_bytes)
    return min(MAX_SHUFFLE_PARTITIONS, max(2 * total_cores, by_size))


def scale_conf(shuffled_bytes: int, total_cores: int) -> dict[str, str]:
    """Settings for one job whose largest shuffle moves ``shuffled_bytes`` on ``total_cores`` cores."""
    return {
        **RECOMMENDED_CONF,
        "spark.sql.shuffle.partitions": str(shuffle_partitions_for(shuffled_bytes, total_cores)),
        "spark.sql.files.maxPartitionBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES // 2),
    }


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder for checkpoints and written tables.

    Taken from ``spark.checkpoint.dir`` (or the SparkContext's checkpoint
    folder).  Only on a local master, where one machine is the whole cluster,
    is a fresh folder made when none is configured; on a cluster an unset
    setting is an error, since a machine-local folder is not visible to other
    executors.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        if not sc.getCheckpointDir():  # named in the session after it started
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder every executor can reach"
        )
    path = tempfile.mkdtemp(prefix="ledgerlake-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir().rstrip("/")
