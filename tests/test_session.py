"""Session helpers: shared folder and partition sizing."""

from __future__ import annotations

from ledgerlake.session import MAX_SHUFFLE_PARTITIONS, TARGET_PARTITION_BYTES, scale_conf, shared_dir, shuffle_partitions_for


def test_shuffle_partitions_scale_with_what_is_shuffled():
    assert shuffle_partitions_for(0, 8) == 16
    assert shuffle_partitions_for(10 * TARGET_PARTITION_BYTES, 2) == 10
    assert shuffle_partitions_for(5 * 1024**4, 8000) == 20480
    assert shuffle_partitions_for(100 * 1024**4, 8000) == MAX_SHUFFLE_PARTITIONS
    conf = scale_conf(2 * 1024**4, 8000)
    assert conf["spark.sql.shuffle.partitions"] == "16000"
    assert conf["spark.sql.adaptive.enabled"] == "true"


def test_shared_dir_reads_the_session_setting(spark):
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert named, "the test session always has a shared folder"
    assert shared_dir(spark) == named.rstrip("/")
