"""The suite's Spark session, and a switch of its ANSI mode."""

from __future__ import annotations

import pathlib
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

CHECKPOINTS = "spark.checkpoint.dir"
# Few partitions and threads: the tests' tables are small.
SETTINGS = {
    "spark.master": "local[2]",
    "spark.app.name": "ledgerlake-tests",
    "spark.sql.shuffle.partitions": "2",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


@pytest.fixture(scope="session")
def spark():
    build = SparkSession.builder
    for name, value in SETTINGS.items():
        build = build.config(name, value)
    running = build.getOrCreate()
    context = running.sparkContext
    context.setLogLevel("ERROR")
    # A folder of the tests' own only where the session names none.
    if not (running.conf.get(CHECKPOINTS, None) or context.getCheckpointDir()):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerlake-test-"))
    yield running
    running.stop()


@pytest.fixture()
def ansi(spark):
    """Set the ANSI mode for one test; the mode before comes back after it."""
    name = "spark.sql.ansi.enabled"
    before = spark.conf.get(name)
    yield lambda on: spark.conf.set(name, "true" if on else "false")
    spark.conf.set(name, before)
