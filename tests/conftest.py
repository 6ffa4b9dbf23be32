from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from sedimenta.plans import LakeLayout, SnapshotStore  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def layout(tmp_path):
    return LakeLayout(*(str(tmp_path / n) for n in ("transient", "bronze", "silver", "gold")))


@pytest.fixture
def store(spark, layout):
    return SnapshotStore(spark, layout)


def rows(df):
    """The rows of a frame as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
