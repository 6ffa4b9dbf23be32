"""Folders for intermediate tables, in storage that driver and executors share."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from sedimenta.sources import files

#: Rows of an Arrow batch while a table is written: rows hold whole texts or sets, and tasks keep
#: a batch in the JVM and in Python at once.
BATCH_ROWS = 1000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
_UNSET = "-1"
_lock = threading.Lock()
_writing = 0
_before = _UNSET


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of `BATCH_ROWS` rows at most; the session's setting is back after the last
    write that overlaps this one."""
    global _writing, _before
    with _lock:
        if not _writing:
            _before = spark.conf.get(_BATCH_SETTING, _UNSET)
            rows = int(_before)
            spark.conf.set(_BATCH_SETTING, str(min(rows, BATCH_ROWS) if rows > 0 else BATCH_ROWS))
        _writing += 1
    try:
        yield
    finally:
        with _lock:
            _writing -= 1
            if not _writing:
                if _before == _UNSET:
                    spark.conf.unset(_BATCH_SETTING)
                else:
                    spark.conf.set(_BATCH_SETTING, _before)


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where that is unset, a local session has one below the
    warehouse; any other is refused, as its executors may not share a folder with the driver."""
    given = spark.sparkContext.getConf().get("spark.checkpoint.dir", "") or spark.conf.get("spark.checkpoint.dir", "")
    if not given and not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (given or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch").rstrip("/")


class Scratch:
    """Tables of one run, each written once and read back: lineage ends there. They go when the
    driver ends; results are lazy and read from them, so they cannot go earlier."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        files.delete_at_exit(spark, self.folder)
        self._count = 0

    def path(self, name: str) -> str:
        self._count += 1
        return f"{self.folder}/{self._count:03d}-{name}"

    def keep(self, frame: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        with small_batches(self.spark):
            frame.write.parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)
