"""Path operations through the Hadoop FileSystem API, so that any storage Spark reads works.

Only metadata passes through the driver here: directory names, sizes, renames.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _open(spark, path)
    return fs.exists(p)


def subdirectories(spark: SparkSession, path: str) -> list[str]:
    """Names of the directories right below ``path``; none if it does not exist."""
    fs, p = _open(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


def total_bytes(spark: SparkSession, path: str) -> int:
    fs, p = _open(spark, path)
    return fs.getContentSummary(p).getLength()


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _open(spark, path)
    fs.delete(p, True)


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Have ``path`` deleted when the driver ends, if it exists by then."""
    fs, p = _open(spark, path)
    fs.mkdirs(p)
    fs.deleteOnExit(p)


def move_into(spark: SparkSession, file: str, directory: str) -> str:
    """Move one file below ``directory``; a name already taken there gets a suffix."""
    fs, source = _open(spark, file)
    _, folder = _open(spark, directory)
    fs.mkdirs(folder)
    name = source.getName()
    goal = spark._jvm.org.apache.hadoop.fs.Path(folder, name)
    if fs.exists(goal):
        goal = spark._jvm.org.apache.hadoop.fs.Path(folder, f"{uuid.uuid4().hex}-{name}")
    if not fs.rename(source, goal):
        raise OSError(f"could not move {file} to {directory}")
    return goal.toString()


def move_parts(spark: SparkSession, source: str, goal: str) -> None:
    """Move the data files of a directory into another one; no two writes give them the same name."""
    fs, folder = _open(spark, source)
    _, into = _open(spark, goal)
    for status in fs.listStatus(folder):
        file = status.getPath()
        if status.isFile() and not file.getName().startswith(("_", ".")):
            if not fs.rename(file, spark._jvm.org.apache.hadoop.fs.Path(into, file.getName())):
                raise OSError(f"could not move {file.toString()} to {goal}")


def rename(spark: SparkSession, source: str, goal: str) -> None:
    """Move a directory to a name that is not taken yet."""
    fs, old = _open(spark, source)
    _, new = _open(spark, goal)
    fs.mkdirs(new.getParent())
    if not fs.rename(old, new):
        raise OSError(f"could not move {source} to {goal}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, in place of the one that is there."""
    fs, p = _open(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file as text; None if there is none."""
    fs, p = _open(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
