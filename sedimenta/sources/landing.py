"""Reading landing files, writing plain files, archiving what was read."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from sedimenta.sources import files

# What a job may name as format, switch and write mode.
FORMATS = ("csv", "avro", "json", "parquet", "delta")
SWITCHES = ("true", "false")
MODES = ("append", "overwrite")

_ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


@dataclass(frozen=True)
class LandingFormat:
    """How the landing files of one table are read.

    Give a ``schema`` for JSON and CSV wherever it is known: inference reads all the data
    once more. ``options`` go to the reader as they are, for instance
    ``datetimeRebaseMode`` and ``int96RebaseMode`` for Parquet files of old writers.
    ``corrupt`` names a column for the text of JSON and CSV records that do not fit the schema,
    which must then be given; without it their values come as NULL.
    """

    format_in: str = "parquet"
    header: str = "true"
    infer_schema: str = "true"
    multiline: str = "true"
    schema: StructType | str | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    corrupt: str | None = None

    def __post_init__(self) -> None:
        _check("format", self.format_in, FORMATS)
        _check("header", self.header, SWITCHES)
        _check("infer_schema", self.infer_schema, SWITCHES)
        _check("multiline", self.multiline, SWITCHES)
        if self.corrupt is not None and (self.schema is None or self.format_in not in ("json", "csv")):
            raise ValueError("a column for corrupt records needs JSON or CSV and a schema")

    def reader_options(self) -> dict[str, str]:
        base: dict[str, str] = {}
        if self.format_in == "json":
            base["multiLine"] = self.multiline
        if self.format_in == "csv":
            base["header"] = self.header
            if self.schema is None:
                base["inferSchema"] = self.infer_schema
        if self.corrupt is not None:
            base |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": self.corrupt}
        return {**base, **self.options}

    def reader_schema(self) -> StructType | str | None:
        """The schema, with the column for corrupt records if there is one."""
        if self.corrupt is None:
            return self.schema
        given = self.schema if isinstance(self.schema, StructType) else StructType.fromDDL(self.schema)
        return StructType([*given.fields, StructField(self.corrupt, StringType())])


def _check(what: str, value: str, allowed: tuple[str, ...]) -> None:
    if value not in allowed:
        raise ValueError(f"{what} must be one of {allowed}, not {value!r}")


def read_landing(
    spark: SparkSession, path: str, landing: LandingFormat = LandingFormat()
) -> DataFrame:
    """The landing files below ``path`` as a lazy frame."""
    reader = spark.read.format(landing.format_in).options(**landing.reader_options())
    if landing.schema is not None:
        reader = reader.schema(landing.reader_schema())
    return reader.load(path)


def is_absent(error: AnalysisException) -> bool:
    """Whether a read failed because there is nothing to read: no folder, or an empty one."""
    return error.getCondition() in _ABSENT


def write_files(
    df: DataFrame,
    path: str,
    format_out: str = "parquet",
    mode: str = "overwrite",
    header: str = "true",
    partition_by: Iterable[str] = (),
) -> None:
    """Write a frame as plain files. ``partition_by`` lays out directories for pruning."""
    _check("format", format_out, FORMATS)
    _check("header", header, SWITCHES)
    _check("mode", mode, MODES)
    writer = df.write.format(format_out).mode(mode)
    if format_out == "csv":
        writer = writer.option("header", header)
    columns = list(partition_by)
    if columns:
        writer = writer.partitionBy(*columns)
    writer.save(path)


def archive_files(spark: SparkSession, paths: Iterable[str], archive: str) -> int:
    """Move the given files to ``archive``; the number of files moved.

    Pass the ``inputFiles()`` of the frame that was loaded, so that files which arrived
    since then stay in the landing folder for the next run. Those paths are URL-encoded.
    """
    moved = 0
    for path in paths:
        files.move_into(spark, unquote(path), archive)
        moved += 1
    return moved
