"""Compare a Spark result with a DuckDB result, regardless of row order."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

# Engine type names that mean the same.
_TYPES = {
    "VARCHAR": "string",
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp",
    "timestamp_ntz": "timestamp",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("set timezone = 'UTC'")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def _type_name(name: str) -> str:
    return _TYPES.get(name, name.lower().replace(" ", ""))


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if isinstance(value, decimal.Decimal):
        return str(value.normalize())
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def _rows(names, types, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    schema = [(names[i], types[i]) for i in order]
    plain = sorted((repr(tuple(_plain(row[i]) for i in order)) for row in rows))
    return schema, plain


def differences(df: DataFrame, sql: str, connection: duckdb.DuckDBPyConnection) -> str:
    """'' if the results are equal, else what differs."""
    fields = df.schema.fields
    mine = _rows(
        [f.name for f in fields],
        [_type_name(f.dataType.simpleString()) for f in fields],
        df.collect(),
    )
    relation = connection.sql(sql)
    theirs = _rows(
        relation.columns, [_type_name(str(t)) for t in relation.types], relation.fetchall()
    )
    if mine[0] != theirs[0]:
        return f"schema {set(mine[0]) ^ set(theirs[0])}"
    if len(mine[1]) != len(theirs[1]):
        return f"rows {len(mine[1])} against {len(theirs[1])}"
    for a, b in zip(mine[1], theirs[1]):
        if a != b:
            return f"values {a} against {b}"
    return ""
