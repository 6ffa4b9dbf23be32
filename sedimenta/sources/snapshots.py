"""Stored tables as Parquet snapshots, for when no format with built-in MERGE is at hand.

A table is a directory holding one directory per version:

    VENDAS/v000001/  VENDAS/v000002/ ...

Readers take the highest version that has its ``_SUCCESS`` marker, which Spark's commit
writes last, so a half-written version is never seen. A version never changes once
complete; that is what lets a table be merged into itself. There is one writer per table.

A merge writes the whole table once. Where the batches are small against the table, use a
catalog table whose format supports MERGE instead (``sedimenta.sources.catalog``), which
rewrites the touched files only.

A version made by merging a batch keeps the batch beside it (``_batch``, which readers do not
see), but for one about as large as the table. ``read_changes`` then compares two versions at the keys of the batches between them only.

Setting columns of all rows to constants writes no rows: such a version is a note (``_set.json``)
of the versions its rows are in and of the values. So is one in which a batch held the rows of the
table once more, with other audit columns. If a batch holds new keys only, the version has the batch for files and
a note of the versions that hold the other rows. When one of those is expired while the note is kept,
its files go to ``_base``, where the note finds them.

What compares or joins large stored tables does so slice by slice of the hashed keys (``_slices``), so
that the shuffles of one slice are gone before those of the next are made.

Files are compressed with ZSTD: row keys are hexadecimal text, of which Snappy saves nothing. The
shuffles of a write are dropped when it ends, not when the driver next collects its garbage.
"""

from __future__ import annotations

import hashlib
import json
import re
import threading
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, TimestampType

from sedimenta.functions.keys import content_sums, has_exact_text, is_hashed_whole
from sedimenta.operators.audit import CREATED, PROCESSED
from sedimenta.operators.changes import CHANGE, INSERT, replace_by_key, table_changes
from sedimenta.operators.dedupe import dedupe, distinct_keys, key_list
from sedimenta.operators.merge import (
    KeyColumn,
    KeyPair,
    key_pairs,
    leftover_keys,
    merge_frames,
    refuse_copies,
    replaces_rows,
    unreplaced,
    with_joined_keys,
    without_key,
)
from sedimenta.sources import files

_VERSION = re.compile(r"v(\d{6,})")
_STAGING = "_staging"
_BATCH = "_batch"
_TAKEN = "_taken.json"
_STREAMS = "_streams"
_SET = "_set.json"
_BASE = "_base"
#: Values ``set_all`` can note: SQL literals, which mean the same whenever they are read.
_CONSTANT = re.compile(r"(?i)true|false|null|[+-]?\d+|'[^'\\]*'")
CODEC = "zstd"
#: Bytes of batches that are looked for by their keys in a table of any size.
_SMALL = 16 * 1024 * 1024
#: Bytes of stored rows from which they are compared and joined in slices, and the most slices.
_SLICE = 64 * 1024 * 1024
_MOST_SLICES = 8
#: Versions that the rows of one version may lie in.
_MOST_PARTS = 8
_HASH = "__hash"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_writing: dict[str, object] = {"lock": threading.Lock(), "writes": 0, "before": None}


@dataclass(frozen=True)
class SnapshotInfo:
    """What a write left behind: version number, its path and its rows."""

    version: int
    path: str
    rows: int


def _version_path(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/v{version:06d}"


def _versions(spark: SparkSession, path: str) -> list[int]:
    """All version numbers present, complete or not, ascending."""
    found = (_VERSION.fullmatch(n) for n in files.subdirectories(spark, path))
    return sorted(int(m.group(1)) for m in found if m)


def latest_version(spark: SparkSession, path: str) -> int | None:
    """The newest complete version, or None if the table does not exist."""
    for version in reversed(_versions(spark, path)):
        if files.exists(spark, _version_path(path, version) + "/_SUCCESS"):
            return version
    return None


def table_exists(spark: SparkSession, path: str) -> bool:
    return latest_version(spark, path) is not None


def read_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The newest complete snapshot, or the given version."""
    chosen = latest_version(spark, path) if version is None else version
    if chosen is None:
        raise FileNotFoundError(f"no stored table at {path}")
    return reduce(DataFrame.unionByName, [_read_part(spark, path, v, s) for v, s in _parts(spark, path, chosen)])


def _read_part(spark: SparkSession, path: str, version: int, values: Mapping[str, str]) -> DataFrame:
    rows = spark.read.parquet(_base_folder(spark, path, version))
    types = {f.name: f.dataType for f in rows.schema.fields}
    return rows.withColumns({c: F.expr(v).cast(types[c]) for c, v in values.items()}) if values else rows


Parts = list[tuple[int, dict[str, str]]]


def _parts(spark: SparkSession, path: str, version: int) -> Parts:
    """The versions whose files hold the rows of a version, and the values set in them."""
    text = files.read_text(spark, f"{_version_path(path, version)}/{_SET}")
    if text is None:
        return [(version, {})]
    note = json.loads(text)
    found = note["parts"] if "parts" in note else [note]  # a note of one version only
    return [(part["base"], part["values"]) for part in found]


def _write_note(spark: SparkSession, folder: str, parts: Parts) -> None:
    note = {"parts": [{"base": base, "values": values} for base, values in parts]}
    files.write_text(spark, f"{folder}/{_SET}", json.dumps(note))


def _note_values(spark: SparkSession, path: str, values: Mapping[str, str], goal: int) -> str:
    """A version with the rows of the newest one and some columns set to constants; its folder."""
    below = _parts(spark, path, latest_version(spark, path))
    folder = _version_path(path, goal)
    _write_note(spark, folder, [(base, {**held, **values}) for base, held in below])
    files.write_text(spark, f"{folder}/_SUCCESS", "")
    return folder


def _base_folder(spark: SparkSession, path: str, version: int) -> str:
    """Where the rows of a version are that others stand on."""
    here = _version_path(path, version)
    return here if files.exists(spark, here) else _version_path(f"{path.rstrip('/')}/{_BASE}", version)


def write_snapshot(df: DataFrame, path: str, version: int | None = None) -> SnapshotInfo:
    """Write ``df`` as the next version, or under a number set aside for it. One job: the rows are
    counted on the way."""
    spark = df.sparkSession
    version = next_version(spark, path) if version is None else version
    goal = _version_path(path, version)
    return SnapshotInfo(version, goal, _write_counted(df, goal))


def _write_joined(
    frames: Sequence[DataFrame], path: str, version: int | None = None, stored: str | None = None, rows: int = 0
) -> SnapshotInfo:
    """Write frames one after another as the next version, which is seen when all is there. The files
    of the folder ``stored``, of so many rows of the same columns, become files of the version."""
    spark = frames[0].sparkSession
    version = next_version(spark, path) if version is None else version
    goal = _version_path(path, version)
    if len(frames) == 1 and stored is None:
        return SnapshotInfo(version, goal, _write_counted(frames[0], goal))
    aside = f"{path.rstrip('/')}/{_STAGING}/{uuid.uuid4().hex}"
    folder = _version_path(aside, version)
    try:
        rows += _write_counted(frames[0] if len(frames) == 1 else frames, folder)
        if stored is not None:
            files.move_parts(spark, stored, folder)
        files.rename(spark, folder, goal)
    finally:
        files.delete(spark, aside)
    return SnapshotInfo(version, goal, rows)


def next_version(spark: SparkSession, path: str) -> int:
    """The number the next write will have: above all versions, and all set aside for streams."""
    aside = [note["version"] for note in _stream_notes(spark, path).values()]
    return max([*_versions(spark, path), *aside], default=0) + 1


def is_complete(spark: SparkSession, path: str, version: int) -> bool:
    return files.exists(spark, _version_path(path, version) + "/_SUCCESS")


def _write_counted(df: DataFrame | Sequence[DataFrame], goal: str) -> int:
    """Write a frame, or several one after another, and count the rows."""
    rows = 0
    for i, frame in enumerate([df] if isinstance(df, DataFrame) else df):
        seen = Observation()
        counted = frame.observe(seen, F.count(F.lit(1)).alias("rows"))
        with shuffles_dropped(frame.sparkSession):
            counted.write.mode("append" if i else "errorifexists").option("compression", CODEC).parquet(goal)
        rows += seen.get["rows"]
    return rows


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written within go when its job ends. The setting is the session's,
    so the first of several threads makes it and the last one takes it back."""
    state = _writing
    with state["lock"]:
        if not state["writes"]:
            state["before"] = spark.conf.get(_CLEANUP, None)
            spark.conf.set(_CLEANUP, "true")
        state["writes"] += 1
    try:
        yield
    finally:
        with state["lock"]:
            state["writes"] -= 1
            if not state["writes"]:
                if state["before"] is None:
                    spark.conf.unset(_CLEANUP)
                else:
                    spark.conf.set(_CLEANUP, state["before"])


@contextmanager
def staged(df: DataFrame | Sequence[DataFrame], table_path: str) -> Iterator[tuple[DataFrame, int, str]]:
    """``df`` computed once and held in files next to the table, with its rows and its folder.

    A merge reads its source several times. From files those reads are scans, lost
    executors cost no recomputation of the source, and the optimizer knows its size. Several frames
    of the same columns are computed one after another.
    """
    first = df if isinstance(df, DataFrame) else df[0]
    spark = first.sparkSession
    goal = f"{table_path.rstrip('/')}/{_STAGING}/{uuid.uuid4().hex}"
    try:
        rows = _write_counted(df, goal)
        yield spark.read.schema(first.schema).parquet(goal), rows, goal
    finally:
        files.delete(spark, goal)


def _slices(df: DataFrame, keys: Sequence[str], size: int) -> int:
    """In how many slices of hashed keys rows of so many bytes are joined or compared by them."""
    return min(_MOST_SLICES, max(1, size // _SLICE)) if _hashed_whole(df, keys) else 1


def _hashed_whole(df: DataFrame, keys: Sequence[str]) -> bool:
    return all(is_hashed_whole(f.dataType) for f in df.select(*map(_q, keys)).schema.fields)


def _slice(df: DataFrame, keys: Sequence[str], part: int, of: int) -> DataFrame:
    """The rows of one slice: all those of a key, or none."""
    return df if of == 1 else df.where(F.pmod(F.xxhash64(*map(_q, keys)), F.lit(of)) == part)


def _q(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def upsert(
    source: DataFrame,
    path: str,
    on: KeyColumn | Sequence[KeyColumn],
    *,
    delete_when: str | Column | None = None,
    source_unique: bool = False,
    form: str = "probe",
    gone: DataFrame | None = None,
    version: int | None = None,
    large: bool = True,
    stored: tuple[str, int] | None = None,
) -> SnapshotInfo:
    """Update all columns on a match, insert otherwise, delete where asked. Rows with a key of
    ``gone`` leave the table first.

    In the ``outer`` form a source with distinct keys and the table's columns is not joined with
    the table but put in the place of its rows (``merge_frames``, ``replace``). If it is ``large``
    against the table, the keys that stay are found first, by keys alone: mostly few. ``stored`` is
    the folder of a large source that is in files already, with the table's columns, and its rows: the files become
    those of the version.
    """
    target = read_table(source.sparkSession, path)
    if gone is not None:
        names = [p.target for p in key_pairs(on)]
        target = target.join(gone.select(*names).distinct(), names, "left_anti").select(target.columns)
    if form == "outer" and source_unique and delete_when is None and replaces_rows(target, source, on):
        return _replace_rows(source, target, path, on, version, large, stored)
    merged = merge_frames(
        target, source, on, delete_when=delete_when, source_unique=source_unique, form=form
    )
    return write_snapshot(merged, path, version)


def _replace_rows(
    source: DataFrame,
    target: DataFrame,
    path: str,
    on: KeyColumn | Sequence[KeyColumn],
    version: int | None,
    large: bool,
    stored: tuple[str, int] | None,
) -> SnapshotInfo:
    spark, keys = source.sparkSession, [p.target for p in key_pairs(on)]
    of = _slices(target, keys, _bytes(spark, path, latest_version(spark, path)))
    cut = lambda df, i: _slice(df, keys, i, of)
    if not large:
        if of == 1:
            return write_snapshot(merge_frames(target, source, on, source_unique=True, form="replace"), path, version)
        kept = [unreplaced(cut(target, i), cut(source, i), on) for i in range(of)]
        return _write_joined([*kept, source.select(target.columns)], path, version)
    left = [leftover_keys(cut(target, i), cut(source, i), on) for i in range(of)]
    with staged(left[0] if of == 1 else left, path) as (others, rows, _):
        if stored is None:
            merged = merge_frames(target, source, on, source_unique=True, form="replace", leftover=others)
            return write_snapshot(merged, path, version)
        folder, taken = stored
        if not rows and without_key(target, key_pairs(on)).isEmpty():
            goal = next_version(spark, path) if version is None else version
            files.rename(spark, folder, _version_path(path, goal))
            return SnapshotInfo(goal, _version_path(path, goal), taken)
        kept = [unreplaced(cut(target, i), source, on, others) for i in range(of)]
        return _write_joined(kept, path, version, folder, taken)


def set_matched(
    source: DataFrame,
    path: str,
    on: KeyColumn | Sequence[KeyColumn],
    values: Mapping[str, str | Column],
    *,
    source_unique: bool = False,
) -> SnapshotInfo:
    """Set columns of the rows whose key is in ``source``; nothing is inserted."""
    target = read_table(source.sparkSession, path)
    merged = merge_frames(
        target, source, on, update=values, insert=False, source_unique=source_unique
    )
    return write_snapshot(merged, path)


def set_most(
    source: DataFrame, path: str, on: KeyColumn | Sequence[KeyColumn], values: Mapping[str, str | Column]
) -> SnapshotInfo:
    """``set_matched`` for a source, repeating keys or not, that most rows of the table match. The keys
    that it does not hold are found by keys alone; if there are none, constants are noted for all rows."""
    spark, pairs = source.sparkSession, key_pairs(on)
    target = read_table(spark, path)
    constant = all(isinstance(v, str) and _CONSTANT.fullmatch(v.strip()) for v in values.values())
    if not constant or not set(values) <= set(target.columns):
        return set_matched(distinct_keys(source, [p.source for p in pairs]), path, on, values, source_unique=True)
    held, names = with_joined_keys(target, source, pairs, "target")
    keyless = without_key(target, pairs)
    if _same_keys(target, source, pairs):
        return set_all(spark, path, values)
    with staged(leftover_keys(target, source, on), path) as (others, rows, _):
        if not rows and keyless.isEmpty():
            return set_all(spark, path, values)
        types = {f.name: f.dataType for f in target.schema.fields}
        marked = held.join(others.distinct().withColumn("__other", F.lit(True)), names, "left")
        new = {c: F.when(F.col("__other").isNull(), F.expr(v).cast(types[c])).otherwise(F.col(c)) for c, v in values.items()}
        return write_snapshot(marked.withColumns(new).select(*target.columns).unionByName(keyless), path)


def _same_keys(target: DataFrame, source: DataFrame, pairs: Sequence[KeyPair]) -> bool:
    """Whether both sides hold the same keys equally often, and none with a NULL: told by sums over
    the rows, without a shuffle. False also where that cannot be told."""
    kinds = [(target.select(_q(p.target)).schema[0].dataType, source.select(_q(p.source)).schema[0].dataType) for p in pairs]
    if not all(a == b and has_exact_text(a) for a, b in kinds):
        return False
    if not without_key(target, pairs).isEmpty():
        return False
    was = _sums(target.select(*[_q(p.target).alias(f"k{i}") for i, p in enumerate(pairs)]))
    return was is not None and was == _sums(source.select(*[_q(p.source).alias(f"k{i}") for i, p in enumerate(pairs)]))


def _sums(df: DataFrame) -> tuple | None:
    """The rows and ``content_sums`` of all columns; None for more rows than these hold."""
    row = df.agg(F.count(F.lit(1)), *content_sums(df.columns, df)).first()
    return tuple(row) if row[0] < 2**33 else None


def set_matched_many(
    source: DataFrame,
    tables: Mapping[str, Sequence[KeyColumn]],
    values: Mapping[str, str | Column],
) -> dict[str, SnapshotInfo]:
    """``set_matched`` for several tables, each with its own keys against ``source``.

    The source is folded to distinct keys per table, so it may repeat them freely; the
    values can therefore not refer to source columns other than the keys.
    """
    done = {}
    for path, on in tables.items():
        keys = distinct_keys(source, [p.source for p in key_pairs(on)])
        done[path] = set_matched(keys, path, on, values, source_unique=True)
    return done


def set_where(
    spark: SparkSession, path: str, rows: Column, values: Mapping[str, str | Column]
) -> SnapshotInfo:
    """Set columns of the rows that meet a condition. Does not shuffle."""
    target = read_table(spark, path)
    types = {f.name: f.dataType for f in target.schema.fields}
    changed = {}
    for name, value in values.items():
        new = F.expr(value) if isinstance(value, str) else value
        changed[name] = F.when(rows, new.cast(types[name])).otherwise(F.col(name))
    return write_snapshot(target.withColumns(changed), path)


def set_all(spark: SparkSession, path: str, values: Mapping[str, str | Column]) -> SnapshotInfo:
    """Set columns of all rows. Where the values are constants this writes a note, not the rows."""
    version = latest_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"no stored table at {path}")
    held = read_table(spark, path, version)
    constant = all(isinstance(v, str) and _CONSTANT.fullmatch(v.strip()) for v in values.values())
    if not constant or not set(values) <= set(held.columns):
        return set_where(spark, path, F.lit(True), values)
    goal = next_version(spark, path)
    return SnapshotInfo(goal, _note_values(spark, path, values, goal), held.count())


def create_or_upsert(
    source: DataFrame,
    path: str,
    on: KeyColumn | Sequence[KeyColumn],
    *,
    source_unique: bool = False,
    form: str | None = None,
    gone: DataFrame | None = None,
    version: int | None = None,
) -> SnapshotInfo | None:
    """Create the table from ``source``, or upsert into it; None if there were no rows.

    ``form`` is that of the merge, whatever the size of the batch: ``outer`` (the default
    with ``source_unique``: a table made by this alone then holds each key once, so no key
    of it is hot) or ``probe`` (the default otherwise, and the one for a small source or a
    table that holds a key very often). Without ``source_unique`` a new table is refused a
    source that repeats a key.
    """
    spark = source.sparkSession
    if not table_exists(spark, path):
        info = write_snapshot(source if source_unique else refuse_copies(source, on), path, version)
        if info.rows:
            return info
        files.delete(spark, info.path)
        return None
    held = read_table(spark, path)
    if replaces_rows(held, source, on):
        source = source.select(held.columns)
    with staged(source, path) as (batch, rows, folder):
        return _merge_stored(batch, rows, folder, path, on, source_unique, form, gone, version)


def _merge_stored(
    batch: DataFrame,
    rows: int,
    folder: str,
    path: str,
    on: KeyColumn | Sequence[KeyColumn],
    source_unique: bool,
    form: str | None,
    gone: DataFrame | None,
    version: int | None,
) -> SnapshotInfo | None:
    """Merge a batch that is in files beside the table."""
    if not rows and gone is None:
        return None
    spark = batch.sparkSession
    chosen = form or ("outer" if source_unique else "probe")
    target = read_table(spark, path)
    whole = chosen == "outer" and source_unique and replaces_rows(target, batch, on)
    if whole and gone is None and version is None:  # a number set aside is for a version that is written
        info = _restated(batch, rows, target, path, on, version) or _appended(batch, rows, folder, target, path, on, version)
        if info is not None:
            return info
    size = files.total_bytes(spark, folder)
    large = 2 * size >= _bytes(spark, path, latest_version(spark, path))
    keep = gone is None and (size < _SMALL or not large)
    stored = (folder, rows) if large and not keep and batch.columns == target.columns else None
    info = upsert(
        batch, path, on, source_unique=source_unique, form=chosen, gone=gone, version=version, large=large, stored=stored
    )
    if gone is None and files.exists(spark, folder) and (size < _SMALL or 2 * size < _bytes(spark, path, info.version)):
        files.rename(spark, folder, f"{info.path}/{_BATCH}")
    return info


def _restated(
    batch: DataFrame,
    rows: int,
    target: DataFrame,
    path: str,
    on: KeyColumn | Sequence[KeyColumn],
    version: int | None = None,
) -> SnapshotInfo | None:
    """Where a batch holds the rows of the table and no others, but for audit columns that are constant
    in it, a note of these is the version. That is told by sums over the rows, without a shuffle."""
    spark, keys = batch.sparkSession, [p.target for p in key_pairs(on)]
    marks = [c for c in (PROCESSED, CREATED) if c in target.columns]
    rest = [c for c in target.columns if c not in marks]
    kinds = {f.name: f.dataType for f in target.schema.fields}
    if not set(keys) <= set(rest) or not all(has_exact_text(kinds[c]) for c in rest):
        return None
    if not all(isinstance(kinds[c], (BooleanType, TimestampType)) for c in marks) or target.count() != rows:
        return None
    plain = {c: F.unix_micros(c) if isinstance(kinds[c], TimestampType) else F.col(c) for c in marks}
    ends = [f(plain[c]) for c in marks for f in (F.min, F.max, F.count)]
    lacks = reduce(Column.__or__, [_q(k).isNull() for k in keys])
    sums = content_sums(rest, batch)
    held = batch.agg(F.count_if(lacks), *ends, F.count(F.lit(1)), *sums).first()
    spans = [held[1 + 3 * i : 4 + 3 * i] for i in range(len(marks))]
    if held[0] or rows >= 2**33 or any(low != high or filled not in (0, rows) for low, high, filled in spans):
        return None
    if tuple(held[-1 - len(sums) :]) != _sums(target.select(*map(_q, rest))):
        return None
    values = {}
    for c, (low, _, _) in zip(marks, spans):
        values[c] = "null" if low is None else str(low).lower() if isinstance(low, bool) else f"timestamp_micros({low})"
    goal = next_version(spark, path) if version is None else version
    return SnapshotInfo(goal, _note_values(spark, path, values, goal), rows)


def _appended(
    batch: DataFrame,
    rows: int,
    folder: str,
    target: DataFrame,
    path: str,
    on: KeyColumn | Sequence[KeyColumn],
    version: int | None,
) -> SnapshotInfo | None:
    """Where a batch holds no key of the table its files are the version's, beside those of the
    version before. Hashes of the keys are compared: where none is shared, no key is."""
    spark, keys = batch.sparkSession, [p.target for p in key_pairs(on)]
    parts = _parts(spark, path, latest_version(spark, path))
    if len(parts) >= _MOST_PARTS or not _hashed_whole(target, keys):
        return None
    hashed = lambda df: df.select(F.xxhash64(*map(_q, keys)).alias(_HASH))
    with shuffles_dropped(spark):
        if not hashed(batch).join(hashed(target), _HASH, "left_semi").isEmpty():
            return None
    goal = next_version(spark, path) if version is None else version
    before = target.count()
    _write_note(spark, folder, [*parts, (goal, {})])
    files.rename(spark, folder, _version_path(path, goal))
    return SnapshotInfo(goal, _version_path(path, goal), before + rows)


def save_first(
    rows: DataFrame,
    path: str,
    on: KeyColumn | Sequence[KeyColumn],
    keys: str | Sequence[str],
    order_by: Sequence[str | Column] = (),
    finish: Callable[[DataFrame], DataFrame] | None = None,
    gone: DataFrame | None = None,
) -> SnapshotInfo | None:
    """``create_or_upsert`` of ``finish(dedupe(rows, keys, order_by))``.

    The rows go into files first. Of these only hashes of the keys are shuffled, 8 bytes a row: rows
    whose hash is no other row's are the only ones of their key, and only others are put in order. If
    there are no others the files are the batch.
    """
    spark, names = rows.sparkSession, key_list(keys)
    new = not table_exists(spark, path)
    if not new and finish is None and replaces_rows(read_table(spark, path), rows, on):
        rows = rows.select(read_table(spark, path).columns)
    with staged(rows, path) as (held, count, folder):
        with _first_of_keys(held, count, folder, path, names, order_by) as (batch, all_rows, scan):
            if all_rows and finish is None and not new:
                return _merge_stored(held, count, folder, path, on, True, "outer", gone, None)
            if all_rows and finish is None and count:
                goal = next_version(spark, path)
                files.rename(spark, folder, _version_path(path, goal))
                return SnapshotInfo(goal, _version_path(path, goal), count)
            batch = batch if finish is None else finish(batch)
            if new:
                return create_or_upsert(batch, path, on, source_unique=True)
            target = read_table(spark, path)
            if replaces_rows(target, batch, on):
                batch = batch.select(target.columns)
                if gone is None and scan:
                    same = _restated(batch, count if all_rows else batch.count(), target, path, on)
                    if same is not None:
                        return same
            with staged(batch, path) as (ready, taken, goal):
                files.delete(spark, folder)
                return _merge_stored(ready, taken, goal, path, on, True, "outer", gone, None)


@contextmanager
def _first_of_keys(
    held: DataFrame, count: int, folder: str, path: str, keys: Sequence[str], order_by: Sequence[str | Column]
) -> Iterator[tuple[DataFrame, bool, bool]]:
    """``dedupe`` of rows in files, whether that is all of them, and whether most rows are not shuffled for it."""
    if not _hashed_whole(held, keys) or files.total_bytes(held.sparkSession, folder) < _SMALL:
        yield dedupe(held, keys, order_by, pack=True), False, False
        return
    marked = held.withColumn(_HASH, F.xxhash64(*map(_q, keys)))
    repeated = marked.groupBy(_HASH).count().where("count > 1").select(_HASH)
    with staged(repeated, path) as (shared, hashes, _):
        if not hashes:
            yield held, True, True
        elif 64 * hashes > count:
            yield dedupe(held, keys, order_by, pack=True), False, False
        else:
            alone = marked.join(shared, _HASH, "left_anti").drop(_HASH)
            others = marked.join(shared, _HASH, "left_semi").drop(_HASH)
            yield alone.unionByName(dedupe(others, keys, order_by, pack=True)), False, True


def replace_keys(fresh: DataFrame, path: str, keys: DataFrame, on: str | Sequence[str]) -> SnapshotInfo:
    """Write a version in which the rows of the given keys are those of ``fresh``, and no others."""
    spark, names = fresh.sparkSession, key_list(on)
    target = read_table(spark, path)
    of = _slices(target, names, _bytes(spark, path, latest_version(spark, path)))
    types = {f.name: f.dataType for f in target.schema.fields}
    if of == 1 or set(fresh.columns) != set(types) or len(types) != len(target.columns):
        return write_snapshot(replace_by_key(target, fresh, keys, on), path)
    fresh = fresh.select(*[_q(c).cast(types[c]).alias(c) for c in target.columns])
    with staged(fresh, path) as (_, rows, folder), staged(keys.select(*map(_q, names)), path) as (asked, _, _):
        none = fresh.limit(0)
        kept = [replace_by_key(_slice(target, names, i, of), none, _slice(asked, names, i, of), on) for i in range(of)]
        return _write_joined(kept, path, None, folder, rows)


def read_changes(
    spark: SparkSession, path: str, since: int, on: str | Sequence[str], until: int | None = None
) -> DataFrame | None:
    """The rows in which version ``until`` (by default the newest) differs from ``since``, as
    ``table_changes``. None if one of the two is no longer there.

    Where every version in between kept its batch, both are first cut down to the keys of these
    batches: a semi join, which broadcasts small batches, so of the table only rows of touched keys
    are shuffled. Otherwise all rows are compared, and so they are if the batches are about as large
    as the table, when keys to look for would cost more than they save. Versions that only mark rows
    change none that is compared.
    """
    found = changes_in_slices(spark, path, since, on, until, slices=1)
    return None if found is None else found[0]


def changes_in_slices(
    spark: SparkSession,
    path: str,
    since: int,
    on: str | Sequence[str],
    until: int | None = None,
    slices: int | None = None,
) -> list[DataFrame] | None:
    """``read_changes`` as frames to be computed one after another, by slices of the keys."""
    until = latest_version(spark, path) if until is None else until
    if until is None or not is_complete(spark, path, since) or not is_complete(spark, path, until):
        return None
    old, new = read_table(spark, path, since), read_table(spark, path, until)
    keys = key_list(on)
    between = [v for v in _versions(spark, path) if since < v <= until and is_complete(spark, path, v)]
    between = [v for v in between if not _only_marks(spark, path, v)]
    if not between:
        return [table_changes(old.where(F.lit(False)), new.where(F.lit(False)), on)]
    added = _added_rows(spark, path, since, until, keys)
    if added is not None:
        return [added.withColumn(CHANGE, F.lit(INSERT))]
    batches = [_batch_folder(spark, path, v) for v in between]
    touched = None
    if all(files.exists(spark, b) for b in batches):
        parts = [spark.read.parquet(b) for b in batches]
        size = sum(files.total_bytes(spark, b) for b in batches)
        small = size < _SMALL or 2 * size < _bytes(spark, path, until)
        if small and all(set(keys) <= set(p.columns) for p in parts):
            touched = parts[0].select(*keys)
            for part in parts[1:]:
                touched = touched.unionByName(part.select(*keys))
            touched = touched.distinct()
    if slices is None:
        same = old.select(*keys).schema == new.select(*keys).schema
        slices = _slices(new, keys, _bytes(spark, path, since) + _bytes(spark, path, until)) if same else 1
    cut = lambda df, i: None if df is None else _slice(df, keys, i, slices)
    return [table_changes(cut(old, i), cut(new, i), on, touched=cut(touched, i)) for i in range(slices)]


def _batch_folder(spark: SparkSession, path: str, version: int) -> str:
    """Where the batch is that a version was made by, if it was kept."""
    here, parts = _version_path(path, version), _parts(spark, path, version)
    return here if len(parts) > 1 and version in dict(parts) else f"{here}/{_BATCH}"


def _added_rows(spark: SparkSession, path: str, since: int, until: int, keys: Sequence[str]) -> DataFrame | None:
    """The rows of the batches that were put beside those of ``since``; None if more than that was done."""
    old, new = _parts(spark, path, since), _parts(spark, path, until)
    rest = lambda values: {c: v for c, v in values.items() if c not in (PROCESSED, CREATED)}
    if len(new) <= len(old) or [(v, rest(s)) for v, s in old] != [(v, rest(s)) for v, s in new[: len(old)]]:
        return None
    added = reduce(DataFrame.unionByName, [_read_part(spark, path, v, s) for v, s in new[len(old) :]])
    return added if without_key(added, key_pairs(keys)).isEmpty() else None


def _only_marks(spark: SparkSession, path: str, version: int) -> bool:
    """Whether a version is a note that sets audit columns in the rows of the one before."""
    return all(base != version and set(values) <= {PROCESSED, CREATED} for base, values in _parts(spark, path, version))


def _bytes(spark: SparkSession, path: str, version: int) -> int:
    """The size of a version's rows."""
    size = 0
    for base, _ in _parts(spark, path, version):
        folder = _base_folder(spark, path, base)
        batch = f"{folder}/{_BATCH}"
        size += files.total_bytes(spark, folder)
        size -= files.total_bytes(spark, batch) if files.exists(spark, batch) else 0
    return size


def begin_batch(spark: SparkSession, path: str, query: str, batch_id: int) -> int:
    """Set a version number aside for a batch of a stream, and note which, before it is written.

    No other write takes this number, so the version's own commit commits the batch as well: there
    is no moment between the two in which a job could end.
    """
    version = next_version(spark, path)
    note = {"batch": batch_id, "version": version}
    files.write_text(spark, f"{path.rstrip('/')}/{_STREAMS}/{_plain(query)}/note.json", json.dumps(note))
    return version


def has_batch(spark: SparkSession, path: str, query: str, batch_id: int) -> bool:
    """Whether a batch, or a later one of the same stream, is in the table."""
    note = _stream_notes(spark, path).get(_plain(query))
    if note is None or note["batch"] < batch_id:
        return False
    # Of an earlier batch the stream itself knows that it ended before the noted one began. If the
    # version has been expired meanwhile it is not known whether it was complete: then the batch is
    # merged once more, which repeats no row.
    return note["batch"] > batch_id or is_complete(spark, path, note["version"])


def _stream_notes(spark: SparkSession, path: str) -> dict[str, dict[str, int]]:
    folder = f"{path.rstrip('/')}/{_STREAMS}"
    notes = {}
    for name in files.subdirectories(spark, folder):
        text = files.read_text(spark, f"{folder}/{name}/note.json")
        try:
            notes[name] = json.loads(text or "")
        except ValueError:  # cut off: the version it was to announce had not been begun
            continue
    return notes


def _plain(query: str) -> str:
    """A folder name for any text."""
    return hashlib.sha256(query.encode()).hexdigest()[:32]


def read_taken(spark: SparkSession, path: str) -> dict[str, object]:
    """What ``note_taken`` last wrote."""
    text = files.read_text(spark, f"{path.rstrip('/')}/{_TAKEN}")
    try:
        return json.loads(text) if text else {}
    except ValueError:  # cut off while it was written: then all is taken again
        return {}


def note_taken(spark: SparkSession, path: str, taken: Mapping[str, object]) -> None:
    """Say which versions of its inputs a table has in it. Written after the table's own commit:
    if a job ends between the two, the same changes are taken again, with the same result."""
    files.write_text(spark, f"{path.rstrip('/')}/{_TAKEN}", json.dumps(dict(taken)))


def compact_table(
    spark: SparkSession, path: str, target_bytes: int = 256 * 1024 * 1024
) -> SnapshotInfo:
    """Rewrite the newest snapshot in files of about ``target_bytes``, without a shuffle:
    neighbouring small files are read by one task and written as one file."""
    version = latest_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"no stored table at {path}")
    size = _bytes(spark, path, version)
    wanted = max(1, -(-size // target_bytes))
    return write_snapshot(read_table(spark, path, version).coalesce(wanted), path)


def expire_snapshots(spark: SparkSession, path: str, keep: int = 3) -> list[int]:
    """Delete all but the newest ``keep`` complete versions, and dead half-written ones
    below them. Rows a kept version stands on are set aside. Keep at least two while jobs may still be reading the one before."""
    if keep < 1:
        raise ValueError("at least one version must stay")
    versions = _versions(spark, path)
    complete = [
        v for v in versions if files.exists(spark, _version_path(path, v) + "/_SUCCESS")
    ]
    if len(complete) <= keep:
        return []
    oldest_kept = complete[-keep]
    gone = [v for v in versions if v < oldest_kept]
    needed = {base for v in complete[-keep:] for base, _ in _parts(spark, path, v)}
    aside = f"{path.rstrip('/')}/{_BASE}"
    for version in gone:
        if version in needed:
            files.delete(spark, f"{_version_path(path, version)}/{_BATCH}")
            files.rename(spark, _version_path(path, version), _version_path(aside, version))
        else:
            files.delete(spark, _version_path(path, version))
    for version in _versions(spark, aside):
        if version not in needed:
            files.delete(spark, _version_path(aside, version))
    return gone
