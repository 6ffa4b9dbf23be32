"""Where layer tables are kept. All stores offer the same operations."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from sedimenta.operators.merge import KeyColumn, key_pairs, refuse_copies
from sedimenta.plans.spec import LakeLayout
from sedimenta.sources import catalog, snapshots

Values = Mapping[str, str | Column]
Keys = KeyColumn | Sequence[KeyColumn]


@dataclass(frozen=True)
class Saved:
    """Rows in the table after a save, if known, and whether there was nothing to save."""

    rows: int | None
    empty: bool = False


@dataclass(frozen=True)
class SnapshotStore:
    """Tables as Parquet snapshots below the layer roots. ``keep`` versions stay on disk."""

    spark: SparkSession
    layout: LakeLayout
    keep: int = 3
    keeps_versions = True

    def exists(self, layer: str, table: str) -> bool:
        return snapshots.table_exists(self.spark, self.layout.path(layer, table))

    def read(self, layer: str, table: str) -> DataFrame:
        return snapshots.read_table(self.spark, self.layout.path(layer, table))

    def version(self, layer: str, table: str) -> object:
        """What ``read`` would read now; equal values mean equal rows. None if not known."""
        return snapshots.latest_version(self.spark, self.layout.path(layer, table))

    def save(
        self,
        source: DataFrame,
        layer: str,
        table: str,
        on: Keys,
        stage: bool = True,
        unique: bool = False,
        gone: DataFrame | None = None,
        batch: tuple[str, int] | None = None,
    ) -> Saved:
        """Create the table, or upsert ``source``. It fails if two rows share a key;
        ``unique`` leaves that check out. ``stage=False`` leaves out the intermediate files:
        for a source that is a mere scan of rows, about as many as the table has. Rows with a key
        of ``gone`` that ``source`` does not have leave the table. ``batch`` is the stream and the
        number of the batch, for ``has_batch``."""
        path = self.layout.path(layer, table)
        version = None if batch is None else snapshots.begin_batch(self.spark, path, *batch)
        if stage or not snapshots.table_exists(self.spark, path):
            info = snapshots.create_or_upsert(
                source, path, on, source_unique=unique, form="outer", gone=gone, version=version
            )
        else:
            info = snapshots.upsert(source, path, on, source_unique=unique, form="outer")
        self._expire(path)
        return Saved(None, empty=True) if info is None else Saved(info.rows)

    def save_first(
        self,
        rows: DataFrame,
        layer: str,
        table: str,
        on: Keys,
        keys: Sequence[str],
        order_by: Sequence[str | Column] = (),
        finish: Callable[[DataFrame], DataFrame] | None = None,
        gone: DataFrame | None = None,
    ) -> Saved:
        """``save`` of the first row of each of ``keys``, as ``finish`` gives it; ``dedupe`` says which
        is first. Rows are held in files meanwhile and mostly not shuffled."""
        path = self.layout.path(layer, table)
        info = snapshots.save_first(rows, path, on, keys, order_by, finish, gone)
        self._expire(path)
        return Saved(None, empty=True) if info is None else Saved(info.rows)

    def set_matched(
        self, source: DataFrame, layer: str, table: str, on: Keys, values: Values
    ) -> None:
        """Set columns of the rows whose key is among those of ``source``."""
        path = self.layout.path(layer, table)
        snapshots.set_matched_many(source, {path: on}, values)
        self._expire(path)

    def set_most(
        self, source: DataFrame, layer: str, table: str, on: Keys, values: Values
    ) -> None:
        """``set_matched`` where most rows of the table are expected to match."""
        path = self.layout.path(layer, table)
        snapshots.set_most(source, path, on, values)
        self._expire(path)

    def set_where(self, layer: str, table: str, rows: Column, values: Values) -> None:
        """Set columns of the rows that meet a condition. Does not shuffle."""
        path = self.layout.path(layer, table)
        snapshots.set_where(self.spark, path, rows, values)
        self._expire(path)

    def set_all(self, layer: str, table: str, values: Values) -> None:
        """Set columns of all rows. Constants are noted beside the rows, which stay as they are."""
        path = self.layout.path(layer, table)
        snapshots.set_all(self.spark, path, values)
        self._expire(path)

    def changes(self, layer: str, table: str, since: int, on: Sequence[str]) -> DataFrame | None:
        """The rows that differ from version ``since``; None if that is no longer there."""
        return snapshots.read_changes(self.spark, self.layout.path(layer, table), since, on)

    def change_slices(self, layer: str, table: str, since: int, on: Sequence[str]) -> list[DataFrame] | None:
        """``changes`` as frames for ``held``, of which one is computed after another."""
        return snapshots.changes_in_slices(self.spark, self.layout.path(layer, table), since, on)

    def taken(self, layer: str, table: str) -> dict[str, object]:
        """The versions of its inputs that a table was last made from."""
        return snapshots.read_taken(self.spark, self.layout.path(layer, table))

    def note_taken(self, layer: str, table: str, taken: Mapping[str, object]) -> None:
        snapshots.note_taken(self.spark, self.layout.path(layer, table), taken)

    def has_batch(self, layer: str, table: str, query: str, batch_id: int) -> bool:
        """Whether a batch of a stream is in the table already."""
        return snapshots.has_batch(self.spark, self.layout.path(layer, table), query, batch_id)

    def overwrite(self, source: DataFrame, layer: str, table: str) -> Saved:
        """The table holds the rows of ``source`` and no others."""
        path = self.layout.path(layer, table)
        info = snapshots.write_snapshot(source, path)
        self._expire(path)
        return Saved(info.rows, empty=not info.rows)

    def replace(
        self, fresh: DataFrame, layer: str, table: str, keys: DataFrame, on: Sequence[str]
    ) -> Saved:
        """The rows of the given keys become those of ``fresh``; other rows stay."""
        path = self.layout.path(layer, table)
        info = snapshots.replace_keys(fresh, path, keys, on)
        self._expire(path)
        return Saved(info.rows)

    def remove(self, keys: DataFrame, layer: str, table: str, on: Sequence[str]) -> Saved:
        """Rows with a key of ``keys`` leave the table."""
        return self.replace(self.read(layer, table).limit(0), layer, table, keys, on)

    @contextmanager
    def held(
        self, frame: DataFrame | Sequence[DataFrame], layer: str, table: str
    ) -> Iterator[tuple[DataFrame, int]]:
        """A frame, or the union of several, computed once, into files beside the table, with its number of rows."""
        with snapshots.staged(frame, self.layout.path(layer, table)) as (stored, rows, _):
            yield stored, rows

    def _expire(self, path: str) -> None:
        snapshots.expire_snapshots(self.spark, path, self.keep)


@dataclass(frozen=True)
class CatalogStore:
    """Tables ``<namespace>.<layer>_<table>`` in a catalog with row-level operations.

    Row counts are not known without another job and are not reported; an empty source is
    merged like any other and changes nothing.
    """

    spark: SparkSession
    namespace: str
    provider: str
    keeps_versions = False

    def name(self, layer: str, table: str) -> str:
        return f"{self.namespace}.{layer}_{table}"

    def exists(self, layer: str, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(layer, table))

    def read(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    def version(self, layer: str, table: str) -> object:
        return None

    def save(
        self,
        source: DataFrame,
        layer: str,
        table: str,
        on: Keys,
        stage: bool = True,
        unique: bool = False,
    ) -> Saved:
        source = source if unique else refuse_copies(source, on)
        catalog.create_or_merge(source, self.name(layer, table), on, self.provider)
        return Saved(None)

    def set_matched(
        self, source: DataFrame, layer: str, table: str, on: Keys, values: Values
    ) -> None:
        keys = source.select(*[p.source for p in key_pairs(on)]).distinct()
        catalog.merge_set(keys, self.name(layer, table), on, values)

    def set_where(self, layer: str, table: str, rows: Column, values: Values) -> None:
        catalog.update_where(self.spark, self.name(layer, table), rows, values)
