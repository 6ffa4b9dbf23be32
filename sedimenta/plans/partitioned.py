"""A store whose tables are split by a column, so that a batch rewrites only what it touches.

A table is one folder of Parquet files split by ``lake_part``. A batch is joined with the
partitions it has rows of, and the result replaces exactly these by one write with Spark's dynamic
partition overwrite. Cost follows the touched partitions, whatever the size of the whole.

The partition must be a function of the key or, with a key over the whole content, of any
column: equal keys then always meet in the same partition. Spark moves finished partitions into
place one after the other when the write commits, so readers at that moment may see some of them
replaced already; a format with its own transactions belongs in a ``CatalogStore``.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sedimenta.operators.dedupe import distinct_keys
from sedimenta.operators.merge import key_pairs, merge_frames, refuse_copies
from sedimenta.plans.spec import LakeLayout
from sedimenta.plans.stores import Keys, Saved, SnapshotStore, Values
from sedimenta.sources import files, snapshots
from sedimenta.sources.landing import is_absent

_PART = "lake_part"


@dataclass(frozen=True)
class PartitionedStore:
    """Tables named in ``by`` are split by the given expression over their columns; others
    are kept as in ``SnapshotStore``. Row counts are not known without another job and are not
    reported for split tables."""

    spark: SparkSession
    layout: LakeLayout
    by: Mapping[tuple[str, str], Column] = field(default_factory=dict)
    keep: int = 3
    keeps_versions = False

    @property
    def _whole(self) -> SnapshotStore:
        return SnapshotStore(self.spark, self.layout, self.keep)

    def _split(self, layer: str, table: str) -> bool:
        return (layer, table) in self.by

    def _read_parts(self, layer: str, table: str) -> DataFrame | None:
        """The table with its partition column. Partitions may differ in late columns."""
        try:
            options = {"mergeSchema": "true"}
            return self.spark.read.options(**options).parquet(self.layout.path(layer, table)).withColumn(
                _PART, F.col(_PART).cast("string")
            )
        except AnalysisException as error:
            if not is_absent(error):
                raise
            return None

    def exists(self, layer: str, table: str) -> bool:
        if not self._split(layer, table):
            return self._whole.exists(layer, table)
        return self._read_parts(layer, table) is not None

    def read(self, layer: str, table: str) -> DataFrame:
        if not self._split(layer, table):
            return self._whole.read(layer, table)
        held = self._read_parts(layer, table)
        if held is None:
            raise FileNotFoundError(f"no stored table {layer}.{table}")
        return held.drop(_PART)

    def version(self, layer: str, table: str) -> object:
        """Not known for split tables."""
        return None if self._split(layer, table) else self._whole.version(layer, table)

    def save(
        self,
        source: DataFrame,
        layer: str,
        table: str,
        on: Keys,
        stage: bool = True,
        unique: bool = False,
    ) -> Saved:
        """Upsert into the partitions the batch has rows of. It fails, with nothing changed, if
        two rows share a key (``unique`` leaves that check out) or a value does not fit the type
        of the table's column."""
        if not self._split(layer, table):
            return self._whole.save(source, layer, table, on, stage, unique)
        source = source if unique else refuse_copies(source, on)
        split = source.withColumn(_PART, _part_name(self.by[(layer, table)]))
        if self._read_parts(layer, table) is None:
            # Nothing to merge with: one pass over the source, through no file in between.
            seen = Observation()
            self._write(split, layer, table, seen=seen)
            if not seen.get["rows"]:
                files.delete(self.spark, self.layout.path(layer, table))
                return Saved(None, empty=True)
            return Saved(None)
        with snapshots.staged(split, f"{self.layout.path(layer, table)}_batches") as (batch, rows, _):
            if not rows:
                return Saved(None, empty=True)
            held = self._read_parts(layer, table)
            touched = self._touched(batch)
            # Partitions that are not touched keep their types, so these do too.
            merged = merge_frames(
                held.where(touched), batch, [*key_pairs(on), _PART], source_unique=True, form="outer", widen=False
            )
            self._write(merged, layer, table)
        return Saved(None)

    def set_matched(
        self, source: DataFrame, layer: str, table: str, on: Keys, values: Values
    ) -> None:
        if not self._split(layer, table):
            return self._whole.set_matched(source, layer, table, on, values)
        held = self._read_parts(layer, table)
        pairs = key_pairs(on)
        names = [p.target for p in pairs]
        keys = distinct_keys(source, [p.source for p in pairs]).toDF(*names)
        with snapshots.staged(keys, f"{self.layout.path(layer, table)}_batches") as (asked, _, _):
            touched = self._touched(held.join(asked, names, "left_semi"))
            merged = merge_frames(
                held.where(touched), asked, names, update=values, insert=False, source_unique=True
            )
            self._write(merged, layer, table)

    def set_where(self, layer: str, table: str, rows: Column, values: Values) -> None:
        if not self._split(layer, table):
            return self._whole.set_where(layer, table, rows, values)
        held = self._read_parts(layer, table)
        types = {f.name: f.dataType for f in held.schema.fields}
        touched = held.where(self._touched(held.where(rows)))
        changed = {
            name: F.when(rows, (F.expr(v) if isinstance(v, str) else v).cast(types[name])).otherwise(F.col(name))
            for name, v in values.items()
        }
        self._write(touched.withColumns(changed), layer, table, spread=False)

    def _touched(self, rows: DataFrame) -> Column:
        """Which partitions these rows are in, as a filter the scan prunes folders by. The names
        of the partitions of one batch pass through the driver, as they do in any listing."""
        names = [r[0] for r in rows.select(_PART).distinct().collect()]
        return F.col(_PART).isin(names) if names else F.lit(False)

    def _write(
        self, frame: DataFrame, layer: str, table: str, spread: bool = True, seen: Observation | None = None
    ) -> None:
        """``spread`` makes one file or few per partition, and spreads a hot partition over several
        tasks. Rows that come from a scan of the table lie like that already."""
        frame = frame.hint("rebalance", _PART) if spread else frame
        frame = frame if seen is None else frame.observe(seen, F.count(F.lit(1)).alias("rows"))
        writer = frame.write.mode("overwrite").partitionBy(_PART).option("compression", snapshots.CODEC)
        with snapshots.shuffles_dropped(self.spark):
            writer.option("partitionOverwriteMode", "dynamic").parquet(self.layout.path(layer, table))


def _part_name(value: Column) -> Column:
    """A directory name that needs no escaping and reads back as text, for NULL as well."""
    text = F.coalesce(value.cast("string"), F.lit(""))
    return F.concat(F.lit("p"), F.regexp_replace(text, "[^A-Za-z0-9._-]", "_"))
