"""What changed between two versions of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions.keys import is_plain_text, packed, unpacked
from sedimenta.operators.audit import CREATED, PROCESSED
from sedimenta.operators.dedupe import key_list

CHANGE = "change"
INSERT, BEFORE, AFTER, DELETE = "insert", "update_before", "update_after", "delete"


def table_changes(
    old: DataFrame,
    new: DataFrame,
    on: str | Sequence[str],
    ignore: Sequence[str] = (PROCESSED, CREATED),
    touched: DataFrame | None = None,
) -> DataFrame:
    """The rows that differ, with a column ``change``: ``insert``, ``delete``, or the two states
    ``update_before`` and ``update_after`` of a row whose key stayed.

    One full outer join on the key; rows are compared column by column there, so no digest can
    hide a change. Columns named in ``ignore`` are handed on but not compared: a row taken again
    with a new audit time has not changed. The result has the columns of ``new``, then those only
    ``old`` has; old values are cast to the new types.

    ``touched`` are the distinct keys outside of which no row with a whole key differs, where they are
    known: rows are cut down to them, by the partitioning the join needs anyway.

    Each version must hold a key once. A NULL in the key equals nothing, so such rows are compared
    as a whole, copies counted, and are never updates.
    """
    keys = key_list(on)
    types = {f.name: f.dataType for f in [*old.schema.fields, *new.schema.fields]}
    names = [*new.columns, *(c for c in old.columns if c not in new.columns)]
    compared = [c for c in names if c not in keys and c not in ignore]
    was, now = _unused("__old", names), _unused("__new", names)

    def whole(df: DataFrame) -> DataFrame:
        return df.select(
            *[(F.col(_q(c)) if c in df.columns else F.lit(None)).cast(types[c]).alias(c) for c in names]
        )

    old, new = whole(old), whole(new)
    present = F.lit(True)
    for k in keys:
        present = present & F.col(_q(k)).isNotNull()

    rest = [c for c in names if c not in keys]
    texts = {k for k in keys if is_plain_text(types[k])}

    def keyed(df: DataFrame, name: str) -> DataFrame:
        """Key columns under names of their own, packed, and the rest of the row: the key goes along once."""
        asked = df.where(present)
        if touched is not None:
            asked = asked.join(touched.select(*map(_q, keys)), keys, "left_semi")
        held = F.struct(F.lit(True), *map(_q, rest)).alias(name)
        columns = []
        for i, k in enumerate(keys):
            parts = packed(F.col(_q(k))) if k in texts else (F.col(_q(k)),)
            columns += [part.alias(f"{name}_k{i}" + "_" * j) for j, part in enumerate(parts)]
        return asked.select(*columns, held)

    def state(name: str) -> Column:
        return F.struct(*[F.col(name)[c] for c in compared]) if compared else F.lit(0)

    def row(change: str, name: str) -> Column:
        column = {c: F.col(name)[c] for c in rest}
        for i, k in enumerate(keys):
            first = F.col(f"{name}_k{i}")
            column[k] = unpacked(first, F.col(f"{name}_k{i}_")) if k in texts else first
        whole_row = F.struct(*[column[c].alias(c) for c in names])
        return F.struct(F.lit(change).alias(CHANGE), whole_row.alias("row"))

    same = F.lit(True)
    for i, k in enumerate(keys):
        for part in (f"_k{i}", f"_k{i}_")[: 1 + (k in texts)]:
            same = same & (F.col(was + part) == F.col(now + part))
    joined = keyed(old, was).join(keyed(new, now), same, "full_outer")
    found = (
        F.when(F.col(was).isNull(), F.array(row(INSERT, now)))
        .when(F.col(now).isNull(), F.array(row(DELETE, was)))
        .when(~state(was).eqNullSafe(state(now)), F.array(row(BEFORE, was), row(AFTER, now)))
    )
    changed = joined.select(F.inline(found)).select("row.*", CHANGE)
    lone = [c for c in names if c not in ignore]
    old_lone, new_lone = (df.where(~present).select(*map(_q, lone)) for df in (old, new))
    for change, rows in ((INSERT, new_lone.exceptAll(old_lone)), (DELETE, old_lone.exceptAll(new_lone))):
        changed = changed.unionByName(rows.withColumn(CHANGE, F.lit(change)), allowMissingColumns=True)
    return changed


def _unused(name: str, taken: Sequence[str]) -> str:
    while name in taken:
        name += "_"
    return name


def rows_after(changes: DataFrame) -> DataFrame:
    """The new state of inserted and updated rows."""
    return changes.where(F.col(CHANGE).isin(INSERT, AFTER)).drop(CHANGE)


def rows_gone(changes: DataFrame) -> DataFrame:
    """The last state of deleted rows."""
    return changes.where(F.col(CHANGE) == DELETE).drop(CHANGE)


def replace_by_key(target: DataFrame, fresh: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """The target with all rows of the given keys taken out and ``fresh`` put in: what no longer
    comes out for a key is gone. Columns of one side only are NULL in rows of the other."""
    kept = target.join(keys.select(*map(_q, key_list(on))).distinct(), key_list(on), "left_anti")
    types = {f.name: f.dataType for f in target.schema.fields}
    fresh = fresh.select(*[F.col(_q(c)).cast(types[c]).alias(c) if c in types else F.col(_q(c)) for c in fresh.columns])
    return kept.select(*map(_q, target.columns)).unionByName(fresh, allowMissingColumns=True)


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
