"""MERGE as DataFrame algebra.

``merge_frames`` returns the merged table as a lazy frame and knows nothing of storage. It
has three forms with the same result.

``probe``, the default:

    (target LEFT JOIN source, column by column)  -- kept and updated rows
    UNION ALL
    (source LEFT ANTI keys found in target)      -- inserted rows

never shuffles the target when the source is small, since the optimizer can broadcast the
right side of a left or semi join, and lets AQE split a hot target key over many tasks. It
costs a second scan of the target, of the key columns only.

``outer`` is one FULL OUTER JOIN: each side is read, shuffled and sorted once, which is two to
three times faster where neither side is small. Spark can neither broadcast nor split such a
join, so it is for tables that hold each key once. NULL keys are led around the join. A source not
known to have distinct keys is checked by the partitioning the join needs anyway.

``replace`` is for a source with distinct keys that has just the columns of the target, of the same
types: a matched row then becomes the source's whole row, so the source goes as it is and only its
keys meet the target. If ``leftover_keys`` have been found by keys alone, no row of either side is
shuffled but target rows that stay.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField

from sedimenta.functions.keys import is_plain_text, packed
from sedimenta.operators.evolve import conform, merged_type, overlay

KeyColumn = str | tuple[str, str]

_HIT = "__hit"
_HELD = "__held"
_COPIES = "__copies"
_ROW = "__row"
_PLACE = "__place"


class KeyPair(NamedTuple):
    target: str
    source: str


def key_pairs(on: KeyColumn | Sequence[KeyColumn]) -> list[KeyPair]:
    """Keys as (target column, source column); a plain name stands for both sides."""
    items = [on] if isinstance(on, str) else list(on)
    if not items:
        raise ValueError("a merge needs at least one key column")
    return [KeyPair(k, k) if isinstance(k, str) else KeyPair(*k) for k in items]


def merge_frames(
    target: DataFrame,
    source: DataFrame,
    on: KeyColumn | Sequence[KeyColumn],
    *,
    update: str | Mapping[str, str | Column] = "all",
    insert: bool = True,
    delete_when: str | Column | None = None,
    source_unique: bool = False,
    form: str = "probe",
    widen: bool = True,
    leftover: DataFrame | None = None,
) -> DataFrame:
    """The target after merging ``source`` into it.

    ``update``       'all' takes every source column on a match, 'none' leaves matched rows
                     alone, and a mapping sets the named target columns to expressions,
                     which may use ``target.c`` and ``source.c``.
    ``insert``       add source rows whose key is not in the target.
    ``delete_when``  condition over ``target.c`` / ``source.c``; matched rows that meet it
                     leave the table. It is tested before the update.

    Columns only the source has are added when all columns are updated or rows are inserted;
    rows without a value for a column get NULL, and a matched row keeps the target value of
    a column the source lacks; the same holds for fields of structs, at any depth. A column of
    both gets a type that holds the values of both (``merged_type``); without ``widen``, or where
    there is none, source values are cast to the type of the target column. A NULL key matches nothing, so such source rows are inserted each time.

    If several source rows match one target row the query fails, as the outcome would be
    arbitrary. ``source_unique`` leaves that check out for sources with distinct keys. The
    ``outer`` form fails on any key that the source repeats, matched or not.

    ``leftover`` are the ``leftover_keys`` of the two, for the ``replace`` form.
    """
    if form not in ("probe", "outer", "replace"):
        raise ValueError("form must be 'probe', 'outer' or 'replace'")
    pairs = key_pairs(on)
    if form == "replace":
        if update != "all" or not insert or delete_when is not None or not source_unique:
            raise ValueError("the replace form updates all columns, inserts, and needs distinct keys")
        if not replaces_rows(target, source, on):
            raise ValueError("the replace form needs a source with the columns and types of the target")
        return unreplaced(target, source, on, leftover).unionByName(source.select(*map(_q, target.columns)))
    fields = _resolve(target, source, pairs)
    set_values = None if isinstance(update, str) else _checked_set(target, update)
    if set_values is None and update not in ("all", "none"):
        raise ValueError(f"update must be 'all', 'none' or a mapping, not {update!r}")
    if form == "outer" and not insert:
        form = "probe"  # without inserts the left join alone does it
    evolve = update == "all" or insert
    added = [f for f in source.schema.fields if f.name not in fields.values()] if evolve else []
    added = [f for f in added if f.name not in {p.source for p in pairs}]

    if form == "outer":
        whole = target.where(_all_present(pairs, "target")).withColumn(_HELD, F.lit(True))
        keyed = source.where(_all_present(pairs, "source"))
        keyed = keyed if source_unique else _refuse_repeats(keyed, pairs)
        probe = _probe(keyed, pairs, unique=True)
        how = "full_outer"
    else:
        whole, how = target, "left"
        probe = _probe(source, pairs, source_unique)
    joined = whole.alias("target").join(probe.alias("source"), _matches(pairs), how)
    if form == "probe" and not source_unique and (update != "none" or delete_when is not None):
        joined = joined.where(_single_match())
    if delete_when is not None:
        condition = F.expr(delete_when) if isinstance(delete_when, str) else delete_when
        gone = _hit() & F.coalesce(condition, F.lit(False))
        if form == "outer":
            gone = gone & F.col(f"target.{_HELD}").isNotNull()
        joined = joined.where(~gone)

    types = _merged_types(target, source, fields, widen and evolve)
    kept = [_kept_value(f, fields, pairs, update, set_values, types, source) for f in target.schema.fields]
    kept += [_added_value(f, update) for f in added]
    new = [_inserted_value(f, fields, types, source) for f in target.schema.fields]
    new += [F.col(f"source.{_q(f.name)}") for f in added]
    names = target.columns + [f.name for f in added]

    if form == "outer":
        fresh = F.col(f"target.{_HELD}").isNull()
        both = [F.when(fresh, n).otherwise(k).alias(c) for n, k, c in zip(new, kept, names)]
        keyless = target.where(~_all_present(pairs, "target")).select(
            *[conform(F.col(_q(f.name)), f.dataType, types[f.name]).alias(f.name) for f in target.schema.fields],
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in added],
        )
        unheld = source.where(~_all_present(pairs, "source")).alias("source").select(*new)
        return joined.select(*both).unionByName(keyless).unionByName(unheld.toDF(*names))
    merged = joined.select(*kept)
    if not insert:
        return merged
    unmatched = _unmatched(target, source, pairs, source_unique)
    return merged.unionByName(unmatched.select(*new).toDF(*names))


def replaces_rows(target: DataFrame, source: DataFrame, on: KeyColumn | Sequence[KeyColumn]) -> bool:
    """Whether a matched row becomes the source's row as a whole."""
    held, given = ({f.name: f.dataType for f in df.schema.fields} for df in (target, source))
    return held == given and len(held) == len(target.columns) == len(source.columns) and all(
        p.target == p.source and p.target in held for p in key_pairs(on)
    )


def leftover_keys(target: DataFrame, source: DataFrame, on: KeyColumn | Sequence[KeyColumn]) -> DataFrame:
    """The keys of the target that the source does not hold, as ``with_joined_keys`` names them. Of
    both only keys are read and shuffled."""
    pairs = key_pairs(on)
    held, names = with_joined_keys(target, source, pairs, "target")
    asked, _ = with_joined_keys(target, source, pairs, "source")
    return held.select(*names).join(asked.select(*names), names, "left_anti")


def with_joined_keys(
    target: DataFrame, source: DataFrame, pairs: Sequence[KeyPair], side: str
) -> tuple[DataFrame, list[str]]:
    """The rows of a side with a whole key, with that in columns ``__k0`` and on: text is packed."""
    df, columns = target if side == "target" else source, {}
    for i, p in enumerate(pairs):
        kinds = (target.select(_q(p.target)).schema[0].dataType, source.select(_q(p.source)).schema[0].dataType)
        key = F.col(_q(getattr(p, side)))
        parts = packed(key) if all(map(is_plain_text, kinds)) else (key,)
        columns |= {f"__k{i}" + "_" * j: part for j, part in enumerate(parts)}
    return df.where(_all_present(pairs, side)).withColumns(columns), list(columns)


def without_key(target: DataFrame, pairs: Sequence[KeyPair]) -> DataFrame:
    """The target's rows with a NULL in the key, which match nothing."""
    return target.where(~_all_present(pairs, "target"))


def unreplaced(
    target: DataFrame, source: DataFrame, on: KeyColumn | Sequence[KeyColumn], leftover: DataFrame | None = None
) -> DataFrame:
    """The target's rows whose key the source does not hold, as the ``replace`` form keeps them."""
    pairs = key_pairs(on)
    held, names = with_joined_keys(target, source, pairs, "target")
    if leftover is not None:
        kept = held.join(leftover, names, "left_semi")
    else:
        asked, _ = with_joined_keys(target, source, pairs, "source")
        kept = held.join(asked.select(*names), names, "left_anti")
    return kept.select(*map(_q, target.columns)).unionByName(without_key(target, pairs))


def _resolve(target: DataFrame, source: DataFrame, pairs: Sequence[KeyPair]) -> dict[str, str]:
    """Target column -> the source column that feeds it, under the session's name rules."""
    sensitive = target.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    fold = (lambda n: n) if sensitive else str.lower
    by_name = {fold(c): c for c in source.columns}
    if len(by_name) != len(source.columns):
        raise ValueError(f"ambiguous source columns: {source.columns}")
    fields = {c: by_name[fold(c)] for c in target.columns if fold(c) in by_name}
    known = {fold(c) for c in target.columns}
    for pair in pairs:
        if fold(pair.target) not in known or fold(pair.source) not in by_name:
            raise ValueError(f"merge key {pair} is missing from the target or the source")
        name = next(c for c in target.columns if fold(c) == fold(pair.target))
        fields[name] = by_name[fold(pair.source)]
    return fields


def _checked_set(target: DataFrame, update: Mapping[str, str | Column]) -> dict[str, Column]:
    unknown = [c for c in update if c not in target.columns]
    if unknown or not update:
        raise ValueError(f"columns to set must exist in the target: {unknown}")
    return {c: F.expr(v) if isinstance(v, str) else v for c, v in update.items()}


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _matches(pairs: Sequence[KeyPair]) -> Column:
    condition = F.lit(True)
    for p in pairs:
        condition = condition & (F.col(f"target.{_q(p.target)}") == F.col(f"source.{_q(p.source)}"))
    return condition


def _probe(source: DataFrame, pairs: Sequence[KeyPair], unique: bool) -> DataFrame:
    """Source rows marked with their copy count, one row per key.

    NULL keys cannot match and are left out. Keys are taken from the folded row, not from the
    grouping, on purpose: the join then shuffles both sides afresh, which is what AQE needs
    to split a hot target key, and the source is the small side of that. The count is a
    partial aggregate, so a key with very many source rows folds into one row per map task
    before the shuffle.
    """
    if unique:
        return source.withColumn(_HIT, F.lit(1).cast("bigint"))
    keys = [F.col(_q(p.source)) for p in pairs]
    folded = (
        source.where(_all_present(pairs, "source"))
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias(_COPIES),
            F.first(F.struct(*[F.col(_q(c)) for c in source.columns])).alias(_ROW),
        )
    )
    return folded.select(f"{_ROW}.*", F.col(_COPIES).alias(_HIT))


def _all_present(pairs: Sequence[KeyPair], side: str) -> Column:
    present = F.lit(True)
    for p in pairs:
        present = present & F.col(_q(getattr(p, side))).isNotNull()
    return present


def _single_match() -> Column:
    """Fails the query on a match with more than one source row; never drops a row."""
    ambiguous = F.raise_error(F.lit("several source rows match one target row"))
    return F.when(F.col(f"source.{_HIT}") > 1, ambiguous.cast("boolean")).otherwise(F.lit(True))


def refuse_copies(source: DataFrame, on: KeyColumn | Sequence[KeyColumn]) -> DataFrame:
    """``source`` itself; running it fails if two of its rows share a key. A key with a NULL in
    it equals none, as in a merge."""
    pairs = key_pairs(on)
    present = _all_present(pairs, "source")
    return _refuse_repeats(source.where(present), pairs).unionByName(source.where(~present))


def _refuse_repeats(keyed: DataFrame, pairs: Sequence[KeyPair]) -> DataFrame:
    """Each map task passes on two rows of a key at most, so a key held by very many rows is
    told by a few of them and never gathers in one task."""
    window = Window.partitionBy(*[F.col(_q(p.source)) for p in pairs]).orderBy(F.lit(1))
    repeated = F.raise_error(F.lit("several source rows share one key"))
    return (
        keyed.withColumn(_PLACE, F.row_number().over(window))
        .where(F.col(_PLACE) <= 2)
        .where(F.when(F.col(_PLACE) > 1, repeated.cast("boolean")).otherwise(F.lit(True)))
        .drop(_PLACE)
    )


def _hit() -> Column:
    return F.col(f"source.{_HIT}").isNotNull()


def _kept_value(
    field: StructField,
    fields: Mapping[str, str],
    pairs: Sequence[KeyPair],
    update: str | Mapping[str, str | Column],
    set_values: Mapping[str, Column] | None,
    types: Mapping[str, DataType],
    source: DataFrame,
) -> Column:
    held, to = F.col(f"target.{_q(field.name)}"), types[field.name]
    old = conform(held, field.dataType, to).alias(field.name)
    if set_values is not None:
        if field.name not in set_values:
            return old
        new = set_values[field.name].cast(to)
    elif update == "all" and field.name in fields and field.name not in {p.target for p in pairs}:
        name = fields[field.name]
        new = overlay(F.col(f"source.{_q(name)}"), source.schema[name].dataType, held, field.dataType, to)
    else:
        return old
    return F.when(_hit(), new).otherwise(old).alias(field.name)


def _merged_types(
    target: DataFrame, source: DataFrame, fields: Mapping[str, str], widen: bool
) -> dict[str, DataType]:
    """The type each target column has after the merge."""
    return {
        f.name: f.dataType
        if f.name not in fields or source.schema[fields[f.name]].dataType == f.dataType
        else merged_type(f.dataType, source.schema[fields[f.name]].dataType, widen)
        for f in target.schema.fields
    }


def _added_value(field: StructField, update: str | Mapping[str, str | Column]) -> Column:
    if update == "all":
        return F.col(f"source.{_q(field.name)}").alias(field.name)
    return F.lit(None).cast(field.dataType).alias(field.name)


def _inserted_value(
    field: StructField, fields: Mapping[str, str], types: Mapping[str, DataType], source: DataFrame
) -> Column:
    to = types[field.name]
    if field.name in fields:
        name = fields[field.name]
        return conform(F.col(f"source.{_q(name)}"), source.schema[name].dataType, to).alias(field.name)
    return F.lit(None).cast(to).alias(field.name)


def _unmatched(
    target: DataFrame, source: DataFrame, pairs: Sequence[KeyPair], unique: bool
) -> DataFrame:
    """Source rows whose key the target does not hold.

    The target's keys are cut down to those the source asks for, so what meets the source in
    the anti join is never larger than the source. The keys of both sides are folded to one
    row each on the map side: key columns alone compress so well that AQE, which goes by
    bytes, would not see a hot one. If the source can be broadcast, the optimizer moves the
    semi join below the fold of the target's keys, so those are not shuffled.
    """
    names = [f"__k{i}" for i in range(len(pairs))]
    held = target.select(*[F.col(_q(p.target)).alias(n) for p, n in zip(pairs, names)])
    asked = source.select(*[F.col(_q(p.source)).alias(n) for p, n in zip(pairs, names)])
    asked = asked if unique else asked.distinct()
    found = held.distinct().join(asked, names, "left_semi").alias("found")
    same = F.lit(True)
    for p, n in zip(pairs, names):
        same = same & (F.col(f"source.{_q(p.source)}") == F.col(f"found.{n}"))
    return source.alias("source").join(found, same, "left_anti")
