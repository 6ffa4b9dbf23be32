"""Bringing two versions of a schema together."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    ShortType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

# Whole numbers by width, with the digits each can have.
_WHOLE = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 19}
_FRACTIONAL = (FloatType, DoubleType)
_MOST_DIGITS = 38


def merged_type(held: DataType, added: DataType, widen: bool = True) -> DataType:
    """The type that holds the values of both.

    Structs get the fields of both, at any depth, also inside arrays and maps: first those of
    ``held`` in their order. Numbers get a type wide enough for both, a date and a timestamp
    become a timestamp. Where there is no such type, or ``widen`` is off, ``held`` stays, and
    values are cast to it.
    """
    if isinstance(held, StructType) and isinstance(added, StructType):
        by_name = {f.name.lower(): f for f in added.fields}
        fields = []
        for f in held.fields:
            other = by_name.pop(f.name.lower(), None)
            kind = f.dataType if other is None else merged_type(f.dataType, other.dataType, widen)
            fields.append(StructField(f.name, kind, True))
        return StructType([*fields, *(StructField(f.name, f.dataType, True) for f in by_name.values())])
    if isinstance(held, ArrayType) and isinstance(added, ArrayType):
        return ArrayType(merged_type(held.elementType, added.elementType, widen), True)
    if isinstance(held, MapType) and isinstance(added, MapType):
        return MapType(
            merged_type(held.keyType, added.keyType, widen), merged_type(held.valueType, added.valueType, widen), True
        )
    return _wider(held, added) if widen else held


def _wider(a: DataType, b: DataType) -> DataType:
    if a == b:
        return a
    kinds = {type(a), type(b)}
    if kinds <= set(_WHOLE):
        return a if _WHOLE[type(a)] >= _WHOLE[type(b)] else b
    if kinds <= {*_WHOLE, DecimalType}:
        x, y = (t if isinstance(t, DecimalType) else DecimalType(_WHOLE[type(t)], 0) for t in (a, b))
        scale = max(x.scale, y.scale)
        digits = max(x.precision - x.scale, y.precision - y.scale) + scale
        return DecimalType(digits, scale) if digits <= _MOST_DIGITS else a
    if kinds <= {*_WHOLE, DecimalType, *_FRACTIONAL} and kinds & set(_FRACTIONAL):
        return DoubleType()
    if kinds <= {DateType, TimestampType, TimestampNTZType}:
        return TimestampType() if TimestampType in kinds else TimestampNTZType()
    return a


def conform(value: Column, was: DataType, to: DataType) -> Column:
    """A value with the type ``merged_type`` gave; fields it lacks are NULL."""
    if was == to:
        return value
    if isinstance(was, StructType) and isinstance(to, StructType):
        names = {f.name.lower(): f for f in was.fields}
        fields = []
        for f in to.fields:
            own = names.get(f.name.lower())
            part = F.lit(None).cast(f.dataType) if own is None else conform(value[own.name], own.dataType, f.dataType)
            fields.append(part.alias(f.name))
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(was, ArrayType) and isinstance(to, ArrayType):
        return F.transform(value, lambda x: conform(x, was.elementType, to.elementType))
    if isinstance(was, MapType) and isinstance(to, MapType):
        entry = lambda e: F.struct(
            conform(e["key"], was.keyType, to.keyType).alias("key"),
            conform(e["value"], was.valueType, to.valueType).alias("value"),
        )
        return F.map_from_entries(F.transform(F.map_entries(value), entry))
    return value.cast(to)


def overlay(new: Column, new_type: DataType, old: Column, old_type: DataType, to: DataType) -> Column:
    """The new value, with the old one's fields where the new struct does not have them at all."""
    if not all(isinstance(t, StructType) for t in (new_type, old_type, to)):
        return conform(new, new_type, to)
    news = {f.name.lower(): f for f in new_type.fields}
    olds = {f.name.lower(): f for f in old_type.fields}
    fields = []
    for f in to.fields:
        n, o = news.get(f.name.lower()), olds.get(f.name.lower())
        if n is None:
            part = conform(old[o.name], o.dataType, f.dataType)
        elif o is None:
            part = conform(new[n.name], n.dataType, f.dataType)
        else:
            part = overlay(new[n.name], n.dataType, old[o.name], o.dataType, f.dataType)
        fields.append(part.alias(f.name))
    return F.when(new.isNotNull(), F.struct(*fields))
