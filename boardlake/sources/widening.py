"""Common types of a table's columns and new data's (S6): widened without loss, or a declared error.

Integers widen to longer integers, to decimals that hold them, and (up to 32
bits) to doubles; floats to doubles; decimals to decimals with the digits of
both; dates to timestamps without a zone; structs field by field, arrays by
their elements, maps by keys and values.  Everything else, a number that turns
text or a long that turns a double, would lose or reinterpret values and is a
WideningError.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


class WideningError(TypeError):
    """New data's type and the table's have no common type without loss."""


#: Digits of the integer types, in ascending order.
DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
INTEGERS = list(DIGITS)


def _decimal(kind: T.DataType) -> T.DecimalType | None:
    if isinstance(kind, T.DecimalType):
        return kind
    return T.DecimalType(DIGITS[type(kind)], 0) if type(kind) in DIGITS else None


def common_type(old: T.DataType, new: T.DataType, path: str = "column") -> T.DataType:
    """The narrowest type that holds every value of both."""
    if old == new or isinstance(new, T.NullType):
        return old
    if isinstance(old, T.NullType):
        return new
    pair = {type(old), type(new)}
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return T.StructType(_fields(old, new, path))
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(common_type(old.elementType, new.elementType, f"{path}[]"), True)
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        return T.MapType(common_type(old.keyType, new.keyType, f"{path}{{key}}"), common_type(old.valueType, new.valueType, f"{path}{{}}"), True)
    if pair <= set(INTEGERS):
        return max((old, new), key=lambda t: INTEGERS.index(type(t)))
    if pair == {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    if pair & {T.FloatType, T.DoubleType} and pair & set(INTEGERS[:3]):
        return T.DoubleType()
    if pair == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    a, b = _decimal(old), _decimal(new)
    if a and b:
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale) + scale
        if digits <= 38:
            return T.DecimalType(digits, scale)
    raise WideningError(f"{path}: {old.simpleString()} in the table and {new.simpleString()} in the new data have no common type without loss")


def _fields(old: T.StructType, new: T.StructType, path: str) -> list[T.StructField]:
    added = {f.name: f for f in new.fields}
    out = []
    for f in old.fields:
        kind = common_type(f.dataType, added[f.name].dataType, f"{path}.{f.name}") if f.name in added else f.dataType
        out.append(T.StructField(f.name, kind, True))
    held = set(old.names)
    return out + [T.StructField(f.name, f.dataType, True) for f in new.fields if f.name not in held]


def widened(column: Column, kind: T.DataType, to: T.DataType) -> Column:
    """``column`` of type ``kind`` as the common type ``to``; a struct's missing fields are null."""
    if kind == to:
        return column
    if isinstance(to, T.StructType) and isinstance(kind, T.StructType):
        own = {f.name: f.dataType for f in kind.fields}
        parts = [(widened(column[f.name], own[f.name], f.dataType) if f.name in own else F.lit(None).cast(f.dataType)).alias(f.name)
                 for f in to.fields]
        return F.when(column.isNotNull(), F.struct(*parts))
    if isinstance(to, T.ArrayType) and isinstance(kind, T.ArrayType):
        return F.transform(column, lambda x: widened(x, kind.elementType, to.elementType))
    if isinstance(to, T.MapType) and isinstance(kind, T.MapType):
        entries = F.transform(F.map_entries(column), lambda e: F.struct(
            widened(e["key"], kind.keyType, to.keyType).alias("key"), widened(e["value"], kind.valueType, to.valueType).alias("value")))
        return F.map_from_entries(entries)
    return column.cast(to)
