"""One schema for shards whose nested records differ, and the casts that bring
each shard to it.

Fields are matched by name at every level (structs, structs in lists, map values);
a field that a shard lacks is null there; numbers widen to a type that holds both; a
column of nulls takes the other's type. Anything else is a conflict and is named by
its path: nothing is ever turned into text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class SchemaConflict(ValueError):
    """Two shards disagree on a field."""


#: Whole numbers by size, with the decimal digits each needs.
_WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}


def _wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The smallest type that holds both scalars without loss, if there is one."""
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    if a == b:
        return a
    ka, kb = type(a), type(b)
    if ka in _WHOLE and kb in _WHOLE:
        return a if _WHOLE[ka] > _WHOLE[kb] else b
    if {ka, kb} == {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    for x, y in ((a, b), (b, a)):
        if isinstance(x, T.DoubleType) and type(y) in (T.ByteType, T.ShortType, T.IntegerType):
            return x                                    # a double holds whole numbers below 2^53
        if isinstance(x, T.FloatType) and type(y) in (T.ByteType, T.ShortType):
            return x
        if isinstance(x, T.DecimalType) and (type(y) in _WHOLE or isinstance(y, T.DecimalType)):
            whole, scale = (y.precision - y.scale, y.scale) if isinstance(y, T.DecimalType) else (_WHOLE[type(y)], 0)
            scale = max(scale, x.scale)
            whole = max(whole, x.precision - x.scale)
            return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None
        if isinstance(x, T.TimestampType) and isinstance(y, T.DateType):
            return x
    return None


def unify(a: T.DataType, b: T.DataType, path: str = "") -> T.DataType:
    """The type that holds values of both; raises :class:`SchemaConflict`."""
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        fields = {f.name: f for f in a.fields}
        for f in b.fields:
            have = fields.get(f.name)
            kind = unify(have.dataType, f.dataType, f"{path}.{f.name}".lstrip(".")) if have else f.dataType
            fields[f.name] = T.StructField(f.name, kind, True)
        return T.StructType([T.StructField(f.name, f.dataType, True) for f in fields.values()])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(unify(a.elementType, b.elementType, f"{path}[]"), True)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(unify(a.keyType, b.keyType, f"{path}{{key}}"), unify(a.valueType, b.valueType, f"{path}{{}}"), True)
    wide = _wider(a, b)
    if wide is None:
        raise SchemaConflict(f"{path or 'record'}: {a.simpleString()} in one shard, {b.simpleString()} in another")
    return wide


def conform(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """``value`` of type ``have`` as ``want`` (a result of :func:`unify`)."""
    if have == want:
        return value
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        own = {f.name: f.dataType for f in have.fields}
        parts = [(conform(value[f.name], own[f.name], f.dataType) if f.name in own else F.lit(None).cast(f.dataType)).alias(f.name)
                 for f in want.fields]
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(value, lambda x: conform(x, have.elementType, want.elementType))
    if isinstance(want, T.MapType) and isinstance(have, T.MapType):
        keyed = F.transform_keys(value, lambda k, v: conform(k, have.keyType, want.keyType))
        return F.transform_values(keyed, lambda k, v: conform(v, have.valueType, want.valueType))
    return value.cast(want)


def union_nested(*shards: DataFrame) -> DataFrame:
    """Bag union of shards whose columns, at any depth, differ in presence, order
    or width. The work is a projection a shard: nothing is shuffled."""
    if not shards:
        raise ValueError("no shards")
    for s in shards:
        twice = {c.lower() for c in s.columns if [x.lower() for x in s.columns].count(c.lower()) > 1}
        if twice:
            raise SchemaConflict(f"columns named twice in one shard: {sorted(twice)}")
    whole = reduce(unify, [s.schema for s in shards])
    parts = []
    for s in shards:
        own = {f.name: f.dataType for f in s.schema.fields}
        parts.append(s.select(*[(conform(F.col(f"`{f.name}`"), own[f.name], f.dataType) if f.name in own
                                 else F.lit(None).cast(f.dataType)).alias(f.name) for f in whole.fields]))
    return reduce(DataFrame.unionAll, parts)
