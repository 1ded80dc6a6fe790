"""Joins that survive a key holding a large share of the left rows.

Adaptive execution splits a skewed partition of a join, but only where both inputs come
straight from a shuffle. The joins here mostly have an aggregated right side (one row per
key), which is shuffled by the key already and would be joined as it stands. Their keys
therefore get one more column, the hash of the keys: neither side is placed by that, so both
are shuffled for the join, and a heavy key's partition is cut into as many tasks as it needs.
Nothing is read beforehand and nothing has to be known about the keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

_HASH = "__key_hash"


def placement(df: DataFrame, slices: Column | int) -> Column:
    """A slice number per row that is the same when a task is retried.

    Content spreads different rows; the partition number spreads equal copies.
    Texts are left out, as they may be whole documents.
    """
    narrow = [
        f.name
        for f in df.schema.fields
        if not isinstance(f.dataType, (T.MapType, T.VariantType, T.ArrayType, T.StructType, T.StringType, T.BinaryType))
    ]
    names = narrow or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)][:1]
    content = F.xxhash64(*names) if names else F.lit(0)
    return F.pmod(content + F.spark_partition_id(), F.lit(slices) if isinstance(slices, int) else slices)


def comparable(left: DataFrame, right: DataFrame, on: Sequence[str]) -> list[T.DataType]:
    """The type in which an equality of each key compares both sides."""
    common = left.select(*on).union(right.select(*on)).schema
    types = []
    for k, f in zip(on, common.fields):
        a, b = left.schema[k].dataType, right.schema[k].dataType
        if isinstance(a, T.StringType) != isinstance(b, T.StringType):  # the text is read as the other type
            other = b if isinstance(a, T.StringType) else a
            types.append(T.LongType() if isinstance(other, T.IntegralType) else other)
        else:
            types.append(f.dataType)
    return types


def _alike(name: str, data_type: T.DataType) -> Column:
    """A key in the common type; both zeros of a floating type are one value."""
    value = F.col(name).cast(data_type)
    return value + F.lit(0).cast(data_type) if isinstance(data_type, (T.DoubleType, T.FloatType)) else value


def spread_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """``left.join(right, on, how)`` whose heavy left keys adaptive execution can split.

    ``how``: left, inner, left_semi, left_anti, the joins of which the left side may be
    split. The result is the plain join's, whatever the types of the keys; NULL keys never
    match, and many of them are split like any other key. A right side that Spark finds
    small is broadcast as usual.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"spread_join cannot do a {how} join")
    on = list(on)
    types = comparable(left, right, on)
    key_hash = F.xxhash64(*[_alike(k, t) for k, t in zip(on, types)])
    return left.withColumn(_HASH, key_hash).join(right.withColumn(_HASH, key_hash), [*on, _HASH], how).drop(_HASH)
