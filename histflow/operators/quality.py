"""Declarative row checks, duplicate keys, and the valid / invalid split."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from histflow import fixed_values as fv
from histflow.functions.scalar import AsOf, as_instant, safe_cast
from histflow.operators.spread import spread_join

DUPLICATE = "is_duplicate"


def not_null_rule(columns: Sequence[str]) -> Column:
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    return F.when(missing, fv.FAIL_NOT_NULL).otherwise(fv.PASS)


def castable_rule(types: Mapping[str, T.DataType | str]) -> Column:
    """Every column must hold a value of its type; NULL does not."""
    bad = reduce(lambda a, b: a | b, [safe_cast(c, t).isNull() for c, t in types.items()])
    return F.when(bad, fv.FAIL_DATATYPE).otherwise(fv.PASS)


def allowed_rule(column: str, values: Sequence[str]) -> Column:
    """The lower-cased text must be listed; NULL is not."""
    return F.when(F.lower(F.col(column)).isin(*values), fv.PASS).otherwise(fv.FAIL_VALID_VALUE)


def apply_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add one status column per rule, all in a single projection."""
    return df.withColumns(dict(rules))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count ``cnt``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).where(F.col("cnt") > 1)


def flag_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mark all members of a duplicate group; a key with a NULL is in none.

    The counts are aggregated before the shuffle and joined back, so a key that
    fills a third of the table is never gathered in one task.
    """
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    repeated = duplicate_keys(df.where(known), keys).select(*keys, F.lit(True).alias(DUPLICATE))
    joined = spread_join(df, repeated, keys, "left")
    return joined.select(*df.columns, F.coalesce(DUPLICATE, F.lit(False)).alias(DUPLICATE))


def is_valid(statuses: Sequence[str]) -> Column:
    passed = reduce(lambda a, b: a & b, [F.col(s) == fv.PASS for s in statuses])
    return passed & ~F.col(DUPLICATE)


def split_valid(checked: DataFrame, statuses: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid): together they are exactly the checked rows."""
    valid = is_valid(statuses)
    return checked.where(valid), checked.where(~valid)


def audit_rows(invalid: DataFrame, as_of: AsOf) -> DataFrame:
    """Rejected rows with the audit time in front."""
    as_of = as_instant(as_of)
    return invalid.select(as_of.alias("audit_dts"), "*")
