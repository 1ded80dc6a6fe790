"""Account levels: pivot dates per level, write them to the deepest row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from histflow.functions.scalar import default_date, high_date, level_number
from histflow.operators.spread import spread_join

LEVELS = (1, 2, 3, 4)


def date_columns(prefix: str) -> list[str]:
    return [f"{prefix}{n}_{kind}_dt" for n in LEVELS for kind in ("effective", "expiration")]


def level_pivot(
    df: DataFrame,
    account: str,
    level: Column | str,
    effective: str,
    expiration: str,
    prefix: str = "level_",
) -> DataFrame:
    """Deepest level and the latest dates per level, one row per account.

    Numbers and dates only, so this is a hash aggregate reduced before its
    shuffle, whatever share of the rows one account holds.
    """
    return _pivot(df.withColumn("__number", level_number(level)), account, effective, expiration, prefix)


def _pivot(numbered: DataFrame, account: str, effective: str, expiration: str, prefix: str) -> DataFrame:
    number = F.col("__number")
    picks = [F.max(number).alias("max_level")]
    for n in LEVELS:
        for kind, source in (("effective", effective), ("expiration", expiration)):
            picks.append(F.max(F.when(number == n, F.col(source))).alias(f"{prefix}{n}_{kind}_dt"))
    return numbered.groupBy(account).agg(*picks)


def level_update(
    df: DataFrame,
    account: str,
    level: str,
    effective: str,
    expiration: str,
    prefix: str = "customer_account_structure_level_",
) -> DataFrame:
    """Set the eight level dates on the deepest-level rows of each account.

    Other rows keep what they have. A missing expiration becomes the open end
    (also for a level the account does not have); a missing effective date
    stays NULL.
    """
    # the number is a column of its own, so that it is computed once per row
    numbered = df.withColumn("__number", level_number(level))
    pivot = _pivot(numbered, account, effective, expiration, prefix="__level_")
    joined = spread_join(numbered, pivot, [account], "left")
    deepest = F.col("__number") == F.col("max_level")
    updates = {}
    for n in LEVELS:
        for kind in ("effective", "expiration"):
            name, new = f"{prefix}{n}_{kind}_dt", F.col(f"__level_{n}_{kind}_dt")
            if kind == "expiration":
                new = default_date(new, high_date())
            kept = F.col(name) if name in df.columns else F.lit(None).cast("date")
            updates[name] = F.when(deepest, new).otherwise(kept)
    order = [*df.columns, *[n for n in updates if n not in df.columns]]
    return joined.select(*[updates[c].alias(c) if c in updates else F.col(c) for c in order])
