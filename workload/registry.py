"""Registration of queries and the helpers they share."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from histflow import configure
from histflow.sources.tables import dealt_out

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# The run time of every registered query.
AS_OF_TEXT = "2026-01-01 00:00:00"
AS_OF_SQL = f"TIMESTAMP '{AS_OF_TEXT}'"
OPEN_SQL = "TIMESTAMP '9999-12-31 00:00:00'"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(key: str, sql: str):
    """Register a query under ``key`` with the SQL that must give its rows."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        QUERIES[key] = run
        SQL[key] = sql
        return fn

    return register


def key_sql(*values: str) -> str:
    """The generated id over text values and the run time: each with its length, NULL as a dash."""
    parts = [f"coalesce(CAST(length({v}) AS VARCHAR) || ':' || {v}, '-')" for v in [*values, f"'{AS_OF_TEXT}'"]]
    return f"sha256({' || '.join(parts)})"


def as_of() -> Column:
    return F.lit(AS_OF_TEXT).cast("timestamp_ntz")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def derived(spark: SparkSession, sf_dir: str, sql: str, payloads: bool | str = False) -> DataFrame:
    """Rows of an input statement over the given tables.

    The same text runs in the check engine; timestamps have no zone there.
    ``payloads``: the rows carry JSON, so a small table is dealt out first; a name: by the column
    that the statement's groups share, so that their rows need not move once more.
    """
    by = [payloads] if isinstance(payloads, str) else []
    for table in TABLES:
        if re.search(rf"\b{table}\b", sql):
            rows = read(spark, sf_dir, table)
            (dealt_out(rows, by=by) if payloads else rows).createOrReplaceTempView(table)
    return spark.sql(sql.replace("TIMESTAMP '", "TIMESTAMP_NTZ '"))
