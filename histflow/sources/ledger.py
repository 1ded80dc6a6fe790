"""Which landing rows are done, without rewriting the landing table.

The keys a batch has processed are added to a key-only table, partitioned by batch: what is
written grows with the batch. Rows are pending if their flag says so and the ledger does
not have their key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from histflow.operators.history import known
from histflow.operators.spread import spread_join
from histflow.sources import tables


@dataclass(frozen=True)
class Ledger:
    spark: SparkSession
    path: str
    keys: T.StructType

    @property
    def names(self) -> Sequence[str]:
        return self.keys.names

    def record(self, done: DataFrame, origin: str, batch: int) -> None:
        """Add the keys in ``done``; a repeated batch replaces its own, NULL keys are left out."""
        rows = tables.align(done, self.keys).where(known(self.names)).distinct()
        named = rows.withColumns({"origin": F.lit(origin), "batch": F.lit(batch)})
        named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("origin", "batch").parquet(self.path)

    def processed(self) -> DataFrame:
        return tables.read_or_empty(self.spark, self.path, self.keys)

    def pending(self, landing: DataFrame, flag: str = "indicator_flag", value: str = "N") -> DataFrame:
        """Pending rows whose key no batch has processed.

        Only the keys of the ledger are read; it is broadcast where Spark sees from its files that it
        is small. A NULL key is in no ledger.
        """
        return spread_join(tables.pending(landing, flag, value), self.processed(), self.names, "left_anti")

    def settle(self, landing: DataFrame, flag: str = "indicator_flag", value: str = "N", done: str = "Y") -> DataFrame:
        """The landing table with its flags, for the day it is rewritten anyway; an empty ledger can follow."""
        seen = self.processed().distinct().withColumn("__done", F.lit(True))
        joined = spread_join(tables.pending(landing, flag, value), seen, self.names, "left")
        flipped = F.when(F.col("__done"), F.lit(done)).otherwise(F.col(flag))
        marked = joined.select(*[flipped.alias(c) if c == flag else F.col(c) for c in landing.columns])
        return landing.where(~F.col(flag).eqNullSafe(value)).unionByName(marked)
