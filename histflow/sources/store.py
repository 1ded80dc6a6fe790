"""A history table on parquet that batches are merged into.

    active/bucket=<b>/              the active rows, by the hash of their key
    closed/batch=<name>/bucket=<b>/ the rows a batch closed
    batches/                        a marker row per finished batch

A batch rewrites the active rows of the buckets it touches (dynamic partition overwrite) and adds its closures, the
closures first, the marker last: one that died is merged again, and finds the old active rows or its closures in place.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from histflow.operators.history import ACTIVE, History, merge_active
from histflow.session import owned_folders
from histflow.sources.tables import align, read_or_empty, stage


@dataclass(frozen=True)
class HistoryTable:
    spark: SparkSession
    path: str
    schema: T.StructType
    history: History
    buckets: int = 64

    def _rows(self, part: str) -> DataFrame:
        stored = T.StructType([*self.schema.fields, T.StructField("bucket", T.IntegerType())])
        return read_or_empty(self.spark, f"{self.path}/{part}", stored).select(*stored.names)

    def read(self) -> DataFrame:
        return self._rows("active").unionByName(self._rows("closed")).drop("bucket")

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        keys = [F.col(k).cast(self.schema[k].dataType) for k in self.history.keys]
        return rows.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int"))

    def apply(self, source: DataFrame, as_of, origin: str = "", batch: int | None = None) -> bool:
        """Merge a batch, unless its origin and number are marked as finished; whether it was merged now."""
        markers = read_or_empty(self.spark, f"{self.path}/batches", "origin string, batch bigint")
        if batch is not None and not markers.where((F.col("origin") == origin) & (F.col("batch") == batch)).isEmpty():
            return False
        with owned_folders(self.spark):
            source = self._bucketed(stage(source, "batch"))
            touched = [r[0] for r in source.select("bucket").distinct().collect()]  # at most ``buckets``
            active = self._rows("active").where(F.col("bucket").isin(touched))
            merged = stage(self._bucketed(align(merge_active(active.drop("bucket"), source.drop("bucket"), self.history, as_of), self.schema)), "merged")
            named = merged.withColumn("batch", F.lit(f"{origin}-{uuid.uuid4().hex if batch is None else batch}"))
            is_active = F.col(self.history.active) == ACTIVE
            for part, rows, by in (("closed", named.where(~is_active), ["batch", "bucket"]), ("active", merged.where(is_active), ["bucket"])):
                writer = rows.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                writer.partitionBy(*by).parquet(f"{self.path}/{part}")
        if batch is not None:
            self.spark.createDataFrame([(origin, batch)], markers.schema).coalesce(1).write.mode("append").parquet(f"{self.path}/batches")
        return True
