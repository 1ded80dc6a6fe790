"""Sharding by sampled splitters.

Records are ordered by (hash of the text, hash of the id, staging number). A
sample drawn with probability in proportion to size gives the quantiles of that
order as splitters; they cut the records into many more ranges than shards. The
exact size of every range then tells which ranges are overfull for a shard
border: the border is put between two groups of equal texts of that range, or,
where one group is itself large, between two of its rows. So the shards' sizes
are as equal as whole small groups allow, whatever the skew.

Only DataFrame functions are used. Collected: the splitters, at most
``shards * ranges_per_shard``.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window, functions as F

from histflow.llm.common import stage

SHARDS = 24
RANGES_PER_SHARD = 64
SAMPLES_PER_RANGE = 8
LEAST = -(2**63)


def _key(h, d, r) -> Column:
    return F.struct(h.cast("long").alias("h"), d.cast("long").alias("d"), r.cast("long").alias("r"))


def measured(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """What placing needs of each record: id, size, checksum and sort key, staged."""
    body = F.coalesce(docs[text].cast("string"), F.lit(""))
    return stage(
        docs.select(
            docs[doc_id].alias("doc_id"),
            (F.octet_length(body) + 8).cast("long").alias("size"),
            F.crc32(body).alias("text_crc32"),
            F.xxhash64(body).alias("h"),
            F.xxhash64(docs[doc_id]).alias("d"),
            F.monotonically_increasing_id().alias("r"),
        ),
        "shard-keys",
    )


def splitters(records: DataFrame, total: int, ranges: int, seed: int = 7) -> list[list[int]]:
    """At most ``ranges - 1`` keys that cut the records into ranges of about equal bytes.

    A row is drawn with probability size / (total / samples), larger rows always,
    so at most about twice ``samples`` rows are drawn; the rows between two
    splitters stand for equal shares of the bytes.
    """
    samples = ranges * SAMPLES_PER_RANGE
    step = total / samples
    drawn = records.where(F.rand(seed) * step < F.col("size")).withColumn("weight", F.greatest(F.col("size"), F.lit(step)))
    order = Window.orderBy("h", "d", "r")
    whole = Window.partitionBy()
    cut = (
        drawn.select("h", "d", "r", "weight")
        .withColumn("upto", F.sum("weight").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("part", F.floor(F.col("upto") * ranges / (F.sum("weight").over(whole) * (1 + 1e-9))))
        .groupBy("part")
        .agg(F.min(_key(F.col("h"), F.col("d"), F.col("r"))).alias("key"))
        .where("part > 0")
        .select("key.h", "key.d", "key.r")
    )
    found = sorted((x.h, x.d, x.r) for x in cut.collect())
    # A text with one splitter is a small group: the range begins where the group does.
    times: dict[int, int] = {}
    for h, _, _ in found:
        times[h] = times.get(h, 0) + 1
    return [[h, d, r] if times[h] > 1 else [h, LEAST, LEAST] for h, d, r in found]


def range_number(keys: list[list[int]], key: Column) -> Column:
    """How many of the sorted ``keys`` are at most ``key``, by halving."""
    if not keys:
        return F.lit(0)
    text = json.dumps([{"h": h, "d": d, "r": r} for h, d, r in keys])
    array = F.from_json(F.lit(text), "array<struct<h:bigint,d:bigint,r:bigint>>")
    steps = [1 << i for i in reversed(range(len(keys).bit_length()))]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda low, step: F.when(
            (low + step <= len(keys)) & (F.get(array, low + step - 1) <= key), low + step
        ).otherwise(low),
    )


def assign_shards(
    docs: DataFrame,
    shards: int = SHARDS,
    ranges_per_shard: int = RANGES_PER_SHARD,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """One row per record: doc_id, size, text_crc32, shard, slot.

    ``size`` is the text's UTF-8 bytes (NULL: none) plus 8. ``slot`` counts from
    0 without gaps in each shard. NULL ids, repeated ids and repeated rows are
    records of their own. An empty table gives no rows; other columns of
    ``docs`` are not read.
    """
    records = measured(docs, text, doc_id)
    total = records.agg(F.sum("size")).first()[0] or 0
    ranges = shards * ranges_per_shard
    keys = splitters(records, total, ranges) if total else []
    key = _key(F.col("h"), F.col("d"), F.col("r"))
    ranged = records.withColumn("range", range_number(keys, key))
    # At most one row per range, which is bounded by the parameters.
    upto = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        ranged.groupBy("range")
        .agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
        .select(
            "range",
            F.coalesce(F.sum("bytes").over(upto), F.lit(0)).alias("bytes_before"),
            F.coalesce(F.sum("rows").over(upto), F.lit(0)).alias("rows_before"),
        )
    )
    inside = Window.partitionBy("range").orderBy("h", "d", "r")
    group = Window.partitionBy("range", "h")
    placed = (
        ranged.join(F.broadcast(bases), "range")
        .withColumn("n", F.row_number().over(inside))
        .withColumn("end", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("group_bytes", F.sum("size").over(group))
        .withColumn("group_end", F.max("end").over(group))
    )
    # Twice the middle of what is placed whole: a small group, or else the row.
    small = F.col("group_bytes") * (2 * ranges) <= total
    twice = F.lit(2) * F.col("bytes_before") + F.when(
        small, 2 * F.col("group_end") - F.col("group_bytes")
    ).otherwise(2 * F.col("end") - F.col("size"))
    placed = placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.least(F.floor(twice.cast("decimal(38,0)") * shards / (2 * max(total, 1))), F.lit(shards - 1)).cast("int").alias("shard"),
        (F.col("rows_before") + F.col("n")).alias("place"),
    )
    first = placed.groupBy("shard").agg(F.min("place").alias("first"))  # a row per shard
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("place") - F.col("first")).cast("long").alias("slot")
    )


def op9_sharding(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return assign_shards(docs).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
