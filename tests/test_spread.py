import random
from contextlib import contextmanager

import pytest
from row_lists import rows
from pyspark.sql import functions as F

from histflow.operators import history, spread

# Small data, treated as a cluster treats large data: shuffled joins, and partitions that count as skewed early.
LARGE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@contextmanager
def large(spark):
    for name, value in LARGE.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name in LARGE:
            spark.conf.unset(name)


def jobs(spark):
    """The number of jobs so far."""
    return spark.sparkContext._jsc.sc().dagScheduler().nextJobId()


@pytest.fixture(scope="module")
def skewed(spark):
    generator = random.Random(7)
    keys = ["hot"] * 3000 + [None] * 1500 + [f"k{generator.randrange(400)}" for _ in range(3000)]
    generator.shuffle(keys)
    left = spark.createDataFrame([(k, 1, i % 5) for i, k in enumerate(keys)], "k string, g int, n int").repartition(40)
    right = spark.createDataFrame(
        [(f"k{i}", 1, f"v{i}") for i in range(0, 500, 2)] + [("hot", 1, "v"), ("hot", 1, "w"), (None, 1, "null")],
        "k string, g int, v string",
    )
    return left, right


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_equals_the_plain_join(spark, skewed, how):
    left, right = skewed
    plain = left.join(right, ["k", "g"], how)
    expected = rows(plain)
    joined = spread.spread_join(left, right, ["k", "g"], how)
    assert joined.columns == plain.columns and rows(joined) == expected
    with large(spark):
        assert rows(spread.spread_join(left, right, ["k", "g"], how)) == expected


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_heavy_key_is_split_though_the_right_side_is_aggregated(spark, skewed, how):
    left, right = skewed
    counts = right.where("k <> 'hot'" if how == "left_anti" else "true").groupBy("k").agg(F.count("*").alias("n_right"))
    with large(spark):
        joined = spread.spread_join(left, counts, ["k"], how)
        placed = joined.withColumn("p", F.spark_partition_id())
        parts = {(r["k"], r["p"]) for r in placed.collect()}
        plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan
    # what reaches the output of a heavy key comes from several tasks
    assert sum(k == "hot" for k, _ in parts) > 1


def test_building_a_join_runs_nothing(spark, skewed):
    left, right = skewed
    before = jobs(spark)
    spread.spread_join(left, right.groupBy("k").agg(F.max("v")), ["k"])
    flagged = left.withColumn("indicator_flag", F.lit("N"))
    history.mark_processed(flagged, right, {"k": "k"})
    assert jobs(spark) == before


def test_equal_copies_are_spread_too(spark):
    copies = spark.range(8000).select(F.lit("hot").alias("k")).repartition(8)
    placed = copies.select(spread.placement(copies, 4).alias("p")).distinct().count()
    assert placed > 1


def test_full_outer_is_refused(skewed):
    with pytest.raises(ValueError):
        spread.spread_join(*skewed, ["k"], "full")


def test_types_of_keys_may_differ(spark):
    left = spark.range(6000, numPartitions=6).select(
        F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.col("id")).cast("int").alias("k"),
        F.when(F.col("id") % 2 == 0, F.lit(-0.0)).otherwise(F.lit(0.0)).alias("z"),
        F.lit("2026-01-01").cast("date").alias("d"),
        F.lit(1.5).cast("decimal(10,2)").alias("m"),
        F.lit("7").alias("s"),
    )
    right = spark.createDataFrame([(7, 0.0, "x", 7)], "k bigint, z double, v string, s int").select(
        "*", F.lit("2026-01-01 00:00:00").cast("timestamp").alias("d"), F.lit(1.5).alias("m")
    )
    for on in (["k"], ["z"], ["d"], ["m"], ["s"], ["k", "m"]):
        narrow = right.select(*on, "v")
        expected = left.join(narrow, on, "left").where("v IS NOT NULL").count()
        with large(spark):
            joined = spread.spread_join(left, narrow, on, "left")
            assert joined.where("v IS NOT NULL").count() == expected and joined.count() == 6000
        assert expected


def test_empty_left_side(spark, skewed):
    left, right = skewed
    assert spread.spread_join(left.where("false"), right, ["k", "g"], "left").count() == 0
