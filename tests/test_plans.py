"""What the physical plans must look like."""

import re

import pytest

from histflow.operators import history as hx
from workload import QUERIES


@pytest.fixture(scope="module")
def plan(spark, sf_dir):
    def text(key_or_df):
        df = QUERIES[key_or_df](spark, sf_dir) if isinstance(key_or_df, str) else key_or_df
        return df._jdf.queryExecution().executedPlan().toString()

    return text


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def exchanges(text, kind="hashpartitioning"):
    return len(re.findall(rf"Exchange {kind}", text))


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_python_and_no_cross_join(plan, key):
    text = plan(key)
    for word in ("EvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text


def test_pending_filter_reaches_the_scan(spark, tmp_path):
    from histflow.sources import tables

    spark.createDataFrame([("N", 1, 2)], "indicator_flag string, a int, b int").write.parquet(str(tmp_path / "t"))
    df = tables.pending(tables.read_table(spark, str(tmp_path / "t"))).select("a")
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(indicator_flag,N)" in text
    assert "ReadSchema: struct<indicator_flag:string,a:int>" in text


def test_rollup_stays_in_the_row(spark, tmp_path):
    """Of single payloads no attribute becomes a row, and nothing moves; each branch parses once."""
    from histflow import fixed_values as fv
    from histflow.operators.rollup import eav_rollup

    element = '{"Attribute_Category__c":"Billing","AttributeName__c":"a","Attribute_Value__c":"1"}'
    ids = ["ID", "Product_Association_ID"]
    landing = spark.createDataFrame([(f"c{i}", "x", f"[{element}]") for i in range(50)], "ID string, Product_Association_ID string, Payload string")
    landing.write.parquet(str(tmp_path / "single"))
    wide = eav_rollup(spark.read.parquet(str(tmp_path / "single")), ids, fv.CATEGORIES)
    text = wide._jdf.queryExecution().executedPlan().toString()
    assert text.count("from_json(") == 1 and wide.count() == 50
    for word in ("Exchange", "Generate", "Join", "Aggregate"):
        assert word not in text

    landing.unionByName(landing.limit(1)).write.parquet(str(tmp_path / "several"))
    wide = eav_rollup(spark.read.parquet(str(tmp_path / "several")), ids, fv.CATEGORIES)
    row, many = wide._jdf.queryExecution().optimizedPlan().toString().split("Aggregate", 1)
    assert row.count("from_json(") == 1 and many.count("from_json(") == 1
    assert "Generate" not in row and "Generate" in many
    assert wide.count() == 50
    plan = wide._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    rolled = plan[: plan.index("SortAggregate")] if "SortAggregate" in plan else plan
    assert "BroadcastHashJoin" in rolled and "Exchange hashpartitioning" not in rolled


def test_mapping_parses_once(plan):
    assert plan("mapped_select_value").count("parseJson(") == 1


def test_prefix_split_does_not_shuffle(plan):
    assert "Exchange" not in plan("json_prefix_split")


def test_latest_per_key_is_cut_before_the_shuffle(plan):
    assert re.search(r"WindowGroupLimit.*Partial", plan("latest_per_key"))


def test_merge_leaves_the_slice_in_place_for_a_small_batch(plan):
    text = plan("scd2_apply")
    assert "FullOuter" not in text and "SortMergeJoin" not in text
    assert re.search(r"BroadcastHashJoin.*LeftOuter, BuildRight", text)


def test_merge_without_broadcast_is_two_joins(plan, no_broadcast):
    text = plan("scd2_apply")
    assert len(re.findall(r"SortMergeJoin.*Left(Outer|Anti)", text)) == 2


def test_insert_is_an_anti_join(plan):
    assert "LeftAnti" in plan("insert_new_or_changed")


def test_level_pivot_is_a_hash_aggregate(plan):
    text = plan("level_pivot")
    assert "HashAggregate" in text and "SortAggregate" not in text


def test_closed_rows_are_pruned_by_partition(spark, tmp_path, plan):
    path = str(tmp_path / "h")
    rows = [("a", "1", "Y"), ("a", "0", "N")]
    spark.createDataFrame(rows, "k string, h string, active string").write.partitionBy("active").parquet(path)
    history = hx.History(keys=["k"], watch=["h"], active="active", start="s", end="e")
    text = plan(hx.active_rows(spark.read.parquet(path), history))
    assert re.search(r"PartitionFilters: \[isnotnull\(active#\d+\), \(active#\d+ = Y\)\]", text)
