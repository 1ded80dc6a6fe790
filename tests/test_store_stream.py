import datetime as dt
import json
import time

import pytest
from row_lists import rows
from pyspark.sql import functions as F

from histflow import work_folder
from histflow.operators import history as hx
from histflow.plans import loads
from histflow.sources import schemas, tables
from histflow.sources.store import HistoryTable
from histflow.streaming.incremental import landing_stream, stream_apply

SCHEMA = "k string, h string, active string, s timestamp_ntz, e timestamp_ntz"
HISTORY = hx.History(keys=["k"], watch=["h"], active="active", start="s", end="e")


def new_table(spark, tmp_path):
    return HistoryTable(spark, str(tmp_path / "table"), spark.createDataFrame([], SCHEMA).schema, HISTORY)


def batch(spark, **values):
    return spark.createDataFrame(list(values.items()), "k string, h string")


def test_batches_equal_the_snapshot_operator(spark, tmp_path):
    table = new_table(spark, tmp_path)
    expected = spark.createDataFrame([], SCHEMA)
    assert table.read().collect() == []
    for day, values in ((1, {"a": "1", "b": "1"}), (2, {"a": "2", "c": "1"}), (3, {"a": "2", "b": "3"})):
        as_of = dt.datetime(2026, 1, day)
        assert table.apply(batch(spark, **values), as_of)
        expected = spark.createDataFrame(
            hx.scd2_apply(expected, batch(spark, **values), HISTORY, as_of).collect(), SCHEMA
        )
        assert rows(table.read()) == rows(expected)
    assert table.read().columns == ["k", "h", "active", "s", "e"]


def test_a_repeated_batch_is_not_applied_twice(spark, tmp_path):
    table = new_table(spark, tmp_path)
    assert table.apply(batch(spark, a="1"), dt.datetime(2026, 1, 1), origin="feed", batch=1)
    before = rows(table.read())
    assert not table.apply(batch(spark, a="9"), dt.datetime(2026, 1, 2), origin="feed", batch=1)
    assert rows(table.read()) == before
    # the same number from elsewhere is another batch
    table.apply(batch(spark, a="9"), dt.datetime(2026, 1, 2), origin="other", batch=1)
    assert sorted((r["h"], r["active"]) for r in table.read().collect()) == [("1", "N"), ("9", "Y")]


def files_of(path):
    return {str(f): f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


def test_only_touched_buckets_are_written(spark, tmp_path):
    table = new_table(spark, tmp_path)
    table.apply(batch(spark, **{f"k{i}": "1" for i in range(300)}), dt.datetime(2026, 1, 1))
    before = files_of(tmp_path / "table" / "active")
    table.apply(batch(spark, k7="2", k8="1"), dt.datetime(2026, 1, 2))
    after = files_of(tmp_path / "table" / "active")
    changed = {f.split("bucket=")[1].split("/")[0] for f in set(before.items()) ^ set(after.items()) for f in f[:1]}
    assert 1 <= len(changed) <= 2 and len(after) > 40
    got = table.read()
    assert got.count() == 301 and got.where("active = 'Y'").count() == 300


@pytest.mark.parametrize("died", ["before the active rows", "between buckets", "before the marker"])
def test_a_batch_that_died_is_merged_again(spark, tmp_path, died):
    """The closures are there; the active rows are written in no bucket, in some, or in all."""
    import shutil

    names = [f"k{i}" for i in range(40)]
    table = new_table(spark, tmp_path)
    table.apply(batch(spark, **{k: "1" for k in names}), dt.datetime(2026, 1, 1), "feed", 1)
    old = tmp_path / "old"
    shutil.copytree(tmp_path / "table", old)
    table.apply(batch(spark, **{k: "2" for k in names}), dt.datetime(2026, 1, 2), "feed", 2)
    expected = rows(table.read())
    again = HistoryTable(spark, str(tmp_path / "again"), table.schema, HISTORY)
    shutil.copytree(tmp_path / "table", tmp_path / "again", ignore=lambda d, names: ["batches"] if d.endswith("table") else [])
    shutil.copytree(old / "batches", tmp_path / "again" / "batches")
    if died != "before the marker":
        for n, bucket in enumerate(sorted((tmp_path / "again" / "active").glob("bucket=*"))):
            if died == "before the active rows" or n % 2:
                bucket.rename(tmp_path / f"gone-{n}")
                shutil.copytree(old / "active" / bucket.name, bucket)
    spark.catalog.refreshByPath(str(tmp_path / "again"))
    assert again.apply(batch(spark, **{k: "2" for k in names}), dt.datetime(2026, 1, 2), "feed", 2)
    assert rows(again.read()) == expected and len(expected) == 80


def test_a_stream_after_other_batches_loses_nothing(spark, tmp_path):
    table = new_table(spark, tmp_path)
    for day in (1, 2, 3):
        table.apply(batch(spark, a=str(day)), dt.datetime(2026, 1, day))
    folder = str(tmp_path / "in")
    batch(spark, b="1").write.parquet(folder)
    for n in (1, 2):  # twice the same files under new checkpoints: unchanged the second time
        stream = landing_stream(spark, folder, batch(spark, x="y").schema)
        stream_apply(stream, table, lambda b: b, str(tmp_path / f"cp{n}")).awaitTermination()
        assert sorted((r["k"], r["h"], r["active"]) for r in table.read().collect()) == [("a", "1", "N"), ("a", "2", "N"), ("a", "3", "Y"), ("b", "1", "Y")]


def test_publish_reads_only_the_touched_buckets(spark, tmp_path):
    table = new_table(spark, tmp_path)
    table.apply(batch(spark, a="1"), dt.datetime(2026, 1, 1))
    plan = table._rows("active").where(F.col("bucket").isin([1]))._jdf.queryExecution().executedPlan().toString()
    assert "(bucket#" in plan.split("PartitionFilters")[1]


def test_ledger(spark, tmp_path):
    from histflow.sources.ledger import Ledger

    landing = spark.createDataFrame([("a", 1, "N"), ("b", 1, "N"), ("b", 2, "N"), (None, 1, "N"), ("c", 1, "Y")], "k string, n int, indicator_flag string")
    ledger = Ledger(spark, str(tmp_path / "ledger"), spark.createDataFrame([], "k string").schema)
    assert rows(ledger.pending(landing)) == rows(landing.where("indicator_flag = 'N'"))
    done = spark.createDataFrame([("a", 5), ("a", 6), (None, 7)], "k string, other int")
    for _ in range(2):  # a repeated batch replaces its own keys
        ledger.record(done, "feed", 1)
    assert ledger.processed().count() == 1
    assert rows(ledger.pending(landing)) == [("b", 1, "N"), ("b", 2, "N"), (None, 1, "N")]
    first = files_of(tmp_path / "ledger")
    ledger.record(spark.createDataFrame([("b",)], "k string"), "feed", 2)
    assert first.items() <= files_of(tmp_path / "ledger").items()  # what is written grows with the batch alone
    assert rows(ledger.pending(landing)) == [(None, 1, "N")]
    settled = ledger.settle(landing)
    assert rows(settled) == sorted([("a", 1, "Y"), ("b", 1, "Y"), ("b", 2, "Y"), (None, 1, "N"), ("c", 1, "Y")], key=repr)


def test_append_by_name(spark, tmp_path):
    path = str(tmp_path / "audit")
    schema = spark.createDataFrame([], "a string, b int, c date").schema
    tables.append_named(spark.createDataFrame([(1, "x", 9)], "B int, a string, unknown int"), path, schema)
    tables.append_named(spark.createDataFrame([("y",)], "a string"), path, schema)
    assert rows(spark.read.schema(schema).parquet(path)) == sorted([("x", 1, None), ("y", None, None)], key=repr)


def test_stage_fixes_random_ids(spark):
    staged = tables.stage(spark.range(50).withColumn("id", F.expr("uuid()")), "ids")
    assert rows(staged) == rows(staged.unionByName(staged).distinct())


def test_layout_spreads_a_hot_day(spark):
    path = work_folder(spark, "layout-test")
    events = spark.range(20000, numPartitions=8).select(
        "id",
        F.when(F.col("id") % 3 > 0, F.lit("2026-01-01 10:00:00")).otherwise("2026-01-02 10:00:00").cast("timestamp").alias("t"),
        F.lit("one").alias("who"),
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tables.layout_write(events, path, "t", ["who"])
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    written = spark.read.parquet(path)
    assert written.count() == 20000
    files = written.where("load_dt = DATE'2026-01-01'").select(F.input_file_name()).distinct().count()
    assert files > 1


def test_clustering_lasts_over_appends(spark, tmp_path):
    path = str(tmp_path / "clustered")
    for n in range(10):
        day = spark.range(n, 20_000, 10, numPartitions=4).select(
            "id", F.when(F.col("id") % 3 > 0, F.lit("2026-01-01 10:00:00")).otherwise("2026-01-02 10:00:00").cast("timestamp").alias("t")
        )
        tables.layout_write(day, path, "t", ["id"])
    table = spark.read.parquet(path)
    assert all(r.depth >= 10 for r in tables.layout_overlap(table, "id").collect())
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as for large days: several files
    try:
        assert len(tables.layout_compact(spark, path, ["id"])) == 2
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    table = spark.read.parquet(path)
    assert table.count() == 20_000 and table.distinct().count() == 20_000
    ranges = table.groupBy("load_dt", F.input_file_name().alias("f")).agg(F.min("id").alias("a"), F.max("id").alias("b")).collect()
    assert len(ranges) > 4
    for point in (0, 77, 5000, 9_999, 19_999):
        for day in {r.load_dt for r in ranges}:
            assert sum(r.load_dt == day and r.a <= point <= r.b for r in ranges) <= 2
    before = files_of(tmp_path / "clustered")
    assert tables.layout_compact(spark, path, ["id"]) == [] and files_of(tmp_path / "clustered") == before


def test_constraints(spark):
    from pyspark.sql import Observation

    declared = "a string not null, n bigint not null, d date, absent string"
    df = spark.createDataFrame([("x", "1", "2026-01-01", 0), (None, "2", None, 1), ("y", "z", "never", 2), ("w", None, None, 3)], "A string, n string, d string, more int")
    seen = Observation("constraints")
    kept, violations = tables.constrained(df, declared, seen)
    assert kept.dtypes == [("a", "string"), ("n", "bigint"), ("d", "date"), ("absent", "string")]
    assert [tuple(r) for r in kept.collect()] == [("x", 1, dt.date(2026, 1, 1), None)]
    assert sorted((r.more, tuple(r.violated)) for r in violations.collect()) == [(1, ("a",)), (2, ("n", "d")), (3, ("n",))]
    assert seen.get == {"rows": 4, "a": 1, "n": 2, "d": 1, "absent": 0}
    none, all_ = tables.constrained(df, "a string, gone string not null")
    assert none.count() == 0 and all_.count() == 4


def test_a_merge_does_not_move_a_bucketed_target(spark):
    """Target and batch in buckets of the key: only the batch is shuffled, if anything."""
    target = spark.range(3000).select(
        F.col("id").cast("string").alias("k"), F.col("id").cast("string").alias("h"), F.lit("Y").alias("active"),
        F.lit("2025-01-01 00:00:00").cast("timestamp_ntz").alias("s"), F.lit("9999-12-31 00:00:00").cast("timestamp_ntz").alias("e"),
    )
    source = spark.range(0, 3500, 2).select(F.col("id").cast("string").alias("k"), F.lit("new").alias("h"))
    tables.bucketed_write(target, "m_target", work_folder(spark, "m_target"), ["k"], 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = spark.table("m_target")
        merged = hx.merge_active(stored, source, HISTORY, dt.datetime(2026, 1, 1))
        plan = merged._jdf.queryExecution().sparkPlan().toString()
        executed = merged._jdf.queryExecution().executedPlan().toString()
        moved = [part for part in executed.split("Exchange")[1:] if "Bucketed: true" in part.split("Exchange")[0].split("+- Exchange")[0]]
        assert "m_target" in plan and rows(merged) == rows(hx.merge_active(target, source, HISTORY, dt.datetime(2026, 1, 1)))
        assert moved == []
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE m_target")


def test_bucketed_tables_join_without_a_shuffle(spark):
    left, right = spark.range(1000), spark.range(500)
    for name, df in (("b_left", left), ("b_right", right)):
        tables.bucketed_write(df, name, work_folder(spark, name), ["id"], 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("b_left").join(spark.table("b_right"), "id")
        assert joined.count() == 500
        assert "Exchange" not in joined._jdf.queryExecution().sparkPlan().toString()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(id" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE b_left")
        spark.sql("DROP TABLE b_right")


def test_bound_table_and_payload(spark):
    spark.range(3).createOrReplaceTempView("dev_t")
    got = tables.bound_query(spark, "SELECT count(*) AS n FROM IDENTIFIER(:env || '_t') WHERE id >= :low", env="dev", low=1)
    assert got.first()["n"] == 2
    payload = spark.range(1).select(tables.json_payload({"a": F.lit("x"), "b": F.lit(None).cast("string")}))
    assert payload.first()[0] == '[{"a":"x","b":null}]'


def contact(i, value, n):
    return (str(i), "A", None, None, dt.datetime(2026, 1, 1, n), None, None, "Y", json.dumps([{"ACI_a": value, "AcAu_b": None}]))


def test_stream_equals_batches(spark, tmp_path):
    landing = spark.createDataFrame([], schemas.LANDING_CONTACTS).schema
    folder = str(tmp_path / "landing")
    as_of = "2026-02-01 00:00:00"
    history = loads.contacts_history(as_of)
    schema = spark.createDataFrame([], schemas.CONTACTS_HISTORY).schema
    table = HistoryTable(spark, str(tmp_path / "contacts"), schema, history)

    def prepare(batch):
        return loads.contacts_source(batch, as_of)

    def run():
        stream = landing_stream(spark, folder, landing, files_per_batch=1)
        query = stream_apply(stream, table, prepare, str(tmp_path / "checkpoint"), as_of=as_of)
        query.awaitTermination()
        assert query.exception() is None

    expected = spark.createDataFrame([], schemas.CONTACTS_HISTORY)
    for n, data in enumerate(([contact(1, "a", 0), contact(2, "a", 0)], [contact(1, "b", 1), contact(3, "c", 1)])):
        arrived = spark.createDataFrame(data, landing)
        arrived.coalesce(1).write.mode("append").parquet(folder)
        run()
        expected = loads.contacts_load(arrived, expected, as_of).history
        assert rows(table.read()) == rows(expected)
    # nothing new: no batch, nothing changes
    run()
    assert table.read().where("active_flg = 'Y'").count() == 3


def test_stream_takes_the_latest_of_a_batch(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    table = HistoryTable(spark, str(tmp_path / "t"), schema, HISTORY)
    folder = str(tmp_path / "in")
    spark.createDataFrame([("a", "1", 1), ("a", "2", 2)], "k string, h string, n int").write.parquet(folder)
    stream = landing_stream(spark, folder, spark.createDataFrame([], "k string, h string, n int").schema)
    stream_apply(stream, table, lambda b: b, str(tmp_path / "cp"), order_by=["n"]).awaitTermination()
    assert [(r["k"], r["h"]) for r in table.read().collect()] == [("a", "2")]


@pytest.mark.parametrize("flag", ["N", "Y"])
def test_pending_polarity(spark, flag):
    df = spark.createDataFrame([("N",), ("Y",), (None,)], "indicator_flag string")
    assert [r[0] for r in tables.pending(df, value=flag).collect()] == [flag]


def test_publishing_a_load_twice_changes_nothing(spark, tmp_path):
    from histflow.plans.publish import publish
    from histflow.sources.ledger import Ledger

    landing = spark.createDataFrame(
        [("1", "a", "A1", "true", "Aetna", "N", None), ("2", "b", "A2", "maybe", "Aetna", "N", None), ("3", "c", "A3", "true", "Aetna", "N", None), ("4", "d", "A3", "true", "Aetna", "N", None)],
        "customer_id string, customer_nm string, sf_account_id string, sf_platform_id_level_nm string, business_unit_cd string, indicator_flag string, business_effective_dt date",
    )
    as_of = "2026-01-01 00:00:00"
    schema = loads.customer_source(landing, as_of).schema
    empty = spark.createDataFrame([], schema)
    history = hx.History(keys=["sf_account_id"], watch=loads.CUSTOMER_WATCH)
    table = HistoryTable(spark, str(tmp_path / "customers"), schema, history)
    load = loads.customer_load(landing, empty, as_of)
    ledger = Ledger(spark, str(tmp_path / "ledger"), spark.createDataFrame([], "sf_account_id string").schema)
    for merged in (True, False):
        assert publish(load, table, as_of, "feed", 1, str(tmp_path / "audit"), ledger) is merged
    # two valid rows of one account go to audit and do not stop the load
    assert [r.sf_account_id for r in table.read().collect()] == ["A1"]
    assert sorted(r.sf_account_id for r in spark.read.parquet(str(tmp_path / "audit")).collect()) == ["A2", "A3", "A3"]
    reasons = {r.sf_account_id: r.reject_reason for r in spark.read.parquet(str(tmp_path / "audit")).collect()}
    assert reasons == {"A2": loads.BAD_VALUE, "A3": loads.REPEATED_KEY}
    assert sorted(r.customer_id for r in ledger.pending(landing).collect()) == ["2", "3", "4"]
    assert rows(ledger.settle(landing)) == rows(load.source)


def test_staged_folders_go_with_their_scope(spark, tmp_path):
    from pathlib import Path

    from histflow.session import owned_folders

    made = []

    def staged(df):
        out = tables.stage(df, "scoped")
        made.append(Path(out.inputFiles()[0].removeprefix("file://")).parent)
        return out

    with owned_folders(spark):
        staged(spark.range(5)).write.parquet(str(tmp_path / "out"))
        with owned_folders(spark):
            staged(spark.range(3)).count()
        assert made[0].exists() and not made[1].exists()
    assert not made[0].exists() and spark.read.parquet(str(tmp_path / "out")).count() == 5
    assert staged(spark.range(2)).count() == 2 and made[2].exists()  # outside a scope nobody owns it


def test_a_merge_leaves_no_staged_folder(spark, tmp_path, monkeypatch):
    from pathlib import Path

    made = []

    def recorded(*args):
        made.append(work_folder(*args))
        return made[-1]

    monkeypatch.setattr(tables, "work_folder", recorded)
    table = new_table(spark, tmp_path)
    table.apply(batch(spark, a="1"), dt.datetime(2026, 1, 1), "feed", 1)
    assert table.read().count() == 1
    assert len(made) == 2 and not any(Path(p.removeprefix("file:")).exists() for p in made)


def test_staged_rows_leave_no_shuffle_files(spark):
    import os

    local = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        spark._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        return {name for d in (x.getPath() for x in local.localDirs()) for _, _, names in os.walk(d) for name in names if name.startswith("shuffle_")}

    before = shuffled()
    staged = tables.stage(spark.range(1000).repartition(3, "id"), "shuffled")
    deadline = time.time() + 20
    while shuffled() - before and time.time() < deadline:  # files go a moment later
        time.sleep(0.2)
    assert not shuffled() - before and staged.count() == 1000


def test_a_staged_result_outlives_what_was_staged_for_it(spark):
    from pathlib import Path

    inner = []

    def made():
        inner.append(tables.stage(spark.range(7), "inner"))
        return inner[0].selectExpr("id + 1 AS id")

    out = tables.stage_result(spark, made, "outer")
    assert out.count() == 7 and not Path(inner[0].staged_folder.removeprefix("file:")).exists()
    tables.discard(out, spark.range(1))
    assert not Path(out.staged_folder.removeprefix("file:")).exists()
