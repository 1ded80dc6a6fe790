import datetime as dt
import random
import re

import pytest
from row_lists import rows
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from histflow.operators import history as hx

TABLE = "k string, h string, d string, active string, s timestamp_ntz, e timestamp_ntz"
OPEN = dt.datetime(9999, 12, 31)
OLD, NOW, NEXT = (dt.datetime(y, 1, 1) for y in (2025, 2026, 2027))
BY_HASH = hx.History(keys=["k"], watch=["h"], active="active", start="s", end="e")
BY_DOCUMENT = hx.History(keys=["k"], documents=["d"], active="active", start="s", end="e")


def table(spark, *data):
    return spark.createDataFrame([(k, h, d, a, s, e) for k, h, d, a, s, e in data], TABLE)


def target(spark):
    return table(
        spark,
        ("changed", "1", None, "Y", OLD, OPEN),
        ("same", "1", "{}", "Y", OLD, OPEN),
        ("gone", "1", None, "Y", OLD, OPEN),
        ("null", None, None, "Y", OLD, OPEN),
        ("changed", "0", None, "N", dt.datetime(2024, 1, 1), OLD),
    )


def source(spark, *extra):
    data = [("changed", "2", None), ("same", "1", None), ("new", "1", None), ("null", "v", None), *extra]
    return spark.createDataFrame(data, "k string, h string, d string")


def test_scd2_cases(spark):
    got = rows(hx.scd2_apply(target(spark), source(spark), BY_HASH, NOW).select("k", "h", "active", "s", "e"))
    assert got == sorted(
        [
            ("changed", "0", "N", dt.datetime(2024, 1, 1), OLD),
            ("changed", "1", "N", OLD, NOW),
            ("changed", "2", "Y", NOW, OPEN),
            ("same", "1", "Y", OLD, OPEN),
            ("gone", "1", "Y", OLD, OPEN),
            ("new", "1", "Y", NOW, OPEN),
            ("null", None, "N", OLD, NOW),
            ("null", "v", "Y", NOW, OPEN),
        ],
        key=repr,
    )


def test_null_is_no_change_in_literal_mode(spark):
    literal = hx.History(keys=["k"], watch=["h"], active="active", start="s", end="e", null_safe=False)
    for got in (
        hx.scd2_apply(target(spark), source(spark), literal, NOW),
        hx.expire(target(spark), source(spark), literal, NOW),
    ):
        assert rows(got.where("k = 'null'").select("active", "e")) == [("Y", OPEN)]
    kept = hx.insert_new_or_changed(hx.expire(target(spark), source(spark), literal, NOW), source(spark), literal, NOW)
    assert sorted(r["k"] for r in kept.collect()) == ["changed", "new"]


def test_null_and_empty_document_are_the_same(spark):
    assert hx.scd2_apply(target(spark), source(spark), BY_DOCUMENT, NOW).where("s = TIMESTAMP_NTZ '2026-01-01'").select(
        "k"
    ).collect() == [("new",)]


def test_two_source_rows_are_an_error_or_the_latest(spark):
    doubled = source(spark, ("new", "9", None))
    with pytest.raises(Exception, match="several source rows"):
        hx.scd2_apply(target(spark), doubled, BY_HASH, NOW).collect()
    latest = hx.latest_per_key(doubled, ["k"], ["h"])
    got = hx.scd2_apply(target(spark), latest, BY_HASH, NOW).where("k = 'new'").collect()
    assert [r["h"] for r in got] == ["9"]


def test_always_inserts_unchanged_rows(spark):
    got = hx.scd2_apply(target(spark), source(spark), BY_HASH, NOW, insert="always")
    assert got.where("k = 'same' and active = 'Y'").count() == 2
    assert got.where("k = 'gone' and active = 'Y'").count() == 1


def test_expire_then_insert_equals_the_merge(spark):
    expired = hx.expire(target(spark), source(spark), BY_HASH, NOW)
    added = hx.insert_new_or_changed(expired, source(spark), BY_HASH, NOW)
    assert rows(expired.unionByName(added)) == rows(hx.scd2_apply(target(spark), source(spark), BY_HASH, NOW))


def test_expire_sees_any_differing_source_row(spark):
    doubled = source(spark, ("same", "other", None))
    got = hx.expire(target(spark), doubled, BY_HASH, NOW)
    assert rows(got.where("k = 'same'").select("active")) == [("N",)]


def test_null_keys_match_nothing_and_stay(spark):
    t = table(spark, (None, "1", None, "Y", OLD, OPEN), (None, "1", None, "Y", OLD, OPEN))
    s = spark.createDataFrame([(None, "1", None), (None, "2", None)], "k string, h string, d string")
    got = hx.scd2_apply(t, s, BY_HASH, NOW)
    assert rows(got.select("h", "active", "s")) == sorted(
        [("1", "Y", OLD), ("1", "Y", OLD), ("1", "Y", NOW), ("2", "Y", NOW)], key=repr
    )
    assert hx.latest_per_key(s, ["k"], ["h"]).count() == 2
    assert hx.scd1_upsert(t, s, ["k"]).count() == 4


def test_hot_target_key(spark):
    t = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").cast("string").alias("h"),
        F.lit(None).cast("string").alias("d"),
        F.lit("Y").alias("active"),
        F.lit(OLD).cast("timestamp_ntz").alias("s"),
        F.lit(OPEN).cast("timestamp_ntz").alias("e"),
    )
    s = spark.createDataFrame([("hot", "x", None), ("1", "1", None)], "k string, h string, d string")
    any_match = hx.History(keys=["k"], active="active", start="s", end="e")
    closed = hx.expire(t, s, any_match, NOW)
    assert closed.where("active = 'N'").count() == 1001
    assert rows(closed.select("k", "h")) == rows(t.select("k", "h"))


def test_previous_day_end(spark):
    rule = hx.History(keys=["k"], watch=["h"], active="active", start="s", end="e", end_rule="previous_day")
    got = hx.expire(target(spark), source(spark), rule, dt.datetime(2026, 1, 1, 10))
    assert rows(got.where("k = 'changed' and h = '1'").select("e")) == [(dt.datetime(2025, 12, 31),)]


def test_on_insert_sees_the_source_row(spark):
    made = hx.History(
        keys=["k"], watch=["h"], active="active", start="s", end="e",
        on_insert={"d": F.concat(F.lit("id-"), F.col("k"))},
    )
    merged = hx.scd2_apply(target(spark), source(spark), made, NOW)
    expired = hx.expire(target(spark), source(spark), made, NOW)
    parts = expired.unionByName(hx.insert_new_or_changed(expired, source(spark), made, NOW))
    assert rows(merged) == rows(parts)
    assert rows(merged.where("k = 'new'").select("d")) == [("id-new",)]


def test_scd1(spark):
    t = spark.createDataFrame([("a", "1", "keep"), ("b", "1", "keep")], "k string, v string, own string")
    s = spark.createDataFrame([("b", None), ("c", "3")], "k string, v string")
    assert rows(hx.scd1_upsert(t, s, ["k"])) == sorted([("a", "1", "keep"), ("b", None, "keep"), ("c", "3", None)], key=repr)


def test_mark_processed_only_flips_pending(spark):
    s = spark.createDataFrame([("a", "N"), ("b", "N"), ("c", "Y"), (None, "N")], "k string, indicator_flag string")
    reached = spark.createDataFrame([("a",), ("a",), ("c",), (None,)], "id string")
    got = hx.mark_processed(s, reached, {"k": "id"})
    assert rows(got) == sorted([("a", "Y"), ("b", "N"), ("c", "Y"), (None, "N")], key=repr)


batches = st.lists(
    st.dictionaries(st.integers(0, 6), st.one_of(st.none(), st.integers(0, 2)), max_size=7), min_size=2, max_size=3
)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batches)
def test_invariants_over_batches(spark, data):
    state = []
    for i, batch in enumerate(data):
        as_of = dt.datetime(2026, 1, 1 + i)
        current = spark.createDataFrame(state, TABLE)
        incoming = spark.createDataFrame(
            [(str(k), None if v is None else str(v), None) for k, v in batch.items()], "k string, h string, d string"
        )
        closed = {tuple(r) for r in state if r[3] == "N"}
        state = [tuple(r) for r in hx.scd2_apply(current, incoming, BY_HASH, as_of).collect()]
        # closed rows never change again
        assert closed <= {r for r in state if r[3] == "N"}
        active = [r[0] for r in state if r[3] == "Y"]
        assert len(active) == len(set(active))
        shown = {r[0]: r[1] for r in state if r[3] == "Y"}
        assert all(shown[str(k)] == (None if v is None else str(v)) for k, v in batch.items())
        # the versions of a key follow each other without overlap
        for key in set(active):
            spans = sorted((r[4], r[5]) for r in state if r[0] == key)
            assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    again = hx.scd2_apply(spark.createDataFrame(state, TABLE), incoming, BY_HASH, NEXT)
    assert rows(again) == sorted(state, key=repr)


@pytest.mark.parametrize("null_safe", [True, False])
def test_merge_equals_expire_and_insert_with_several_active_rows(spark, null_safe):
    generator = random.Random(11)
    history = hx.History(
        keys=["k"], watch=["n"], documents=["d"], active="active", start="s", end="e", null_safe=null_safe
    )
    schema = "k string, n double, d string, active string, s timestamp_ntz, e timestamp_ntz"
    texts = ['{"a":2,"b":1}', '{"b":1, "a":2}', "{}", None]
    for _ in range(3):
        target = spark.createDataFrame(
            [
                (f"k{generator.randrange(6)}" if generator.random() > 0.1 else None, generator.choice([1.0, 2.0, None]), generator.choice(texts), generator.choice("YYN"), None, None)
                for _ in range(25)
            ],
            schema,
        )
        source = spark.createDataFrame(
            [(k, generator.choice([1, 2, None]), generator.choice(texts)) for k in ("k0", "k1", "k2", "k9")] + [(None, 1, "{}")],
            "k string, n bigint, d string",
        )
        expired = hx.expire(target, source, history, NOW)
        expected = expired.unionByName(hx.insert_new_or_changed(expired, source, history, NOW))
        assert rows(hx.scd2_apply(target, source, history, NOW)) == rows(expected)


def test_equal_content_in_another_shape_is_no_change(spark):
    history = hx.History(keys=["k"], watch=["n"], documents=["d"], active="active", start="s", end="e")
    schema = "k string, n double, d string, active string, s timestamp_ntz, e timestamp_ntz"
    target = spark.createDataFrame([("a", 1.0, '{"b":1, "a":2}', "Y", None, None)], schema)
    source = spark.createDataFrame([("a", 1, '{"a":2,"b":1}')], "k string, n bigint, d string")
    assert rows(hx.scd2_apply(target, source, history, NOW)) == rows(target)
    assert rows(hx.expire(target, source, history, NOW)) == rows(target)


def test_a_merge_moves_only_the_tables_columns(spark):
    target = spark.createDataFrame([("a", "1", "Y", None, None)], "k string, h string, active string, s timestamp, e timestamp")
    source = spark.createDataFrame([("a", "2", "x" * 9), ("b", "1", "y" * 9), (None, "1", "z")], "k string, h string, not_in_the_table string")
    merged = hx.merge_active(target, source, hx.History(keys=["k"], watch=["h"], active="active", start="s", end="e"), "2026-01-01 00:00:00")
    assert sorted((r.k or "", r.h, r.active) for r in merged.collect()) == [("", "1", "Y"), ("a", "1", "N"), ("a", "2", "Y"), ("b", "1", "Y")]
    assert not re.search(r"Aggregate.*not_in_the_table", merged._jdf.queryExecution().optimizedPlan().toString())
