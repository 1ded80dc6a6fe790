"""Version chains against a walk along each key's time line."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from row_lists import rows
from pyspark.sql import functions as F

from histflow.operators import chains, history as hx

OPEN = dt.datetime(9999, 12, 31)
NOW = dt.datetime(2026, 1, 1)
SCHEMA = "k string, h string, d string, origin string, status string, active string, s timestamp_ntz, e timestamp_ntz"

def chain():
    return hx.History(
        keys=["k"],
        watch=["h"],
        documents=["d"],
        active="active",
        start="s",
        end="e",
        on_close={"status": F.lit("Inactive")},
        on_insert={"status": F.lit("Active"), "origin": F.concat(F.lit("new-"), F.col("n").cast("string"))},
    )


def day(n):
    return dt.datetime(2025, 1, 1) + dt.timedelta(n)


def content(h, d):
    return h, "{}" if d is None else d


def walk(target, batch):
    """The expected table: every key's events in order of time."""
    by_key, known = defaultdict(list), {r[0] for r in batch if r[0] is not None}
    out = [r for r in target if r[0] not in known]
    latest = {}
    for k, h, d, at, n in batch:
        if k is None:
            out.append((k, h, d, f"new-{n}", "Active", "Y", at or NOW, OPEN))
        elif (k, at or NOW) not in latest or latest[k, at or NOW][4] < n:
            latest[k, at or NOW] = (k, h, d, at or NOW, n)
    for r in target:
        if r[0] in known:
            by_key[r[0]].append((r[6], 1, content(r[1], r[2]), r))
            if r[7] != OPEN:
                by_key[r[0]].append((r[7], 0, None, None))
    for k, h, d, at, n in latest.values():
        by_key[k].append((at, 2, content(h, d), (k, h, d, f"new-{n}", "Active", "Y", at, OPEN)))
    for events in by_key.values():
        line = []
        for at in sorted({e[0] for e in events}):
            here = sorted((e for e in events if e[0] == at), key=lambda e: e[1])
            same = [e for e in here if e[2] == here[-1][2]]
            line.append(same[0])
        heads = [e for e, before in zip(line, [None, *line]) if e[2] != (before and before[2])]
        for e, after in zip(heads, [*heads[1:], None]):
            if e[2] is not None:
                r = e[3]
                end = after[0] if after else OPEN
                if e[1] == 2 or r[7] != end:
                    status = "Inactive" if after else "Active"
                    r = (*r[:4], status, "N" if after else "Y", r[6], end)
                out.append(r)
    return sorted(out, key=repr)


def random_case(seed, keys=12, hot=0):
    rng = random.Random(seed)
    target, batch = [], []
    names = [f"k{i}" for i in range(keys)] + ["hot"] * bool(hot)
    for k in names:
        at = 0
        for _ in range(hot // 2 if k == "hot" else rng.randrange(5)):
            at += rng.randrange(1, 4)
            length = rng.randrange(1, 4)
            target.append((k, rng.choice("ab"), rng.choice([None, "{}", '{"x":1}']), "old", "Inactive", "N", day(at), day(at + length)))
            at += length + rng.choice([0, 0, -0])
            if rng.random() < 0.6:
                at -= rng.randrange(0, 1)
        if target and target[-1][0] == k and rng.random() < 0.5:
            target[-1] = (*target[-1][:4], "Active", "Y", target[-1][6], OPEN)
    n = 0
    for k in rng.sample(names, max(1, keys * 2 // 3)) + ["hot"] * bool(hot):
        for _ in range(hot if k == "hot" else rng.randrange(1, 6)):
            n += 1
            batch.append((k, rng.choice("ab"), rng.choice([None, "{}", '{"x":1}']), rng.choice([None, *map(day, range(2 * hot or 16))]), n))
    batch += [(None, "a", None, day(3), 9001), (None, "a", None, None, 9002)]
    target += [(None, "a", "{}", "old", "Active", "Y", day(1), OPEN), (None, "b", "{}", "old", "Inactive", "N", day(1), day(2))]
    return target, batch


def applied(spark, target, batch):
    t = spark.createDataFrame(target, SCHEMA)
    s = spark.createDataFrame(batch, "k string, h string, d string, since timestamp_ntz, n int")
    return chains.chain_apply(t, s, chain(), "since", F.lit(NOW).cast("timestamp_ntz"), order_by=["n"])


@pytest.mark.parametrize("seed", range(6))
def test_random_batches(spark, seed):
    target, batch = random_case(seed)
    got = applied(spark, target, batch)
    assert got.dtypes == spark.createDataFrame([], SCHEMA).dtypes
    assert rows(got) == walk(target, batch)


def test_a_hot_key_lies_across_ranges(spark):
    target, batch = random_case(77, keys=4, hot=600)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        got = applied(spark, target, batch)
        assert rows(got) == walk(target, batch)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_a_late_row_splits_a_version(spark):
    target = [("k", "a", None, "old", "Active", "Y", day(0), OPEN)]
    got = applied(spark, target, [("k", "b", None, day(5), 1), ("k", "a", None, day(9), 2), ("k", "a", None, day(12), 3)])
    assert [(r.h, r.s, r.e, r.active, r.status, r.origin) for r in sorted(got.collect(), key=lambda r: r.s)] == [
        ("a", day(0), day(5), "N", "Inactive", "old"),
        ("b", day(5), day(9), "N", "Inactive", "new-1"),
        ("a", day(9), OPEN, "Y", "Active", "new-2"),
    ]


def test_the_same_batch_twice_changes_nothing(spark):
    target, batch = random_case(5)
    batch = [b for b in batch if b[0] is not None]  # NULL keys are new versions each time
    once = applied(spark, target, batch)
    again = applied(spark, [tuple(r) for r in once.collect()], batch)
    assert rows(again) == rows(once)


def test_empty_sides(spark):
    target, batch = random_case(3)
    assert rows(applied(spark, target, [])) == sorted(target, key=repr)
    assert rows(applied(spark, [], batch)) == walk([], batch)


def test_what_a_chain_needs(spark):
    t = spark.createDataFrame([], SCHEMA)
    for bad in (hx.History(keys=["k"], start="s", end="e"), hx.History(keys=["k"], watch=["h"], start="s", end="e", end_rule="previous_day")):
        with pytest.raises(ValueError):
            chains.chain_apply(t, t, bad, "s")
