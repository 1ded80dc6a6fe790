"""Repaired conversations against a search over all repairs and a parser over all cuts."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest

from histflow.llm import op12_conversation_repair as op12

SPACE = " \t\n\x0b\x0c\r"


def brute_damage(rows):
    out = []
    for conv_id, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        harm = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        if harm == 0:
            continue
        text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
        out += [(conv_id, turn, "user" if harm == 4 else role, text)] * (2 if harm == 3 else 1)
    return out


def row_digest(conv_id, turn, role, text):
    """The digest that orders rows of one turn and role; stated by the operator, not part of what is tested."""
    key = "" if conv_id is None else str(conv_id)
    same = hashlib.sha256(":".join([str(conv_id is None).lower(), str(len(key)), str(len(role)), key, role, text]).encode()).hexdigest()
    return hashlib.sha256(f"{same}:{' ' if turn is None else turn}".encode()).hexdigest()


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        plain = text.strip(SPACE)
        fault = "blank" if not plain else "duplicate" if (role, text) in seen else "truncated" if plain[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append(fault)
    return out


def search(rows, marks, costs):
    """The least (cost, audit) over all edits, and the rows it gives: shortest path over (place, state)."""
    ahead = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    best, queue = {}, [(0, "", 0, "", ())]
    while queue:
        cost, audit, i, state, made = heapq.heappop(queue)
        if (i, state) in best:
            continue
        best[i, state] = 1
        if i == len(rows) and state in ("", "a"):
            return cost, audit, list(made)
        for letter, name in (("u", "user"), ("a", "assistant")):
            if letter in ahead[state]:
                heapq.heappush(queue, (cost + costs.insert, audit + "I", i, letter, (*made, (name, ""))))
        if i == len(rows):
            continue
        heapq.heappush(queue, (cost + costs.delete, audit + "D", i + 1, state, made))
        if marks[i] in ("blank", "duplicate"):
            continue
        _, _, role, text = rows[i]
        extra = costs.truncated if marks[i] else 0
        if role[:1] in ahead[state] and role[:1]:
            heapq.heappush(queue, (cost + costs.keep + extra, audit + "K", i + 1, role[:1], (*made, (role, text))))
        for letter, name in (("u", "user"), ("a", "assistant")):
            if letter in ahead[state]:
                heapq.heappush(queue, (cost + costs.rerole + extra, audit + "R", i + 1, letter, (*made, (name, text))))


def brute_repair(rows, costs=op12.Costs()):
    by_conv = defaultdict(list)
    for r in brute_damage(rows):
        by_conv[r[0]].append(r)
    out = []
    for conv_id in {r[0] for r in rows}:
        own = sorted(by_conv[conv_id], key=lambda r: (r[1] is not None, r[1] or 0, r[2], row_digest(*r)))
        marks = faults(own)
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, made = search(own, marks, costs)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
        out.append((conv_id, gaps, *[marks.count(m) for m in ("blank", "duplicate", "truncated")], illegal, cost, audit, digest))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def talks():
    rng = random.Random(4)
    roles = ["user", "assistant", "system", "user", "assistant", "useless", "tool", "", None, "User"]
    texts = ["Hello.", "Yes!", "no end", "What?", "", " ", "\u00a0", None, "ends. ", "dot.\n\t", "a\nb.", "é"]
    rows = []
    for conv_id in range(120):
        for turn in range(rng.randrange(1, 9)):
            rows.append((conv_id, turn * rng.choice([1, 1, 1, 2]), rng.choice(roles[:5] if conv_id % 2 else roles), rng.choice(texts) if rng.random() < 0.6 else f"Row {rng.random()}."))
    rows += [(None, t, "user", "x.") for t in (None, 1, 2)] + [(200, None, "user", "Hi."), (200, None, "assistant", "Hi."), (201, None, "user", None)]
    rows += [(202, -(2**62), "user", "a."), (202, 2**61, "assistant", "b."), (203, 3, "user", "Same."), (203, 3, "user", "Same."), (203, 3, "assistant", "Same.")]
    rows += [(300, t, "user" if t % 2 else "assistant", f"Turn {t}{'.' if t % 7 else ''}") for t in range(200)]  # long
    rows += [(301, 5, "user", "Copied.")] * 40
    rows += [(302, t, "user", "Again.") for t in range(60)]
    rng.shuffle(rows)
    return rows


def as_table(spark, rows):
    return spark.createDataFrame([(*r, "z", 1, "z") for r in rows], "conv_id bigint, turn bigint, role string, text string, key string, copies int, row string").repartition(3)


@pytest.mark.parametrize("partitions", [4, 60])  # many ranges: conversations lie across them
def test_repairs(spark, talks, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = sorted((tuple(r) for r in op12.repair_digests(as_table(spark, talks)).collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == brute_repair(talks)
    assert {"D", "K", "R"} <= set("".join(r[7] for r in got))


def test_other_costs_insert(spark, talks):
    costs = op12.Costs(rerole=7, delete=6, insert=2, truncated=1)
    got = sorted((tuple(r) for r in op12.repair_digests(as_table(spark, talks), costs).collect()), key=repr)
    assert got == brute_repair(talks, costs)
    assert any("I" in r[7] for r in got)


def test_repaired_rows(spark, talks):
    done = op12.repair(op12.damaged(as_table(spark, talks)))
    by_conv = defaultdict(list)
    for r in sorted(done.rows.collect(), key=lambda r: (r.piece, r.at)):
        by_conv[r.conv_id].append(r)
    assert all(re.fullmatch("s?(ua)+", "".join(r.role[0] for r in own)) for own in by_conv.values())
    audits = {r.conv_id: r.audit for r in done.conversations.collect()}
    assert all("".join(r.edit for r in by_conv[c]) == a.replace("D", "") for c, a in audits.items())


def test_empty_table(spark):
    assert op12.repair_digests(as_table(spark, [])).collect() == []
    one = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)  # its only row is dropped
    got = op12.repair_digests(as_table(spark, [(one, 0, "user", "x.")])).collect()
    assert [tuple(r) for r in got] == [(one, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]


def every_cut(cells, closure):
    """CYK proper: each span from every cut into two."""
    n = len(cells)
    table = {(i, i + 1): c for i, c in enumerate(cells)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            cuts = [op12.combined(table[i, k], table[k, i + length]) for k in range(i + 1, i + length)]
            table[i, i + length] = [min((c[x] for c in cuts if c[x] is not None), default=None) for x in range(16)]
    return table[0, n] if n else closure


def test_one_cut_is_as_good_as_every_cut():
    rng = random.Random(8)
    for costs in (op12.Costs(), op12.Costs(keep=1, rerole=1, delete=1, insert=1, truncated=0), op12.Costs(rerole=3, delete=4, insert=1, truncated=2)):
        closure = op12.insertions(costs)
        for _ in range(40):
            rows = [op12.Row(rng.choice("suat "), rng.random() < 0.2, rng.random() < 0.3) for _ in range(rng.randrange(10))]
            span = op12.Span(costs, closure, {})
            for r in rows:
                span.add(r)
            assert span.whole() == every_cut([op12.row_cell(r, costs, closure) for r in rows], closure)


def test_registered_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    got = op12.op12_conversation_repair(spark, sf_dir)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_repair(rows)
