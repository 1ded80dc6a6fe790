"""Nearest neighbours against brute force: exact scores and order, recall of at least 0.9."""

import random
from collections import defaultdict

import numpy as np
import pytest

from histflow.llm import op11_nearest_neighbours as op11


def good(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)


def cosine(a, b):
    a, b = np.asarray(a, np.float64), np.asarray(b, np.float64)
    a, b = a / np.abs(a).max(), b / np.abs(b).max()
    return float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b)))


def brute(rows, k=5, every=50):
    """For each query row: (query_id, [(score, vec_id), ...]) over all other rows, best first."""
    part = [(i, v) for i, v in rows if good(v)]
    out = []
    for n, (i, v) in enumerate(part):
        if i is not None and i % every == 0:
            others = [(cosine(v, w), j) for m, (j, w) in enumerate(part) if m != n and len(w) == len(v)]
            out.append((i, sorted(others, key=lambda x: (-round(x[0], 9), x[1] is None, x[1] or 0))[:k]))
    return out


def answers(df):
    got = defaultdict(list)
    for r in df.collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    return {i: sorted(x) for i, x in got.items()}


def table(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, "z", 1, 2.0) for i, v in rows], f"vec_id bigint, embedding array<{kind}>, key string, dim int, score double").repartition(3)


def recall(got, expected):
    hits = [len({j for _, j, _ in got.get(i, [])} & {j for _, j in best}) / len(best) for i, best in expected if best]
    return sum(hits) / len(hits)


@pytest.fixture(scope="module")
def clusters():
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(20, 24))
    return [(i, (centres[i % 20] + 0.4 * rng.normal(size=24)).astype(np.float32).tolist()) for i in range(2500)]


@pytest.mark.parametrize("shard_points", [8192, 300])
def test_recall_and_scores(spark, clusters, shard_points):
    expected = brute(clusters)
    got = answers(op11.nearest_neighbours(table(spark, clusters), shard_points=shard_points, query_block=16))
    by_id = dict(clusters)
    assert sorted(got) == sorted(i for i, _ in expected)
    for i, found in got.items():
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5] and i not in {j for _, j, _ in found}
        assert all(abs(s - cosine(by_id[i], by_id[j])) < 1e-12 for _, j, s in found)
        assert [(-s, j) for _, j, s in found] == sorted((-s, j) for _, j, s in found)
    assert recall(got, expected) >= 0.97


def test_odd_rows(spark):
    rng = random.Random(2)
    vector = lambda: [rng.uniform(-1, 1) for _ in range(4)]
    common = [0.5, 0.25, -1.0, 0.0]
    rows = [(i, vector()) for i in range(1, 120)] + [(i, common) for i in range(1000, 1400)] + [(0, common), (2000, common), (2000, common)]
    rows += [(None, [0.5, 0.25, -1.0, 0.1]), (50, vector()), (1450, [-0.0, 1.0]), (1451, [0.0, 1.0]), (1452, [1.0, 1.0]), (1500, [1.0] * 7)]
    rows += [(3000, None), (3050, []), (3100, [0.0] * 4), (3150, [1.0, None, 1.0, 1.0]), (3200, [float("nan"), 1.0, 1.0, 1.0]), (3250, [float("inf"), 1.0, 1.0, 1.0])]
    rows += [(3300, [1e300, 1e300, -1e300, 1e299]), (3301, [1e-300, 1e-300, -1e-300, 1e-301])]
    got = op11.nearest_neighbours(table(spark, rows, "double")).collect()
    expected = brute(rows)
    assert sorted({r.query_id for r in got}) == sorted({i for i, x in expected if x})  # the vector of seven has no partner
    lists = defaultdict(list)
    for r in got:
        lists[r.query_id].append((r["rank"], r.vec_id, round(r.score, 9)))
    want = defaultdict(list)
    for i, best in expected:
        want[i] += [(n, j, round(s, 9)) for n, (s, j) in enumerate(best, 1)]
    for i in want:
        assert sorted(lists[i], key=repr) == sorted(want[i], key=repr), i
    assert [j for _, j, _ in sorted(lists[0])] == [1000, 1001, 1002, 1003, 1004]


def test_few_and_none(spark):
    assert op11.nearest_neighbours(table(spark, [])).collect() == []
    assert op11.nearest_neighbours(table(spark, [(0, [1.0, 2.0])])).collect() == []
    got = op11.nearest_neighbours(table(spark, [(0, [1.0, 2.0]), (7, [2.0, 1.0]), (8, [2.0, 4.0])])).collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in sorted(got)] == [(0, 1, 8), (0, 2, 7)]


def test_stored_graph_is_the_built_one():
    rng = np.random.default_rng(1)
    unit = op11._unit(rng.normal(size=(700, 8)))
    graph = op11.Graph.built(unit, rng.uniform(1e-9, 1, 700))
    again = op11.Graph.loaded(unit, graph.stored())
    queries = op11._unit(rng.normal(size=(40, 8)))
    assert len(graph.links) > 1 and again.entry == graph.entry
    found = [again.nearest(q, 60) for q in queries]
    assert found == [graph.nearest(q, 60) for q in queries]
    exact = np.argsort(-(queries @ unit.T), axis=1)[:, :10]
    assert np.mean([len(set(f[:10]) & set(e.tolist())) / 10 for f, e in zip(found, exact)]) > 0.97


def test_registered_query(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    df = op11.op11_nearest_neighbours(spark, sf_dir)
    assert df.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    expected = brute(rows)
    got = answers(df)
    assert sorted(got) == sorted(i for i, _ in expected) and recall(got, expected) >= 0.9
