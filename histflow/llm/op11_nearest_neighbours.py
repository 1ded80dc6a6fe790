"""Approximate nearest neighbours: a navigable small-world graph per shard.

Equal vectors are one point of the index. Points are dealt to shards by a hash, about
``SHARD_POINTS`` each, and every shard gets a hierarchical navigable small-world graph of
its own: each point has links to near points on level 0, and, with falling probability, on
levels above, where a search takes long steps first. A shard is stored as one row of flat arrays: the
vectors, and for each level the points on it and their neighbours as a matrix
of row numbers.

Queries come in blocks. Each block meets each shard once; the shards' answers, with
scores in double precision on the original vectors, are merged by query.

Skew: a vector that fills a third of the table is cut to its ``k + 1`` least ids before the shuffle,
as no more can be among the nearest; queries with equal vectors are asked once. A
shard's size does not depend on the data. A block of queries and a shard are all that a task holds.
The number of pairs of blocks and shards grows with the square of the table, with
``SHARD_POINTS * QUERY_BLOCK`` below it: both are parameters.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from histflow.llm.common import ship, stage

NEAREST = 5
EVERY = 50
SHARD_POINTS = 8192
QUERY_BLOCK = 1024
#: Links of a point on the upper levels; twice as many on level 0.
LINKS = 16
#: Points that are looked at while a point is put in, and while one is searched.
WIDTH_BUILD = 80
WIDTH_SEARCH = 80


# ---- the graph -----------------------------------------------------------------
class Graph:
    """A hierarchical navigable small-world graph over unit vectors, by inner product.

    ``levels[l]`` has the points on level l and above, in the order of their entry, and
    ``links[l]`` a row of neighbours for each of them (-1: none).
    """

    def __init__(self, unit: np.ndarray, top: np.ndarray, links: list[np.ndarray]) -> None:
        self.unit, self.top, self.links = unit, top, links
        self.seen = np.zeros(len(unit), np.int64)
        self.round = 0

    @classmethod
    def built(cls, unit: np.ndarray, draws: np.ndarray, links: int = LINKS, width: int = WIDTH_BUILD) -> Graph:
        """The graph of ``unit``; ``draws`` in (0, 1] decide the points' levels."""
        top = np.floor(-np.log(draws) / math.log(links)).astype(np.int64)
        highest = int(top.max(initial=0))
        graph = cls(unit, top, [np.full((len(unit), links * (1 if level else 2)), -1, np.int32) for level in range(highest + 1)])
        graph.degree = [np.zeros(len(unit), np.int64) for _ in range(highest + 1)]
        graph.entry = 0
        for point in range(1, len(unit)):
            graph._put(point, links, width)
        return graph

    def _put(self, point: int, links: int, width: int) -> None:
        q, level = self.unit[point], int(self.top[point])
        near = [self.entry]
        for above in range(int(self.top[self.entry]), level, -1):
            near = [i for _, i in self._layer(q, near, 1, above)]
        for l in range(min(level, int(self.top[self.entry])), -1, -1):
            found = self._layer(q, near, width, l)
            near = [i for _, i in found]
            chosen = self._spread(np.array([i for _, i in found]), np.array([s for s, _ in found], np.float32), links)
            table, degree = self.links[l], self.degree[l]
            table[point, : len(chosen)] = chosen
            degree[point] = len(chosen)
            most = table.shape[1]
            for other in chosen.tolist():
                if degree[other] < most:
                    table[other, degree[other]] = point
                    degree[other] += 1
                else:
                    around = np.append(table[other], point)
                    sims = self.unit[around] @ self.unit[other]
                    order = np.argsort(-sims, kind="stable")
                    kept = self._spread(around[order], sims[order], most)
                    table[other, : len(kept)] = kept
                    table[other, len(kept) :] = -1
                    degree[other] = len(kept)
        if level > self.top[self.entry]:
            self.entry = point

    def _spread(self, points: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
        """At most ``most`` of ``points`` (nearest first): those nearer to the centre than to one already taken, then the nearest others."""
        if len(points) <= most:
            return points
        between = self.unit[points] @ self.unit[points].T
        closest = np.full(len(points), -np.inf, np.float32)
        taken, left = [], []
        for n in range(len(points)):
            if closest[n] < sims[n]:
                taken.append(n)
                if len(taken) == most:
                    break
                np.maximum(closest, between[n], out=closest)
            else:
                left.append(n)
        taken += left[: most - len(taken)]
        return points[taken]

    def _layer(self, q: np.ndarray, entries: list[int], width: int, level: int) -> list[tuple[float, int]]:
        """The best ``width`` points that a greedy search from ``entries`` meets on a level, best first."""
        self.round += 1
        seen, now, table, unit = self.seen, self.round, self.links[level], self.unit
        seen[entries] = now
        best = [(s, i) for s, i in zip((unit[entries] @ q).tolist(), entries)]
        ahead = [(-s, i) for s, i in best]
        heapq.heapify(best)
        heapq.heapify(ahead)
        push, pop, swap = heapq.heappush, heapq.heappop, heapq.heappushpop
        while ahead:
            s, i = pop(ahead)
            if len(best) >= width and -s < best[0][0]:
                break
            row = table[i]
            row = row[(row >= 0) & (seen[row] != now)]
            if not len(row):
                continue
            seen[row] = now
            sims = unit[row] @ q
            if len(best) >= width:
                better = sims > best[0][0]
                row, sims = row[better], sims[better]
            for s, i in zip(sims.tolist(), row.tolist()):
                if len(best) < width:
                    push(best, (s, i))
                    push(ahead, (-s, i))
                elif s > best[0][0]:
                    swap(best, (s, i))
                    push(ahead, (-s, i))
        return sorted(best, key=lambda x: (-x[0], x[1]))

    def nearest(self, q: np.ndarray, width: int) -> list[int]:
        """The points nearest to ``q`` that a search of this width finds, best first."""
        near = [self.entry]
        for level in range(int(self.top[self.entry]), 0, -1):
            near = [i for _, i in self._layer(q, near, 1, level)]
        return [i for _, i in self._layer(q, near, width, 0)]

    def stored(self) -> dict[str, bytes]:
        """The graph as flat arrays; upper levels have rows for their own points only."""
        upper = [(np.flatnonzero(self.top >= level).astype(np.int32), level) for level in range(1, len(self.links))]
        return {
            "level_0": self.links[0].tobytes(),
            "level_sizes": np.array([len(p) for p, _ in upper], np.int32).tobytes(),
            "level_points": b"".join(p.tobytes() for p, _ in upper),
            "level_links": b"".join(self.links[level][p].tobytes() for p, level in upper),
            "entry": int(self.entry),
        }

    @classmethod
    def loaded(cls, unit: np.ndarray, row: dict) -> Graph:
        n = len(unit)
        level_0 = np.frombuffer(row["level_0"], np.int32).reshape(n, -1)
        sizes, points = np.frombuffer(row["level_sizes"], np.int32), np.frombuffer(row["level_points"], np.int32)
        narrow = np.frombuffer(row["level_links"], np.int32).reshape(len(points), -1) if len(points) else None
        top, links, at = np.zeros(n, np.int64), [level_0], 0
        for level, size in enumerate(sizes.tolist(), 1):
            own = points[at : at + size]
            top[own] = level
            table = np.full((n, narrow.shape[1]), -1, np.int32)
            table[own] = narrow[at : at + size]
            links.append(table)
            at += size
        graph = cls(unit, top, links)
        graph.entry = row["entry"]
        return graph


# ---- vectors -------------------------------------------------------------------
def _scaled(vectors: np.ndarray) -> np.ndarray:
    """In double precision, times a power of two each, so that squares neither overflow nor vanish: cosines stay exactly the same."""
    wide = vectors.astype(np.float64)
    _, exponent = np.frexp(np.abs(wide).max(axis=1))
    return np.ldexp(wide, -exponent[:, None])


def _unit(scaled: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray((scaled / np.linalg.norm(scaled, axis=1)[:, None]).astype(np.float32))


def _packing(kind: type, schema: pa.Schema):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            lists = batch.column(1)
            offsets = lists.offsets.to_numpy()
            holes = lists.values.is_null().to_numpy(zero_copy_only=False)
            values = lists.values.to_numpy(zero_copy_only=False).astype(kind)
            good = np.isfinite(values) & ~holes
            for n, (vec_id, there) in enumerate(zip(batch.column(0).to_pylist(), lists.is_valid().to_pylist())):
                a, b = offsets[n], offsets[n + 1]
                if there and good[a:b].all() and values[a:b].any():
                    body = (values[a:b] + kind(0)).tobytes()  # one form of zero
                    out.append({"vec_id": vec_id, "dim": int(b - a), "key": hashlib.sha256(body).digest(), "vector": body})
            yield pa.RecordBatch.from_pylist(out, schema)

    return pack


def packed(table: DataFrame, vec_id: str, vector: str) -> tuple[DataFrame, type]:
    """vec_id, dim, key, vector (bytes) of the vectors that take part, staged; the type of their components."""
    single = table.schema[vector].dataType == T.ArrayType(T.FloatType(), True) or table.schema[vector].dataType == T.ArrayType(T.FloatType(), False)
    kind, name = (np.float32, "float") if single else (np.float64, "double")
    schema = pa.schema([("vec_id", pa.int64()), ("dim", pa.int32()), ("key", pa.binary()), ("vector", pa.binary())])
    plain = table.select(table[vec_id].cast("long").alias("vec_id"), table[vector].cast(f"array<{name}>").alias("vector"))
    return stage(plain.mapInArrow(_packing(kind, schema), "vec_id bigint, dim int, key binary, vector binary"), "neighbour-vectors"), kind


# ---- shards --------------------------------------------------------------------
INDEX = (
    "dim int, shard int, keys binary, vectors binary, member_ends binary, member_ids array<bigint>,"
    " level_0 binary, level_sizes binary, level_points binary, level_links binary, entry int"
)
_INDEX = pa.schema(
    [("dim", pa.int32()), ("shard", pa.int32())]
    + [(n, pa.binary()) for n in ("keys", "vectors", "member_ends")]
    + [("member_ids", pa.list_(pa.int64()))]
    + [(n, pa.binary()) for n in ("level_0", "level_sizes", "level_points", "level_links")]
    + [("entry", pa.int32())]
)


def _building(kind: type, links: int, width: int):
    def build(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("key", "ascending"), ("rank", "ascending")])
        keys = rows["key"].to_pylist()
        first = [n for n, key in enumerate(keys) if n == 0 or key != keys[n - 1]]
        own = [keys[n] for n in first]
        vectors = np.stack([np.frombuffer(rows["vector"][n].as_py(), kind) for n in first])
        # The key is a digest: its first bytes are as good as drawn.
        draws = (np.frombuffer(b"".join(k[:8] for k in own), np.uint64).astype(np.float64) + 1) / 2**64
        graph = Graph.built(_unit(_scaled(vectors)), draws, links, width)
        return pa.Table.from_pylist(
            [
                {
                    "dim": rows["dim"][0].as_py(),
                    "shard": rows["shard"][0].as_py(),
                    "keys": b"".join(own),
                    "vectors": vectors.tobytes(),
                    "member_ends": np.array([*first[1:], len(keys)], np.int64).tobytes(),
                    "member_ids": rows["vec_id"].to_pylist(),
                }
                | graph.stored()
            ],
            _INDEX,
        )

    return build


def index(vectors: DataFrame, kind: type, k: int = NEAREST, shard_points: int = SHARD_POINTS, links: int = LINKS, width: int = WIDTH_BUILD) -> tuple[DataFrame, int]:
    """The staged index, a row per shard, and the number of shards of a dimension.

    Of equal vectors, the ``k + 1`` least ids are kept with the point.
    """
    points = vectors.agg(F.approx_count_distinct("key")).first()[0] or 0
    shards = max(1, math.ceil(points / shard_points))
    alike = Window.partitionBy("key").orderBy(F.col("vec_id").asc_nulls_last())
    members = vectors.withColumn("rank", F.row_number().over(alike)).where(F.col("rank") <= k + 1)
    dealt = members.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int"))
    return stage(dealt.groupBy("dim", "shard").applyInArrow(_building(kind, links, width), INDEX), "neighbour-index"), shards


# ---- search --------------------------------------------------------------------
FOUND = "key binary, vec_id bigint, own boolean, score double"
_FOUND = pa.schema([("key", pa.binary()), ("vec_id", pa.int64()), ("own", pa.bool_()), ("score", pa.float64())])


def _searching(kind: type, k: int, width: int):
    def search(shard: pa.Table, block: pa.Table) -> pa.Table:
        out: list[dict] = []
        if shard.num_rows and block.num_rows:
            row = shard.to_pylist()[0]
            keys = [row["keys"][n : n + 32] for n in range(0, len(row["keys"]), 32)]
            place = {key: n for n, key in enumerate(keys)}
            scaled = _scaled(np.frombuffer(row["vectors"], kind).reshape(len(keys), -1))
            norms = np.linalg.norm(scaled, axis=1)
            ends = np.frombuffer(row["member_ends"], np.int64)
            ids = row["member_ids"]
            graph = Graph.loaded(_unit(scaled), row)
            for asked in block["queries"].to_pylist():
                queries = _scaled(np.stack([np.frombuffer(x["vector"], kind) for x in asked]))
                for x, q, u in zip(asked, queries, _unit(queries)):
                    near = graph.nearest(u, max(width, k + 1))
                    own = place.get(x["key"])
                    if own is not None and own not in near:
                        near.append(own)
                    scores = (scaled[near] @ q) / (norms[near] * np.linalg.norm(q))
                    order = np.argsort(-scores, kind="stable")
                    # Ties at the end stay for the ids to decide.
                    least = scores[order[min(k, len(near) - 1)]]
                    for n in order.tolist():
                        if scores[n] < least:
                            break
                        point = near[n]
                        for vec_id in ids[(ends[point - 1] if point else 0) : ends[point]]:
                            out.append({"key": x["key"], "vec_id": vec_id, "own": point == own, "score": float(scores[n])})
        return pa.Table.from_pylist(out, _FOUND)

    return lambda _, shard, block: search(shard, block)


def nearest_neighbours(
    table: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    k: int = NEAREST,
    every: int = EVERY,
    shard_points: int = SHARD_POINTS,
    query_block: int = QUERY_BLOCK,
    links: int = LINKS,
    width_build: int = WIDTH_BUILD,
    width_search: int = WIDTH_SEARCH,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` rows of largest cosine found for each row whose id ``every`` divides.

    Candidates are all other rows whose vector has the query's length; nearest first, ties to
    the smaller id, NULL ids last (they are candidates, never queries). Vectors that are NULL, zero or hold a NULL,
    NaN or infinite component take no part. Repeated rows are rows of their own: a query is
    left out of its own candidates once. An empty table gives no rows; other columns are not read.
    """
    ship(table.sparkSession)
    vectors, kind = packed(table, vec_id, vector)
    shards_of, shards = index(vectors, kind, k, shard_points, links, width_build)
    asking = vectors.where(F.col("vec_id") % every == 0)
    points = asking.agg(F.approx_count_distinct("key")).first()[0] or 0
    parts = max(1, math.ceil(points / query_block))
    once = asking.select("key", "dim", "vector").distinct().withColumn("part", F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int"))
    blocks = once.groupBy("dim", "part").agg(F.collect_list(F.struct("key", "vector")).alias("queries"))
    # Each block goes to each shard, and each shard to each block.
    to_shards = blocks.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    to_blocks = shards_of.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    pair = ["dim", "shard", "part"]
    found = to_blocks.groupBy(*pair).cogroup(to_shards.groupBy(*pair)).applyInArrow(_searching(kind, k, width_search), FOUND)
    best = Window.partitionBy("key").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    merged = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
    answers = stage(merged.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("n", "vec_id", "own", "score"))).alias("found")), "neighbour-answers")
    asked = asking.select("key", F.col("vec_id").alias("query_id")).join(answers, "key")
    itself = F.array_position(F.transform("found", lambda x: x["own"] & F.coalesce(x["vec_id"] == F.col("query_id"), F.lit(False))), F.lit(True)) - 1
    others = asked.select("query_id", F.slice(F.filter("found", lambda x, i: i != itself), 1, k).alias("others"))
    return others.select("query_id", F.posexplode("others").alias("at", "x")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score")
    )


def op11_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    return nearest_neighbours(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
