"""N-gram Jaccard join with Bayesian candidate pruning.

Documents are sets of five-word shingles; all pairs of different texts with a
Jaccard similarity of 0.8 or more are links. Equal texts are one node.

1. Each text gets 128 MinHash values, in 32 bands of 4. Two texts of similarity
   0.8 share no band with a probability of 5e-8.
2. Texts that share a band are candidates. A bucket of many texts is cut into
   blocks by a hash, and each pair of blocks is a unit of work of bounded size, so
   no task ever holds a whole bucket. Surviving pairs are written out as lists of partners.
3. In a unit, pairs are compared 16 values at a time. After each step the posterior
   probability that the similarity reaches the threshold, given the matches so far
   (uniform prior), is looked up; pairs below the tolerance are dropped. A pair is
   looked at only in the first band it shares, so it is counted once.
4. Units with surviving pairs get their texts and verify each pair exactly.
5. Links are counted for each node; a spanning forest of each unit's links gives the
   edges from which connected components are found by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from histflow.llm.common import frugal, lower_words, shingle_hashes, ship, stage

SHINGLE = 5
THRESHOLD = 0.8
VALUES = 128
BAND = 4
STEP = 16
#: A pair is dropped when the posterior probability of a link is below this.
TOLERANCE = 1e-6
#: Texts of a bucket that one side of a unit holds, about.
BLOCK = 256

_RNG = np.random.Generator(np.random.PCG64(77))
_A = _RNG.integers(1, 2**63, VALUES, dtype=np.uint64) | np.uint64(1)
_B = _RNG.integers(0, 2**63, VALUES, dtype=np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The MinHash values of a set of shingle hashes, 16 bits of each."""
    least = np.full(VALUES, 0xFFFFFFFF, np.uint64)
    for i in range(0, len(shingles), 4096):
        part = shingles[i : i + 4096]
        np.minimum(least, ((_A[:, None] * part + _B[:, None]) >> np.uint64(32)).min(axis=1), out=least)
    # Multiplying keeps low bits of the order in the top bits; mix before cutting.
    return ((least * np.uint64(0x9E3779B1)) >> np.uint64(16)).astype(np.uint16)


@lru_cache(maxsize=8)
def least_matches(threshold: float, tolerance: float) -> tuple[int, ...]:
    """For 16, 32, ... compared values, the matches below which a pair is dropped.

    With a uniform prior the posterior is Beta(m + 1, n - m + 1); its share above
    the threshold is the chance of at most m successes in n + 1 trials.
    """
    out = []
    for n in range(STEP, VALUES + 1, STEP):
        total, m = 0.0, -1
        while total < tolerance:
            m += 1
            total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return tuple(out)


def surviving_pairs(a: np.ndarray, b: np.ndarray, pairs: tuple[np.ndarray, np.ndarray], threshold: float, tolerance: float) -> np.ndarray:
    """Which of the pairs of rows of ``a`` and ``b`` may still be links after all values."""
    x, y = pairs
    alive = np.arange(len(x))
    matches = np.zeros(len(x), np.int32)
    for step, least in enumerate(least_matches(threshold, tolerance)):
        cut = slice(step * STEP, (step + 1) * STEP)
        matches = matches + (a[x[alive], cut] == b[y[alive], cut]).sum(axis=1, dtype=np.int32)
        keep = matches >= least
        alive, matches = alive[keep], matches[keep]
        if not len(alive):
            break
    return alive


def first_shared_band(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each pair of signatures (rows) the first band that is equal; it must exist."""
    equal = (a == b).reshape(len(a), VALUES // BAND, BAND).all(axis=2)
    return equal.argmax(axis=1)


def _runs(batches: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """The rows of a task, sorted by ``key``, one run of equal keys at a time."""
    rest: pd.DataFrame | None = None
    for pdf in batches:
        if rest is not None:
            pdf = pd.concat([rest, pdf], ignore_index=True)
        if not len(pdf):
            continue
        k = pdf[key].to_numpy()
        cuts = np.flatnonzero(k[1:] != k[:-1]) + 1
        starts = np.concatenate([[0], cuts])
        for i, j in zip(starts[:-1], starts[1:]):
            yield pdf.iloc[i:j]
        rest = pdf.iloc[starts[-1] :]
    if rest is not None and len(rest):
        yield rest


def text_key(docs: DataFrame, text: str):
    """The name of a text: 128 bits; NULL is the empty text."""
    return F.unhex(F.md5(F.coalesce(docs[text].cast("string"), F.lit(""))))


def _signatures(docs: DataFrame, text: str, doc_id: str, shingle: int) -> DataFrame:
    """(key, doc_id, sig): sig is NULL for a text without words."""
    rows = docs.select(text_key(docs, text).alias("key"), docs[doc_id].alias("doc_id"), docs[text].cast("string").alias("text"))

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for t in pdf["text"]:
                found = shingle_hashes(lower_words(t), shingle)
                out.append(signature(np.unique(found)).tobytes() if len(found) else None)
            yield pd.DataFrame({"key": pdf["key"], "doc_id": pdf["doc_id"], "sig": pd.Series(out, dtype=object)})

    signed = rows.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(frugal(sign), "key binary, doc_id string, sig binary")
    return signed.withColumn("doc_id", F.col("doc_id").cast(docs.schema[doc_id].dataType))


def _band_rows(nodes: DataFrame) -> DataFrame:
    """(bucket, band, id): the buckets of each node."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = VALUES // BAND
        salt = _RNG_BANDS
        for pdf in batches:
            if not len(pdf):
                continue
            sigs = np.frombuffer(b"".join(pdf["sig"]), np.uint16).reshape(len(pdf), VALUES)
            keys = np.ascontiguousarray(sigs).view(np.uint64).reshape(len(pdf), n)
            mixed = (keys ^ salt) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            yield pd.DataFrame({"bucket": mixed.view(np.int64).ravel(), "band": np.tile(np.arange(n, dtype=np.int32), len(pdf)), "id": np.repeat(pdf["id"].to_numpy(), n)})

    return nodes.where("sig IS NOT NULL").select("id", "sig").mapInPandas(frugal(cut), "bucket bigint, band int, id bigint")


_RNG_BANDS = _RNG.integers(0, 2**63, VALUES // BAND, dtype=np.uint64)


def _units(bands: DataFrame, nodes: DataFrame, block: int) -> DataFrame:
    """(unit, band, side, id, sig): the members of each pair of blocks of a bucket.

    ``side``: 0 and 1 are to be compared with each other, 2 with all of its own.
    """
    shared = bands.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / block).cast("int")
    rows = (
        bands.join(shared, "bucket")
        .select("bucket", "band", "id", blocks.alias("blocks"))
        .withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        .join(nodes.select("id", "sig"), "id")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    )
    low, high = F.least("own", "other"), F.greatest("own", "other")
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    return rows.select(F.xxhash64("bucket", "band", low, high).alias("unit"), "band", side.alias("side"), "id", "sig")


def _prune(units: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """(unit, id, partners): members of units that may have links, with their partners."""

    def prune(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out_unit, out_id, out_partners = [], [], []
        for run in _runs(batches, "unit"):
            if len(run) < 2:
                continue
            ids, side, band = run["id"].to_numpy(), run["side"].to_numpy(), int(run["band"].iloc[0])
            sigs = np.frombuffer(b"".join(run["sig"]), np.uint16).reshape(len(run), VALUES)
            if side[0] == 2:
                x, y = np.triu_indices(len(run), 1)
            else:
                left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
                x, y = np.repeat(left, len(right)), np.tile(right, len(left))
            alive = surviving_pairs(sigs, sigs, (x, y), threshold, tolerance)
            x, y = x[alive], y[alive]
            mine = first_shared_band(sigs[x], sigs[y]) == band if len(x) else np.zeros(0, bool)
            x, y = x[mine], y[mine]
            if not len(x):
                continue
            unit = run["unit"].iloc[0]
            order = np.argsort(x, kind="stable")
            x, y = x[order], y[order]
            heads, starts = np.unique(x, return_index=True)
            parts = dict(zip(heads.tolist(), np.split(ids[y], starts[1:])))
            for i in np.unique(np.concatenate([x, y])).tolist():
                out_unit.append(unit)
                out_id.append(ids[i])
                out_partners.append(parts.get(i, ids[:0]))
            if len(out_unit) > 10_000:
                yield pd.DataFrame({"unit": out_unit, "id": out_id, "partners": out_partners})
                out_unit, out_id, out_partners = [], [], []
        yield pd.DataFrame({"unit": np.array(out_unit, np.int64), "id": np.array(out_id, np.int64), "partners": pd.Series(out_partners, dtype=object)})

    dealt = units.repartition("unit").sortWithinPartitions("unit")
    return dealt.mapInPandas(frugal(prune), "unit bigint, id bigint, partners array<bigint>")


def jaccard(a: set, b: set) -> float:
    both = len(a & b)
    return both / (len(a) + len(b) - both) if a or b else 0.0


def shingle_set(text: str | None, shingle: int = SHINGLE) -> set[bytes]:
    """The shingles of a text themselves; all words where they are fewer."""
    words = lower_words(text)
    k = min(shingle, len(words))
    return {b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()


def _verify(members: DataFrame, threshold: float, shingle: int) -> DataFrame:
    """(id, n_links, root): each member's links in a unit, and the least id it is linked with there."""

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for run in _runs(batches, "unit"):
            ids = run["id"].tolist()
            sets = {i: shingle_set(t, shingle) for i, t in zip(ids, run["text"])}
            links = dict.fromkeys(ids, 0)
            root = {i: i for i in ids}

            def find(i):
                while root[i] != i:
                    root[i] = root[root[i]]
                    i = root[i]
                return i

            for i, partners in zip(ids, run["partners"]):
                for j in partners:
                    if jaccard(sets[i], sets[j]) >= threshold:
                        links[i] += 1
                        links[j] += 1
                        a, b = find(i), find(j)
                        root[max(a, b)] = min(a, b)
            kept = [i for i in ids if links[i]]
            if kept:
                yield pd.DataFrame({"id": kept, "n_links": [links[i] for i in kept], "root": [find(i) for i in kept]})

    dealt = members.repartition("unit").sortWithinPartitions("unit")
    return dealt.mapInPandas(frugal(verify), "id bigint, n_links bigint, root bigint")


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the least id that each node of ``edges`` (a, b) is connected with.

    Every round takes the least label among neighbours, then the label's own
    label, so long chains shrink by half; each round is written out.
    """
    both = stage(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "edges")
    labels = stage(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("component")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["id"]).groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near"))
        lower = labels.join(near, "id").select("id", F.col("component").alias("old"), F.least("component", "near").alias("label"))
        of = labels.select(F.col("id").alias("label"), F.col("component").alias("further"))
        jumped = lower.join(of, "label", "left").select("id", "old", F.least("label", F.coalesce("further", "label")).alias("component"))
        found = stage(jumped, "labels")
        if found.where("old <> component").isEmpty():
            return labels
        labels = found.select("id", "component")


def similar_documents(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    shingle: int = SHINGLE,
    tolerance: float = TOLERANCE,
    text: str = "text",
    doc_id: str = "doc_id",
    block: int = BLOCK,
) -> DataFrame:
    """One row per document: doc_id, key, class_id, class_key, n_links, n_copies.

    ``class_id`` is the least id among the documents connected by links or equal
    texts; ``n_links`` the number of different texts linked with the document's;
    ``n_copies`` the documents of the same text. ``key`` names the text, and ``class_key`` a text of the least id. Texts of
    fewer than five words have one shingle; NULL is the empty text, which has no
    links, only copies. NULL ids are never the least unless there is no other.
    Repeated rows each get their row; other columns are not read.
    """
    ship(docs.sparkSession)
    rows = stage(_signatures(docs, text, doc_id, shingle), "signatures")
    groups = rows.groupBy("key").agg(F.min("doc_id").alias("least_id"), F.count("*").alias("n_copies"), F.first("sig").alias("sig"))
    nodes = stage(groups.withColumn("id", F.monotonically_increasing_id()), "nodes")
    bands = stage(_band_rows(nodes), "bands")
    survivors = stage(_prune(_units(bands, nodes, block), threshold, tolerance), "survivors")
    wanted = survivors.select("id").distinct().join(nodes.select("id", "key", "least_id"), "id")
    here = docs.select(text_key(docs, text).alias("key"), docs[doc_id].alias("this_id"), docs[text].cast("string").alias("text"))
    texts = (
        here.join(wanted, "key")
        .where(F.col("this_id").eqNullSafe(F.col("least_id")))
        .select("id", "text")
        .groupBy("id")
        .agg(F.first("text").alias("text"))
    )
    found = stage(_verify(survivors.join(texts, "id"), threshold, shingle), "links")
    links = found.groupBy("id").agg(F.sum("n_links").alias("n_links"))
    named = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    whole = nodes.select("id", "key", "least_id", "n_copies").join(links, "id", "left").join(named, "id", "left")
    whole = whole.withColumn("component", F.coalesce("component", "id"))
    # The class is named by its least id, NULL last, and of texts with that id the least key.
    first = F.min(F.struct(F.col("least_id").isNull().alias("nameless"), "least_id", "key"))
    least = whole.groupBy("component").agg(first.alias("first")).select("component", F.col("first.least_id").alias("class_id"), F.col("first.key").alias("class_key"))
    classes = whole.join(least, "component").select("key", "class_id", "class_key", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "n_copies")
    return rows.select("doc_id", "key").join(classes, "key").select("doc_id", "key", "class_id", "class_key", "n_links", "n_copies")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each class: that of its least id, and of texts with that id the one with the least key.

    Where ids are NULL or stand for several rows, one row stays all the same.
    """
    named = similar_documents(docs).where((F.col("key") == F.col("class_key")) & F.col("doc_id").eqNullSafe(F.col("class_id")))
    kept = named.select(F.col("doc_id").alias("kept_id"), F.col("key").alias("kept_key"))
    kept = stage(kept.groupBy("kept_id", "kept_key").agg(F.count("*").alias("n")), "kept")
    same = docs["doc_id"].eqNullSafe(kept["kept_id"]) & (text_key(docs, "text") == kept["kept_key"])
    out = docs.join(kept, same, "left_semi")
    # Rows repeated with their id: one stays.
    if kept.where("n > 1").isEmpty():
        return out
    return out.withColumn("__key", text_key(out, "text")).dropDuplicates(["doc_id", "__key"]).drop("__key")


def op1_jaccard_join(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return similar_documents(docs).drop("key", "class_key")
