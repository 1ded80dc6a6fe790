"""Benchmark decontamination by a prefix-filtered set join.

A benchmark item is a set of windows (13 consecutive words; a shorter item is one
window), and a window is a set of word shingles at fixed places. A document holds
a window only if it holds all its shingles, so one necessary prefix token is
enough to find it: with the shingles ordered by rarity in the documents, the
rarest. The steps:

1. count the items' shingles in all documents, for the order;
2. give each distinct window its rarest shingle as prefix token;
3. in one pass, each document reports the places of prefix tokens;
4. join them to the windows, apply the positional and length bounds (the window
   must lie inside the document) and compare the window's words exactly.

Tasks know the tokens by a bitmap of bounded size, which can only let too much
through; steps 1 and 4 decide on whole hashes and on the words themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from histflow.llm.common import lower_words, shingle_hashes, ship, stage

WINDOW = 13
SHINGLE = 5
#: A document is contaminated from this share of hit words on.
SHARE = (1, 20)
#: Bits of a bitmap for each token, and at most in all (32 MB).
BITS_EACH = 64
MOST_BITS = 1 << 28

NO_ID = "\x00none"


def row_key(docs: DataFrame, text: str, doc_id: str) -> list[Column]:
    """Columns that name a row: its id as text, and its text's hash."""
    return [F.coalesce(docs[doc_id].cast("string"), F.lit(NO_ID)).alias("k"), F.xxhash64(docs[text].cast("string")).alias("h")]


def _item_windows(items: DataFrame, text: str, item_id: str, window: int) -> DataFrame:
    """(win, n, list, items): each distinct window, and a name for its set of items."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids, wins, lengths = [], [], []
            for i, t in zip(pdf["id"], pdf["text"]):
                words = lower_words(t)
                n = min(window, len(words))
                for a in range(len(words) - n + 1 if n else 0):
                    ids.append(i)
                    wins.append(b" ".join(words[a : a + n]).decode())
                    lengths.append(n)
            yield pd.DataFrame({"id": pd.Series(ids, dtype=object), "win": pd.Series(wins, dtype=object), "n": np.array(lengths, np.int32)})

    named = items.select(items[item_id].cast("string").alias("id"), items[text].cast("string").alias("text")).where("id IS NOT NULL")
    rows = named.mapInPandas(cut, "id string, win string, n int")
    sets = rows.groupBy("win", "n").agg(F.array_sort(F.collect_set("id")).alias("items"))
    return sets.withColumn("list", F.sha2(F.array_join("items", "\x00"), 256))


def _tokens(words: list[bytes], lengths: list[int]) -> list[tuple[int, np.ndarray]]:
    """The shingle hashes of a text for each shingle length that fits."""
    return [(k, shingle_hashes(words, k)) for k in lengths if len(words) >= k]


def _window_tokens(windows: DataFrame, shingle: int) -> DataFrame:
    """(win, n, list, offset, token): the shingles of each window."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = {c: [] for c in ("win", "n", "list", "offset", "token")}
            for win, n, name in zip(pdf["win"], pdf["n"], pdf["list"]):
                for o, x in enumerate(shingle_hashes(win.encode().split(b" "), shingle).view(np.int64)):
                    for c, v in zip(out, (win, n, name, o, x)):
                        out[c].append(v)
            yield pd.DataFrame(out).astype({"n": "int32", "offset": "int32", "token": "int64"})

    return windows.select("win", "n", "list").mapInPandas(cut, "win string, n int, list string, offset int, token bigint")


class Bitmap:
    """Which token hashes may be of interest: ``bits`` places, no token left out."""

    def __init__(self, tokens: DataFrame, n: int):
        self.shift = 64 - max(16, min(MOST_BITS, BITS_EACH * max(n, 1) - 1).bit_length())
        place = tokens.select(F.shiftrightunsigned("token", self.shift).alias("place"))
        found = place.select(F.shiftright("place", 3).alias("byte"), F.expr("shiftleft(1, cast(place & 7 AS INT))").alias("bit"))
        # At most MOST_BITS / 8 rows, whatever the number of tokens.
        table = found.groupBy("byte").agg(F.bit_or("bit").alias("bits")).toArrow()
        self.bytes = np.zeros(1 << (64 - self.shift - 3), np.uint8)
        self.bytes[table["byte"].to_numpy()] = table["bits"].to_numpy()

    def hits(self, tokens: np.ndarray) -> np.ndarray:
        place = tokens >> np.uint64(self.shift)
        return np.flatnonzero(self.bytes[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1)


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    shingle: int = SHINGLE,
    text: str = "text",
    doc_id: str = "doc_id",
    item_text: str = "text",
    item_id: str = "item_id",
) -> DataFrame:
    """One row per document: doc_id, k, h, n_words, spans, items, n_hit, contaminated.

    ``spans``: maximal runs of hit words as (first, after). ``items``: ids of the
    items with a window in the document, as text, sorted. ``k`` and ``h`` name the
    row (see :func:`row_key`). Words are runs of ASCII letters, digits and other
    characters beyond ASCII, A-Z in lower case. NULL and empty texts have no
    words; items without words or id occur nowhere; repeated rows each get their
    row. Other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    windows = stage(_item_windows(items, item_text, item_id, window), "windows")
    tokens = stage(_window_tokens(windows, shingle), "window-tokens")
    lengths = sorted(min(shingle, r.n) for r in tokens.select("n").distinct().collect())  # at most ``window`` of them
    lengths = sorted(set(lengths))
    distinct = tokens.select("token").distinct()
    all_tokens = spark.sparkContext.broadcast(Bitmap(tokens, distinct.count()))
    narrow = docs.select(*row_key(docs, text, doc_id), docs[text].cast("string").alias("text"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [np.empty(0, np.uint64)]
            for t in pdf["text"]:
                for _, x in _tokens(lower_words(t), lengths):
                    found.append(np.unique(x[all_tokens.value.hits(x)]))
            token, n = np.unique(np.concatenate(found), return_counts=True)
            yield pd.DataFrame({"token": token.view(np.int64), "docs": n})

    frequency = narrow.select("text").mapInPandas(count, "token bigint, docs bigint").groupBy("token").agg(F.sum("docs").alias("docs"))
    rank = F.struct(F.coalesce("docs", F.lit(0)), "token", "offset")
    prefix = stage(
        tokens.join(frequency, "token", "left")
        .groupBy("win", "n", "list")
        .agg(F.min(rank).alias("best"))
        .select("win", "n", "list", "best.token", "best.offset"),
        "prefix-tokens",
    )
    wanted = spark.sparkContext.broadcast(Bitmap(prefix, prefix.select("token").distinct().count()))

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sizes, places = [], []
            for t in pdf["text"]:
                words = lower_words(t)
                sizes.append(len(words))
                found = []
                for _, x in _tokens(words, lengths):
                    for p in wanted.value.hits(x):
                        a = max(0, int(p) - window + 1)
                        near = b" ".join(words[a : int(p) + window]).decode()
                        found.append({"at": int(p), "token": int(x[p].astype(np.int64)), "base": a, "near": near})
                places.append(found)
            yield pd.DataFrame({"k": pdf["k"], "h": pdf["h"], "n_words": np.array(sizes, np.int64), "found": places})

    seen = stage(
        narrow.mapInPandas(find, "k string, h bigint, n_words bigint, found array<struct<at:int,token:bigint,base:int,near:string>>"),
        "prefix-places",
    )
    candidates = seen.select("k", "h", "n_words", F.explode("found").alias("f")).select("k", "h", "n_words", "f.*")
    start = F.col("at") - F.col("offset")
    inside = (start >= 0) & (start + F.col("n") <= F.col("n_words"))
    same = F.array_join(F.slice(F.split("near", " "), start - F.col("base") + 1, F.col("n")), " ") == F.col("win")
    hits = (
        candidates.join(prefix, "token")
        .where(inside)
        .where((start >= F.col("base")) & same)
        .groupBy("k", "h")
        .agg(F.array_sort(F.collect_set(F.struct(start.alias("a"), (start + F.col("n")).alias("b")))).alias("cover"), F.collect_set("list").alias("lists"))
    )
    hits = stage(hits, "hits")
    # Windows in order of their start: a span grows while the next one begins inside it.
    kind = "array<struct<a:int,b:int>>"
    spans = F.aggregate(
        "cover",
        F.array().cast(kind),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["b"] >= x["a"]),
            F.concat(
                F.slice(acc, 1, F.size(acc) - 1),
                F.array(F.struct(F.element_at(acc, -1)["a"].alias("a"), F.greatest(F.element_at(acc, -1)["b"], x["b"]).alias("b"))),
            ),
        ).otherwise(F.concat(acc, F.array(x))),
    )
    names = windows.select("list", "items").dropDuplicates(["list"])
    listed = (
        hits.select("k", "h", F.explode("lists").alias("list"))
        .join(names, "list")
        .groupBy("k", "h")
        .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    )
    verdict = hits.select("k", "h", spans.alias("spans")).join(listed, ["k", "h"])
    n_hit = F.coalesce(F.aggregate("spans", F.lit(0).cast("long"), lambda acc, x: acc + x["b"] - x["a"]), F.lit(0).cast("long"))
    share, of = SHARE
    return (
        seen.select("k", "h", "n_words")
        .join(verdict, ["k", "h"], "left")
        .select(
            F.when(F.col("k") != NO_ID, F.col("k")).cast(docs.schema[doc_id].dataType).alias("doc_id"),
            "k",
            "h",
            "n_words",
            F.coalesce("spans", F.array().cast(kind)).alias("spans"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            n_hit.alias("n_hit"),
            ((n_hit > 0) & (n_hit * of >= F.col("n_words") * share)).alias("contaminated"),
        )
    )


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    bad = decontaminate(docs, items).where("contaminated").select("k", "h").distinct()
    k, h = row_key(docs, "text", "doc_id")
    return docs.join(bad, (k == bad["k"]) & (h == bad["h"]), "left_anti")


def op3_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate(docs, items).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


OP3_SQL = r"""
WITH letters AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS up, 'abcdefghijklmnopqrstuvwxyz' AS low),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), up, low), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents, letters),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), up, low), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark, letters),
iw AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[s:s + least(13, len(w)) - 1], ' ') AS win
       FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS s FROM i WHERE len(w) > 0)),
dw AS (SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS win
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
hit AS (SELECT dw.doc_id, dw.s, dw.n, iw.item_id FROM dw JOIN iw ON dw.win = iw.win AND dw.n = iw.n),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT doc_id, s, n FROM hit)) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS ks FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS k FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ks, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""
