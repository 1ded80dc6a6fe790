"""Quality rules: plain counts, and n-gram perplexity within bands of each language.

The language model is an interpolated modified Kneser-Ney model over characters,
one for each language, counted by Spark over all documents:

1. each task counts the n-grams of the highest order in its texts, Spark adds up;
2. lower orders are continuation counts (how many different characters precede),
   each made from the order above it; discounts come from the counts of counts;
3. every n-gram gets its interpolated probability from its context's total and the
   probability of its suffix, and every context its weight for unseen characters;
4. the documents' own n-grams of the highest order are all in the model, so a
   document needs those only, under a 64-bit hash of language and n-gram. They stay
   with Spark, dealt into buckets by hash: each block of documents asks the buckets
   for its distinct n-grams, and is joined to the answers. No entry is left out, and
   no task holds more of the model than one bucket or what one block asks for.

A document is rejected by the base rules (too few words, or too many words in
repeated windows), or if its perplexity lies outside its language's band. Bands
are fitted on the language's labelled documents of good and of bad quality: the
bounds that separate them best and reject at most ``FALSE_REJECTS`` of the good.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from histflow.llm.common import discard, frugal, give_back, mix, shingle_hashes, ship, stage

ORDER = 5
WINDOW = 8
LEAST_WORDS = 20
#: Base rule: percent of words that may stand in repeated windows.
MOST_REPEATED = 30
#: Characters that are counted before a task's counts are merged.
COUNT_CHARS = 4 << 20
#: Different n-grams that a task holds before it passes them on.
HELD_GRAMS = 1 << 19
#: Characters that are hashed together, about.
SCORE_CHARS = 1 << 18
#: Bytes of text that ask for their n-grams together, and for which there is a bucket of the model.
BLOCK_BYTES = 16 << 20
BUCKET_BYTES = 8 << 20
#: The share of good labelled documents that a band may reject.
FALSE_REJECTS = 0.05
#: Log perplexities are counted in steps of this width.
STEP = 0.001
#: Where no bound separates, a band reaches so many deviations from the good documents' mean.
DEVIATIONS = 6.0
LEAST_DEVIATION = 0.02
#: Labelled documents of a language, good ones and bad ones, at least, for a band of its own.
LEAST_LABELLED = 30

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOLS = "#*$%&|<>"
_BLANKS = " \t\n\x0b\x0c\r"
_R = np.uint64(0x9E3779B97F4A7C15)


# ---- base counts ------------------------------------------------------------------
def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode("utf-8", "surrogatepass").split()  # at the six ASCII blanks
    lines = text.split("\n")
    duplicates = 0
    if len(set(lines)) < len(lines):
        for line, times in Counter(lines).items():
            if times > 1 and _WORD.search(line):
                duplicates += times - 1
    chars = len(text) - sum(map(text.count, _BLANKS))
    symbols = sum(map(text.count, _SYMBOLS))
    return len(words), chars, symbols, duplicates, repeated_words(words)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that stand in a window which is found twice or more."""
    n = len(words) - window + 1
    if n < 2 or len(set(words)) == len(words):
        return 0
    hashes = shingle_hashes(words, window)
    order = np.sort(hashes)
    again = order[1:][order[1:] == order[:-1]]
    if not len(again):
        return 0
    starts = np.flatnonzero(np.isin(hashes, again))
    marks = np.zeros(len(words) + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + window, -1)
    return int(np.count_nonzero(np.cumsum(marks)[:-1]))


# ---- characters --------------------------------------------------------------------
def characters(text: str | None) -> str:
    """What the model sees of a text: white space as one blank."""
    return b" ".join(text.encode("utf-8", "surrogatepass").split()).decode("utf-8", "surrogatepass") if text else ""


def count_grams(texts: list[str], order: int) -> dict[str, int]:
    """Counts of the n-grams of padded texts; an n-gram never holds two texts."""
    pad = " " * (order - 1)
    points = np.frombuffer((pad + pad.join(texts) + pad).encode("utf-32-le", "surrogatepass"), np.uint32)
    out: dict[str, int] = {}
    _count(points, order, out)
    return out


def _count(points: np.ndarray, order: int, out: dict[str, int]) -> None:
    n = len(points) - order + 1
    if n <= 0:
        return
    seen = np.zeros(0x110000, bool)
    seen[points] = True
    alphabet = np.flatnonzero(seen)
    bits = max(1, int(len(alphabet) - 1).bit_length())
    if bits * order > 63:  # halves of a text have fewer different characters
        half = n // 2
        _count(points[: half + order - 1], order, out)
        _count(points[half:], order, out)
        return
    code = np.zeros(0x110000, np.uint64)
    code[alphabet] = np.arange(len(alphabet), dtype=np.uint64)
    codes = code[points]
    packed = np.zeros(n, np.uint64)
    for k in range(order):
        packed = (packed << np.uint64(bits)) | codes[k : k + n]
    grams, counts = np.unique(packed, return_counts=True)
    mask = np.uint64((1 << bits) - 1)
    letters = np.empty((len(grams), order), np.uint32)
    for k in range(order):
        letters[:, k] = alphabet[((grams >> np.uint64(bits * (order - 1 - k))) & mask).astype(np.int64)]
    names = letters.tobytes().decode("utf-32-le", "surrogatepass")
    for i, c in enumerate(counts.tolist()):
        gram = names[i * order : (i + 1) * order]
        out[gram] = out.get(gram, 0) + c


def gram_counts(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, gram, c): counts of the highest order over all documents."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[str, dict[str, int]] = {}
        waiting: dict[str, list[str]] = {}
        held = 0

        def merge() -> None:
            for lang, texts in waiting.items():
                total = found.setdefault(lang, {})
                for g, c in count_grams(texts, order).items():
                    total[g] = total.get(g, 0) + c
            waiting.clear()

        def rows() -> Iterator[pd.DataFrame]:
            for lang, grams in found.items():
                yield pd.DataFrame({"lang": lang, "gram": list(grams), "c": np.fromiter(grams.values(), np.int64, len(grams))})
            found.clear()

        for pdf in batches:
            for lang, text in zip(pdf["lang"], pdf["text"]):
                t = characters(text)
                waiting.setdefault(lang, []).append(t)
                held += len(t)
                if held >= COUNT_CHARS:
                    merge()
                    held = 0
                    if sum(map(len, found.values())) > HELD_GRAMS:  # Spark adds up the rest
                        yield from rows()
        merge()
        yield from rows()

    return docs.select("lang", "text").mapInPandas(frugal(count), "lang string, gram string, c bigint").groupBy("lang", "gram").agg(F.sum("c").alias("c"))


# ---- the model -----------------------------------------------------------------------
def _with_discounts(level: DataFrame) -> DataFrame:
    """Each n-gram with ``d`` (its own discount) and its context's ``total`` and ``rest``."""
    # A row per language.
    n = [F.sum((F.col("c") == i).cast("double")) for i in (1, 2, 3, 4)]
    counts = level.groupBy("lang").agg(*[x.alias(f"n{i}") for i, x in enumerate(n, 1)])
    y = F.when((F.col("n1") > 0) & (F.col("n2") > 0), F.col("n1") / (F.col("n1") + 2 * F.col("n2"))).otherwise(F.lit(0.5))

    def discount(i: int):
        here, above = F.col(f"n{i}"), F.col(f"n{i + 1}")
        d = F.when(here > 0, i - (i + 1) * y * above / here).otherwise(F.lit(i / 2))
        return F.greatest(F.lit(0.05), F.least(d, F.lit(i - 0.05))).alias(f"d{i}")

    discounts = counts.select("lang", *[discount(i) for i in (1, 2, 3)])
    own = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
    # Discounts are a few numbers per language; the model's rows stay where they are.
    rows = level.join(F.broadcast(discounts), "lang").withColumn("d", own).withColumn("context", F.expr("left(gram, length(gram) - 1)"))
    contexts = rows.groupBy("lang", "context").agg(F.sum("c").alias("total"), F.sum("d").alias("rest"))
    return rows.join(contexts, ["lang", "context"]).select("lang", "gram", "context", "c", "d", "total", (F.col("rest") / F.col("total")).alias("gamma"))


def _levels(counts: DataFrame, order: int, keep: bool = True) -> tuple[list[DataFrame], DataFrame]:
    """(lang, gram, context, c, gamma, p) of each order, lowest first, and (lang, lower) of the unknown character.

    The highest order is not staged. Unless ``keep``, the lower orders are only for making it, and
    each one's rows are deleted when the next order is staged.
    """
    levels = [stage(counts, "grams")]
    for _ in range(order - 1):
        below = levels[0].select("lang", F.expr("substr(gram, 2)").alias("gram")).groupBy("lang", "gram").agg(F.count("*").alias("c"))
        levels.insert(0, stage(below, "grams"))
    letters = levels[0].groupBy("lang").agg((1 / (F.count("*") + 1)).alias("lower"))
    out: list[DataFrame] = []
    for k, level in enumerate(levels, 1):
        rows = _with_discounts(level)
        if k == 1:
            rows = rows.join(letters, "lang")
        else:
            rows = rows.withColumn("suffix", F.expr("substr(gram, 2)")).join(
                out[-1].select("lang", F.col("gram").alias("suffix"), F.col("p").alias("lower")), ["lang", "suffix"]
            )
        rows = rows.select("lang", "gram", "context", "c", "gamma", ((F.col("c") - F.col("d")) / F.col("total") + F.col("gamma") * F.col("lower")).alias("p"))
        out.append(stage(rows, "model") if k < order else rows)
        if not keep and 1 < k < order:  # the letters are made of the lowest counts
            discard(out[k - 2], level)
    return out, letters


def highest_order(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, gram, p): the interpolated probabilities of the n-grams of the highest order."""
    return _levels(counts, order, keep=False)[0][-1].select("lang", "gram", "p")


def kneser_ney(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, gram, weight, p, gamma): probabilities of all orders, and contexts' weights.

    ``p`` is the probability of the last character behind the others, ``gamma``
    what the n-gram, as a context, leaves for the order below; 1 where it is none.
    """
    rows, letters = _levels(counts, order)
    out = stage(reduce(DataFrame.unionByName, rows), "model")
    weights = out.select("lang", F.col("context").alias("gram"), F.col("gamma").alias("after")).distinct()
    # The empty context leaves its weight to the unknown character.
    entries = out.select("lang", "gram", "c", "p").join(weights, ["lang", "gram"], "left")
    unknown = weights.where("gram = ''").join(letters, "lang").select("lang", "gram", F.lit(0).cast("long").alias("c"), (F.col("after") * F.col("lower")).alias("p"), F.lit(1.0).alias("after"))
    return entries.unionByName(unknown).select("lang", "gram", F.col("c").alias("weight"), "p", F.coalesce("after", F.lit(1.0)).alias("gamma"))


def _seed(lang: str) -> np.uint64:
    h = 1469598103934665603
    for b in lang.encode():
        h = (h ^ b) * 1099511628211 % 2**64
    return np.uint64(h)


def gram_hashes(points: np.ndarray, k: int, lang: str) -> np.ndarray:
    """The hash of the ``k`` characters that end at each place from ``k - 1`` on."""
    n = max(0, len(points) - k + 1)
    h = np.full(n, np.uint64(k), np.uint64)
    for j in range(k):
        h = h * _R + (points[j : j + n].astype(np.uint64) + np.uint64(1))
    return mix(h ^ _seed(lang))


class Model:
    """The model's arrays, and an index of their hashes."""

    def __init__(self, keys: np.ndarray, logp: np.ndarray, logw: np.ndarray | None = None, order: int = ORDER):
        self.keys, self.logp, self.logw, self.order = keys, logp, logw, order
        # Slots for the hashes' leading bits; what finds its slot taken goes to the next level.
        self.levels: list[tuple[np.uint64, np.ndarray]] = []
        left, h = np.arange(len(keys), dtype=np.int32), keys
        while len(left):
            shift = np.uint64(64 - (2 * len(left)).bit_length())
            slots = np.full(1 << int(64 - shift), -1, np.int32)
            slots[h >> shift] = left
            self.levels.append((shift, slots))
            out = slots[h >> shift] != left
            out &= keys[slots[h >> shift]] != keys[left]
            left, h = left[out], mix(h[out] + _R)

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Places of the hashes in the arrays; -1 where there is none."""
        out = np.full(len(h), -1, np.int32)
        todo, key, mixed = np.arange(len(h)), h, h
        for shift, slots in self.levels:
            place = slots[mixed >> shift]
            hit = (place >= 0) & (self.keys[place] == key)
            out[todo[hit]] = place[hit]
            todo, key, mixed = todo[~hit], key[~hit], mix(mixed[~hit] + _R)
            if not len(todo):
                break
        return out

    def log_probabilities(self, texts: list[str], lang: str) -> np.ndarray:
        """For each text the sum of the log probabilities of its characters and of a blank at its end."""
        if not texts:
            return np.empty(0)
        if not len(self.keys):
            return np.zeros(len(texts))
        pad = " " * (self.order - 1)
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        points = np.frombuffer("".join([f"{pad}{t} " for t in texts]).encode("utf-32-le", "surrogatepass"), np.uint32)
        # The places of characters: each text stands behind its own padding.
        firsts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        ends = np.arange(sizes.sum()) + np.repeat(np.arange(1, len(texts) + 1) * (self.order - 1), sizes)
        out = np.zeros(len(ends))
        todo = np.arange(len(ends))
        for k in range(self.order, 0, -1):
            if k == self.order:
                h = gram_hashes(points, k, lang)[ends - k + 1]
            else:
                h = _row_hashes(points[(ends[todo] - k + 1)[:, None] + np.arange(k)], lang)
            place = self._find(h)
            hit = place >= 0
            out[todo[hit]] += self.logp[place[hit]]
            todo = todo[~hit]
            if not len(todo):
                break
            if k > 1:
                place = self._find(_row_hashes(points[(ends[todo] - k + 1)[:, None] + np.arange(k - 1)], lang))
                out[todo] += np.where(place >= 0, self.logw[place], 0)
        if len(todo):
            place = self._find(_row_hashes(np.empty((1, 0), np.uint32), lang))
            out[todo] += self.logp[place[0]] if place[0] >= 0 else np.log(1e-6)
        return np.add.reduceat(out, firsts)


def _row_hashes(rows: np.ndarray, lang: str) -> np.ndarray:
    h = np.full(len(rows), np.uint64(rows.shape[1]), np.uint64)
    for j in range(rows.shape[1]):
        h = h * _R + (rows[:, j].astype(np.uint64) + np.uint64(1))
    return mix(h ^ _seed(lang))


def _keyed(entries: DataFrame, values: dict[str, str]) -> DataFrame:
    """``entries`` as (key, ...): the hash of language and n-gram, and logarithms of columns."""

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            h = np.zeros(len(pdf), np.uint64)
            length = pdf["gram"].str.len()
            for (lang, k), at in pdf.groupby(["lang", length]).indices.items():
                rows = np.frombuffer("".join(pdf["gram"].iloc[at]).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(at), k)
                h[at] = _row_hashes(rows, lang)
            yield pd.DataFrame({"key": h.view(np.int64)} | {new: np.log(pdf[old]).astype("float32") for old, new in values.items()})

    return entries.mapInPandas(keyed, ", ".join(["key bigint", *[f"{new} float" for new in values.values()]]))


def packed_model(entries: DataFrame, order: int = ORDER) -> Model:
    """The whole model in the driver; for a model that one process can hold."""
    table = _keyed(entries, {"p": "logp", "gamma": "logw"}).toArrow()
    return Model(table["key"].to_numpy().view(np.uint64).copy(), table["logp"].to_numpy().copy(), table["logw"].to_numpy().copy(), order)


# ---- on documents --------------------------------------------------------------------
def language_model(docs: DataFrame, lang: str = "lang", text: str = "text", order: int = ORDER) -> Model:
    """The model of all of ``docs`` in the driver; NULL languages are one language of their own."""
    ship(docs.sparkSession)
    return packed_model(kneser_ney(gram_counts(_narrow(docs, lang, text), order), order), order)


def _narrow(docs: DataFrame, lang: str, text: str) -> DataFrame:
    return docs.select(F.coalesce(docs[lang].cast("string"), F.lit("")).alias("lang"), docs[text].cast("string").alias("text"))


def _windows(texts: list[str], lang: str, order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For some texts at a time, the texts' numbers and the hashes of their n-grams.

    An n-gram ends at each character and at a blank behind the last; a text of any
    length is taken in pieces that overlap, and an n-gram never holds two texts.
    """
    waiting: list[tuple[int, str]] = []

    def hashed() -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(s) - order + 1 for _, s in waiting], np.int64)
        points = np.frombuffer("".join([s for _, s in waiting]).encode("utf-32-le", "surrogatepass"), np.uint32)
        starts = np.arange(sizes.sum()) + np.repeat(np.arange(len(sizes)) * (order - 1), sizes)
        return np.repeat(np.array([j for j, _ in waiting], np.int64), sizes), gram_hashes(points, order, lang)[starts]

    pad, held = " " * (order - 1), 0
    for j, t in enumerate(texts):
        if not t:
            continue
        t = f"{pad}{t} "
        for a in range(0, len(t) - order + 1, SCORE_CHARS):
            waiting.append((j, t[a : a + SCORE_CHARS + order - 1]))
            held += len(waiting[-1][1])
            if held >= SCORE_CHARS:
                yield hashed()
                waiting, held = [], 0
    if waiting:
        yield hashed()


def _by_language(langs: list[str]) -> list[tuple[str, np.ndarray]]:
    return list(pd.Series(langs, dtype=object).groupby(langs).indices.items()) if langs else []


def _pack(x) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=5).compress(pickle.dumps(x, protocol=5))


def _unpack(x: bytes):
    import zstandard

    return pickle.loads(zstandard.ZstdDecompressor().decompress(x))


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, pd.DataFrame]]:
    """The rows of a task in blocks, each with a name."""
    from pyspark import TaskContext

    base, n, held, parts = TaskContext.get().partitionId() << 32, 0, 0, []
    for pdf in batches:
        sizes = np.cumsum(pdf["size"].to_numpy())
        a = 0
        while a < len(pdf):
            b = min(len(pdf), int(np.searchsorted(sizes, (sizes[a - 1] if a else 0) + BLOCK_BYTES - held)) + 1)
            parts.append(pdf.iloc[a:b])
            held += int(sizes[b - 1] - (sizes[a - 1] if a else 0))
            a = b
            if held >= BLOCK_BYTES:
                yield base + n, pd.concat(parts, ignore_index=True)
                n, held, parts = n + 1, 0, []
    if parts:
        yield base + n, pd.concat(parts, ignore_index=True)


def measure(docs: DataFrame, lang: str = "lang", text: str = "text", doc_id: str = "doc_id", order: int = ORDER) -> DataFrame:
    """One row per document: doc_id, h, lang, the base counts, log_ppl (NULL without a character).

    ``h`` is the text's hash, which names the row together with its id. The model
    is that of ``docs`` themselves, which are read three times.
    """
    ship(docs.sparkSession)
    entries = _keyed(highest_order(gram_counts(_narrow(docs, lang, text), order), order), {"p": "logp"})
    body = docs[text].cast("string")
    rows = docs.select(
        docs[doc_id].cast("string").alias("doc_id"),
        F.xxhash64(body).alias("h"),
        F.coalesce(docs[lang].cast("string"), F.lit("")).alias("lang"),
        body.alias("text"),
        F.coalesce(F.octet_length(body), F.lit(0)).alias("size"),
    )
    buckets = (rows.agg(F.sum("size")).first()[0] or 0) // BUCKET_BYTES + 1
    borders = np.array([i * 2**64 // buckets for i in range(1, buckets)], np.uint64)

    def distinct_keys(seen: list[str], langs: list[str]) -> np.ndarray:
        """The sorted hashes of a block's n-grams."""
        found = [pd.unique(h) for language, at in _by_language(langs) for _, h in _windows([seen[i] for i in at], language, order)]
        return np.sort(pd.unique(np.concatenate(found))) if found else np.empty(0, np.uint64)

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block, pdf in _cut(batches):
            keys = distinct_keys([characters(t) for t in pdf["text"]], pdf["lang"].tolist())
            if len(keys):
                parts = np.split(keys, np.searchsorted(keys, borders))
                some = [b for b, part in enumerate(parts) if len(part)]
                yield pd.DataFrame({"bucket": some, "block": block, "asked": [parts[b].tobytes() for b in some]})

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf["bucket"] = np.searchsorted(borders, pdf["key"].to_numpy().view(np.uint64), side="right")
            yield pdf[["bucket", "key", "logp"]]

    def answer(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        keys = left["key"].to_numpy().view(np.uint64)
        rank = np.argsort(keys)
        keys, logp = keys[rank], left["logp"].to_numpy()[rank]
        found = []
        for asked in right["asked"]:
            wanted = np.frombuffer(asked, np.uint64)
            place = np.searchsorted(keys, wanted)
            if len(wanted) and (not len(keys) or (keys[np.minimum(place, len(keys) - 1)] != wanted).any()):
                raise RuntimeError("an n-gram of a document is not in the model: the documents changed between two reads")
            found.append(logp[place].tobytes())
        return pd.DataFrame({"block": right["block"], "bucket": right["bucket"], "found": found})

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block, pdf in _cut(batches):
            counts = np.array([base_counts(t) for t in pdf["text"]], np.int64).reshape(-1, 5)
            packed = _pack((pdf["doc_id"].tolist(), pdf["h"].to_numpy(), pdf["lang"].tolist(), counts, [characters(t) for t in pdf["text"]]))
            yield pd.DataFrame({"block": [block], "rows": [packed]})

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        # Buckets in order are the block's keys in order: they need not come back with the answers.
        found = [np.frombuffer(x, np.float32) for x in right.sort_values("bucket")["found"]]
        logp = np.concatenate([np.empty(0, np.float32), *found])
        out = []
        for rows in left["rows"]:
            ids, h, langs, counts, seen = _unpack(rows)
            keys = distinct_keys(seen, langs)
            if len(keys) != len(logp):
                raise RuntimeError("a block of documents lacks an answer: the rows came in another order")
            model = Model(keys, logp, order=order)
            values = np.full(len(ids), np.nan)
            for language, at in _by_language(langs):
                sums = np.zeros(len(at))
                for j, hashes in _windows([seen[i] for i in at], language, order):
                    place = model._find(hashes)
                    if (place < 0).any():
                        raise RuntimeError("a block of documents lacks an answer: the rows came in another order")
                    sums += np.bincount(j, model.logp[place], len(at))
                sizes = np.array([len(seen[i]) for i in at])
                values[at] = np.where(sizes > 0, -sums / (sizes + 1), np.nan)
            out.append(
                pd.DataFrame(
                    {"doc_id": pd.Series(ids, dtype=object), "h": h, "lang": langs}
                    | {n: counts[:, i] for i, n in enumerate(("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))}
                    | {"log_ppl": pd.Series(values, dtype="float64").astype(object).where(~np.isnan(values), None)}
                )
            )
        give_back()
        return pd.concat(out, ignore_index=True)

    answers = (
        entries.mapInPandas(deal, "bucket bigint, key bigint, logp float")
        .groupBy("bucket")
        .cogroup(rows.mapInPandas(frugal(ask), "bucket bigint, block bigint, asked binary").groupBy("bucket"))
        .applyInPandas(answer, "block bigint, bucket bigint, found binary")
    )
    return (
        rows.mapInPandas(frugal(pack), "block bigint, rows binary")
        .groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInPandas(
            score,
            "doc_id string, h bigint, lang string, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, log_ppl double",
        )
    )


def _base_failed():
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def fit_band(good: np.ndarray, bad: np.ndarray) -> tuple[int, int]:
    """Of steps in order, the first that is kept and the first behind the kept ones.

    ``good`` and ``bad`` are the documents in each step. The share of bad documents
    outside, less that of good ones, is the largest that rejects at most
    ``FALSE_REJECTS`` of the good; of equal bands it is the widest.
    """
    n_good, n_bad = good.sum(), bad.sum()
    if not n_good or not n_bad:
        return 0, len(good)
    below_good, below_bad = np.concatenate([[0], np.cumsum(good)]), np.concatenate([[0], np.cumsum(bad)])
    above_good, above_bad = n_good - below_good, n_bad - below_bad
    allowed = int(FALSE_REJECTS * n_good)
    gain_low, gain_high = below_bad / n_bad - below_good / n_good, above_bad / n_bad - above_good / n_good
    # The best upper bound at or behind each step.
    best, at = np.empty(len(gain_high)), np.empty(len(gain_high), np.int64)
    for i in range(len(gain_high) - 1, -1, -1):
        new = i + 1 == len(gain_high) or gain_high[i] > best[i + 1]
        best[i], at[i] = (gain_high[i], i) if new else (best[i + 1], at[i + 1])
    lows = np.flatnonzero(below_good <= allowed)
    firsts = np.searchsorted(-above_good, -(allowed - below_good[lows]))
    low = int(np.argmax(gain_low[lows] + best[firsts]))
    return int(lows[low]), int(at[firsts[low]])


def _fit(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("step")
    good, bad = pdf["good"].to_numpy(), pdf["bad"].to_numpy()
    steps, n = pdf["step"].to_numpy(), max(1, good.sum())
    mean = pdf["s1"].sum() / n
    dev = max(LEAST_DEVIATION, float(np.sqrt(max(0.0, pdf["s2"].sum() / n - mean**2))))
    a, b = fit_band(good, bad)
    return pd.DataFrame(
        {
            "lang": pdf["lang"].iloc[:1],
            "pooled": pdf["pooled"].iloc[:1],
            "n_good": good.sum(),
            "n_bad": bad.sum(),
            "low": steps[a] * STEP if a else mean - DEVIATIONS * dev,
            "high": steps[b] * STEP if b < len(steps) else mean + DEVIATIONS * dev,
        }
    )


def bands(measured: DataFrame, labels: DataFrame) -> DataFrame:
    """(lang, low, high): the band of each language's log perplexity, without ``high`` itself.

    Fitted by :func:`fit_band` on all labelled documents that pass the base rules; a
    document labelled both ways is good. A side on which no bound separates is
    ``DEVIATIONS`` deviations from the good documents' mean. A language with few good
    or bad labelled documents gets the band fitted on all languages' distances from
    their own means, around its own mean; without good labelled documents nothing is rejected.
    """
    ship(measured.sparkSession)
    known = labels.where("quality IS NOT NULL").groupBy(F.col("doc_id").cast("string").alias("doc_id")).agg((F.max("quality") == 1).alias("good"))
    passed = measured.where(F.col("log_ppl").isNotNull() & ~_base_failed())
    means = passed.groupBy("lang").agg(F.avg("log_ppl").alias("mean"))  # a row per language
    labelled = passed.join(known, "doc_id").join(means, "lang")
    each = labelled.select("good", F.expr("inline(array(struct(lang, false AS pooled, log_ppl AS x), struct('' AS lang, true AS pooled, log_ppl - mean AS x)))"))
    good = F.col("good").cast("int")
    steps = each.groupBy("lang", "pooled", F.floor(F.col("x") / STEP).alias("step")).agg(
        F.sum(good).alias("good"), F.sum(1 - good).alias("bad"), F.sum(good * F.col("x")).alias("s1"), F.sum(good * F.col("x") * F.col("x")).alias("s2")
    )
    # The steps of one language, or of all, are few.
    fitted = stage(steps.groupBy("lang", "pooled").applyInPandas(_fit, "lang string, pooled boolean, n_good bigint, n_bad bigint, low double, high double"), "bands")
    whole = fitted.where("pooled AND n_good > 0").select(F.col("low").alias("all_low"), F.col("high").alias("all_high"), F.col("n_bad").alias("all_bad"))
    langs = measured.select("lang").distinct().join(means, "lang", "left").join(fitted.where("NOT pooled").drop("pooled"), "lang", "left")
    enough = (F.col("n_good") >= LEAST_LABELLED) & ((F.col("n_bad") >= LEAST_LABELLED) | (F.col("all_bad") < LEAST_LABELLED))
    own = F.coalesce(enough, F.lit(False))
    return langs.join(F.broadcast(whole), how="left").select(
        "lang",
        F.coalesce(F.when(own, F.col("low")).otherwise(F.col("mean") + F.col("all_low")), F.lit(float("-inf"))).alias("low"),
        F.coalesce(F.when(own, F.col("high")).otherwise(F.col("mean") + F.col("all_high")), F.lit(float("inf"))).alias("high"),
    )


def judge(docs: DataFrame, labels: DataFrame, lang: str = "lang", text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, h, the base counts, perplexity, base_failed, kept.

    NULL, empty and blank texts have no words and fail the base rule. Repeated
    rows and repeated or NULL ids are documents of their own. An empty table gives
    no rows; other columns are not read.
    """
    measured = stage(measure(docs, lang, text, doc_id), "measured")
    limits = bands(measured, labels)  # a row per language
    failed = _base_failed()
    inside = (F.col("log_ppl") >= F.col("low")) & (F.col("log_ppl") < F.col("high"))
    return measured.join(limits, "lang").select(
        F.col("doc_id").cast(docs.schema[doc_id].dataType).alias("doc_id"),
        "h",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        F.exp("log_ppl").alias("perplexity"),
        failed.alias("base_failed"),
        (~failed & F.coalesce(inside, F.lit(False))).alias("kept"),
    )


def kept_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    gone = judge(docs, labels).where("NOT kept").select(F.col("doc_id").alias("bad_id"), F.col("h").alias("bad_h")).distinct()
    return docs.join(gone, docs["doc_id"].eqNullSafe(F.col("bad_id")) & (F.xxhash64(docs["text"]) == F.col("bad_h")), "left_anti")


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return judge(docs, labels).drop("h")
