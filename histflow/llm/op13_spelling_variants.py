"""Spelling variants by blocked Gram matrices of letter counts.

An edit of one character changes the letter counts little: a replaced character
takes one from a letter and gives it to another (squared distance 2), an inserted or
deleted one changes one letter by one (squared distance 1, next length). So only words
of one length at squared distance 2, and words of adjacent lengths at squared distance 1, can be
one edit apart. All squared distances of two blocks of words come from one matrix
product: ``|x - y|^2 = |x|^2 + |y|^2 - 2 x.y``. The pairs that remain are verified on
the words themselves.

Blocks are formed by letter counts too. The letters are dealt to ``CLASSES`` classes;
a word's signature is its count in each class (their sum is its length). What holds for
letters holds for classes: an edit leaves the signature as it is, moves one count from a
class to another, or adds one to a class. A signature therefore meets only itself and its
1 + CLASSES * CLASSES neighbours (one direction each), and a product of blocks is never
asked for where it can hold no pair. A signature of many words is cut into blocks of about
``BLOCK`` words, so that a task holds two blocks at a time whatever the vocabulary.

Words are counted in one pass before the first shuffle (partial counts per task), so a
very common word is no hot key. Everything after that grows with the vocabulary, not the
texts. Words are Latin-1, one byte per character, which is what the matrices read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from histflow.llm.common import ship, stage

CLASSES = 5
BLOCK = 1024
MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5
#: One in so many runs of a document is damaged.
DAMAGE = 199

RUN = "[A-Za-zÀ-ÿ]{%d,}"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Letters as columns of the count matrices: a-z, then U+00C0 to U+00FF.
_COLUMN = np.full(256, -1, np.int64)
_COLUMN[97:123] = np.arange(26)
_COLUMN[0xC0:0x100] = 26 + np.arange(64)
LETTERS = 90

NEAR = "word string, n_near long, near_n long, near string"


# ---- words -------------------------------------------------------------------
def damaged(run: Column, doc_id: Column) -> Column:
    """The run, without one of its characters where :data:`DAMAGE` divides its checksum."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = F.pmod(h, F.length(run)).cast("int")
    cut = F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))
    return F.when(F.pmod(h, F.lit(DAMAGE)) == 0, cut).otherwise(run)


def vocabulary(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n: the damaged runs of all texts that are long and frequent enough."""
    # A shorter run cannot become long enough, as characters are only taken away.
    runs = F.regexp_extract_all(docs[text].cast("string"), F.lit(RUN % min_length), F.lit(0))
    words = docs.select(docs[doc_id].alias("doc_id"), F.explode(runs).alias("run"))
    words = words.select(damaged(F.translate("run", UPPER, LOWER), F.col("doc_id")).alias("word"))
    counts = words.where(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= min_count)


# ---- blocks ------------------------------------------------------------------
def _class_letters() -> list[str]:
    """Each class's letters, dealt out in turn."""
    letters = LOWER + "".join(map(chr, range(0xC0, 0x100)))
    return [letters[i::CLASSES] for i in range(CLASSES)]


def signature(word: Column) -> Column:
    """The word's number of letters in each class."""
    return F.array(*[(F.length(word) - F.length(F.translate(word, own, ""))).cast("short") for own in _class_letters()])


def neighbours(sig: Column) -> Column:
    """The signatures that a block meets: itself, one letter moved, one letter more.

    Of two signatures that differ by a moved letter, the one with more letters in the
    earlier class meets the other; the shorter word's block meets the longer one's.
    """
    moves = [[0] * CLASSES]
    for i in range(CLASSES):
        moves.append([int(k == i) for k in range(CLASSES)])
        for j in range(i + 1, CLASSES):
            moves.append([int(k == j) - int(k == i) for k in range(CLASSES)])
    met = F.array(*[F.array(*[(F.get(sig, k) + m[k]).cast("short") for k in range(CLASSES)]) for m in moves])
    return F.filter(met, lambda s: F.array_min(s) >= 0)


def blocks(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """sig, part, size, letters, ns: a row for each block of words of one signature.

    ``letters`` are the block's words end to end, in order; ``ns`` their counts.
    """
    signed = words.select(signature(F.col("word")).alias("sig"), "word", "n")
    # A signature's words are dealt to so many parts that a part has about ``block`` words.
    sizes = signed.groupBy("sig").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("parts"))
    dealt = signed.join(sizes, "sig").withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    packed = dealt.groupBy("sig", "part").agg(F.sort_array(F.collect_list(F.struct("word", "n"))).alias("words"))
    return packed.select(
        "sig",
        "part",
        F.size("words").alias("size"),
        F.encode(F.array_join("words.word", ""), "ISO-8859-1").alias("letters"),
        F.col("words.n").alias("ns"),
    )


def block_pairs(packed: DataFrame) -> DataFrame:
    """Every pair of blocks that can hold words one edit apart, once."""
    left = packed.select("sig", "part", "size", "letters", "ns", F.explode(neighbours(F.col("sig"))).alias("met"))
    right = packed.select(
        F.col("sig").alias("met"), F.col("part").alias("part_b"), F.col("size").alias("size_b"), F.col("letters").alias("letters_b"), F.col("ns").alias("ns_b")
    )
    both = left.join(right, "met").where((F.col("sig") != F.col("met")) | (F.col("part") <= F.col("part_b")))
    own = (F.col("sig") == F.col("met")) & (F.col("part") == F.col("part_b"))
    return both.select("size", "letters", "ns", "size_b", "letters_b", "ns_b", own.alias("own"))


# ---- matrices ----------------------------------------------------------------
def letter_counts(codes: np.ndarray) -> np.ndarray:
    """A row of letter counts for each row of character codes."""
    n, length = codes.shape
    flat = np.arange(n)[:, None] * LETTERS + _COLUMN[codes]
    return np.bincount(flat.ravel(), minlength=n * LETTERS).reshape(n, LETTERS).astype(np.float32)


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the rows of ``a`` and ``b`` differ by one replaced or one inserted character."""
    length = a.shape[1]
    if length == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    front = np.cumprod(a == b[:, :length], axis=1, dtype=np.uint8).sum(axis=1)
    back = np.cumprod((a == b[:, 1:])[:, ::-1], axis=1, dtype=np.uint8).sum(axis=1)
    return front + back >= length


def near_pairs(a: np.ndarray, b: np.ndarray, own: bool, rows: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """The places in two blocks of words (codes) that are one edit apart; of one block with itself, each pair once."""
    wanted = 2 if a.shape[1] == b.shape[1] else 1
    right = letter_counts(b)
    right_norm = np.einsum("ij,ij->i", right, right)
    found_a, found_b = [], []
    for start in range(0, len(a), rows):
        left = letter_counts(a[start : start + rows])
        gram = left @ right.T
        # |x|^2 + |y|^2 - 2 x.y; small whole numbers are exact in single precision
        gram *= -2
        gram += np.einsum("ij,ij->i", left, left)[:, None]
        gram += right_norm
        i, j = np.nonzero(gram == wanted)
        i += start
        if own:
            i, j = i[i < j], j[i < j]
        for piece in range(0, len(i), 1 << 18):
            x, y = i[piece : piece + (1 << 18)], j[piece : piece + (1 << 18)]
            same = one_edit(a[x], b[y])
            found_a.append(x[same])
            found_b.append(y[same])
    empty = np.empty(0, np.int64)
    return np.concatenate([empty, *found_a]), np.concatenate([empty, *found_b])


def _best(at: np.ndarray, other: np.ndarray, names: list[str], ns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """For each place: its number of partners, and the largest count and least word among them."""
    order = np.lexsort((other, -ns[other], at))  # a block's words are in order, so the least place is the least word
    at, other = at[order], other[order]
    places, first, times = np.unique(at, return_index=True, return_counts=True)
    best = other[first]
    return places, times, ns[best], [names[k] for k in best]


def _near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for row in batch.itertuples(index=False):
            a = np.frombuffer(row.letters, np.uint8).reshape(row.size, -1)
            b = a if row.own else np.frombuffer(row.letters_b, np.uint8).reshape(row.size_b, -1)
            i, j = near_pairs(a, b, row.own)
            if not len(i):
                continue
            words_a, words_b = ([bytes(x).decode("latin-1") for x in m] for m in (a, b))
            ns_a, ns_b = np.asarray(row.ns, np.int64), np.asarray(row.ns_b, np.int64)
            if row.own:
                sides = [(np.concatenate([i, j]), np.concatenate([j, i]), words_a, words_a, ns_a)]
            else:
                sides = [(i, j, words_a, words_b, ns_b), (j, i, words_b, words_a, ns_a)]
            for at, other, own_names, names, ns in sides:
                places, times, best_n, best = _best(at, other, names, ns)
                out.append(pd.DataFrame({"word": [own_names[p] for p in places], "n_near": times, "near_n": best_n, "near": best}))
        yield pd.concat(out) if out else pd.DataFrame({"word": [], "n_near": [], "near_n": [], "near": []})


# ---- forms -------------------------------------------------------------------
def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """word, n_near, near_n, near: of every word with near words, their number and the most frequent one."""
    ship(words.sparkSession)
    found = block_pairs(blocks(words, block)).mapInPandas(_near, NEAR)
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("near")))
    total = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return total.select("word", "n_near", (-F.col("best.n")).alias("near_n"), F.col("best.near").alias("near"))


def roots(links: DataFrame) -> DataFrame:
    """word, root for ``links`` (word, form): the end of each word's chain of forms.

    Chains are halved in each round: a word's root so far is replaced by that one's. A
    form is at least :data:`RATIO` times as frequent as its word, so there are no rings
    and a chain is at most the logarithm of the largest count long.
    """
    reached = stage(links.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        on = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = reached.join(on, "root", "left")
        after = stage(moved.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("went")), "variant-roots")
        reached = after.select("word", "root")
        if after.where("went").limit(1).count() == 0:
            return reached


def spelling_variants(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", ratio: int = RATIO, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, block: int = BLOCK
) -> DataFrame:
    """A row for each frequent word: word, form, root, n, n_near, form_n.

    Words are maximal runs of Latin letters, A-Z in lower case, after the damage; at
    least ``min_length`` characters and ``min_count`` occurrences in all texts. Near words
    are one inserted, deleted or replaced character apart. ``form`` is the near word with
    the largest count (ties: the least word) where that is at least ``ratio`` times the
    word's own, else NULL, as ``form_n``. ``root`` ends the chain of forms.

    NULL and empty texts have no words; a NULL id is read as an empty one in the damage's
    key. Repeated rows count again. An empty table gives no rows; other columns are not
    read.
    """
    words = stage(vocabulary(docs, text, doc_id, min_length, min_count), "variant-words")
    near = words.join(near_words(words, block), "word", "left")
    has = F.col("near_n") >= ratio * F.col("n")
    formed = stage(
        near.select(
            "word",
            F.when(has, F.col("near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(has, F.col("near_n")).alias("form_n"),
        ),
        "variant-forms",
    )
    ends = roots(formed.where("form IS NOT NULL"))
    return formed.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling_variants(spark, sf_dir: str) -> DataFrame:
    return spelling_variants(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
