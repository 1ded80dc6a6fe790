"""License scan: fuzzy search for short notices.

A notice of ``n`` characters may differ by ``k`` edits. Cut into ``k + 1`` pieces,
any such place holds one piece unchanged (pigeonhole), so an automaton over all
pieces of all notices gives the candidates, and bounded-error matching of the
``regex`` library inside the candidate's surroundings decides and gives the span
and the number of edits. Both run on the words of the text, in lower case, joined
by single blanks.

Each search stays inside one candidate's surroundings, which are hardly longer than the
notice; of matches of a notice that overlap, those with the fewest edits stay, and what is left
of a loser's surroundings is searched again. So time grows with the text, however many notices it has.
"""

from __future__ import annotations

import heapq
import re
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from histflow.llm.common import lower_words, ship

# The phrases whose places are counted, and the notices searched for.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "released under the mit license": "mit",
    "licensed under the apache license version 2 0": "apache",
    "you may not use this file except in compliance with the license": "apache",
    "licensed under the gnu general public license version": "gpl",
    "you can redistribute it and or modify it under the terms of the gnu": "gpl",
    "gnu lesser general public license": "lgpl",
    "mozilla public license": "mpl",
    "redistribution and use in source and binary forms": "bsd",
    "licensed under cc by nc": "cc",
    "licensed under a creative commons attribution": "cc",
    "released into the public domain": "public-domain",
    "all rights reserved": "proprietary",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "gnu affero general public license": "agpl",
    "eclipse public license": "epl",
    "this software is provided as is without any express or implied warranty": "zlib",
    "boost software license version 1 0": "bsl",
    "this is free and unencumbered software released into the public domain": "unlicense",
}
#: One edit for so many characters of a notice.
CHARS_PER_EDIT = 10


def _pieces(notice: str, edits: int) -> list[tuple[int, str]]:
    """The notice cut into ``edits + 1`` pieces of about equal length, with their places."""
    cuts = [len(notice) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


@lru_cache(maxsize=2)
def _search(notices: tuple[tuple[str, str], ...], per_edit: int):
    import ahocorasick

    automaton, seeds, patterns = ahocorasick.Automaton(), {}, []
    for number, (notice, label) in enumerate(notices):
        edits = len(notice) // per_edit
        patterns.append(Notice(notice, label, edits))
        for at, piece in _pieces(notice, edits):
            seeds.setdefault(piece, []).append((number, at))
    for piece, places in seeds.items():
        automaton.add_word(piece, (len(piece), places))
    automaton.make_automaton()
    return automaton, patterns


class Notice:
    """A notice to search for in short stretches of text."""

    def __init__(self, notice: str, label: str, edits: int):
        import regex

        self.notice, self.label, self.edits = notice, label, edits
        self.pattern = regex.compile(f"(?b)(?:{regex.escape(notice, literal_spaces=True)}){{e<={edits}}}")
        self.places = {c: sum(1 << i for i, x in enumerate(notice) if x == c) for c in set(notice)}
        self.best = lru_cache(maxsize=20_000)(self._best)

    def near(self, text: str) -> bool:
        """Whether some stretch of the text is within the edits (bit-parallel edit distance)."""
        size = len(self.notice)
        whole, top = (1 << size) - 1, 1 << (size - 1)
        up, down, score = whole, 0, size
        for c in text:
            same = self.places.get(c, 0)
            diagonal = (((same & up) + up) ^ up) | same | down
            right = down | (whole & ~(diagonal | up))
            left = diagonal & up
            score += ((right & top) > 0) - ((left & top) > 0)
            if score <= self.edits:
                return True
            right, left = (right << 1) & whole, (left << 1) & whole
            up, down = left | (whole & ~(diagonal | right)), right & diagonal
        return False

    def _best(self, text: str) -> tuple[int, int, int] | None:
        """(edits, begin, end) of the best match in a short text."""
        m = self.pattern.search(text) if len(text) >= len(self.notice) - self.edits and self.near(text) else None
        return (sum(m.fuzzy_counts), m.start(), m.end()) if m else None


def _resolved(sought: Notice, joined: str, windows: list[tuple[int, int]]) -> Iterator[tuple[int, int, int]]:
    """(begin, end, edits) of the matches in ``windows`` that do not overlap, the best ones first.

    Where a match overlaps a better one, the free parts of its window are searched again, as
    are those beside a match that stays.
    """
    found: list[tuple[int, int, int, int, int]] = []
    taken: list[tuple[int, int]] = []

    def look(a: int, b: int) -> None:
        best = sought.best(joined[a:b]) if a < b else None
        if best:
            heapq.heappush(found, (best[0], a + best[1], a + best[2], a, b))

    for a, b in windows:
        look(a, b)
    while found:
        edits, begin, end, a, b = heapq.heappop(found)
        first = bisect_left(taken, (a, a))
        first -= first > 0 and taken[first - 1][1] > a
        near = taken[first : bisect_left(taken, (b, b))]
        if any(x < end and begin < y for x, y in near):
            for x, y in near:
                look(a, min(x, b))
                a = max(a, y)
            look(a, b)
        else:
            insort(taken, (begin, end))
            yield begin, end, edits
            look(a, begin)
            look(end, b)


def fuzzy_places(joined: str, notices: tuple[tuple[str, str], ...], per_edit: int) -> list[tuple[str, str, int, int, int]]:
    """(label, notice, first char, char after, edits) of the notices in a text."""
    automaton, patterns = _search(notices, per_edit)
    begins: dict[int, set[int]] = {}
    for end, (length, places) in automaton.iter(joined):
        for number, at in places:
            begins.setdefault(number, set()).add(end + 1 - length - at)
    out = []
    for number, own in begins.items():
        sought = patterns[number]
        edits, size = sought.edits, len(sought.notice)
        # Pieces of one place say the same begin, but for the edits between them.
        windows: list[tuple[int, int]] = []
        first = last = None
        for begin in [*sorted(own), None]:
            if first is not None and (begin is None or begin - first > 2 * edits):
                windows.append((max(0, first - edits), min(len(joined), last + size + edits)))
                first = None
            if first is None:
                first = begin
            last = begin
        out += [(sought.label, sought.notice, a, b, n) for a, b, n in _resolved(sought, joined, windows)]
    return sorted(out, key=lambda x: (x[2], x[3], x[1]))


def word_numbers(joined: str, places: list[int]) -> list[int]:
    """For each character the number of blanks before it."""
    if not places:
        return []
    blanks = np.flatnonzero(np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32) == 32)
    return np.searchsorted(blanks, places).tolist()


def phrase_places(joined: str, phrases: dict[str, str]) -> list[tuple[str, int]]:
    """(label, char where it starts) of each place where a phrase's words stand."""
    return [(label, m.start()) for phrase, label in phrases.items() if phrase in joined for m in re.finditer(rf"(?<![^ ])(?={re.escape(phrase)}(?: |$))", joined)]


def scan_licenses(
    docs: DataFrame,
    phrases: dict[str, str] | None = None,
    notices: dict[str, str] | None = None,
    per_edit: int = CHARS_PER_EDIT,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """One row per document: doc_id, n_words, base (label, word), found (label, notice, first, after, edits).

    ``base`` are the places of the phrases by their first word, ``found`` the
    notices by the words they touch. NULL and empty texts have no words and no
    places; repeated rows each get their row; other columns are not read.
    """
    ship(docs.sparkSession)
    known = PHRASES if phrases is None else phrases
    sought = tuple((NOTICES if notices is None else notices).items())

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sizes, bases, founds = [], [], []
            for t in pdf["text"]:
                words = lower_words(t)
                joined = b" ".join(words).decode()
                sizes.append(len(words))
                base = phrase_places(joined, known)
                bases.append([{"label": label, "word": w} for (label, _), w in zip(base, word_numbers(joined, [at for _, at in base]))])
                found = fuzzy_places(joined, sought, per_edit)
                firsts, lasts = (word_numbers(joined, [x[k] for x in found]) for k in (2, 3))
                founds.append(
                    [
                        {"label": x[0], "notice": x[1], "first": first, "after": last + 1, "edits": x[4]}
                        for x, first, last in zip(found, firsts, lasts)
                    ]
                )
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_words": pd.Series(sizes, dtype="int64"), "base": bases, "found": founds})

    rows = docs.select(docs[doc_id].cast("string").alias("doc_id"), docs[text].cast("string").alias("text")).mapInPandas(
        scan,
        "doc_id string, n_words bigint, base array<struct<label:string,word:bigint>>, "
        "found array<struct<label:string,notice:string,first:bigint,after:bigint,edits:int>>",
    )
    return rows.withColumn("doc_id", F.col("doc_id").cast(docs.schema[doc_id].dataType))


def op6_license_scan(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    likeness = F.transform("found", lambda x: 1 - x["edits"] / F.length(x["notice"]))
    return scan_licenses(docs).select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.word").alias("first_word"),
        F.array_max("base.word").alias("last_word"),
        joined(F.col("base.label")).alias("base_labels"),
        joined(F.concat("base.label", "found.label")).alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max(likeness), F.lit(0.0))).alias("score"),
    )
