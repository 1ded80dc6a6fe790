"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from histflow.llm import op13_spelling_variants as op13


def brute_words(rows, least=6, often=5):
    counts = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least and n >= often}


def brute_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute_variants(rows, ratio=5, least=6, often=5):
    words = brute_words(rows, least, often)
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and brute_near(w, v)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return sorted(out)


@pytest.fixture(scope="module")
def misspelt():
    """Words with variants of variants, accents and ties; short alphabets make many pairs of equal counts."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abé") for _ in range(rng.randrange(5, 8))) for _ in range(400)]
    chain = [("variant", 640), ("varient", 125), ("varientt", 25), ("vaarientt", 5), ("Straße×", 30), ("straßé×", 6), ("tiesone", 5), ("tiesonea", 25), ("tiesoneb", 25)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(60))) for _ in range(200)]
    texts += ["\n".join([w] * n) + "." for w, n in chain]
    texts += [None, "", "1 2 3", "abcdef " * 40_000, "À" * 5000, "漢字 abcdefgĀhijklmn"]
    rows = [*enumerate(texts), (None, texts[0]), (0, texts[0]), (0, texts[0])]
    return rows


def test_variants(spark, misspelt):
    table = spark.createDataFrame([(*r, "z", 1, "z") for r in misspelt], "doc_id bigint, text string, word string, n int, sig string").repartition(3)
    expected = brute_variants(misspelt)
    for block in (1024, 4):  # blocks of four words: signatures are cut into parts
        got = op13.spelling_variants(table, block=block)
        assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == expected
    by_word = {r[0]: r for r in expected}
    assert by_word["vaarientt"][2] == "variant" and by_word["tiesone"][1] == "tiesonea"
    assert sum(r[4] for r in expected) > 100
    assert op13.spelling_variants(table.where("false")).collect() == []


def test_registered_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = op13.op13_spelling_variants(spark, sf_dir)
    assert got.dtypes == [("word", "string"), ("form", "string"), ("root", "string"), ("n", "bigint"), ("n_near", "bigint"), ("form_n", "bigint")]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == brute_variants(rows)


def test_signatures_meet_every_edit(spark):
    """Of any two words one edit apart, exactly one signature meets the other, or both are one."""
    rng = random.Random(9)
    letters = op13.LOWER + "éüß"
    pairs = []
    for _ in range(300):
        a = "".join(rng.choice(letters) for _ in range(rng.randrange(1, 12)))
        k = rng.randrange(len(a))
        b = rng.choice([a[:k] + a[k + 1 :], a[:k] + rng.choice(letters) + a[k:], a[:k] + rng.choice(letters) + a[k + 1 :]])
        pairs.append((a, b))
    df = spark.createDataFrame(pairs, "a string, b string")
    a, b = op13.signature(df.a), op13.signature(df.b)
    from pyspark.sql import functions as F

    got = df.select((a == b).alias("same"), F.array_contains(op13.neighbours(a), b).alias("ab"), F.array_contains(op13.neighbours(b), a).alias("ba")).collect()
    assert all((r.ab and r.ba) if r.same else (r.ab != r.ba) for r in got)


def test_verified_edits():
    code = lambda *w: np.array([list(x.encode("latin-1")) for x in w], np.uint8)
    a, b = code("listen", "silent", "abcdef"), code("listem", "sileny", "abcdfe")
    assert [(i, j) for i, j in zip(*op13.near_pairs(a, b, False))] == [(0, 0), (1, 1)]
    longer = code("listens", "slilent", "abdcefg")
    assert [(i, j) for i, j in zip(*op13.near_pairs(a, longer, False))] == [(0, 0), (1, 1)]
    assert not len(op13.near_pairs(a, a, True)[0])
