import random

import pytest

WORDS = "the of and to in is that it was for on are as with his they at be this from or one had by word but not what all were".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "ing", "ed", "é", "s", "."]) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text): copies, near copies, shared passages, NULL, empty and long texts."""
    rng = random.Random(5)
    texts = [prose(rng, rng.randrange(1, 160)) for _ in range(60)]
    base = prose(rng, 120).split(" ")
    near = [" ".join([*base[:i], "changed", *base[i + 1 :]]) for i in (3, 50, 51, 110)]
    passage = prose(rng, 30)
    shared = [f"{prose(rng, 20)}\n{passage}\n{prose(rng, 20)}" for _ in range(4)]
    odd = [None, "", " ", "  two  blanks \n\n tab\t end ", "漢字 🙂 x\x00y", "a", "▁ a▁b", prose(rng, 30_000), "don't we'll <|endoftext|> x"]
    everything = [*texts, " ".join(base), *near, *shared, *odd, texts[0], texts[0], texts[1], None, ""]
    rows = list(enumerate(everything))
    rows.append((0, texts[0]))  # a repeated row
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def documents(spark, corpus):
    """The corpus with further columns whose names the operators use inside."""
    extra = "k string, h string, block string, id string, unit string, size string, key string, n int, word string, name string"
    rows = [(i, t, "en" if i % 3 else None, "s", len(t or ""), *["z"] * 7, 1, "z", "z") for i, t in corpus]
    return spark.createDataFrame(rows, f"doc_id bigint, text string, lang string, source string, n_chars bigint, {extra}").repartition(3)


@pytest.fixture(scope="session")
def nothing(documents):
    return documents.where("false")
