"""Similar documents, contamination, licenses against brute force."""

import re

import duckdb
import regex

from histflow.llm import op01_jaccard_join as op1, op03_decontamination as op3, op06_license_scan as op6
from histflow.llm.common import lower_words
from histflow.llm.queries import QUERIES, SQL


def brute_links(corpus):
    texts = sorted({t or "" for _, t in corpus})
    sets = {t: op1.shingle_set(t) for t in texts}
    links = {t: {u for u in texts if u != t and sets[t] and op1.jaccard(sets[t], sets[u]) >= 0.8} for t in texts}
    least = {t: min(i for i, u in corpus if (u or "") == t) for t in texts}
    changed = True
    while changed:
        changed = False
        for t in texts:
            low = min([least[t], *(least[u] for u in links[t])])
            changed |= low != least[t]
            least[t] = low
    return [(i, least[t or ""], len(links[t or ""]), sum((u or "") == (t or "") for _, u in corpus)) for i, t in corpus]


def test_links_and_classes(documents, corpus, nothing):
    expected = sorted(brute_links(corpus))
    for block in (256, 2):  # blocks of two: buckets are cut into pairs of blocks
        got = op1.similar_documents(documents, block=block).collect()
        assert sorted((r.doc_id, r.class_id, r.n_links, r.n_copies) for r in got) == expected
    assert any(n for _, _, n, _ in expected)
    assert op1.similar_documents(nothing).collect() == []


def test_one_document_of_each_class_stays(documents, corpus):
    kept = op1.one_of_each(documents)
    assert kept.columns == documents.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c, _, _ in brute_links(corpus)})


def test_null_and_repeated_ids_leave_one_row_a_class(spark):
    base = " ".join(f"w{i}" for i in range(80))
    near = [base, base.replace("w3 ", "x "), base.replace("w70 ", "y ")]
    other = " ".join(f"v{i}" for i in range(80))
    cases = {
        "null ids": [(None, t) for t in near],
        "null and known": [(None, near[0]), (9, near[1]), (None, near[2])],
        "one id twice": [(7, near[0]), (7, near[1])],
        "a row twice": [(7, near[0]), (7, near[0]), (8, near[2])],
        "no text": [(None, None), (None, ""), (None, None)],
    }
    for name, rows in cases.items():
        docs = spark.createDataFrame([*rows, (50, other)], "doc_id bigint, text string").repartition(2)
        kept = op1.one_of_each(docs).collect()
        assert len(kept) == 2 and (50, other) in [tuple(r) for r in kept], name
        left = next(r for r in kept if r.text != other)
        assert left.doc_id == min((i for i, _ in rows if i is not None), default=None), name


def test_long_chains_are_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "a bigint, b bigint")
    got = {r.id: r.component for r in op1.components(edges).collect()}
    assert {got[i] for i in range(201)} == {0} and got[501] == 500


def test_pruning_keeps_pairs_at_the_threshold():
    least = op1.least_matches(0.8, 1e-6)
    # a pair of similarity 0.8 matches 102 of 128 values on average
    assert all(m < 0.8 * n for m, n in zip(least, range(16, 129, 16))) and least[-1] > 0.5 * 128


def brute_contamination(docs, items):
    out = []
    for i, t in docs:
        words = lower_words(t)
        hit, found = set(), set()
        for name, text in items:
            own = lower_words(text)
            n = min(13, len(own))
            for a in range(len(own) - n + 1 if n else 0):
                for p in range(len(words) - n + 1):
                    if words[p : p + n] == own[a : a + n]:
                        hit.update(range(p, p + n))
                        found.add(str(name))
        out.append((i, len(words), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(words)))
    return sorted(out)


def test_contamination(spark, documents, corpus, nothing):
    short = [(i, t) for i, t in corpus if len(t or "") < 5000]
    by_id = dict(short)
    words = [t for _, t in short if t and len(t.split()) > 60]
    items = [(1, " ".join(words[0].split()[5:40])), (2, " ".join(words[1].split()[:13])), (3, "changed"), (4, None), (5, ""), (12, words[0]), (2, words[2]), (None, words[3])]
    table = spark.createDataFrame([(*x, "z") for x in items], "item_id bigint, text string, win string")
    docs = documents.where("length(text) < 5000 OR text IS NULL")
    got = sorted((r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in op3.decontaminate(docs, table).collect())
    assert got == brute_contamination(short, [x for x in items if x[0] is not None])
    assert any(x[4] for x in got) and by_id
    clean = op3.without_contaminated(docs, table)
    assert clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == sorted(x[0] for x in got if not x[4])
    assert op3.decontaminate(nothing, table).collect() == []
    none = op3.decontaminate(docs, table.where("false")).collect()
    assert len(none) == len(short) and not any(r.contaminated for r in none)


def test_contamination_query_equals_sql(spark, sf_dir):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    relation = con.sql(SQL["op3_decontamination"])
    df = QUERIES["op3_decontamination"](spark, sf_dir)
    assert sorted(relation.columns) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*relation.columns).collect())) == sorted(relation.fetchall())


NOTE = "This file is Released under the MIT Licence, see LICENSE.\nThe MIT License mit license. GNU General Public License!"


def test_license_scan_equals_matching_the_whole_text(spark, corpus, nothing):
    texts = [NOTE, "licensed under teh apache license, version 2.0", "mit licensed", "premit license", None, "", "All rights reserved", "x mit license"]
    texts += [t for _, t in corpus[:20]]
    docs = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "doc_id bigint, text string, found string")
    got = {r.doc_id: r for r in op6.scan_licenses(docs).collect()}
    for i, t in enumerate(texts):
        words = [w.decode() for w in lower_words(t)]
        base = sorted((label, a) for p, label in op6.PHRASES.items() for a in range(len(words)) if words[a : a + len(p.split())] == p.split())
        assert sorted((b.label, b.word) for b in got[i].base) == base
        assert got[i].n_words == len(words)
        joined = " ".join(words)
        for notice, label in op6.NOTICES.items():
            k = len(notice) // op6.CHARS_PER_EDIT
            whole = regex.search(f"(?b)(?:{re.escape(notice)}){{e<={k}}}", joined)
            assert bool(whole) == any(f.notice == notice and f.label == label for f in got[i].found)
    assert {f.label for f in got[0].found} >= {"mit"} and {f.label for f in got[1].found} == {"apache"}
    assert op6.scan_licenses(nothing).collect() == []


def brute_notices(joined, notice, edits, a=0):
    """The best match of a whole text, and those of the texts before and behind it."""
    m = regex.search(f"(?b)(?:{re.escape(notice)}){{e<={edits}}}", joined)
    if not m:
        return []
    before = brute_notices(joined[: m.start()], notice, edits, a)
    return before + [(a + m.start(), a + m.end(), sum(m.fuzzy_counts))] + brute_notices(joined[m.end() :], notice, edits, a + m.end())


def test_damaged_notices_beside_clean_ones_are_found():
    clean, damaged = "all rights reserved", "all rights reservd"
    long, longer = "gnu leser general pubic license", "gnu lesser general public license"
    texts = {f"{damaged} {clean}": 2, f"{clean} {damaged}": 2, f"{damaged} {damaged} {clean} {damaged} {clean}": 5, f"{long} and {longer}": 2, f"x {long} {longer} {long} y": 3}
    for joined, n in texts.items():
        notice = clean if clean in joined else longer
        edits = len(notice) // op6.CHARS_PER_EDIT
        got = [x[2:] for x in op6.fuzzy_places(joined, tuple(op6.NOTICES.items()), op6.CHARS_PER_EDIT) if x[1] == notice]
        assert got == brute_notices(joined, notice, edits) and len(got) == n, (joined, got)


def test_overlapping_matches_are_resolved_as_in_the_whole_text():
    import random

    rng = random.Random(5)
    notice = "all rights reserved"
    for _ in range(150):
        parts = []
        for _ in range(rng.randrange(1, 9)):
            t = list(notice)
            for _ in range(rng.randrange(3)):
                k = rng.randrange(len(t))
                t[k : k + 1] = rng.choice([[], [rng.choice("abz")], [t[k], "q"]])
            parts.append("".join(t))
        joined = " ".join(rng.choice(["", "other words"]) + " " + x for x in parts).strip()
        got = [x[2:] for x in op6.fuzzy_places(joined, ((notice, "p"),), op6.CHARS_PER_EDIT)]
        expected = brute_notices(joined, notice, len(notice) // op6.CHARS_PER_EDIT)
        assert [e for _, _, e in got] == [e for _, _, e in expected] and [a for a, _, _ in got] == [a for a, _, _ in expected], joined


def test_many_damaged_notices_take_linear_time(spark):
    import time

    text = "all rights reservd. licensed under teh apache license, version 2.0; " * 10_000
    began = time.time()
    words = b" ".join(lower_words(text)).decode()
    found = op6.fuzzy_places(words, tuple(op6.NOTICES.items()), op6.CHARS_PER_EDIT)
    assert len(found) >= 20_000 and time.time() - began < 5
    row = op6.scan_licenses(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert len(row.found) == len(found) and len(row.base) == 10_000 and row.found[-1].after == row.n_words


def test_registered_license_columns(spark, tmp_path):
    texts = [NOTE, "mit license and apache license, apache license", "All rights reservd", "nothing here", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in op6.op6_license_scan(spark, str(tmp_path)).collect()}
    assert (got[1].n_base, got[1].first_word, got[1].last_word, got[1].base_labels) == (3, 0, 5, "apache,mit")
    assert got[1].labels == "apache,mit" and got[1].score == 1.0
    assert (got[2].n_base, got[2].first_word, got[2].base_labels, got[2].labels) == (0, None, "", "proprietary")
    assert abs(got[2].score - (1 - 1 / 19)) < 1e-12 and got[3].score == 0.0 and (got[4].n_words, got[4].labels) == (0, "")
