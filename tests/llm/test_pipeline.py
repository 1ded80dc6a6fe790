"""The pipeline against its stages done by hand, and the registered queries."""

import re

import public_tokenizers
import sentencepiece

import __spark_entry__ as entry_points
import corpus_pipeline
from histflow.llm import op01_jaccard_join as op1, op02_sentencepiece as op2
from histflow.llm.queries import QUERIES


def test_all_queries_and_the_pipeline_are_registered():
    names = [n for n in entry_points.queries() if re.match(r"op\d+_|pipeline$", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names if n != "pipeline") == list(range(1, 14))
    assert "pipeline" in names and set(QUERIES) <= set(names)


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, seen = docs.columns, [docs]
    for _, apply in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(apply(spark, docs, sf_dir), "test-pipeline")
        seen.append(docs)
    assert all(d.columns == columns for d in seen[:-1])
    start, good, unique, clean, private, final = [{r.doc_id: r for r in d.collect()} for d in seen]
    assert set(start) >= set(good) >= set(unique) >= set(clean) == set(private) == set(final)
    # no two documents of the second stage's output are similar, and none is gone without a similar one
    sets = {i: op1.shingle_set(r.text) for i, r in good.items()}
    kept = list(unique)
    for n, i in enumerate(kept):
        assert not any(op1.jaccard(sets[i], sets[j]) >= 0.8 for j in kept[:n])
    for i in set(good) - set(unique):
        assert any(j < i and op1.jaccard(sets[i], sets[j]) >= 0.8 for j in good)
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for i, r in private.items():
        assert final[i].n_tokens == len(model.encode(r.text)) and r.n_chars == len(r.text)
    assert op2.encode_digests(seen[4].where("false"), public_tokenizers.path("piece_bpe_32k.model")).count() == 0
