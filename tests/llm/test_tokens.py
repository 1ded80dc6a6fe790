"""SentencePiece ids and token files against the libraries."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from histflow import work_folder
from histflow.llm import op02_sentencepiece as op2, op04_token_files as op4

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def test_chunks_give_the_librarys_ids_and_text(corpus):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert op2.splits_at_markers(PIECES)
    for _, t in corpus:
        t = (t or "")[:20_000]
        ids, decoded = op2.segment(PIECES, op2.chunks(PIECES, t))
        assert ",".join(ids) == ",".join(map(str, model.encode(t)))
        assert " ".join(decoded) == model.decode(model.encode(t))


def test_documents_are_encoded_and_decoded(documents, corpus, nothing):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = sorted((r.doc_id, r.ids, r.decoded) for r in op2.encode_documents(documents, PIECES, block_bytes=4000).collect())
    expected = sorted((i, model.encode(t or ""), model.decode(model.encode(t or "")) if t else "") for i, t in corpus)
    assert got == expected
    digests = {(r.doc_id, r.n_tokens, r.ids_sha256) for r in op2.encode_digests(documents, PIECES).collect()}
    assert digests == {(i, len(x), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest()) for i, x, _ in expected}
    assert op2.encode_documents(nothing, PIECES).collect() == []


def test_encoder_equals_the_library(corpus):
    library, own = Tokenizer.from_file(BYTES), op4.Encoder(BYTES)
    assert own.by_chunk
    more = ["a  b\n\n c\t d'll we're 12ab  ", "x <|endoftext|> y'S", "\n a", "ab\u0085c \x1c d", "über--naïve###$$ (x)", " lead", "tail "]
    for t in [*(t for _, t in corpus if t), *more]:
        assert np.frombuffer(own.encode(t), own.kind).tolist() == library.encode(t, add_special_tokens=False).ids


def test_a_full_store_starts_anew(monkeypatch, corpus):
    monkeypatch.setattr(op4, "CACHED", 5)
    monkeypatch.setattr(op4, "CACHED_WORDS", 5)
    library, own = Tokenizer.from_file(BYTES), op4.Encoder(BYTES)
    for _, t in corpus[:40]:
        t = (t or "")[:3000]
        assert np.frombuffer(own.encode(t), own.kind).tolist() == library.encode(t, add_special_tokens=False).ids


def test_files_hold_all_documents_in_order(spark, documents, corpus, nothing):
    library = Tokenizer.from_file(BYTES)
    folder = work_folder(spark, "token-files")
    manifest = op4.write_token_files(documents, BYTES, folder, file_bytes=20_000, frame_bytes=1000)
    assert manifest.count() > 3
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in op4.read_token_files(manifest, folder).collect())
    assert [int(x[1]) for x in got] == sorted(i for i, _ in corpus)
    start = 0
    by_id = dict(corpus)
    for at, i, n, crc in got:
        ids = [*library.encode(by_id[int(i)] or "", add_special_tokens=False).ids, 0]
        assert (at, n, crc) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += n
    empty = work_folder(spark, "token-files")
    assert op4.read_token_files(op4.write_token_files(nothing, BYTES, empty), empty).collect() == []


def test_a_reader_fetches_only_what_it_needs_and_checks_it(tmp_path):
    import pyarrow.fs as fs
    import zstandard

    rng = np.random.Generator(np.random.PCG64(1))
    docs = [rng.integers(0, 50_000, n).astype("<u2") for n in (5, 0, 3000, 1, 700)]
    path = str(tmp_path / "x.tok")
    with fs.LocalFileSystem().open_output_stream(path) as out:
        writer = op4.TokenFileWriter(out, 2, frame_bytes=512)
        for i, d in enumerate(docs):
            writer.add(str(i), d.tobytes())
        writer.close()
    raw = open(path, "rb").read()
    # any zstandard reader gets the ids
    whole = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
    assert whole == b"".join(d.tobytes() for d in docs)
    with fs.LocalFileSystem().open_input_file(path) as source:
        reader = op4.TokenFileReader(source)
        fetched = []
        frame = reader.frame
        reader.frame = lambda i: fetched.append(i) or frame(i)
        assert reader.document(4).tolist() == docs[4].tolist()
        assert 0 < len(set(fetched)) < len(reader.sums) / 2
        assert [reader.document(i).tolist() for i in range(5)] == [d.tolist() for d in docs]
    damaged = bytearray(raw)
    damaged[20] ^= 1
    open(path, "wb").write(damaged)
    with fs.LocalFileSystem().open_input_file(path) as source, pytest.raises(Exception):
        op4.TokenFileReader(source).document(0)
