"""SentencePiece encoding and decoding through a table of distinct chunks.

Where no piece of a model has a whitespace marker behind another character,
merges never cross from a word into the marker before the next one. A text is
then a sequence of chunks (markers, then a word), and each distinct chunk of the
corpus is segmented, and its ids decoded, once:

1. each task cuts its documents into blocks; a block asks for its distinct chunks,
   packed by chunk hash into one request per bucket;
2. each bucket segments every distinct chunk once and answers each block;
3. each block meets its answers and puts ids and decoded text together by position.

So what moves is the documents once, compressed, and each block's distinct chunks
there and back. A model with other pieces, or one that rewrites text, takes whole
texts as chunks, which is the library's own result.
"""

from __future__ import annotations

import hashlib
import pickle
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from histflow.llm.common import ship

#: UTF-8 bytes of text in a block.
BLOCK_BYTES = 24 << 20


@lru_cache(maxsize=4)
def processor(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@lru_cache(maxsize=4)
def splits_at_markers(path: str) -> bool:
    """Whether the model's pieces allow chunks to be segmented alone."""
    from sentencepiece import sentencepiece_model_pb2

    spec = sentencepiece_model_pb2.ModelProto()
    spec.ParseFromString(processor(path).serialized_model_proto())
    norm = spec.normalizer_spec
    plain = norm.add_dummy_prefix and norm.escape_whitespaces and not norm.remove_extra_whitespaces and not norm.precompiled_charsmap
    own = any(p.type == 4 for p in spec.pieces)  # user-defined symbols are matched before merging
    suffix = spec.trainer_spec.treat_whitespace_as_suffix
    return plain and not own and not suffix and spec.trainer_spec.model_type == 2 and not any("▁" in p.piece.lstrip("▁") for p in spec.pieces)


def chunks(path: str, text: str | None) -> list[str]:
    """The text's chunks in order, each without its first marker.

    Further markers of a chunk are written as blanks; a chunk of the first marker
    alone, as a text's last blank makes, is the empty string.
    """
    if not text:
        return []
    if not splits_at_markers(path):
        return [text]
    parts = text.replace("▁", " ").split(" ")
    if "" not in parts:
        return parts
    # Blanks in a row: they belong to the word behind them.
    out, blanks = [], 0
    for part in parts:
        if part:
            out.append(" " * blanks + part)
            blanks = 0
        else:
            blanks += 1
    if blanks:
        out.append(" " * (blanks - 1))
    return out


def segment(path: str, some: list[str]) -> tuple[list[str], list[str]]:
    """For each chunk its ids, as decimals joined by commas, and what they decode to.

    What a chunk decodes to is what it adds to a text behind its first marker.
    """
    model = processor(path)
    if not splits_at_markers(path):
        ids = model.encode(some, num_threads=1)
        return [",".join(map(str, x)) for x in ids], model.decode(ids, num_threads=1) if ids else []
    # The library puts the first marker in front, and drops it again.
    ids = model.encode(some, num_threads=1)
    marker = model.encode("a ")[len(model.encode("a")) :]
    ids = [x if c else marker for c, x in zip(some, ids)]
    decoded = model.decode(ids, num_threads=1) if ids else []
    return [",".join(map(str, x)) for x in ids], decoded


def _pack(x) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=3).compress(pickle.dumps(x, protocol=5))


def _unpack(x: bytes):
    import zstandard

    return pickle.loads(zstandard.ZstdDecompressor().decompress(x))


def encode_documents(docs: DataFrame, model: str, text: str = "text", doc_id: str = "doc_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, ids array<int>, decoded string.

    NULL and empty texts have no ids and decode to the empty text. Repeated rows
    and repeated or NULL ids each give their own row; other columns are not read.
    """

    def shape(ids: str, decoded: str) -> tuple:
        return list(map(int, ids.split(","))) if ids else [], decoded

    return _blocks(docs, model, text, doc_id, block_bytes, "ids array<int>, decoded string", shape)


def encode_digests(docs: DataFrame, model: str, text: str = "text", doc_id: str = "doc_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """As :func:`encode_documents`, with counts and digests in place of ids and text."""

    def shape(ids: str, decoded: str) -> tuple:
        return ids.count(",") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()

    return _blocks(docs, model, text, doc_id, block_bytes, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", shape)


def _cut(batches: Iterator[pd.DataFrame], block_bytes: int) -> Iterator[tuple[int, list, list]]:
    """The rows of a task in blocks: a name for the block, ids, texts."""
    from pyspark import TaskContext

    base, n, held, ids, texts = TaskContext.get().partitionId() << 32, 0, 0, [], []
    for pdf in batches:
        for i, t in zip(pdf["doc_id"], pdf["text"]):
            ids.append(i)
            texts.append(t)
            held += len(t) if t else 0
            if held >= block_bytes:
                yield base + n, ids, texts
                n, held, ids, texts = n + 1, 0, [], []
    if ids:
        yield base + n, ids, texts


def _blocks(docs, model, text, doc_id, block_bytes, schema, shape) -> DataFrame:
    ship(docs.sparkSession)
    # Ids travel as text: pandas has no integers with NULLs.
    narrow = docs.select(docs[doc_id].cast("string").alias("doc_id"), docs[text].cast("string").alias("text"))
    size = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = size // block_bytes + 1

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block, _, texts in _cut(batches, block_bytes):
            wanted: set[str] = set()
            for t in texts:
                wanted.update(chunks(model, t))
            asked: list[list[str]] = [[] for _ in range(buckets)]
            for c in sorted(wanted):
                asked[zlib.crc32(c.encode()) % buckets].append(c)
            some = [b for b in range(buckets) if asked[b]]
            yield pd.DataFrame({"bucket": some, "block": [block] * len(some), "asked": [_pack(asked[b]) for b in some]})

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        ids: dict[str, str] = {}
        decoded: dict[str, str] = {}  # of chunks that do not decode to themselves
        out = []
        for packed in pdf["asked"]:
            asked = _unpack(packed)
            new = [c for c in asked if c not in ids]
            for c, x, d in zip(new, *segment(model, new)):
                ids[c] = x
                if c != d:
                    decoded[c] = d
            out.append(_pack((";".join([ids[c] for c in asked]), {c: decoded[c] for c in asked if c in decoded} if decoded else {})))
        return pd.DataFrame({"block": pdf["block"], "asked": pdf["asked"], "found": out})

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block, ids, texts in _cut(batches, block_bytes):
            yield pd.DataFrame({"block": [block], "rows": [_pack((ids, texts))]})

    names = [x.split(" ")[0] for x in schema.split(", ")]

    def join(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        table: dict[str, str] = {}
        other: dict[str, str] = {}
        for asked, found in zip(right["asked"], right["found"]):
            joined, odd = _unpack(found)
            table.update(zip(_unpack(asked), joined.split(";")))
            other.update(odd)
        kept, out = [], []
        for rows in left["rows"]:
            for i, t in zip(*_unpack(rows)):
                parts = chunks(model, t)
                missing = [c for c in parts if c not in table] if not all(map(table.__contains__, parts)) else []
                if missing:  # only if a task that ran again cut its rows otherwise
                    for c, x, d in zip(missing, *segment(model, missing)):
                        table[c] = x
                        if c != d:
                            other[c] = d
                kept.append(i)
                out.append(shape(",".join(map(table.__getitem__, parts)), " ".join([other.get(c, c) for c in parts] if other else parts)))
        return pd.DataFrame({"doc_id": pd.Series(kept, dtype=object)} | {n: pd.Series(list(x), dtype="int64" if n == "n_tokens" else object) for n, x in zip(names, zip(*out) if out else [()] * len(names))})

    answers = (
        narrow.select(F.lit(None).cast("string").alias("doc_id"), "text")
        .mapInPandas(ask, "bucket bigint, block bigint, asked binary")
        .groupBy("bucket")
        .applyInPandas(answer, "block bigint, asked binary, found binary")
    )
    packed = narrow.mapInPandas(pack, "block bigint, rows binary")
    joined = packed.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(join, f"doc_id string, {schema}")
    return joined.withColumn("doc_id", F.col("doc_id").cast(docs.schema[doc_id].dataType))


def op2_sentencepiece(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encode_digests(docs, public_tokenizers.path("piece_bpe_32k.model"))
