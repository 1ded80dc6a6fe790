"""Token ids in binary files of independent zstandard frames.

A file holds the ids of consecutive documents, little-endian, 16 bits wide where
the vocabulary allows it, else 32, cut into frames of a fixed length. Each frame
is compressed on its own. Behind them stand two skippable frames that any
zstandard reader passes over:

- the document index: JSON (compressed) with the width, the ids of the documents
  and their numbers of tokens;
- the seek table of the public seekable format: for each frame its compressed and
  decompressed length and the low 32 bits of the XXH64 of its content, then the
  number of frames, a descriptor and the closing magic number.

A reader fetches the tail, then only the frames that hold the documents it wants,
and checks each one's checksum.

Documents are dealt out by ranges of their id, so files in order hold ids in
ascending order; a repeated id is ordered by its text's hash. Each task writes its
file under a name of its own and returns a manifest row; the manifest is written
by Spark, so files of tasks that were lost or ran twice are never listed.
"""

from __future__ import annotations

import json
import re
import struct
import sys
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from histflow.llm.common import ship, stage
from histflow.session import work_folder

#: UTF-8 bytes of text that go to one file.
FILE_BYTES = 32 << 20
#: Bytes of ids in a frame.
FRAME_BYTES = 1 << 18

# Fixed values of the public frame and seekable formats.
SKIPPABLE_INDEX = 0x184D2A50
SKIPPABLE_SEEK = 0x184D2A5E
SEEK_MAGIC = 0x8F92EAB1
HAS_CHECKSUMS = 0x80


# ---- encoding -------------------------------------------------------------------
_CHUNK = re.compile(r"\s*\S+|\s+")
# What the byte-level pattern makes of text without apostrophes and in Latin letters:
# runs of letters, of digits and of other marks, each with the blank before it.
_PLAIN = re.compile(r"[ \nA-Za-z0-9À-ÖØ-öø-ɏ!-&(-/:-@\[-`{-~]*")
_PARTS = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ɏ]+| ?[0-9]+| ?[!-&(-/:-@\[-`{-~]+|\s+(?!\S)|\s+")
_ODD_SPACE = re.compile("[\x1c-\x1f]")
# White space other than blanks and line ends.
_OTHER_SPACE = re.compile("[\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: Chunks and words that a worker keeps of what it has encoded; then it starts anew.
CACHED = 1_000_000
CACHED_WORDS = 1_000_000
#: Marks that often end a word; with it they are two parts.
_END_MARKS = frozenset(".,;:!?)")


def _byte_letters() -> dict[int, str]:
    """The printable stand-in for each byte in byte-level vocabularies."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder:
    """Ids of whole texts as the tokenizers library gives them.

    With a byte-level tokenizer no token spans the place between a character and
    the white space behind it, so texts are encoded chunk by chunk and repeated
    chunks only once. Other tokenizers get the whole text.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        model = spec["model"]
        self.by_chunk = (
            pre.get("type") == "ByteLevel"
            and not pre.get("add_prefix_space")
            and pre.get("use_regex", True)
            and not spec.get("normalizer")
            and model.get("type") == "BPE"
            and not model.get("dropout")
            and not any(re.search(r"\s", t["content"]) or t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in spec.get("added_tokens", []))
        )
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.kind = np.dtype("<u2" if self.width == 2 else "<u4")
        self.letters = _byte_letters()
        self.blank = self.letters[32]
        # Added tokens are looked for before anything else; none may hide in a plain chunk.
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        self.letters_only = not any(t[:-1].isalpha() or t.isalpha() for t in self.added)
        self.code = "H" if self.width == 2 else "I"
        self.known: dict[str, bytes] = {}
        self.spaced: dict[str, bytes] = {}  # by the chunk without the blank before it
        self.words: dict[str, bytes] = {}

    def _packed(self, ids: list[int]) -> bytes:
        out = array(self.code, ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def _word(self, word: str) -> bytes:
        found = self.words.get(word)
        if found is None:
            if word.isascii() and word[1:].isalnum():  # such bytes stand for themselves
                shown = self.blank + word[1:] if word[0] == " " else word
            else:
                shown = word.encode().decode("latin-1").translate(self.letters)
            tokens = self.model.tokenize(shown)
            found = self.words[word] = self._packed([t.id for t in tokens])
        return found

    def _learn(self, store: dict[str, bytes], keys: set[str], lead: str) -> None:
        """Put the ids of ``lead`` and key into ``store`` for all ``keys``."""
        if len(self.words) > CACHED_WORDS:
            self.words.clear()
        rest, word = [], self._word
        for key in keys:
            chunk = lead + key
            # Letters alone are one part, a mark behind them another.
            if self.letters_only and key.isalpha() and max(key) < "\u0250":
                store[key] = word(chunk)
            elif self.letters_only and key[-1:] in _END_MARKS and key[:-1].isalpha() and max(key) < "\u0250":
                store[key] = word(chunk[:-1]) + word(key[-1])
            elif _PLAIN.fullmatch(chunk) and not any(t in chunk for t in self.added):
                store[key] = b"".join([word(x) for x in _PARTS.findall(chunk)])
            else:
                rest.append(key)
        for key, e in zip(rest, self.tokenizer.encode_batch([lead + key for key in rest], add_special_tokens=False) if rest else ()):
            store[key] = self._packed(e.ids)

    def _found(self, store: dict[str, bytes], keys: list[str], lead: str) -> list[bytes]:
        """The ids of ``lead`` and each key."""
        found = list(map(store.get, keys))
        if None in found:
            if len(store) > CACHED:
                store.clear()
            self._learn(store, {key for key, ids in zip(keys, found) if ids is None}, lead)
            found = [store[key] if ids is None else ids for key, ids in zip(keys, found)]
        return found

    def encode(self, text: str | None) -> bytes:
        """The ids of a text, packed."""
        if not text:
            return b""
        if not self.by_chunk or _ODD_SPACE.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()
        if "  " in text or "\n\n" in text or " \n" in text or "\n " in text or _OTHER_SPACE.search(text):
            return b"".join(self._found(self.known, _CHUNK.findall(text), ""))
        # A line end stands alone between two characters, and is a part of its own; every blank stands
        # behind a character, so each part of a line but the first has one before it.
        lines = [line.split(" ") for line in text.split("\n")]
        *firsts, end = self._found(self.known, [*[parts[0] for parts in lines], "\n"], "")
        others = self._found(self.spaced, [part for parts in lines for part in parts[1:]], " ")
        out, at = [], 0
        for first, parts in zip(firsts, lines):
            after = at + len(parts) - 1
            out += [end, first, *others[at:after]]
            at = after
        return b"".join(out[1:])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


# ---- the file format --------------------------------------------------------------
class TokenFileWriter:
    """Writes one file: ``add`` for each document in order, then ``close``."""

    def __init__(self, out, width: int, frame_bytes: int = FRAME_BYTES):
        import zstandard

        self.out, self.width, self.frame_bytes = out, width, frame_bytes
        self.compress = zstandard.ZstdCompressor(level=3).compress
        self.waiting: list[bytes] = []
        self.held = 0
        self.table: list[bytes] = []
        self.ids: list[str | None] = []
        self.counts: list[int] = []

    def add(self, doc_id: str | None, packed: bytes) -> None:
        self.ids.append(doc_id)
        self.counts.append(len(packed) // self.width)
        self.waiting.append(packed)
        self.held += len(packed)
        if self.held >= self.frame_bytes:
            whole = b"".join(self.waiting)
            cut = len(whole) - len(whole) % self.frame_bytes
            for i in range(0, cut, self.frame_bytes):
                self._frame(whole[i : i + self.frame_bytes])
            self.waiting, self.held = [whole[cut:]], len(whole) - cut

    def _frame(self, content: bytes) -> None:
        import xxhash

        packed = self.compress(content)
        self.out.write(packed)
        self.table.append(struct.pack("<III", len(packed), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))

    def close(self) -> None:
        if self.held:
            self._frame(b"".join(self.waiting))
        index = self.compress(json.dumps({"width": self.width, "ids": self.ids, "counts": self.counts}).encode())
        self.out.write(struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index)
        body = b"".join(self.table) + struct.pack("<IBI", len(self.table), HAS_CHECKSUMS, SEEK_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_SEEK, len(body)) + body)


class TokenFileReader:
    """Reads documents of one file; only the frames that hold them are fetched."""

    def __init__(self, source):
        import zstandard

        self.source = source
        self.decompress = zstandard.ZstdDecompressor().decompress
        size = source.size()
        n, kind, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEK_MAGIC or kind != HAS_CHECKSUMS:
            raise ValueError("no seek table at the end of the file")
        head = size - 9 - 12 * n - 8
        table = np.frombuffer(self._at(head + 8, 12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(table[:, 0])])
        self.offsets = np.concatenate([[0], np.cumsum(table[:, 1])])
        self.sums = table[:, 2]
        magic, length = struct.unpack("<II", self._at(int(self.starts[-1]), 8))
        if magic != SKIPPABLE_INDEX:
            raise ValueError("no document index in the file")
        index = json.loads(self.decompress(self._at(int(self.starts[-1]) + 8, length)))
        self.width, self.ids = index["width"], index["ids"]
        self.counts = np.array(index["counts"], np.int64)
        self.begins = np.concatenate([[0], np.cumsum(self.counts)])
        self.last: tuple[int, bytes] = (-1, b"")

    def _at(self, offset: int, length: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(length)

    def frame(self, i: int) -> bytes:
        import xxhash

        if self.last[0] != i:
            packed = self._at(int(self.starts[i]), int(self.starts[i + 1] - self.starts[i]))
            content = self.decompress(packed, max_output_size=int(self.offsets[i + 1] - self.offsets[i]))
            if xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self.sums[i]:
                raise ValueError(f"frame {i} is damaged")
            self.last = (i, content)
        return self.last[1]

    def document(self, place: int) -> np.ndarray:
        """The ids of the document at ``place`` in the file."""
        a, b = int(self.begins[place]) * self.width, int(self.begins[place + 1]) * self.width
        parts, i = [], int(np.searchsorted(self.offsets, a, "right")) - 1
        while a < b:
            base = int(self.offsets[i])
            part = self.frame(i)[a - base : b - base]
            parts.append(part)
            a, i = a + len(part), i + 1
        return np.frombuffer(b"".join(parts), "<u2" if self.width == 2 else "<u4")


def _store(uri: str):
    """The file system of a folder, and the folder's path on it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


# ---- on Spark -----------------------------------------------------------------------
def write_token_files(
    docs: DataFrame,
    tokenizer: str,
    folder: str,
    end_id: int = 0,
    text: str = "text",
    doc_id: str = "doc_id",
    file_bytes: int = FILE_BYTES,
    frame_bytes: int = FRAME_BYTES,
) -> DataFrame:
    """Write files below ``folder``; returns the staged manifest.

    Columns: part, file, n_docs, n_tokens, start (tokens in the files before).
    NULL and empty texts are documents with the end id alone. NULL ids come
    first; repeated ids and rows are documents of their own. No documents, no
    files. Other columns of ``docs`` are not read.
    """
    ship(docs.sparkSession)
    narrow = docs.select(docs[doc_id].alias("doc_id"), docs[text].cast("string").alias("text"))
    size = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    key = F.xxhash64("text")
    ordered = narrow.repartitionByRange(size // file_bytes + 1, F.col("doc_id"), key).sortWithinPartitions("doc_id", key)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, writer, out, name = TaskContext.get().partitionId(), None, None, ""
        code = encoder(tokenizer)
        end = np.array([end_id], code.kind).tobytes()
        for pdf in batches:
            for i, t in zip(pdf["doc_id"], pdf["text"]):
                if writer is None:
                    store, path = _store(folder)
                    store.create_dir(path)
                    name = f"part-{part:06d}-{uuid.uuid4().hex}.tok"
                    out = store.open_output_stream(f"{path}/{name}")
                    writer = TokenFileWriter(out, code.width, frame_bytes)
                writer.add(i, code.encode(t) + end)
        if writer is not None:
            writer.close()
            out.close()
            yield pd.DataFrame({"part": [part], "file": [name], "n_docs": [len(writer.ids)], "n_tokens": [sum(writer.counts)]})

    files = ordered.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(write, "part int, file string, n_docs bigint, n_tokens bigint")
    # One row per file.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return stage(files, "token-manifest").withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per document of the listed files: doc_id (as text), start, n_tokens, ids_crc32."""
    ship(manifest.sparkSession)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, start in zip(pdf["file"], pdf["start"]):
                store, path = _store(folder)
                with store.open_input_file(f"{path}/{name}") as source:
                    r = TokenFileReader(source)
                    for a in range(0, len(r.ids), 8192):
                        b = min(a + 8192, len(r.ids))
                        sums = [zlib.crc32(r.document(k).astype("<u4").data) for k in range(a, b)]
                        yield pd.DataFrame({"doc_id": pd.Series(r.ids[a:b], dtype=object), "start": r.begins[a:b] + start, "n_tokens": r.counts[a:b], "ids_crc32": np.array(sums, np.int64)})

    n = max(1, manifest.count())
    return manifest.select("file", "start", "part").repartitionByRange(n, "part").mapInPandas(read, "doc_id string, start bigint, n_tokens bigint, ids_crc32 bigint")


def op4_token_files(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = work_folder(spark, "token-files")
    manifest = write_token_files(docs, public_tokenizers.path("byte_bpe_50k.json"), folder)
    return read_token_files(manifest, folder).withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
