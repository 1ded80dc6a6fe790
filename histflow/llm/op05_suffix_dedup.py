"""Repeated passages by a distributed difference-cover suffix sort.

A byte goes if it lies in a 50-byte string that also starts in a document with a
smaller id. That needs the equal 50-byte prefixes among all suffixes, together with
the least document of each. Two steps keep the suffix sort to what can repeat:

1. Every 50-byte window has a seed, its 32-byte string with the least hash. Equal
   windows have equal seeds, so a window whose seed stands in one document only
   cannot repeat.
2. The other windows stand in runs: neighbours with one seed in one place. Equal runs
   are one run (a run is named by its length and the hashes of the three 32-byte
   strings that cover it, 104 bits in all) with its least document. In any later
   document such a run goes whole. In its least document it can only go where a run
   of other content has the same seed and a smaller least document, so a seed whose
   runs all have one least document is settled. For every other seed the sort gets
   each run once, from its least document.

The suffix sort, over all runs left, neighbours joined: positions 1 and 2 mod 3 are
the sample. Their prefixes of 27 bytes are sorted and named by rank. Any two positions
then have equal prefixes of 50 bytes exactly if the keys made of the names and bytes at
the places that the difference cover gives them agree: one byte and the names behind it
for positions 0 and 1, two bytes for 0 and 2, the names alone for 1 and 2. Sorting these
keys merges the remaining positions with the sample; a group of equal keys (adjacent, at
least 50 bytes in common) has a least document.

Each sort is distributed: blocks send their distinct keys, sorted, to ranges between
splitters; a range merges them and answers each block in order. So a key that stands
in a third of all places is sent once by each block.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from histflow.llm.common import discard, give_back, mix, ship, stage

LENGTH = 50
SEED = 32
REACH = LENGTH - SEED + 1
#: UTF-8 bytes in a block of documents, and of what is sorted.
DOC_BLOCK = 4 << 20
CHUNK_BLOCK = 1 << 19
#: Bytes that are hashed at a time.
PIECE = 1 << 18
#: Keys that the splitters of a sort are chosen from, at most about so many (7 MB in the driver), and by a full block.
SAMPLED, MOST_DRAWN = 1 << 18, 256
#: A block of documents may leave so many blocks to the sort, and a task have so many blocks: bits of a block's number.
PIECE_BITS = TASK_BITS = 20
#: Bytes and bits of a name: the range that gave it, and the rank inside.
NAME, RANK_BITS = 6, 28
NO_ID = 2**63 - 1

_RNG = np.random.Generator(np.random.PCG64(505))
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_MULT = [_RNG.integers(1, 2**63, dtype=np.uint64) | np.uint64(1) for _ in range(5)]
_PLACE = np.uint64((1 << 24) - 1)
_SEED_BITS = np.uint64((1 << 40) - 1)
_SPREAD = np.uint64(0x9E3779B97F)


def _pack(x) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=3).compress(pickle.dumps(x, protocol=5))


def _unpack(x: bytes):
    import zstandard

    return pickle.loads(zstandard.ZstdDecompressor().decompress(x))


def seeds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each 50-byte window of ``data`` the hash (40 bits) and the place of its seed; the hash of each 32-byte string."""
    if len(data) < LENGTH:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.uint64)
    values, places, strings = [], [], []
    last = len(data) - LENGTH + 1
    for a in range(0, last, PIECE):
        h = _BYTE[data[a : min(a + PIECE, last) + LENGTH - 1]]
        width = 1
        for m in _MULT:
            h = h[:-width] * m + h[width:]
            width *= 2
        h = mix(h)
        strings.append(h[:PIECE] if a + PIECE < last else h)
        v = h & ~_PLACE | np.arange(len(h), dtype=np.uint64)
        width = 1
        while width * 2 <= REACH:
            v = np.minimum(v[:-width], v[width:])
            width *= 2
        v = np.minimum(v[: len(v) - (REACH - width)], v[REACH - width :])
        values.append(v >> np.uint64(24))
        places.append((v & _PLACE).astype(np.int64) + a)
    return np.concatenate(values), np.concatenate(places), np.concatenate(strings)


def runs(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """The windows of texts in runs of the same seed.

    For each run: the text's number, its first window, the window after it, the
    seed's hash and the run's own. Texts are hashed end to end, windows over an end
    left out.
    """
    out = []
    a = 0
    while a < len(texts):
        b, held = a, 0
        while b < len(texts) and (held == 0 or held + len(texts[b]) <= PIECE):
            held += len(texts[b])
            b += 1
        out.append(_runs(texts[a:b], a))
        a = b
    return tuple(np.concatenate(x) for x in zip(*out)) if out else _runs([], 0)


def _runs(texts: list[bytes], number: int) -> tuple[np.ndarray, ...]:
    values, places, strings = seeds(np.frombuffer(b"".join(texts), np.uint8))
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    text = np.repeat(np.arange(len(texts)), sizes)[: len(values)]
    inside = np.arange(len(values)) + LENGTH <= (starts + sizes)[text]
    other = np.ones(len(values), bool)
    other[1:] = (places[1:] != places[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(inside & other)
    text = text[first]
    after = np.minimum(np.append(first[1:], len(values)), (starts + sizes)[text] - LENGTH + 1)
    # The seed, which is in all windows, lies between the first 32 bytes and the last, or over them.
    own = mix(strings[first] + (after - first).astype(np.uint64))
    own = mix(mix(own + strings[places[first]]) + strings[after - 1 + LENGTH - SEED])
    # Least hashes are small numbers; the product (a bijection) spreads them.
    return text + number, first - starts[text], after - starts[text], values[first] * _SPREAD & _SEED_BITS, own


def _member(some: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which values are among the sorted ``some``."""
    if not len(some):
        return np.zeros(len(values), bool)
    return some[np.minimum(np.searchsorted(some, values), len(some) - 1)] == values


# ---- a sort over blocks -------------------------------------------------------------
def _order(keys: np.ndarray) -> np.ndarray:
    """The order that sorts keys: by eight bytes first, and by the rest where those are equal."""
    if keys.dtype.kind != "S":
        return np.argsort(keys)
    width = keys.dtype.itemsize
    table = np.zeros((len(keys), -(-width // 8) * 8), np.uint8)
    table[:, :width] = np.frombuffer(keys.tobytes(), np.uint8).reshape(-1, width)
    columns = [c.astype(np.uint64) for c in table.view(">u8").T]
    order = np.argsort(columns[0])
    lead = columns[0][order]
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = lead[1:] == lead[:-1]
    tied = np.flatnonzero(same[1:] | same[:-1])
    if len(columns) > 1 and len(tied):
        some = order[tied]
        order[tied] = some[np.lexsort([c[some] for c in reversed(columns)])]
    return order


def _sorted_unique(keys: np.ndarray, values: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    order = _order(keys)
    keys = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    starts = np.flatnonzero(new)
    inverse = np.empty(len(keys), np.int64)
    inverse[order] = np.cumsum(new) - 1
    least = None if values is None else np.minimum.reduceat(values[order], starts) if len(starts) else np.empty(0, np.int64)
    return keys[starts], inverse, least


def _planes(keys: np.ndarray) -> tuple[str, int, bytes]:
    """Keys byte place by byte place, which packs well when they are sorted."""
    return keys.dtype.str, len(keys), np.ascontiguousarray(np.frombuffer(keys.tobytes(), np.uint8).reshape(len(keys), -1).T).tobytes()


def _keys(planes: tuple[str, int, bytes]) -> np.ndarray:
    kind, n, raw = planes
    return np.frombuffer(np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(-1, n).T).tobytes(), kind) if n else np.empty(0, kind)


def resolve(blocks: DataFrame, keys_of: Callable, answer_of: Callable, splitters: np.ndarray) -> DataFrame:
    """(block, found): for each block the answers to its keys, in order of its sorted distinct keys.

    ``keys_of(data)``: keys and values (or None) of a block. ``answer_of(keys, ranks,
    values)``: an answer for each of the distinct keys of a range, given what the
    blocks sent as ranks and values. Ranges are cut at ``splitters``.
    """

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for block, data in zip(pdf["block"], pdf["data"]):
                unique, _, values = _sorted_unique(*keys_of(_unpack(data)))
                cuts = np.concatenate([[0], np.searchsorted(unique, splitters), [len(unique)]])
                out = [(r, _pack((_planes(unique[a:b]), None if values is None else values[a:b]))) for r, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
                del unique, values
                yield pd.DataFrame({"range": pd.Series([x[0] for x in out], dtype="int64"), "block": block, "asked": pd.Series([x[1] for x in out], dtype=object)})
                give_back()

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        asked = [_unpack(x) for x in pdf["asked"]]
        ends = np.cumsum([k[1] for k, _ in asked])
        values = None if asked[0][1] is None else np.concatenate([v for _, v in asked])
        keys = np.concatenate([_keys(k) for k, _ in asked])
        del asked
        unique, ranks, _ = _sorted_unique(keys, None)
        del keys
        found = answer_of(unique, ranks, values)[ranks]
        out = pd.DataFrame({"block": pdf["block"], "range": pdf["range"], "found": [_pack((int(pdf["range"].iloc[0]), x)) for x in np.split(found, ends[:-1])]})
        del unique, ranks, values, found
        give_back()
        return out

    asked = blocks.mapInPandas(ask, "range bigint, block bigint, asked binary")
    return asked.groupBy("range").applyInPandas(answer, "block bigint, range bigint, found binary")


def _gathered(found: pd.DataFrame, ranked: bool = False) -> np.ndarray:
    """A block's answers in key order; ranks of a range follow those of the range before."""
    parts = sorted((_unpack(x) for x in found["found"]), key=lambda x: x[0])
    if not parts:
        return np.empty(0, np.int64)
    return np.concatenate([(x + (np.int64(r) << np.int64(RANK_BITS)) if ranked else x) for r, x in parts])


def _ranks(keys: np.ndarray, ranks: np.ndarray, values) -> np.ndarray:
    if len(keys) >> RANK_BITS:
        raise OverflowError("a range of the sort has more keys than names")
    return np.arange(len(keys), dtype=np.int64)


def _least(keys: np.ndarray, ranks: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = np.full(len(keys), NO_ID, np.int64)
    np.minimum.at(out, ranks, values)
    return out


def _sample(blocks: DataFrame, keys_of: Callable, ranges: int) -> np.ndarray:
    """Splitters for so many ranges: quantiles of keys drawn evenly from each block, as many as its share of the distinct keys, at most about ``SAMPLED`` in all."""
    if ranges < 2:
        return np.empty(0, "S1")
    each, full = min(MOST_DRAWN, max(1, SAMPLED // ranges)), CHUNK_BLOCK

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for block, data in zip(pdf["block"], pdf["data"]):
                if ranges > SAMPLED and (block >> PIECE_BITS) % (ranges // SAMPLED + 1):
                    continue
                some = _drawn(keys_of(data := _unpack(data))[0], sum(map(len, data["chunks"])) / full, each)
                if len(some):
                    yield pd.DataFrame({"width": [some.dtype.itemsize], "keys": [some.tobytes()]})

    got = blocks.mapInPandas(draw, "width int, keys binary").collect()
    if not got:
        return np.empty(0, "S1")
    keys = np.sort(np.frombuffer(b"".join(bytes(r["keys"]) for r in got), f"S{got[0].width}"))
    return np.unique(keys[[len(keys) * i // ranges for i in range(1, ranges)]])


def _drawn(keys: np.ndarray, share: float, each: int) -> np.ndarray:
    """Keys of a block from its least to its greatest, evenly: ``each`` for a full block (``share`` 1) of distinct ones.

    The ends count: keys above the last one drawn by every block would all be of one range,
    which grows with the input.
    """
    looked = keys[:: max(1, len(keys) // (each * 16))]
    unique = np.unique(looked)  # some of the places are enough, and no key counts twice
    if not len(unique):
        return unique
    n = min(len(unique), max(1, round(each * share * len(unique) / len(looked))))
    return unique[(2 * np.arange(n) + 1) * len(unique) // (2 * n)]


# ---- documents in blocks ---------------------------------------------------------------
def _doc_blocks(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """(block, data): the documents of each task in blocks; data is ids, rank ids and texts."""
    narrow = docs.select(
        docs[doc_id].cast("string").alias("name"),
        F.coalesce(docs[doc_id].cast("long"), F.lit(NO_ID)).alias("id"),
        docs[text].cast("string").alias("text"),
    )

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        base, n, held, rows = TaskContext.get().partitionId() << PIECE_BITS + TASK_BITS, 0, 0, []
        for pdf in batches:
            for name, i, t in zip(pdf["name"], pdf["id"], pdf["text"]):
                rows.append((name, i, t.encode() if t else b""))
                held += len(rows[-1][2])
                if held >= DOC_BLOCK:
                    yield pd.DataFrame({"block": [base + (n << PIECE_BITS)], "data": [_pack(rows)]})
                    n, held, rows = n + 1, 0, []
        if rows:
            yield pd.DataFrame({"block": [base + (n << PIECE_BITS)], "data": [_pack(rows)]})

    return narrow.mapInPandas(pack, "block bigint, data binary")


def _doc_seeds(rows: list) -> tuple[np.ndarray, np.ndarray]:
    text, _, _, hashes, _ = runs([t for _, _, t in rows])
    return _seeds_of(text, hashes)


def _seeds_of(text: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct seeds of a block's runs; the value is 1 for a seed of two documents or more, else 2."""
    order = np.argsort(hashes, kind="stable")  # texts stay in order
    text, hashes = text[order], hashes[order]
    new = np.ones(len(hashes), bool)
    new[1:] = hashes[1:] != hashes[:-1]
    again = np.zeros(len(hashes), bool)  # the same seed in another document
    again[1:] = ~new[1:] & (text[1:] != text[:-1])
    starts = np.flatnonzero(new)
    if not len(starts):
        return hashes, np.empty(0, np.int64)
    return hashes[starts], np.where(np.logical_or.reduceat(again, starts), 1, 2).astype(np.int64)


def _shared(keys: np.ndarray, ranks: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether a seed stands in two documents: of one block (value 1), or of two."""
    return (np.bincount(ranks, minlength=len(keys)) > 1) | (_least(keys, ranks, values) == 1)


def _joined(text: np.ndarray, first: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which runs are the first, and which the last, of neighbours in a text."""
    begins = np.ones(len(text), bool)
    begins[1:] = (text[1:] != text[:-1]) | (first[1:] != after[:-1])
    return np.flatnonzero(begins), np.flatnonzero(np.append(begins[1:], True)[: len(text)])


def _shared_runs(rows: list, found: np.ndarray) -> dict:
    """The runs of a block whose seeds stand in several documents, with their bytes.

    A run's bytes begin at ``at`` in ``bytes``, where neighbours overlap.
    """
    texts = [t for _, _, t in rows]
    text, first, after, hashes, own = runs(texts)
    known, _ = _seeds_of(text, hashes)
    keep = _member(known[found], hashes)
    text, first, after, hashes, own = (x[keep] for x in (text, first, after, hashes, own))
    begin, end = _joined(text, first, after)
    parts = [texts[p][a : b + LENGTH - 1] for p, a, b in zip(text[begin].tolist(), first[begin].tolist(), after[end].tolist())]
    sizes = np.array([len(x) for x in parts], np.int64)
    at = first + np.repeat(np.cumsum(sizes) - sizes - first[begin], end - begin + 1)
    return {"text": text, "first": first, "n": (after - first).astype(np.uint8), "seed": hashes, "own": own, "id": np.array([i for _, i, _ in rows], np.int64), "at": at, "bytes": b"".join(parts)}


def _run_keys(data: dict) -> tuple[np.ndarray, np.ndarray]:
    """Seed and name of each run, and its document."""
    return _as_keys(_big(data["seed"], 5), _big(data["own"], 8)), data["id"][data["text"]]


def _least_runs(keys: np.ndarray, ranks: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The least document of each run, and whether runs of its seed have different ones."""
    least = _least(keys, ranks, values)
    seed = np.frombuffer(keys.tobytes(), np.uint8).reshape(len(keys), -1)[:, :5]
    new = np.ones(len(keys), bool)
    new[1:] = (seed[1:] != seed[:-1]).any(axis=1)
    starts = np.flatnonzero(new)
    differ = np.minimum.reduceat(least, starts) < np.maximum.reduceat(least, starts)
    return np.stack([least, differ[np.cumsum(new) - 1]], axis=1)


def _settle(data: dict, found: np.ndarray) -> tuple[tuple[np.ndarray, ...], list[dict]]:
    """Spans (text, a, b) that go as whole runs, and pieces of what is left to the sort.

    A piece: chunks, for each its document, text and first window.
    """
    keys, ids = _run_keys(data)
    _, inverse, _ = _sorted_unique(keys, None)
    least, differ = found[inverse, 0], found[inverse, 1] > 0
    text, first, after = data["text"], data["first"], data["first"] + data["n"]
    gone = ids > least
    begin, end = _joined(text[gone], first[gone], after[gone])
    spans = (text[gone][begin], first[gone][begin], after[gone][end] + LENGTH - 1)
    left = differ & ~gone
    text, first, after, at = (x[left] for x in (text, first, after, data["at"]))
    begin, end = _joined(text, first, after)
    pieces, held = [], CHUNK_BLOCK
    for p, i, j, o in zip(text[begin].tolist(), first[begin].tolist(), after[end].tolist(), at[begin].tolist()):
        for a in range(i, j, CHUNK_BLOCK):  # a very long one in several, windows apart
            b = min(a + CHUNK_BLOCK, j)
            if held + (b - a) > CHUNK_BLOCK:
                pieces.append({"chunks": [], "least": [], "text": [], "first": []})
                held = 0
            piece = pieces[-1]
            piece["chunks"].append(data["bytes"][o + a - i : o + b - i + LENGTH - 1])
            piece["least"].append(int(data["id"][p]))
            piece["text"].append(p)
            piece["first"].append(a)
            held += b - a
    return spans, pieces


# ---- the suffix sort ---------------------------------------------------------------------
class _Flat:
    """The chunks of a block end to end, with the places that matter."""

    def __init__(self, data: dict):
        self.bytes = np.frombuffer(b"".join(data["chunks"]), np.uint8)
        sizes = np.array([len(c) for c in data["chunks"]], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        self.left = np.repeat(self.starts + sizes, sizes) - np.arange(len(self.bytes))  # bytes up to the chunk's end
        self.cls = (np.arange(len(self.bytes)) - np.repeat(self.starts, sizes)) % 3
        self.least = np.repeat(np.array(data["least"], np.int64), sizes)
        self.sizes = sizes

    def sample(self, length: int) -> np.ndarray:
        """Positions 1 and 2 mod 3 with so many bytes ahead."""
        return np.flatnonzero((self.cls > 0) & (self.left >= length))


def _big(x: np.ndarray, width: int) -> np.ndarray:
    """The last bytes of integers, the highest first."""
    return x.astype(">u8").view(np.uint8).reshape(len(x), 8)[:, 8 - width :]


def _as_keys(*columns: np.ndarray) -> np.ndarray:
    table = np.ascontiguousarray(np.concatenate([c if c.ndim == 2 else c[:, None] for c in columns], axis=1))
    return table.view(f"S{table.shape[1]}").ravel()


def _prefixes(data: dict) -> tuple[np.ndarray, None]:
    """The 27 bytes ahead of the sampled positions."""
    flat = _Flat(data)
    at = flat.sample(27)
    return _as_keys(np.lib.stride_tricks.sliding_window_view(flat.bytes, 27)[at] if len(at) else np.empty((0, 27), np.uint8)), None


def _cover_keys(data: dict) -> tuple[np.ndarray, np.ndarray]:
    """Both keys of each position with 50 bytes ahead, and its chunk's document."""
    flat = _Flat(data)
    byte, name = flat.bytes, np.zeros(len(flat.bytes), np.int64)
    name[flat.sample(27)] = data["names"]
    out, values = [], []
    for tag, classes, where in ((0, (0, 1), 1), (1, (0, 2), 2), (2, (1, 2), 0)):
        at = _cover_places(flat, classes)
        tags = np.full((len(at), 1), 65 + tag, np.uint8)
        near, far = _big(name[at + where], NAME), _big(name[at + where + 21], NAME)
        if where == 1:
            parts = (near, far, byte[at], byte[at + 49])
        elif where == 2:
            parts = (near, far, byte[at], byte[at + 1])
        else:
            parts = (near, far, byte[at + 48], byte[at + 49])
        out.append(_as_keys(tags, *parts))
        values.append(flat.least[at])
    return np.concatenate(out), np.concatenate(values)


def _cover_places(flat: _Flat, classes: tuple[int, int]) -> np.ndarray:
    return np.flatnonzero(np.isin(flat.cls, classes) & (flat.left >= LENGTH))


def _named(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Blocks with the names that the sort found for their sampled positions."""
    out = []
    for block, packed in zip(left["block"], left["data"]):
        data = _unpack(packed)
        _, inverse, _ = _sorted_unique(*_prefixes(data))
        out.append((block, _pack(data | {"names": _gathered(right, True)[inverse]})))
        give_back()
    return pd.DataFrame(out, columns=["block", "data"])


def _earlier(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """(block, spans): the spans of a block of the sort that an earlier document has, for its block of documents."""
    out = []
    for block, packed in zip(left["block"], left["data"]):
        data = _unpack(packed)
        flat = _Flat(data)
        _, inverse, _ = _sorted_unique(*_cover_keys(data))
        found = _gathered(right)[inverse]
        hit = np.zeros(len(flat.bytes), bool)
        base = 0
        for classes in ((0, 1), (0, 2), (1, 2)):
            at = _cover_places(flat, classes)
            hit[at] |= found[base : base + len(at)] < flat.least[at]
            base += len(at)
        at = np.flatnonzero(hit)
        chunk = np.searchsorted(flat.starts, at, "right") - 1
        begin, end = _joined(chunk, at, at + 1)
        text, first = np.array(data["text"], np.int64)[chunk[begin]], np.array(data["first"], np.int64)[chunk[begin]] - flat.starts[chunk[begin]]
        spans = (text, at[begin] + first, at[end] + first + LENGTH)
        out.append((block >> PIECE_BITS << PIECE_BITS, _pack(spans)))
        give_back()
    return pd.DataFrame(out, columns=["block", "spans"])


def earlier_spans(blocks: DataFrame, n_bytes: int) -> DataFrame:
    """(block, spans): what earlier documents have of the blocks' chunks. The suffix sort of the module's text; takes ``blocks`` over."""
    ranges = min(n_bytes // CHUNK_BLOCK + 1, 1 << 8 * NAME - RANK_BITS)
    found = resolve(blocks, _prefixes, _ranks, _sample(blocks, _prefixes, ranges))
    named = stage(blocks.groupBy("block").cogroup(found.groupBy("block")).applyInPandas(_named, "block bigint, data binary"), "named-blocks")
    found = resolve(named, _cover_keys, _least, _sample(named, _cover_keys, ranges))
    out = stage(named.groupBy("block").cogroup(found.groupBy("block")).applyInPandas(_earlier, "block bigint, spans binary"), "sorted-spans")
    discard(named)
    return out


# ---- the operator ---------------------------------------------------------------------------
def repeated_spans(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """The documents in blocks, and (block, spans): what earlier documents have of theirs, as arrays of text, begin and end."""
    ship(docs.sparkSession)
    blocks = stage(_doc_blocks(docs, text, doc_id), "document-blocks")
    size = docs.select(F.sum(F.octet_length(docs[text].cast("string")))).first()[0] or 0
    ranges = max(1, size // DOC_BLOCK)
    even = (np.arange(1, ranges, dtype=np.uint64) << np.uint64(40)) // np.uint64(ranges)
    marks = resolve(blocks, _doc_seeds, _shared, even)

    def shared(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for block, packed in zip(left["block"], left["data"]):
            out.append((block, _pack(_shared_runs(_unpack(packed), _gathered(right).astype(bool)))))
            give_back()
        return pd.DataFrame(out, columns=["block", "data"])

    def settle(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for block, packed in zip(left["block"], left["data"]):
            spans, pieces = _settle(_unpack(packed), _gathered(right).reshape(-1, 2))
            out.append((block, _pack(spans), None, 0))
            out.extend((block + n, None, _pack(piece), sum(map(len, piece["chunks"]))) for n, piece in enumerate(pieces))
            del spans, pieces
            give_back()
        return pd.DataFrame(out, columns=["block", "spans", "data", "size"])

    several = stage(blocks.groupBy("block").cogroup(marks.groupBy("block")).applyInPandas(shared, "block bigint, data binary"), "shared-runs")
    found = resolve(several, _run_keys, _least_runs, _as_keys(_big(even, 5), np.zeros((len(even), 8), np.uint8)))
    parts = several.groupBy("block").cogroup(found.groupBy("block")).applyInPandas(settle, "block bigint, spans binary, data binary, size bigint")
    parts = stage(parts, "settled-runs")
    discard(several)
    whole = parts.where("spans IS NOT NULL").select("block", "spans")
    open_runs = parts.where("data IS NOT NULL").select("block", "data")
    return blocks, whole.unionByName(earlier_spans(open_runs, parts.agg(F.sum("size")).first()[0] or 0))


def _removed(rows: list, hits: pd.DataFrame) -> list[list[tuple[int, int]]]:
    """The maximal removed runs of bytes of each document of a block."""
    out: list[list[tuple[int, int]]] = [[] for _ in rows]
    found = [_unpack(x) for x in hits["spans"]]
    if not found:
        return out
    text, begin, end = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((begin, text))
    for place, a, b in zip(text[order].tolist(), begin[order].tolist(), end[order].tolist()):
        merged = out[place]
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return out


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_bytes, spans (a, b), kept binary.

    ``spans`` are the maximal removed runs of bytes, ``kept`` the bytes that stay
    (which need not be whole characters). NULL is the empty text. Documents of
    one id do not remove each other; NULL ids count as the last. An empty table
    gives no rows; other columns are not read.
    """
    return _finish(docs, text, doc_id, "spans array<struct<a:bigint,b:bigint>>, kept binary", lambda spans, kept: ([{"a": a, "b": b} for a, b in spans], kept))


def repeat_digests(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """As :func:`remove_repeats`, with counts and a digest in place of spans and bytes."""
    return _finish(
        docs,
        text,
        doc_id,
        "n_removed bigint, n_spans bigint, kept_sha256 string",
        lambda spans, kept: (sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest()),
    )


def _finish(docs: DataFrame, text: str, doc_id: str, schema: str, shape: Callable) -> DataFrame:
    blocks, hits = repeated_spans(docs, text, doc_id)
    names = ["doc_id", "n_bytes", *[x.split(" ")[0].split(":")[0] for x in (schema.split(", ") if "<" not in schema else ["spans", "kept"])]]

    def keep(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for packed in left["data"]:
            rows = _unpack(packed)
            for (name, _, t), spans in zip(rows, _removed(rows, right)):
                parts, at = [], 0
                for a, b in spans:
                    parts.append(t[at:a])
                    at = b
                out.append((name, len(t), *shape(spans, b"".join([*parts, t[at:]]))))
            give_back()
        return pd.DataFrame(out, columns=names)

    joined = blocks.groupBy("block").cogroup(hits.groupBy("block")).applyInPandas(keep, f"doc_id string, n_bytes bigint, {schema}")
    return joined.withColumn("doc_id", F.col("doc_id").cast(docs.schema[doc_id].dataType))


def op5_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return repeat_digests(docs)
