"""What the corpus operators share: words, hashes, staging."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from histflow.session import remove_folder, work_folder

# A word is a run of ASCII letters or digits and of all characters beyond ASCII.
_TABLE = bytes(
    (b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32)
    for b in range(256)
)
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def lower_words(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8, with A-Z in lower case; none for NULL."""
    return text.encode().translate(_TABLE).split() if text else []


CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read again.

    Whatever is computed twice from it, or computed again after a lost
    executor, then starts from the same rows. The shuffle files of the write are of
    no more use, and go with its end.
    """
    spark: SparkSession = df.sparkSession
    path = work_folder(spark, purpose)
    before = spark.conf.get(CLEAN_UP)
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_folder = path
    return out


def discard(*staged: DataFrame) -> None:
    """Delete staged rows that nothing is computed from any more: what was made of them is staged itself."""
    for df in staged:
        remove_folder(df.sparkSession, df.staged_folder)


#: Rows that a Python task gets at a time.
BATCH_ROWS = 2000


def ship(spark: SparkSession) -> None:
    """Ready a session for Python tasks over texts.

    Tasks get this package (the archive is made on the driver, and Spark serves
    it), and rows in batches of ``BATCH_ROWS``, as texts may be long.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    context = spark.sparkContext
    if getattr(context, "_histflow_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root, name = os.path.split(package)
    folder = tempfile.mkdtemp()
    context.addPyFile(shutil.make_archive(os.path.join(folder, name), "zip", root, name))
    context._histflow_shipped = True


def give_back() -> None:
    """Return a task's freed memory to the system: Python workers live on, and further stages share them."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim is not None:
        trim(0)


def frugal(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task over batches that gives its memory back at its end."""

    def run(batches: Iterator) -> Iterator:
        yield from task(batches)
        give_back()

    return run


# ---- hashes of word windows ---------------------------------------------------
_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_P = 0x9E3779B97F4A7C15
_P_INV = pow(_P, -1, 2**64)
_POW = np.ones(1, np.uint64)
_INV = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POW, _INV
    if len(_POW) < n:
        size = 1 << int(n - 1).bit_length()
        power, inverse = np.full(size, _P, np.uint64), np.full(size, _P_INV, np.uint64)
        power[0] = inverse[0] = 1
        _POW, _INV = np.cumprod(power, dtype=np.uint64), np.cumprod(inverse, dtype=np.uint64)
    return _POW, _INV


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Words taken at a time, so that a very long text needs no more memory.
PIECE = 1 << 17


def shingle_hashes(words: list[bytes], k: int) -> np.ndarray:
    """A 64-bit hash for each run of ``k`` words, in order.

    Fewer words, but not none, make one shingle of all words.
    """
    if not words:
        return np.empty(0, np.uint64)
    k = min(k, len(words))
    last = len(words) - k + 1
    return np.concatenate([_piece(words[i : min(i + PIECE, last) + k - 1], k) for i in range(0, last, PIECE)])


def _piece(words: list[bytes], k: int) -> np.ndarray:
    joined = np.frombuffer(b" ".join(words) + b" ", np.uint8)
    power, inverse = _powers(len(joined) + 1)
    sums = np.zeros(len(joined) + 1, np.uint64)
    np.cumsum(_BYTE[joined] * power[: len(joined)], out=sums[1:])
    ends = np.flatnonzero(joined == 32) + 1
    starts = np.concatenate([[0], ends[:-1]])
    starts, ends = starts[: len(ends) - k + 1], ends[k - 1 :]
    return mix((sums[ends] - sums[starts]) * inverse[starts])
