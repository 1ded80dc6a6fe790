"""Session settings the operators rely on, and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# UTC makes "date of an instant" the same everywhere; duplicate keys inside one
# JSON object must not void the whole payload (the last one is kept).
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


#: The folders made in the innermost scope that owns them.
_OWNED: ContextVar[list[str] | None] = ContextVar("owned_folders", default=None)


CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def cleared_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs in this scope go with the end of each query, not when the driver collects its garbage."""
    before = spark.conf.get(CLEAN_UP)
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN_UP, before)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a working folder and what is in it; a Connect session leaves it to the cluster's clean-up."""
    try:
        jvm = spark._jvm
    except AttributeError:
        return
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def owned_folders(spark: SparkSession) -> Iterator[None]:
    """A scope that owns the working folders made in it: they go when it ends.

    What is computed from staged rows must be written before that. A scope inside
    another owns its own folders only.
    """
    mine: list[str] = []
    token = _OWNED.set(mine)
    try:
        yield
    finally:
        _OWNED.reset(token)
        for path in mine:
            remove_folder(spark, path)


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new path below the cluster's shared folder (``spark.checkpoint.dir``).

    A machine-local folder is used only in a local session that names none. On a
    cluster every executor would write to its own disk, so there it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        try:
            context = spark.sparkContext
            set_there = context._jsc.sc().getCheckpointDir()
            base, local = set_there.get() if set_there.isDefined() else None, re.fullmatch(r"local(\[[^-]*\])?", context.master) is not None
        except AttributeError:  # a Connect session has no context
            local = False
        if not base:
            if not local:
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            base = tempfile.mkdtemp(prefix="histflow-")
    path = f"{base.rstrip('/')}/histflow/{purpose}-{uuid.uuid4().hex}"
    if (owner := _OWNED.get()) is not None:
        owner.append(path)
    return path
