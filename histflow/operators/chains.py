"""Version chains: several versions of a key in one batch, late ones included.

A history is read as events on each key's time line: a version begins, or ends with
nothing behind it. A batch adds beginnings anywhere. On the merged line, beginnings that
repeat the content before them are dropped (gaps and islands), and every version that
is left ends where the next event stands (``lead`` over key and start). So a late row splits
the version it falls into, two rows of a batch follow each other, and a row that says what
was known already changes nothing.

Only keys of the batch take part; the versions of others stay where they are.

No key has to fit into a task. The events are range-partitioned by key and time, so a key
with a large share of them lies across several ranges; what a range needs from its
neighbours, the content before its first event of a key and the beginning behind its
last, is taken from one row per key and range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from histflow.functions.scalar import AsOf, as_instant, content_digest, open_end
from histflow.operators.history import (
    ACTIVE,
    CLOSED,
    History,
    comparable_source,
    known,
    latest_keyed,
    new_version_values,
)
from histflow.operators.spread import spread_join
from histflow.sources.tables import stage

# Kinds of events; where several stand at one time the highest counts.
_END, _STORED, _ARRIVED = 0, 1, 2
_AT, _KIND, _CONTENT, _ROW, _SLICE = "__at", "__kind", "__content", "__row", "__slice"


def _stored_events(target: DataFrame, history: History) -> DataFrame:
    """A beginning for each version, and an end where it is closed."""
    start, end = F.col(history.start), F.col(history.end)
    open_ended = end.isNull() | (end == open_end(target.schema[history.end].dataType))
    begins = F.struct(
        start.alias("at"), F.lit(_STORED).alias("kind"), content_digest(history.watched()).alias("content"), F.struct(*target.columns).alias("row")
    )
    ends = F.struct(
        end.cast(target.schema[history.start].dataType).alias("at"),
        F.lit(_END).alias("kind"),
        F.lit(None).cast("string").alias("content"),
        F.lit(None).cast(target.schema).alias("row"),
    )
    events = F.when(open_ended, F.array(begins)).otherwise(F.array(begins, ends))
    rows = target.select(*history.keys, F.explode(events).alias("e"))
    return rows.select(*history.keys, F.col("e.at").alias(_AT), F.col("e.kind").alias(_KIND), F.col("e.content").alias(_CONTENT), F.col("e.row").alias(_ROW))


def _new_rows(source: DataFrame, target: DataFrame, history: History) -> DataFrame:
    """Source rows as open versions from their own time on, with it and their content."""
    available = {c: F.col(c) for c in source.columns if c != _AT}
    row = new_version_values(target.schema, {**available, **history.on_insert}, history, F.col(_AT))
    keys = [F.col(k).cast(target.schema[k].dataType).alias(k) for k in history.keys]
    return source.select(
        *keys,
        _AT,
        F.lit(_ARRIVED).alias(_KIND),
        content_digest(history.watched()).alias(_CONTENT),
        F.struct(*[c.alias(name) for name, c in row.items()]).alias(_ROW),
    )


def _one_event_at_a_time(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of the events at one time the one that counts; a stored version with the same content stays itself."""
    line = [_SLICE, *keys, _AT]
    strongest = Window.partitionBy(*line).orderBy(F.col(_KIND).desc(), F.col(_CONTENT).desc())
    counts = F.first(_CONTENT).over(strongest)
    chosen = events.withColumn("__counts", counts).withColumn("__same", F.col(_CONTENT).eqNullSafe(F.col("__counts")))
    order = Window.partitionBy(*line).orderBy(F.col("__same").desc(), _KIND, _CONTENT)
    return chosen.withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n", "__counts", "__same")


def _from_other_slices(df: DataFrame, keys: Sequence[str], edge: Column, value: str, backwards: bool, name: str) -> DataFrame:
    """``df`` with ``value`` of the nearest row before (behind) in another slice of the key.

    ``edge`` marks each slice's last (first) row of a key: one row per key and slice moves.
    """
    edges = df.where(edge).select(_SLICE, *keys, F.col(value).alias("__value"))
    order = F.col(_SLICE).desc() if backwards else F.col(_SLICE)
    carried = edges.withColumn(name, F.lag("__value").over(Window.partitionBy(*keys).orderBy(order)))
    return df.join(carried.drop("__value"), [_SLICE, *keys], "left")


def chain_of(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The beginnings that change something, with the time of the next event as ``__until`` (NULL: none).

    ``events`` are staged and carry the number of their range in ``__slice``.
    """
    line = Window.partitionBy(_SLICE, *keys).orderBy(_AT)
    # One exchange serves all windows below.
    events = _one_event_at_a_time(events.repartition(_SLICE, *keys), keys)
    events = events.withColumn("__first", F.lag(_AT).over(line).isNull()).withColumn("__last", F.lead(_AT).over(line).isNull())
    events = events.withColumn("__before", F.lag(_CONTENT).over(line))
    events = _from_other_slices(events, keys, F.col("__last"), _CONTENT, False, "__carried")
    before = F.when(F.col("__first"), F.col("__carried")).otherwise(F.col("__before"))
    heads = events.where(~F.col(_CONTENT).eqNullSafe(before)).select(_SLICE, *keys, _AT, _KIND, _CONTENT, _ROW)
    heads = heads.withColumn("__next", F.lead(_AT).over(line)).withColumn("__first", F.lag(_AT).over(line).isNull())
    heads = _from_other_slices(heads, keys, F.col("__first"), _AT, True, "__carried")
    return heads.withColumn("__until", F.coalesce("__next", "__carried")).where(F.col(_CONTENT).isNotNull())


def _as_rows(heads: DataFrame, target: DataFrame, history: History) -> DataFrame:
    """The versions with their ends; stored ones that keep their end are as they were."""
    flat = heads.select(f"{_ROW}.*", _KIND, "__until")
    end_type = target.schema[history.end].dataType
    ends = F.col("__until").isNotNull()
    end = F.coalesce(F.col("__until").cast(end_type), open_end(end_type))
    was_open = F.col(history.end).isNull() | (F.col(history.end) == open_end(end_type))
    same_end = F.when(ends, F.col(history.end).eqNullSafe(end)).otherwise(was_open)
    changed = (F.col(_KIND) == _ARRIVED) | ~same_end
    values = {history.active: F.when(ends, CLOSED).otherwise(ACTIVE), history.end: end}
    for name, closing in history.on_close.items():
        # A stored version that is open again gets the value of a new one, where that says something.
        reopened = history.on_insert.get(name)
        again = F.col(name) if reopened is None else F.when(F.col(_KIND) == _STORED, reopened).otherwise(F.col(name))
        values[name] = F.when(ends, closing).otherwise(again)
    return flat.select(
        *[
            F.when(changed, values[f.name].cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name) if f.name in values else F.col(f.name)
            for f in target.schema.fields
        ]
    )


def chain_apply(
    target: DataFrame, source: DataFrame, history: History, effective: str, as_of: AsOf = None, order_by: Sequence[str] = ()
) -> DataFrame:
    """The whole history after a batch whose rows say since when they hold (``effective``).

    A key may have any number of rows, before, between or behind its stored versions. Of
    several at one time the one with the highest ``order_by`` counts (ties: by content); it
    replaces a stored version that began at that time, unless their content is the same.
    A version ends where the next one begins. A gap between stored versions stays a gap, but
    for what arrives in it: that lasts to the next beginning.

    A row without an effective time holds from ``as_of`` on. NULL keys match nothing: such source
    rows are open versions of their own, such target rows stay. Stored versions of a key
    must not overlap.
    """
    if not history.watch and not history.documents:
        raise ValueError("a chain needs columns to watch")
    if history.end_rule != "as_of":
        raise ValueError("a chain's versions end where the next one begins")
    keys = list(history.keys)
    moment = target.schema[history.start].dataType
    timed = source.withColumn(_AT, F.coalesce(F.col(effective), as_instant(as_of)).cast(moment))
    arrived = latest_keyed(comparable_source(timed, target.schema, history), [*keys, _AT], order_by)
    batch = stage(_new_rows(arrived, target, history), "chain-batch")
    touched = batch.select(*keys)
    concerned = spread_join(target.where(known(keys)), touched, keys, "left_semi")
    events = _stored_events(concerned, history).unionByName(batch)
    ranged = events.repartitionByRange(*keys, _AT).withColumn(_SLICE, F.spark_partition_id())
    # A slice's number is a fact of this run: it is written before it is used.
    chained = _as_rows(chain_of(stage(ranged, "chain-events"), keys), target, history)
    unkeyed = _new_rows(timed.where(~known(keys)), target, history).select(f"{_ROW}.*")
    return spread_join(target, touched, keys, "left_anti").unionByName(chained).unionByName(unkeyed)
