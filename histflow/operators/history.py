"""Current (SCD1) and versioned (SCD2) tables as snapshot operators.

Parquet tables have no row-level MERGE, so each operator returns rows. Closed
versions never take part in a join: only the active slice is shuffled, and with
a table partitioned by its active flag only that slice is rewritten.

Keys are compared with SQL equality: a NULL key matches nothing, so such a
source row is a new version and such a target row stays as it is.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from histflow.functions.documents import document_or_empty, documents_differ
from histflow.functions.scalar import AsOf, as_instant, content_digest, open_end, previous_midnight
from histflow.operators.spread import spread_join

CLOSED, ACTIVE = "N", "Y"


@dataclass(frozen=True)
class History:
    """How a history table names its columns and detects a change.

    keys        business key (equality)
    watch       plain columns whose difference is a change
    documents   JSON text columns to watch; NULL and ``{}`` are the same
    on_close    further columns set when a version is closed
    on_insert   further columns of a new version, from the row it is made of
    end_rule    ``as_of``: a version ends when the next one starts;
                ``previous_day``: it ends at midnight of the day before
    null_safe   NULL against a value is a change (False: it is not)
    """

    keys: Sequence[str]
    watch: Sequence[str] = ()
    documents: Sequence[str] = ()
    active: str = "active_record_ind"
    start: str = "record_start_dts"
    end: str = "record_end_dts"
    on_close: Mapping[str, Column] = field(default_factory=dict)
    on_insert: Mapping[str, Column] = field(default_factory=dict)
    end_rule: str = "as_of"
    null_safe: bool = True

    def watched(self) -> list[Column]:
        return [F.col(c) for c in self.watch] + [document_or_empty(c) for c in self.documents]


def known(keys: Sequence[str]) -> Column:
    """All key columns are present."""
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


# --- single match ----------------------------------------------------------------------


def _orderable(data_type: T.DataType) -> bool:
    return not isinstance(data_type, (T.MapType, T.VariantType, T.StructType, T.ArrayType))


def latest_keyed(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """``latest_per_key`` of the rows whose key is known, without the others.

    ``row_number`` = 1 is cut per task before the shuffle (a window group
    limit), so the copies of a hot key do not travel.
    """
    rest = [f.name for f in df.schema.fields if f.name not in [*keys, *order_by] and _orderable(f.dataType)]
    ordering = [F.col(c).desc_nulls_last() for c in order_by] + [F.xxhash64(*rest).desc()] * bool(rest)
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*ordering))
    keyed = df.where(known(keys)).withColumn("__position", position)
    return keyed.where(F.col("__position") == 1).drop("__position")


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row with the highest ``order_by`` of each key; ties are broken by content.

    Rows with a NULL key match nothing and are all kept; they are a second read
    of ``df``, so stage it first if it is costly.
    """
    return latest_keyed(df, keys, order_by).unionByName(df.where(~known(keys)))


def assert_single(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with known keys only, folded per key; the job fails on a second row.

    Folding is a partial aggregation, so a repeated key is reduced where it is
    read. The result is already partitioned by the keys: a join on them does not
    shuffle it again.
    """
    rest = [c for c in df.columns if c not in keys]
    folded = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__rows"),
        F.first(F.struct(*[F.col(c) for c in rest]) if rest else F.lit(True)).alias("__row"),
    )
    message = F.concat(F.lit("several source rows for key "), F.to_json(F.struct(*keys)))
    once = folded.where(F.assert_true(F.col("__rows") == 1, message).isNull())
    return once.select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns])


def assert_single_match(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows; the job fails if a key occurs twice (NULL is no key)."""
    return assert_single(df.where(known(keys)), keys).unionByName(df.where(~known(keys)))


# --- pieces ----------------------------------------------------------------------------


def closing_values(target: DataFrame, history: History, as_of: Column) -> dict[str, Column]:
    end_type = target.schema[history.end].dataType
    if history.end_rule == "previous_day":
        end = previous_midnight(as_of, end_type)
    else:
        end = as_of.cast(end_type)
    return {history.active: F.lit(CLOSED), history.end: end, **history.on_close}


def new_version_values(schema: T.StructType, available: Mapping[str, Column], history: History, as_of: Column):
    """Expressions for one new row; what nobody provides is a typed NULL."""
    values = {
        **available,
        history.active: F.lit(ACTIVE),
        history.start: as_of,
        history.end: open_end(schema[history.end].dataType),
    }
    return {f.name: values.get(f.name, F.lit(None)).cast(f.dataType) for f in schema.fields}


def new_versions(source: DataFrame, schema: T.StructType, history: History, as_of: AsOf) -> DataFrame:
    """Source rows in the shape of the history table, active and open-ended."""
    as_of = as_instant(as_of)
    columns = {c: F.col(c) for c in source.columns}
    row = new_version_values(schema, {**columns, **history.on_insert}, history, as_of)
    return source.select(*[c.alias(name) for name, c in row.items()])


def active_rows(target: DataFrame, history: History) -> DataFrame:
    return target.where(F.col(history.active) == ACTIVE)


def closed_rows(target: DataFrame, history: History) -> DataFrame:
    return target.where(~F.col(history.active).eqNullSafe(ACTIVE))


def comparable_source(source: DataFrame, schema: T.StructType, history: History) -> DataFrame:
    """The source with its watched columns in the target's types, so that values are compared."""
    types = {f.name: f.dataType for f in schema.fields}
    return source.withColumns({c: F.col(c).cast(types[c]) for c in history.watch if c in types and source.schema[c].dataType != types[c]})


def differs(history: History, ours: str = "", theirs: str = "") -> Column:
    """Whether the watched contents of two sides, told apart by prefixes, differ."""
    pairs = [(F.col(f"{ours}{c}"), F.col(f"{theirs}{c}")) for c in history.watch]
    if history.null_safe:
        found = [~a.eqNullSafe(b) for a, b in pairs]
    else:
        found = [F.coalesce(a != b, F.lit(False)) for a, b in pairs]
    found += [documents_differ(f"{ours}{c}", f"{theirs}{c}") for c in history.documents]
    return reduce(lambda a, b: a | b, found, F.lit(False))


# --- expire ------------------------------------------------------------------------------


def expire(
    target: DataFrame,
    source: DataFrame,
    history: History,
    as_of: AsOf,
) -> DataFrame:
    """Close the active rows matched by the source; all other rows unchanged.

    With nothing to watch every match closes. Otherwise a row closes if some
    source row of its key has another content. The source is reduced to one row
    per key before it is shuffled: the least and greatest content digest say
    whether a different one exists.
    """
    as_of = as_instant(as_of)
    source = comparable_source(source, target.schema, history)
    keys, watched = list(history.keys), history.watched()
    active = active_rows(target, history)
    if not watched:
        seen = source.select(*keys).distinct().withColumn("__close", F.lit(True))
        close = F.col("__close")
    else:
        # one digest for the whole content, or column by column where a NULL
        # on either side must not count as a difference
        contents = [content_digest(watched)] if history.null_safe else watched
        bounds = [
            x
            for i, c in enumerate(contents)
            for x in (F.min(c).alias(f"__least{i}"), F.max(c).alias(f"__most{i}"))
        ]
        seen = source.groupBy(*keys).agg(*bounds)
        differs = [
            F.coalesce((c != F.col(f"__least{i}")) | (c != F.col(f"__most{i}")), F.lit(False))
            for i, c in enumerate(contents)
        ]
        close = reduce(lambda a, b: a | b, differs)
    joined = spread_join(active, seen, keys, "left")
    close = F.coalesce(close, F.lit(False))
    closing = closing_values(target, history, as_of)
    touched = joined.select(
        *[
            F.when(close, closing[f.name].cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name)
            if f.name in closing
            else F.col(f.name)
            for f in target.schema.fields
        ]
    )
    return closed_rows(target, history).unionByName(touched)


# --- insert --------------------------------------------------------------------------------


def insert_new_or_changed(target: DataFrame, source: DataFrame, history: History, as_of: AsOf) -> DataFrame:
    """New versions for source rows no active row already shows.

    The target may be the table before or after ``expire``: an active row of the
    key with the source's content is what counts. One anti join on the key, with
    the content as its residual condition.
    """
    as_of = as_instant(as_of)
    keys = list(history.keys)
    compared = [*history.watch, *history.documents]
    shown = active_rows(target, history).select(*[F.col(c).alias(f"__t_{c}") for c in dict.fromkeys([*keys, *compared])])
    typed = comparable_source(source, target.schema, history)
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__t_{k}") for k in keys])
    missing = typed.join(shown, same & ~differs(history, "__t_", ""), "left_anti")
    return new_versions(missing, target.schema, history, as_of)


def scd_actions(source: DataFrame) -> DataFrame:
    """Every source row twice, tagged EXPIRE and INSERT, from one pass."""
    action = F.explode(F.array(F.lit("EXPIRE"), F.lit("INSERT"))).alias("action_type")
    return source.select(action, "*")


# --- merges ----------------------------------------------------------------------------------


def merge_active(active: DataFrame, source: DataFrame, history: History, as_of: AsOf) -> DataFrame:
    """Merge one source batch into the active slice.

    Returns the slice's rows, untouched or closed, and the new versions. The source
    has one row per key (checked). The slice is joined to it from the left, so a
    small batch is broadcast and the slice stays where it is; the new versions come
    from an anti join of the batch. A key may have several active rows: each that
    differs is closed, and one new version is made unless one shows the content.
    """
    as_of = as_instant(as_of)
    schema, keys = active.schema, list(history.keys)
    watched = list(dict.fromkeys([*history.watch, *history.documents]))
    if not history.on_insert:  # which may read any column; else only the table's own need to move
        wanted = {c.lower() for c in [*schema.names, *keys, *watched]}
        source = source.select(*[F.col(f"`{c}`") for c in source.columns if c.lower() in wanted])
    checked = comparable_source(assert_single(source.where(known(keys)), keys), schema, history)
    batch = checked.select(
        *[F.col(k).alias(f"__s_{k}") for k in keys],
        *[F.col(c).alias(f"__s_{c}") for c in watched if c not in keys],
        F.lit(True).alias("__in_source"),
    )
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__s_{k}") for k in keys])
    closing = closing_values(active, history, as_of)
    changed = F.col("__in_source").isNotNull() & differs(history, "", "__s_")
    touched = active.join(batch, on, "left").withColumn("__changed", changed)
    touched = touched.select(
        *[
            F.when(F.col("__changed"), closing[f.name].cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name)
            if f.name in closing
            else F.col(f.name)
            for f in schema.fields
        ]
    )
    # NULL keys match nothing: such source rows are new versions as they are
    unkeyed = new_versions(source.where(~known(keys)), schema, history, as_of)
    return touched.unionByName(insert_new_or_changed(active, checked, history, as_of)).unionByName(unkeyed)


def scd2_apply(
    target: DataFrame,
    source: DataFrame,
    history: History,
    as_of: AsOf,
    insert: str = "new_or_changed",
) -> DataFrame:
    """The whole history table after one batch.

    ``new_or_changed``: a second identical run changes nothing.
    ``always``: changed rows are closed and every source row is inserted,
    changed or not.
    """
    as_of = as_instant(as_of)
    if insert == "always":
        return expire(target, source, history, as_of).unionByName(
            new_versions(source, target.schema, history, as_of)
        )
    if insert != "new_or_changed":
        raise ValueError(f"unknown insert mode {insert!r}")
    merged = merge_active(active_rows(target, history), source, history, as_of)
    return closed_rows(target, history).unionByName(merged)


def scd1_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The current table after one batch: the source wins, nothing is deleted.

    Columns the source does not have keep the target's value.
    """
    keys = list(keys)
    checked = assert_single(source.where(known(keys)), keys)
    given = [c for c in target.columns if c in source.columns]
    batch = checked.select(*[F.col(c).alias(f"__s_{c}") for c in dict.fromkeys([*keys, *given])], F.lit(True).alias("__in_source"))
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__s_{k}") for k in keys])
    in_source = F.col("__in_source").isNotNull()
    updated = target.join(batch, on, "left").select(
        *[
            F.when(in_source, F.col(f"__s_{f.name}").cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name)
            if f.name in given
            else F.col(f.name)
            for f in target.schema.fields
        ]
    )
    there = target.select(*[F.col(k).alias(f"__t_{k}") for k in keys])
    absent = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__t_{k}") for k in keys])
    added = checked.join(there, absent, "left_anti").unionByName(source.where(~known(keys))).select(
        *[(F.col(f.name) if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name) for f in target.schema.fields]
    )
    return updated.unionByName(added)


# --- source flags ----------------------------------------------------------------------------


def mark_processed(
    source: DataFrame,
    reached: DataFrame,
    on: Mapping[str, str],
    flag: str = "indicator_flag",
    pending: str = "N",
    done: str = "Y",
) -> DataFrame:
    """Flip the flag of pending source rows whose key reached the target.

    ``on`` maps source key columns to the columns of ``reached``. Only pending
    rows are joined; the others pass by.
    """
    seen = (
        reached.select(*[F.col(theirs).alias(ours) for ours, theirs in on.items()])
        .distinct()
        .withColumn("__reached", F.lit(True))
    )
    waiting = source.where(F.col(flag) == pending)
    joined = spread_join(waiting, seen, list(on), "left")
    flipped = F.when(F.col("__reached").isNotNull(), F.lit(done)).otherwise(F.col(flag))
    marked = joined.select(*[flipped.alias(c) if c == flag else F.col(c) for c in source.columns])
    return source.where(~F.col(flag).eqNullSafe(pending)).unionByName(marked)
