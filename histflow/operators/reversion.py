"""New versions of active rows when their child collections arrive."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from histflow import fixed_values as fv
from histflow.functions.documents import document, json_subtree
from histflow.functions.scalar import AsOf, as_instant
from histflow.operators.history import (
    History,
    active_rows,
    assert_single,
    closed_rows,
    closing_values,
    expire,
    latest_keyed,
    new_version_values,
    new_versions,
)
from histflow.operators.spread import spread_join


def json_children(
    df: DataFrame, payload: str, children: Mapping[str, str] = fv.CHILDREN, keep: Sequence[str] = ()
) -> DataFrame:
    """Child collections of payload element 0, one JSON text column each.

    An absent child is NULL; a present JSON null is the text ``null``.
    """
    parsed = df.select(*keep, document(payload).alias("__document"))
    return parsed.select(
        *keep, *[json_subtree("__document", f"$[0].{name}").alias(column) for name, column in children.items()]
    )


def children_of_groups(
    configurations: DataFrame,
    children: DataFrame,
    group: str,
    payload: str,
    order_by: Sequence[str] = (),
    columns: Mapping[str, str] = fv.CHILDREN,
) -> DataFrame:
    """One row of child documents per group present in both sources.

    Several child rows of a group are an error, unless ``order_by`` says which
    one is the latest. The configuration side is only tested for presence, so
    its repeated rows do not multiply anything.
    """
    groups = configurations.select(group).distinct()
    if order_by:
        one = latest_keyed(children, [group], order_by).join(groups, group, "left_semi")
    else:
        one = assert_single(children.join(groups, group, "left_semi"), [group])
    return json_children(one, payload, columns, keep=[group])


def reversion_rows(
    target: DataFrame,
    documents: DataFrame,
    history: History,
    group: str,
    as_of: AsOf,
) -> DataFrame:
    """New versions of the active rows of the given groups, with the children.

    Everything else is copied from the active row; ids, times and status come
    from ``history``.
    """
    as_of = as_instant(as_of)
    fresh = [c for c in documents.columns if c != group]
    active = active_rows(target, history)
    carried = active.select(*[c for c in active.columns if c not in fresh])
    joined = spread_join(carried, documents, [group], "inner")
    return new_versions(joined, target.schema, history, as_of)


def reversion_expire(
    target: DataFrame, documents: DataFrame, history: History, group: str, as_of: AsOf
) -> DataFrame:
    """Close exactly the active rows that get a new version."""
    as_of = as_instant(as_of)
    by_group = History(
        keys=[group],
        active=history.active,
        start=history.start,
        end=history.end,
        on_close=history.on_close,
        end_rule=history.end_rule,
    )
    return expire(target, documents, by_group, as_of)


def reversion_with_children(
    target: DataFrame,
    documents: DataFrame,
    history: History,
    group: str,
    as_of: AsOf,
) -> DataFrame:
    """The whole table after a re-version: closed rows, old actives, new rows.

    One join serves both the closing and the new versions.
    """
    as_of = as_instant(as_of)
    fresh = [c for c in documents.columns if c != group]
    active = active_rows(target, history)
    renamed = documents.select(
        group, *[F.col(c).alias(f"__new_{c}") for c in fresh], F.lit(True).alias("__arrived")
    )
    joined = spread_join(active, renamed, [group], "left")
    arrived = F.col("__arrived").isNotNull()
    parts = F.when(arrived, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    out = joined.withColumn("__part", F.explode(parts))

    closing = closing_values(target, history, as_of)
    available = {c: F.col(c) for c in active.columns}
    available.update({c: F.col(f"__new_{c}") for c in fresh})
    available.update(history.on_insert)
    new = new_version_values(target.schema, available, history, as_of)
    columns = []
    for f in target.schema.fields:
        old = F.col(f.name)
        if f.name in closing:
            old = F.when(arrived, closing[f.name].cast(f.dataType)).otherwise(old)
        columns.append(F.when(F.col("__part") == 0, old).otherwise(new[f.name]).alias(f.name))
    return closed_rows(target, history).unionByName(out.select(*columns))
