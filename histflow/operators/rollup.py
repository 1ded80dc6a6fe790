"""Attribute lists: JSON array -> one document per category -> one wide row.

The payload is read and parsed once. An entity that arrives with one payload is rolled up
inside its row: the array's elements are read, sorted, reduced and written as documents
without ever becoming rows. Only entities with several payloads are merged. Their
attributes are first reduced per (entity, category, key), with partial aggregation before
the shuffle, so the copies of a hot entity are merged where they are read and its attributes
are spread over many tasks; then that reduced set, the content of the resulting documents,
is brought together per entity. Where these entities are many, each of the steps is staged, so
that the shuffle files of one are gone when the next begins.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from histflow import fixed_values as fv
from histflow.functions.documents import json_elements, json_member, json_object, json_quote, scalar_only, with_scalars
from histflow.functions.scalar import clean_key, decode_ampersand, split_list, underscore_spaces
from histflow.operators.spread import spread_join
from histflow.sources.tables import discard, stage

_ORDER, _CATEGORY, _KEY, _RAW, _MERGED = "__order", "__category", "__key", "__raw", "__merged"

#: So many entities with several payloads are few: their ids are broadcast, and merging them needs no staged steps.
FEW = 1_000


def json_array_rows(df: DataFrame, payload: str, keep: Sequence[str]) -> DataFrame:
    """One row per array element: ``keep`` columns, ``pos``, ``element``.

    A payload that is NULL, empty, bad text or not an array gives no row.
    """
    return df.select(*keep, F.posexplode(json_elements(payload)).alias("pos", "element"))


def attribute_rows(df: DataFrame, payload: str, keep: Sequence[str]) -> DataFrame:
    """Element rows with the decoded category, the key and the raw value."""
    rows = with_scalars(
        json_array_rows(df, payload, keep),
        "element",
        {"category": fv.CATEGORY_PATH, "key": fv.NAME_PATH, "raw": fv.VALUE_PATH},
    )
    return rows.withColumn("category", decode_ampersand("category"))


# --- value rules: (key, raw text) -> JSON text ---------------------------------------


def separated_values(key: Column, raw: Column) -> Column:
    """Text with ``;`` is a list; NULL is JSON null; other text is a string."""
    return F.when(raw.contains(";"), F.to_json(split_list(raw))).otherwise(json_quote(raw))


def listed_keys_values(list_keys: Sequence[str]):
    """Only the named keys are lists (spaces in elements become ``_``)."""

    def rule(key: Column, raw: Column) -> Column:
        elements = F.to_json(F.transform(split_list(raw), underscore_spaces))
        return F.when(key.isin(*list_keys), F.coalesce(elements, F.lit("[]"))).otherwise(json_quote(raw))

    return rule


def kv_string_agg(attributes: DataFrame, ids: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``"key":value`` texts joined in order, one per entity and category."""
    value = separated_values(F.col("key"), F.col("raw"))
    pairs = attributes.select(
        *ids, "category", *order, F.concat(json_quote("key"), F.lit(":"), value).alias("pair")
    ).where(F.col("key").isNotNull())
    within = ", ".join(f"`{c}`" for c in order)
    return pairs.groupBy(*ids, "category").agg(
        F.expr(f"listagg(pair, ',') WITHIN GROUP (ORDER BY {within})").alias("kv_string")
    )


def _envelope(name: str) -> str:
    return f"__envelope_{name}"


# --- the roll-up ---------------------------------------------------------------------


def _reduced_attributes(
    df: DataFrame,
    ids: Sequence[str],
    payload: str,
    documents: Sequence[str],
    arrays: Sequence[str],
    order_by: Sequence[str],
    latest: Sequence[str],
    key_rule,
) -> DataFrame:
    keep = list(dict.fromkeys([*ids, *order_by, *latest]))
    rows = with_scalars(
        json_array_rows(df, payload, keep),
        "element",
        {_CATEGORY: fv.CATEGORY_PATH, _KEY: fv.NAME_PATH, _RAW: fv.VALUE_PATH}
        | {_envelope(name): path for name, path in fv.ENVELOPE_PATHS.items()},
    )
    rows = rows.withColumn(_CATEGORY, decode_ampersand(_CATEGORY))
    in_document = F.col(_CATEGORY).isin(*documents)
    in_array = F.col(_CATEGORY).isin(*arrays)
    rows = rows.select(
        *ids,
        F.when(in_document | in_array, F.col(_CATEGORY)).alias(_CATEGORY),
        F.when(in_document, key_rule(F.col(_KEY))).alias(_KEY),
        F.when(in_document, F.col(_RAW)).alias(_RAW),
        F.struct(*order_by, "pos").alias(_ORDER),
        (F.struct(*order_by, *[c for c in latest if c not in order_by]) if order_by or latest else F.lit(True)).alias("__latest"),
        *[F.when(in_document, F.col(_envelope(name))).alias(_envelope(name)) for name in fv.ENVELOPE_PATHS],
        *([F.when(in_array, F.to_json("element")).alias("__text")] if arrays else []),
    )
    aggregates = [
        # the last position wins where a name is repeated
        F.max(F.struct(_ORDER, _RAW))[_RAW].alias(_RAW),
        F.max("__latest").alias("__latest"),
        *[F.max(_envelope(name)).alias(_envelope(name)) for name in fv.ENVELOPE_PATHS],
    ]
    if arrays:
        item = F.when(F.col("__text").isNotNull(), F.struct(F.col(_ORDER), F.col("__text").alias("text")))
        aggregates.append(F.collect_list(item).alias("__items"))
    return rows.groupBy(*ids, _CATEGORY, _KEY).agg(*aggregates)


def _category_document(association: str | None) -> list[Column]:
    """Aggregates over one category of one entity: attributes and envelope."""
    envelope = {
        "Attribute_Category__c": F.first(_CATEGORY),
        "Client_External_Id__c": F.max(_envelope("Client_External_Id__c")),
        "Configured_Product__c": F.max(_envelope("Configured_Product__c")),
        "Grouper_ID__c": F.max(_envelope("Grouper_ID__c")),
        "Product_Association_ID": F.first(association) if association else F.lit(None),
        "line_of_business": F.max(_envelope("line_of_business")),
        "LastModifiedBy": F.max(_envelope("LastModifiedBy")),
    }
    return [
        F.collect_list("__entry").alias("__entries"),
        *[value.cast("string").alias(f"__{name}") for name, value in envelope.items()],
    ]


def _document(members: Column, envelope: Mapping[str, Column]) -> Column:
    """``[{attributes + envelope}]`` from the attributes' members and the envelope's texts."""
    values = {name: json_quote(text) for name, text in envelope.items()}
    values["LastModifiedBy"] = F.concat(F.lit('{"Name":{"Value":'), values["LastModifiedBy"], F.lit("}}"))
    constants = F.array(*[json_member(name, value) for name, value in values.items()])
    return F.concat(F.lit("["), json_object(F.concat(members, constants)), F.lit("]"))


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _scalars(elements: str, paths: Mapping[str, str], **others: Callable[[Column, Column], Column]) -> Column:
    """An array of structs: the ``json_value`` of every path (name -> path), each read once, and ``others`` of (element, position)."""

    def read(element: Column, pos: Column) -> Column:
        texts = [F.try_variant_get(element, path, "string").alias(name) for name, path in paths.items()]
        return F.struct(element.alias("__element"), *texts, *[make(element, pos).alias(name) for name, make in others.items()])

    def checked(x: Column) -> Column:
        texts = [scalar_only(x[name], x["__element"], path).alias(name) for name, path in paths.items()]
        return F.struct(*texts, *[x[name].alias(name) for name in others])

    return F.transform(F.transform(elements, read), checked)


def _rolled_in_the_row(
    df: DataFrame,
    ids: Sequence[str],
    payload: str,
    documents: Mapping[str, str],
    arrays: Mapping[str, str],
    association: str | None,
    value_rule,
    key_rule,
    latest: Sequence[str],
) -> DataFrame:
    """One wide row per row of ``df`` that has elements."""
    passed = list(dict.fromkeys([*ids, *latest]))
    # A row number in the projection keeps the condition above it: below, it would parse the payload a second time.
    parsed = df.select(*passed, json_elements(payload).alias("__elements"), F.monotonically_increasing_id().alias("__row"))
    parsed = parsed.where((F.size("__elements") > 0) & (F.col("__row") >= 0))

    # Sorted by category and key, the last position of a repeated name stands last among its copies.
    paths = {"category": fv.CATEGORY_PATH, "key": fv.NAME_PATH, "raw": fv.VALUE_PATH} | {_envelope(name): path for name, path in fv.ENVELOPE_PATHS.items()}
    attributes = F.transform(
        _scalars("__elements", paths, pos=lambda element, pos: pos),
        lambda a: F.struct(
            decode_ampersand(a["category"]).alias("category"), key_rule(a["key"]).alias("key"), *[a[n].alias(n) for n in ("pos", *list(paths)[2:])]
        ),
    )
    texts = F.transform(
        _scalars("__elements", {"category": fv.CATEGORY_PATH}, text=lambda element, pos: F.to_json(element)),
        lambda x: F.struct(decode_ampersand(x["category"]).alias("category"), x["text"].alias("text")),
    )
    sorted_ = parsed
    if documents:
        sorted_ = sorted_.withColumn("__attributes", F.sort_array(F.filter(attributes, lambda a: a["category"].isin(*documents))))
    if arrays:
        sorted_ = sorted_.withColumn("__texts", F.filter(texts, lambda x: x["category"].isin(*arrays)))

    def document(category: Column) -> Column:
        def written(own: Column) -> Column:
            following = F.concat(F.slice(own, 2, F.size(own)), F.array(F.lit(None)))
            last = F.zip_with(own, following, lambda a, b: F.when(~a["key"].eqNullSafe(b["key"]) | b.isNull(), a))
            # an envelope field replaces an attribute of the same name
            named = F.filter(last, lambda a: a["key"].isNotNull() & ~a["key"].isin(*fv.ENVELOPE_KEYS))
            members = F.transform(named, lambda a: json_member(a["key"], value_rule(a["key"], a["raw"])))
            envelope = {name: F.array_max(own[_envelope(name)]) for name in fv.ENVELOPE_PATHS}
            envelope |= {"Attribute_Category__c": category, "Product_Association_ID": F.col(association) if association else F.lit(None)}
            return _document(members, {name: envelope[name].cast("string") for name in fv.ENVELOPE_KEYS})

        return _bound(F.filter("__attributes", lambda a: a["category"] == category), written)

    def array(category: Column) -> Column:
        own = F.filter("__texts", lambda x: x["category"] == category)
        return F.concat(F.lit("["), F.array_join(own["text"], ","), F.lit("]"))

    def by_category(source: str, write) -> Column:
        """A map of the categories that are there to what is written of them."""
        there = F.array_distinct(F.col(source)["category"])
        return F.map_from_arrays(there, F.transform(there, write))

    kinds = [("__attributes", documents, document), ("__texts", arrays, array)]
    written = {f"{source}_written": by_category(source, write) for source, columns, write in kinds if columns}
    return sorted_.withColumns(written).select(
        *ids,
        *[F.col(c) for c in latest],
        *[F.col(f"{source}_written")[category].alias(column) for source, columns, _ in kinds for category, column in columns.items()],
    )


def _rolled_together(
    reduced: DataFrame,
    ids: Sequence[str],
    documents: Mapping[str, str],
    arrays: Mapping[str, str],
    association: str | None,
    value_rule,
    latest: Sequence[str],
) -> DataFrame:
    """One wide row per entity, merged from the reduced attributes of all its payloads."""
    # an envelope field replaces an attribute of the same name
    named = F.col(_KEY).isNotNull() & ~F.col(_KEY).isin(*fv.ENVELOPE_KEYS)
    entry = json_member(F.col(_KEY), value_rule(F.col(_KEY), F.col(_RAW)))
    entries = reduced.withColumn("__entry", F.when(named, entry)).drop(_KEY, _RAW)
    # One exchange on the entity serves both groupings below.
    together = entries.repartition(*[F.col(i) for i in ids])
    aggregates = [F.max("__latest").alias("__latest")]
    if documents:
        aggregates += _category_document(association)
    if arrays:
        aggregates.append(F.flatten(F.collect_list("__items")).alias("__items"))
    per_category = together.groupBy(*ids, _CATEGORY).agg(*aggregates)
    if documents:
        in_document = F.col(_CATEGORY).isin(*documents)
        written = _document(F.col("__entries"), {name: F.col(f"__{name}") for name in fv.ENVELOPE_KEYS})
        per_category = per_category.withColumn("__document", F.when(in_document, written))
    if arrays:
        items = F.array_join(F.sort_array("__items")["text"], ",")
        per_category = per_category.withColumn("__array", F.concat(F.lit("["), items, F.lit("]")))
    wide = [
        F.max(F.when(F.col(_CATEGORY) == category, F.col(source))).alias(column)
        for source, columns in (("__document", documents), ("__array", arrays))
        for category, column in columns.items()
    ]
    row = per_category.groupBy(*ids).agg(*wide, F.max("__latest").alias("__latest"))
    return row.select(*ids, *[F.col(f"__latest.{c}").alias(c) for c in latest], *documents.values(), *arrays.values())


def eav_rollup(
    df: DataFrame,
    ids: Sequence[str],
    documents: Mapping[str, str],
    payload: str = "Payload",
    association: str | None = None,
    arrays: Mapping[str, str] | None = None,
    value_rule=separated_values,
    clean_keys: bool = False,
    order_by: Sequence[str] = (),
    latest: Sequence[str] = (),
    per_delivery: Sequence[str] = (),
) -> DataFrame:
    """One wide row per entity (``ids``): a JSON column per category.

    ``documents`` maps a category to the column holding its one-element array
    ``[{attributes + envelope}]``; ``arrays`` maps a category to the column
    holding its elements as they came, in payload order. ``order_by`` orders
    several payloads of one entity (later wins), ``latest`` columns are taken
    from the last of them. A category without attributes is NULL.

    With ``per_delivery`` columns there is instead one row for each of their
    distinct values an entity arrived with, all with the same documents.
    """
    ids, arrays = list(ids), dict(arrays or {})
    key_rule = clean_key if clean_keys else (lambda c: c)
    keyed = reduce(lambda a, b: a & b, [F.col(i).isNotNull() for i in ids])
    # Read from the ids alone, and written: where it is empty nothing is joined, and where Spark sees that it is
    # small the payloads need not move. A NULL matches nothing, so rows without an id are merged like several.
    counts = df.groupBy(*ids).agg(F.count(F.lit(1)).alias("__n"))
    several = stage(counts.where((F.col("__n") > 1) | ~keyed).select(*ids), "several-payloads")
    rules = (documents, arrays, association, value_rule, key_rule)
    # Of a single payload there is one delivery, that of its row.
    n_several, carried = several.count(), [*per_delivery, *latest]
    if not n_several:
        return _rolled_in_the_row(df, ids, payload, *rules, carried)
    few = n_several <= FEW
    if few:
        single = spread_join(df.where(keyed), several, ids, "left_anti")
        many = spread_join(df.where(keyed), several, ids, "left_semi").unionByName(df.where(~keyed))
    else:
        told = _told_apart(df.select(*dict.fromkeys([*ids, payload, *order_by, *latest, *per_delivery])), several, ids, keyed)
        single, many = (told.where(F.col(_MERGED) == merged).drop(_MERGED) for merged in (False, True))
    reduced = _reduced_attributes(many, ids, payload, list(documents), list(arrays), list(order_by), list(latest), key_rule)
    if not few:
        reduced = stage(reduced, "attributes")
    merged = _rolled_together(reduced, ids, documents, arrays, association, value_rule, latest)
    if not few:
        merged = stage(merged, "merged-payloads")
        discard(reduced, several)
    if per_delivery:
        deliveries = many.where(F.size(json_elements(payload)) > 0).select(*ids, *per_delivery).distinct()
        merged = spread_join(deliveries, merged, ids, "left").select(*ids, *per_delivery, *merged.columns[len(ids) :])
    return _rolled_in_the_row(single, ids, payload, *rules, carried).unionByName(merged)


def _told_apart(df: DataFrame, several: DataFrame, ids: Sequence[str], keyed: Column) -> DataFrame:
    """The rows, staged, with whether their entity is to be merged: the payloads move once, and are not made again."""
    joined = spread_join(df, several.withColumn(_MERGED, F.lit(True)), ids, "left")
    return stage(joined.withColumn(_MERGED, F.col(_MERGED).isNotNull() | ~keyed), "payloads")


def category_arrays(df: DataFrame, ids: Sequence[str], arrays: Mapping[str, str], **options) -> DataFrame:
    """The raw elements of each category as one JSON array per entity."""
    return eav_rollup(df, ids, {}, arrays=arrays, **options)
