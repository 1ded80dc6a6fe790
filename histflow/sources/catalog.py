"""Target columns and mapping documents."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from histflow.operators.mapping import MappingSpec

MAPPING_TYPE = "struct<field_mappings: array<struct<target_field: string, source_field: string>>>"


def target_columns(table: DataFrame) -> list[tuple[int, str, str]]:
    """(position, name, type) of a table's columns, in order."""
    return [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(table.schema.fields, start=1)]


def column_profile(table: DataFrame) -> DataFrame:
    """The target columns as rows, each with its number of filled values.

    One aggregate over the table, unpivoted.
    """
    catalog = target_columns(table)
    counts = table.agg(*[F.count(F.col(name)).alias(name) for _, name, _ in catalog])
    entries = F.array(
        *[
            F.struct(
                F.lit(position).alias("ordinal_position"),
                F.lit(name).alias("column_name"),
                F.lit(data_type).alias("data_type"),
                F.col(name).alias("filled"),
            )
            for position, name, data_type in catalog
        ]
    )
    return counts.select(F.inline(entries)).orderBy("ordinal_position")


def mapping_rows(df: DataFrame, document: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Mapping documents -> one row per (target_field, source_field).

    A missing source field reads as empty text.
    """
    parsed = F.from_json(F.col(document), MAPPING_TYPE)
    rows = df.select(*keep, F.inline(parsed["field_mappings"]))
    return rows.select(*keep, "target_field", F.coalesce("source_field", F.lit("")).alias("source_field"))


def mapping_file(spark: SparkSession, path: str, **options) -> MappingSpec:
    """A mapping document in a file; a few hundred entries, one per target column."""
    document = spark.read.text(path, wholetext=True)
    pairs = mapping_rows(document, "value").toLocalIterator()
    return MappingSpec(fields={r.target_field: r.source_field for r in pairs}, **options)


def mapping_document(spec: MappingSpec) -> str:
    entries = [{"target_field": t, "source_field": s} for t, s in spec.fields.items()]
    return json.dumps({"field_mappings": entries})
