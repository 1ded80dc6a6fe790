"""Metadata-driven mapping: JSON payload -> typed target columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T

from histflow import fixed_values as fv
from histflow.functions.documents import document, with_scalars
from histflow.functions.scalar import date_of_instant, first_match, routed_field, safe_cast, typed_null

_DOC = "__document"


# A route builds a text column from payload values: it gets a function from
# path to scalar column.
Values = Callable[[str], Column]


@dataclass(frozen=True)
class MappingSpec:
    """Target column -> payload field, plus columns routed by payload content.

    ``wrapped_values``: a field may also be ``{"value": scalar}``.
    """

    fields: Mapping[str, str]
    routes: Mapping[str, Callable[[Values], Column]] = field(default_factory=dict)
    wrapped_values: bool = False

    def source_field(self, target: str) -> str | None:
        found = {k.lower(): v for k, v in self.fields.items()}.get(target.lower())
        return (found or "").strip() or None


def level_1_id_route(value: Values) -> Column:
    """Level-1 account id: the field depends on category and client level."""
    category, level = value("$.Client_Category__c"), value("$.ClientLevel__c")
    return first_match(
        [
            (category == "Caremark", value("$.Carrier_ID__c")),
            ((category == "Aetna") & (level == "Plan Sponsor"), value("$.Plan_Sponsor_ID__c")),
            (category == "Third_Party", value("$.Level_1_ID__c")),
        ]
    )


def population_group_route(value: Values) -> Column:
    """Population group id: the field depends on the category."""
    return routed_field(
        value("$.Client_Category__c"),
        {
            "Caremark": value("$.Grouper_Id__c"),
            "Aetna": value("$.Grouper_Id__c"),
            "Third_Party": value("$.Grouper__c"),
        },
    )


def mapped_column(value: Values, target: T.StructField, spec: MappingSpec) -> Column:
    """The expression of one target column; unmapped columns are typed NULLs."""
    routes = {k.lower(): v for k, v in spec.routes.items()}
    if target.name.lower() in routes:
        return safe_cast(routes[target.name.lower()](value), target.dataType)
    source = spec.source_field(target.name)
    if source is None:
        return typed_null(target.dataType)
    text = value(f"$.{source}")
    if spec.wrapped_values:
        text = F.coalesce(value(f"$.{source}.value"), text)
    if isinstance(target.dataType, T.DateType) and target.name.lower() in fv.DATES_THROUGH_TIMESTAMP:
        return date_of_instant(text)
    return safe_cast(text, target.dataType)


def select_values(
    df: DataFrame,
    payload: str,
    keep: Sequence[str],
    build: Callable[[Values], Sequence[Column]],
) -> DataFrame:
    """``keep`` and the columns ``build`` makes of payload values.

    The payload is parsed once and each path that is used is read once.
    """
    names: dict[str, str] = {}

    def value(path: str) -> Column:
        return F.col(names.setdefault(path, f"__value{len(names)}"))

    columns = build(value)
    parsed = df.select(*keep, document(payload).alias(_DOC))
    return with_scalars(parsed, _DOC, {name: path for path, name in names.items()}).select(*keep, *columns)


def map_payload(
    df: DataFrame,
    target: T.StructType,
    spec: MappingSpec,
    payload: str = "Payload",
    keep: Sequence[str] = (),
) -> DataFrame:
    """One pass: ``keep``, then the target columns, the two times last."""
    times = {f.name.lower(): f for f in target.fields if f.name.lower() in fv.MAPPED_TIMES}

    def build(value: Values) -> list[Column]:
        columns = [
            mapped_column(value, f, spec).alias(f.name.lower()) for f in target.fields if f.name.lower() not in times
        ]
        for name, source in fv.MAPPED_TIMES.items():
            data_type = times[name].dataType if name in times else T.TimestampType()
            columns.append(safe_cast(value(f"$.{source}"), data_type).alias(name))
        return columns

    return select_values(df, payload, keep, build)
