"""One function per load. Each takes and returns DataFrames.

The prepared source rows are staged (written once) because several results are
computed from them; pass ``staging=False`` to keep everything in one lazy plan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from histflow import fixed_values as fv
from histflow.functions.documents import json_object_of, json_value, prefix_split
from histflow.functions.scalar import (
    AsOf,
    as_instant,
    code_map,
    default_date,
    high_date,
    joined_key,
    low_date,
    md5_key,
    open_end,
    sha256_key,
    surrogate_key,
)
from histflow.operators.history import (
    History,
    active_rows,
    known,
    latest_per_key,
    mark_processed,
    scd1_upsert,
    scd2_apply,
)
from histflow.operators.mapping import MappingSpec, map_payload
from histflow.operators.quality import (
    allowed_rule,
    apply_rules,
    audit_rows,
    castable_rule,
    duplicate_keys,
    flag_duplicates,
    not_null_rule,
    split_valid,
)
from histflow.operators.reversion import children_of_groups, reversion_with_children
from histflow.operators.rollup import eav_rollup, listed_keys_values, separated_values
from histflow.operators.spread import spread_join
from histflow.sources.tables import pending, stage, stage_result


@dataclass(frozen=True)
class Load:
    """history: the whole target table; source: landing rows with their flags;
    rejected: rows for the audit table, with the reason; rows: what the batch merges into the
    history, and processed: the keys of the landing rows it is done with, for
    :func:`histflow.plans.publish.publish`."""

    history: DataFrame
    source: DataFrame | None = None
    rejected: DataFrame | None = None
    rows: DataFrame | None = None
    processed: DataFrame | None = None


# --- customers ---------------------------------------------------------------------------

CUSTOMER_STATUSES = ["not_null_status", "datatype_status", "valid_value_status"]
CUSTOMER_WATCH = [
    "customer_id",
    "customer_nm",
    "business_unit_cd",
    "sf_platform_id_level_nm",
    "business_effective_dt",
    "business_expiration_dt",
]


def customer_source(landing: DataFrame, as_of: AsOf, flag: str = "N") -> DataFrame:
    """Pending customers with codes, defaults, hash and audit columns.

    A computed column replaces the landing column of the same name.
    """
    as_of = as_instant(as_of)
    expiration = "business_expiration_dt" if "business_expiration_dt" in landing.columns else F.lit(None)
    return pending(landing, value=flag).withColumns(
        {
            "sgk_customer_id": surrogate_key(fv.DUPLICATE_CUSTOMER_KEYS, as_of),
            "source_system_cd": F.lit(fv.SOURCE_SYSTEM),
            "business_unit_cd": code_map("business_unit_cd", fv.BUSINESS_UNITS),
            "insert_dts": as_of,
            "record_hash_key_id": F.md5(F.col("customer_id").cast("string")),
            "last_process_dts": as_of,
            "business_effective_dt": default_date("business_effective_dt", low_date()),
            "business_expiration_dt": default_date(expiration, high_date()),
            "record_start_dts": as_of,
            "record_end_dts": open_end(),
            "active_record_ind": F.lit("Y"),
        }
    )


def check_customers(source: DataFrame) -> DataFrame:
    """Three statuses and the duplicate flag per row."""
    checked = apply_rules(
        source,
        {
            "not_null_status": not_null_rule(fv.REQUIRED_CUSTOMER_COLUMNS),
            "datatype_status": castable_rule({"customer_id": "string"}),
            "valid_value_status": allowed_rule("sf_platform_id_level_nm", fv.PLATFORM_FLAG_VALUES),
        },
    )
    return flag_duplicates(checked, fv.DUPLICATE_CUSTOMER_KEYS)


REASON = "reject_reason"
BAD_VALUE, REPEATED_KEY = "bad value", "repeated key"


def _one_per_key(rows: DataFrame, keys: Sequence[str], order_by: Sequence[str], staging: bool = False) -> tuple[DataFrame, DataFrame]:
    """The rows with one for each key, and the rejected ones with their reason.

    The latest row by ``order_by``; without it, all rows of a repeated key are rejected, and
    the others load. ``rows`` are staged: they are read for the keys, and for either part.
    With ``staging`` the repeated keys are staged too: where there are none, no row moves to be told apart.
    """
    none = rows.where(F.lit(False)).withColumn(REASON, F.lit(REPEATED_KEY))
    if order_by:
        return latest_per_key(rows, list(keys), list(order_by)), none
    repeated = duplicate_keys(rows.where(known(keys)).select(*keys), keys).select(*keys)
    if staging:
        repeated = stage(repeated, "repeated-keys")
        if repeated.isEmpty():
            return rows, none
    return spread_join(rows, repeated, keys, "left_anti"), spread_join(rows, repeated, keys, "left_semi").withColumn(REASON, F.lit(REPEATED_KEY))


def customer_load(
    landing: DataFrame,
    target: DataFrame,
    as_of: AsOf,
    insert: str = "new_or_changed",
    end_rule: str = "as_of",
    staging: bool = True,
    order_by: Sequence[str] = (),
) -> Load:
    """Check pending customers; valid ones go to the history, others to audit.

    An account with several valid rows: with ``order_by`` the latest counts,
    otherwise all of them go to audit as well, beside the rows that failed.
    """
    as_of = as_instant(as_of)
    checked = check_customers(customer_source(landing, as_of))
    if staging:
        checked = stage(checked, "customers")
    valid, invalid = split_valid(checked, CUSTOMER_STATUSES)
    valid, repeated = _one_per_key(valid, ["sf_account_id"], order_by)
    rejected = invalid.withColumn(REASON, F.lit(BAD_VALUE)).unionByName(repeated)
    history = History(
        keys=["sf_account_id"],
        watch=CUSTOMER_WATCH if insert == "new_or_changed" else (),
        end_rule=end_rule,
    )
    return Load(
        history=scd2_apply(target, valid, history, as_of, insert),
        source=mark_processed(landing, valid, {"sf_account_id": "sf_account_id"}),
        rejected=audit_rows(rejected, as_of),
        rows=valid,
        processed=valid.select("sf_account_id"),
    )


# --- account structures --------------------------------------------------------------------


def account_structure_source(
    landing: DataFrame,
    customers: DataFrame,
    as_of: AsOf,
    literal_hash: bool = False,
) -> DataFrame:
    """Account structures with the customer id of their account and hash keys.

    The hashes use the structure's own customer id and the business unit as
    delivered, before it is coded; the result's customer id is the owner's. With
    ``literal_hash`` NULLs are left out of the record hash, which then cannot
    tell (a, NULL, b) from (a, b, NULL).
    """
    as_of = as_instant(as_of)
    owners = customers.select("sf_account_id", F.col("customer_id").alias("__owner"))
    own = landing if "customer_id" in landing.columns else landing.withColumn("customer_id", F.lit(None).cast("string"))
    joined = spread_join(own, owners, ["sf_account_id"], "left")
    made = ("business_unit_cd", "business_effective_dt", "business_expiration_dt", "customer_id", "__owner")
    return joined.select(
        *[c for c in joined.columns if c not in made],
        F.col("__owner").alias("customer_id"),
        code_map("business_unit_cd", fv.BUSINESS_UNITS).alias("business_unit_cd"),
        md5_key(fv.ACCOUNT_BUSINESS_HASH).alias("business_hash_key_id"),
        md5_key(fv.ACCOUNT_BUSINESS_KEY).alias("business_key_txt"),
        md5_key(fv.ACCOUNT_RECORD_HASH, None if literal_hash else fv.NULL_TEXT).alias("record_hash_key_id"),
        default_date("business_effective_dt", low_date()).alias("business_effective_dt"),
        default_date("business_expiration_dt", high_date()).alias("business_expiration_dt"),
        surrogate_key(["sf_group_census_id", "customer_id", "__owner"], as_of).alias("sgk_customer_account_structure_id"),
        as_of.alias("insert_dts"),
        as_of.alias("last_process_dts"),
    )


def account_structure_load(
    landing: DataFrame,
    customers: DataFrame,
    target: DataFrame,
    as_of: AsOf,
    end_rule: str = "as_of",
    literal_hash: bool = False,
    staging: bool = True,
    order_by: Sequence[str] = (),
) -> Load:
    """Version account structures by their record hash.

    Of a structure with several rows the latest by ``order_by``; without it they are rejected.
    """
    as_of = as_instant(as_of)
    source = account_structure_source(landing, customers, as_of, literal_hash)
    if staging:
        source = stage(source, "account-structures")
    source, rejected = _one_per_key(source, ["sf_group_census_id"], order_by)
    history = History(keys=["sf_group_census_id"], watch=["record_hash_key_id"], end_rule=end_rule)
    return Load(
        history=scd2_apply(target, source, history, as_of),
        rejected=audit_rows(rejected, as_of),
        rows=source,
        processed=source.select("sf_group_census_id"),
    )


# --- product configurations -------------------------------------------------------------------


def configuration_source(
    landing: DataFrame,
    entitlement: DataFrame,
    raw_categories: bool = False,
    order_by: Sequence[str] = ("LastModifiedDate", "CreatedDate"),
    per_delivery: Sequence[str] = (),
    staging: bool = False,
) -> DataFrame:
    """One wide row per pending configuration, with its customer id.

    ``per_delivery``: landing columns that tell deliveries apart; a row for each. With ``staging``
    these rows are staged before they get their customer.
    ``raw_categories``: two categories become keyed documents with cleaned
    keys, the other eight stay arrays of elements as they came.
    """
    rows = pending(landing).withColumn(
        "business_unit_cd", code_map("line_of_business", fv.BUSINESS_UNITS, ignore_case=True)
    )
    keyed = {c: fv.CATEGORIES[c] for c in fv.KEYED_CATEGORIES}
    rolled = lambda: eav_rollup(
        rows,
        ["ID", "Product_Association_ID"],
        keyed if raw_categories else fv.CATEGORIES,
        association="Product_Association_ID",
        arrays={c: d for c, d in fv.CATEGORIES.items() if c not in keyed} if raw_categories else None,
        value_rule=listed_keys_values(fv.LIST_KEYS) if raw_categories else separated_values,
        clean_keys=raw_categories,
        order_by=order_by,
        latest=[c for c in ("business_unit_cd", "Grouper_val", "CreatedDate", "LastModifiedDate") if c not in per_delivery],
        **({"per_delivery": list(per_delivery)} if per_delivery else {}),
    )
    wide = stage_result(landing.sparkSession, rolled, "deliveries") if staging and per_delivery else rolled()
    owners = entitlement.select(
        F.col("sf_product_association_id").alias("Product_Association_ID"), "customer_id"
    )
    joined = spread_join(wide, owners, ["Product_Association_ID"], "left")
    return joined.select(
        F.col("ID").alias("sf_product_configuration_id"),
        F.col("Product_Association_ID").alias("sf_product_association_id"),
        "business_unit_cd",
        "customer_id",
        F.col("Grouper_val").alias("customer_population_group_id"),
        *fv.CATEGORIES.values(),
        F.lit(fv.SOURCE_SYSTEM).alias("source_system_cd"),
        joined_key(["ID", "Product_Association_ID"]).alias("business_hash_key_id"),
        sha256_key("ID").alias("record_hash_key_id"),
        F.col("CreatedDate").alias("orig_src_pst_dts"),
        F.col("LastModifiedDate").alias("source_last_process_dts"),
        F.lit("Active").alias("record_status_cd"),
        F.lit(fv.UPDATED_BY).alias("update_by"),
        *[c for c in per_delivery if c not in ("CreatedDate", "LastModifiedDate", "Grouper_val", "business_unit_cd")],
    )


def configuration_history(watch: Sequence[str] | None = None) -> History:
    return History(
        keys=["sf_product_configuration_id", "sf_product_association_id"],
        documents=list(fv.CATEGORIES.values()) if watch is None else watch,
        on_close={"record_status_cd": F.lit("Inactive")},
    )


def product_configuration_load(
    landing: DataFrame,
    entitlement: DataFrame,
    target: DataFrame,
    as_of: AsOf,
    raw_categories: bool = False,
    watch: Sequence[str] | None = None,
    insert: str = "new_or_changed",
    staging: bool = True,
    order_by: Sequence[str] = (),
    per_delivery: Sequence[str] = (),
) -> Load:
    """Roll up pending configurations and version them by their documents.

    A configuration and its association are one versioned row. With
    ``per_delivery`` the source has a row for each delivery; ``order_by`` (columns
    of the source) then says which is the latest; without it, a configuration that came in
    several deliveries is rejected.
    """
    as_of = as_instant(as_of)

    def prepared() -> DataFrame:
        return configuration_source(landing, entitlement, raw_categories, per_delivery=per_delivery, staging=staging).withColumn(
            "sgk_customer_product_configuration_id",
            surrogate_key(["sf_product_configuration_id", "sf_product_association_id"], as_of),
        )

    source = stage_result(landing.sparkSession, prepared, "configurations") if staging else prepared()
    source, rejected = _one_per_key(source, ["sf_product_configuration_id", "sf_product_association_id"], order_by, staging)
    history = scd2_apply(target, source, configuration_history(watch), as_of, insert)
    # after the load a configuration is active if it was before or came now
    reached = active_rows(target, configuration_history()).select("sf_product_configuration_id").unionByName(
        source.select("sf_product_configuration_id")
    )
    waiting = pending(landing).select("ID")
    return Load(
        history,
        mark_processed(landing, reached, {"ID": "sf_product_configuration_id"}),
        audit_rows(rejected, as_of),
        rows=source,
        processed=spread_join(waiting, reached.withColumnRenamed("sf_product_configuration_id", "ID"), ["ID"], "left_semi"),
    )


def reversion_load(
    configurations: DataFrame,
    children: DataFrame,
    target: DataFrame,
    as_of: AsOf,
    group: str = "customer_population_group_id",
    order_by: Sequence[str] = ("LastModifiedDate", "CreatedDate"),
    staging: bool = True,
) -> Load:
    """Give active rows a new version carrying their group's child collections."""
    as_of = as_instant(as_of)
    documents = children_of_groups(
        configurations.withColumnRenamed("Grouper_val", group),
        children.withColumnRenamed("Grouper_val", group),
        group,
        "Payload",
        order_by,
    )
    if staging:
        documents = stage(documents, "children")
    history = History(
        keys=["sf_product_configuration_id"],
        on_close={"record_status_cd": F.lit("Inactive")},
        on_insert={
            "sgk_customer_product_configuration_id": surrogate_key(
                ["sf_product_configuration_id", "sf_product_association_id", group], as_of
            ),
            "insert_dts": as_of,
            "last_process_dts": as_of,
            "record_status_cd": F.lit("Active"),
            "update_by": F.lit(fv.UPDATED_BY),
        },
    )
    return Load(reversion_with_children(target, documents, history, group, as_of))


# --- contacts ------------------------------------------------------------------------------------


def contacts_source(
    landing: DataFrame,
    as_of: AsOf,
    flag: str = "Y",
    prefixes: Mapping[str, str] = fv.CONTACT_PREFIXES,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Pending contacts: key-prefix documents of the payload, or of its element 0.

    The payload may be an array of one object or the object itself.
    """
    as_of = as_instant(as_of)
    rows = pending(landing, value=flag)
    first = rows.select("ID", "indicator_flag", *carry, json_object_of("Payload").alias("__object"))
    return first.select(
        *carry,
        F.col("ID").cast("string").alias("id"),
        "indicator_flag",
        json_value("__object", "$.line_of_business").alias("line_of_business"),
        *[prefix_split("__object", prefix).alias(column) for prefix, column in prefixes.items()],
        surrogate_key(["ID"], as_of).alias("surrogate_key"),
        as_of.alias("load_ts"),
    )


def contacts_history(as_of: AsOf) -> History:
    as_of = as_instant(as_of)
    return History(
        keys=["id"],
        documents=list(fv.CONTACT_PREFIXES.values()),
        active="active_flg",
        start="effective_start_ts",
        end="effective_end_ts",
        on_close={"load_ts": as_of},
    )


def contacts_load(
    landing: DataFrame, target: DataFrame, as_of: AsOf, staging: bool = True, order_by: Sequence[str] = ()
) -> Load:
    """Version contacts by their two documents; ``Y`` marks pending rows here.

    With ``order_by`` (columns of the landing rows) the latest row of a contact counts;
    without it, several rows of a contact are rejected.
    """
    as_of = as_instant(as_of)
    source = contacts_source(landing, as_of, carry=order_by)
    if staging:
        source = stage(source, "contacts")
    source, rejected = _one_per_key(source, ["id"], order_by)
    history = contacts_history(as_of)
    reached = active_rows(target, history).select("id").unionByName(source.select("id"))
    return Load(
        scd2_apply(target, source, history, as_of),
        mark_processed(landing, reached, {"ID": "id"}, pending="Y", done="N"),
        audit_rows(rejected, as_of),
        rows=source,
        processed=spread_join(pending(landing, value="Y").select("ID"), reached.withColumnRenamed("id", "ID"), ["ID"], "left_semi"),
    )


# --- mapped tables ----------------------------------------------------------------------------------


def mapped_load(
    raw: DataFrame,
    target: DataFrame,
    spec: MappingSpec,
    keys: Sequence[str] = ("sf_account_id",),
    payload: str = "Payload",
    latest_by: Sequence[str] = ("source_last_process_dts",),
    staging: bool = True,
) -> Load:
    """Map payloads to the target's columns and upsert them.

    Of several payloads with one key the latest counts; with no ``latest_by``
    they are an error.
    """
    mapped = map_payload(raw, target.schema, spec, payload)
    if staging:
        mapped = stage(mapped, "mapped")
    if latest_by:
        mapped = latest_per_key(mapped, list(keys), list(latest_by))
    return Load(scd1_upsert(target, mapped, keys))
