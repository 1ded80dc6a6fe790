"""JSON documents, attribute roll-ups, mapping, prefix split."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from histflow import fixed_values as fv
from histflow.functions import documents as dx, scalar as fx
from histflow.operators import mapping, rollup
from histflow.operators.reversion import json_children as children_of
from histflow.operators.spread import spread_join
from histflow.plans import loads
from workload import inputs
from workload.registry import as_of, derived, query

IDS = ["ID", "Product_Association_ID"]


def configuration(spark, sf):
    return derived(spark, sf, inputs.CONFIGURATION, payloads=True)


# --- elements ------------------------------------------------------------------------------


@query(
    "json_array_rows",
    f"""SELECT 'C' || l_orderkey AS "ID", CAST(row_number() OVER (PARTITION BY l_orderkey
       ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag) - 1 AS INTEGER) AS pos, el AS element
       FROM ({inputs.ATTRIBUTES}) a""",
)
def json_array_rows(spark, sf):
    rows = rollup.json_array_rows(configuration(spark, sf), "Payload", ["ID"])
    return rows.select("ID", "pos", F.to_json("element").alias("element"))


@query(
    "category_clean",
    f"SELECT category, count(*) AS n, count(raw) AS filled FROM ({inputs.ELEMENTS_CHECK}) e GROUP BY category",
)
def category_clean(spark, sf):
    rows = rollup.attribute_rows(configuration(spark, sf), "Payload", ["ID"])
    return rows.groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.count("raw").alias("filled"))


@query(
    "key_clean",
    f"""SELECT name AS key, regexp_replace(regexp_replace(name, '[^A-Za-z0-9 ]', '', 'g'), ' +', '_', 'g') AS cleaned,
       count(*) AS n FROM ({inputs.ELEMENTS_CHECK}) e GROUP BY 1, 2""",
)
def key_clean(spark, sf):
    rows = rollup.attribute_rows(configuration(spark, sf), "Payload", ["ID"])
    return rows.groupBy("key", fx.clean_key("key").alias("cleaned")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "split_list",
    f"""SELECT id AS "ID", CAST(pos AS INTEGER) AS pos, CASE kind WHEN 0 THEN NULL WHEN 1 THEN 'p x|q|' || flag ELSE raw END AS elements,
       CASE kind WHEN 0 THEN NULL WHEN 1 THEN 3 ELSE 1 END AS n FROM ({inputs.ELEMENTS_CHECK}) e""",
)
def split_list(spark, sf):
    rows = rollup.attribute_rows(configuration(spark, sf), "Payload", ["ID"])
    parts = fx.split_list("raw")
    return rows.select("ID", "pos", F.array_join(parts, "|").alias("elements"), F.size(parts).alias("n")).withColumn(
        "n", F.when(F.col("elements").isNotNull(), F.col("n"))
    )


# --- roll-ups ------------------------------------------------------------------------------

VALUE_A = """CASE kind WHEN 0 THEN 'null' WHEN 1 THEN '["p x","q","' || flag || '"]' ELSE '"' || raw || '"' END"""
CLEAN = "regexp_replace(regexp_replace(name, '[^A-Za-z0-9 ]', '', 'g'), ' +', '_', 'g')"
VALUE_B = f"""CASE WHEN {CLEAN} = 'Contracted_LOB_Sub_Category' THEN
    CASE kind WHEN 0 THEN '[]' WHEN 1 THEN '["p_x","q","' || flag || '"]' ELSE '["' || raw || '"]' END
  ELSE coalesce('"' || raw || '"', 'null') END"""


def documents_sql(value: str, name: str, last: str = "pos DESC", elements: str = inputs.ELEMENTS_CHECK) -> str:
    """docs(id, assoc, category, doc): one-element arrays of sorted-key objects."""
    envelope = [
        ("Attribute_Category__c", "'\"' || category || '\"'"),
        ("Client_External_Id__c", "'null'"),
        ("Configured_Product__c", "'null'"),
        ("Grouper_ID__c", "coalesce('\"' || g || '\"', 'null')"),
        ("Product_Association_ID", "'\"' || assoc || '\"'"),
        ("line_of_business", "'null'"),
        ("LastModifiedBy", "'{\"Name\":{\"Value\":\"' || m || '\"}}'"),
    ]
    constant = " UNION ALL ".join(f"SELECT id, assoc, category, '{k}', {v} FROM env" for k, v in envelope)
    return f"""el AS ({elements}),
  named AS (SELECT *, {name} AS key FROM el),
  kept AS (SELECT *, row_number() OVER (PARTITION BY id, category, key ORDER BY {last}) AS rn FROM named),
  env AS (SELECT id, assoc, category, max(grouper) AS g, max(modified_by) AS m FROM el GROUP BY 1, 2, 3),
  pairs AS (SELECT id, assoc, category, key, {value} AS v FROM kept WHERE rn = 1 UNION ALL {constant}),
  docs AS (SELECT id, assoc, category, '[{{' || string_agg('"' || key || '":' || v, ',' ORDER BY key) || '}}]' AS doc
           FROM pairs GROUP BY 1, 2, 3)"""


def wide_sql(documents: dict[str, str], source: str = "doc") -> str:
    return ", ".join(f"max({source}) FILTER (WHERE category = '{c}') AS {d}" for c, d in documents.items())


@query(
    "kv_string_agg",
    f"""SELECT id AS "ID", category, string_agg('"' || name || '":' || {VALUE_A}, ',' ORDER BY pos) AS kv_string
       FROM ({inputs.ELEMENTS_CHECK}) e GROUP BY 1, 2""",
)
def kv_string_agg(spark, sf):
    rows = rollup.attribute_rows(configuration(spark, sf), "Payload", ["ID"])
    return rollup.kv_string_agg(rows, ["ID"], ["pos"])


@query(
    "eav_rollup",
    f"""WITH {documents_sql(VALUE_A, 'name')}
       SELECT id AS "ID", assoc AS "Product_Association_ID", {wide_sql({'Billing': 'billing_detail'})} FROM docs GROUP BY 1, 2""",
)
def eav_rollup(spark, sf):
    return rollup.eav_rollup(
        configuration(spark, sf), IDS, {"Billing": "billing_detail"}, association="Product_Association_ID"
    )


@query(
    "eav_rollup_all",
    f"""WITH {documents_sql(VALUE_A, 'name')}, ent AS ({inputs.ENTITLEMENT}),
       wide AS (SELECT id, assoc, {wide_sql(fv.CATEGORIES)} FROM docs GROUP BY 1, 2)
       SELECT id AS "ID", assoc AS "Product_Association_ID", {', '.join(fv.CATEGORIES.values())}, customer_id
       FROM wide LEFT JOIN ent ON assoc = sf_product_association_id""",
)
def eav_rollup_all(spark, sf):
    landing = configuration(spark, sf)
    wide = rollup.eav_rollup(landing, IDS, fv.CATEGORIES, association="Product_Association_ID")
    owners = derived(spark, sf, inputs.ENTITLEMENT).withColumnRenamed(
        "sf_product_association_id", "Product_Association_ID"
    )
    joined = spread_join(wide, owners, ["Product_Association_ID"], "left")
    return joined.select(
        *IDS, *fv.CATEGORIES.values(), "customer_id"
    )


@query(
    "eav_rollup_deliveries",
    f"""WITH {documents_sql(VALUE_A, 'name', 'delivery DESC, pos DESC')},
       d AS (SELECT id, assoc, {wide_sql(fv.CATEGORIES)} FROM docs GROUP BY 1, 2),
       came AS (SELECT DISTINCT id, CAST(delivery AS INTEGER) AS delivery FROM el)
       SELECT d.id AS "ID", assoc AS "Product_Association_ID", delivery, {', '.join(fv.CATEGORIES.values())}
       FROM d JOIN came ON d.id = came.id""",
)
def eav_rollup_deliveries(spark, sf):
    return rollup.eav_rollup(
        derived(spark, sf, inputs.DELIVERIES, payloads="l_orderkey"),
        IDS,
        fv.CATEGORIES,
        association="Product_Association_ID",
        order_by=["delivery"],
        per_delivery=["delivery"],
    )


KEYED = {c: fv.CATEGORIES[c] for c in fv.KEYED_CATEGORIES}
RAW = {c: d for c, d in fv.CATEGORIES.items() if c not in KEYED}
RAW_SQL = f"""raw AS (SELECT id, category, '[' || string_agg(el, ',' ORDER BY pos) || ']' AS items FROM
    (SELECT 'C' || l_orderkey AS id, el,
            replace(json_extract_string(el, '$.Attribute_Category__c'), '&amp;', '&') AS category,
            row_number() OVER (PARTITION BY l_orderkey
              ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag) AS pos
     FROM ({inputs.ATTRIBUTES}) a) x GROUP BY 1, 2)"""


@query(
    "category_arrays",
    f"""WITH {RAW_SQL} SELECT id AS "ID", {wide_sql(RAW, 'items')} FROM raw GROUP BY 1""",
)
def category_arrays(spark, sf):
    return rollup.category_arrays(configuration(spark, sf), ["ID"], RAW)


@query(
    "eav_rollup_listkeys",
    f"""WITH {documents_sql(VALUE_B, CLEAN)}, {RAW_SQL},
       d AS (SELECT id, assoc, {wide_sql(KEYED)} FROM docs GROUP BY 1, 2),
       r AS (SELECT id, {wide_sql(RAW, 'items')} FROM raw GROUP BY 1)
       SELECT d.id AS "ID", assoc AS "Product_Association_ID", {', '.join(fv.CATEGORIES.values())}
       FROM d JOIN r ON d.id = r.id""",
)
def eav_rollup_listkeys(spark, sf):
    return rollup.eav_rollup(
        configuration(spark, sf),
        IDS,
        KEYED,
        association="Product_Association_ID",
        arrays=RAW,
        value_rule=rollup.listed_keys_values(fv.LIST_KEYS),
        clean_keys=True,
    )


# --- documents --------------------------------------------------------------------------------


def scalar_sql(path: str) -> str:
    return (
        f"CASE WHEN json_type(Payload, '{path}') IN ('OBJECT', 'ARRAY', 'NULL') THEN NULL "
        f"ELSE json_extract_string(Payload, '{path}') END"
    )


@query(
    "json_value",
    f"""SELECT event_id, {scalar_sql('$.Client_Category__c')} AS category, {scalar_sql('$.Count__c')} AS cnt,
       {scalar_sql('$.Count__c.value')} AS nested, {scalar_sql('$.Level_1_ID__c')} AS level_1,
       {scalar_sql('$.Note__c')} AS note, {scalar_sql('$.Absent__c')} AS absent FROM ({inputs.MAPPED}) m""",
)
def json_value(spark, sf):
    parsed = derived(spark, sf, inputs.MAPPED, payloads=True).select("event_id", dx.document("Payload").alias("doc"))
    paths = {
        "category": "$.Client_Category__c",
        "cnt": "$.Count__c",
        "nested": "$.Count__c.value",
        "level_1": "$.Level_1_ID__c",
        "note": "$.Note__c",
        "absent": "$.Absent__c",
    }
    return dx.with_scalars(parsed, "doc", paths).drop("doc")


OBJECT_SQL = """CASE WHEN p_partkey % 19 = 0 THEN '{}' ELSE '{"ACI_a":' || p_size || ',"ACI_b":' ||
  CASE WHEN p_size % 3 = 0 THEN 'null' ELSE '"' || p_brand || '"' END || ',"AcAu_x":' ||
  CASE WHEN p_size % 2 = 0 THEN 'null' ELSE '{"y":[true],"z":1}' END ||
  ',"Billing_q":"No","line_of_business":"L' || p_size % 5 || '"}' END"""
ACI_SQL = """CASE WHEN p_partkey % 19 = 0 THEN '{}' ELSE '{"ACI_a":' || p_size ||
  CASE WHEN p_size % 3 = 0 THEN '' ELSE ',"ACI_b":"' || p_brand || '"' END || '}' END"""
ACAU_SQL = """CASE WHEN p_partkey % 19 = 0 OR p_size % 2 = 0 THEN '{}' ELSE '{"AcAu_x":{"y":[true],"z":1}}' END"""


@query(
    "json_canon",
    f"""SELECT CAST(p_partkey AS VARCHAR) AS id, CASE WHEN p_partkey % 19 = 0 THEN '[]' ELSE '[' || {OBJECT_SQL} || ']' END
       AS canonical FROM part""",
)
def json_canon(spark, sf):
    return derived(spark, sf, inputs.CONTACTS).select(
        F.col("ID").alias("id"), dx.canonical("Payload").alias("canonical")
    )


@query("json_first", f"SELECT CAST(p_partkey AS VARCHAR) AS id, {OBJECT_SQL} AS first FROM part")
def json_first(spark, sf):
    return derived(spark, sf, inputs.CONTACTS).select(
        F.col("ID").alias("id"), F.to_json(dx.json_first("Payload")).alias("first")
    )


@query(
    "json_prefix_split",
    f"""SELECT CAST(p_partkey AS VARCHAR) AS id, CASE WHEN p_partkey % 19 <> 0 THEN 'L' || p_size % 5 END AS line_of_business,
       {ACI_SQL} AS assigned_owner_contact_information, {ACAU_SQL} AS accreditation_audits FROM part
       WHERE p_partkey % 4 <> 0""",
)
def json_prefix_split(spark, sf):
    source = loads.contacts_source(derived(spark, sf, inputs.CONTACTS), as_of())
    return source.select("id", "line_of_business", *fv.CONTACT_PREFIXES.values())


CHILDREN_SQL = ", ".join(f"{inputs.CHILD_VALUES[name][1]} AS {column}" for name, column in fv.CHILDREN.items())


@query("json_children", f"SELECT o_orderkey AS n, {CHILDREN_SQL} FROM orders")
def json_children(spark, sf):
    return children_of(derived(spark, sf, inputs.CHILD_ROWS, payloads=True), "payload", keep=["n"])


# --- mapping -----------------------------------------------------------------------------------

LEVEL_1_SQL = """CASE WHEN event_id % 4 = 0 THEN 'C' || user_id WHEN event_id % 4 = 1 AND event_id % 3 = 0 THEN 'P' || user_id
  WHEN event_id % 4 = 2 AND event_id % 5 <> 0 THEN 'L' || user_id END"""
GROUP_SQL = """CASE WHEN event_id % 4 IN (0, 1) THEN 'GI' || user_id WHEN event_id % 4 = 2 THEN 'GR' || user_id END"""
TIMES_SQL = """TIMESTAMP '2025-12-22 18:15:02' AS orig_src_pst_dts,
  CASE WHEN event_id % 6 <> 0 THEN TIMESTAMP '2025-12-23 01:00:00' END AS source_last_process_dts"""
TARGET = (
    "orig_src_pst_dts timestamp_ntz, sf_account_id string, customer_account_structure_level_1_id string, "
    "customer_population_group_id string, employee_cnt bigint, note_txt string, type_nm string, "
    "business_effective_dt date, missing_cd string, source_last_process_dts timestamp_ntz, missing_cnt bigint"
)
FIELDS = {
    "SF_ACCOUNT_ID": "Account__c",
    "employee_cnt": "Count__c",
    "note_txt": "Note__c",
    "type_nm": "Type__c",
    "business_effective_dt": "Effective__c",
    "missing_cd": "",
}


def mapping_spec(wrapped: bool) -> mapping.MappingSpec:
    route = (
        {"customer_population_group_id": mapping.population_group_route}
        if wrapped
        else {"customer_account_structure_level_1_id": mapping.level_1_id_route}
    )
    return mapping.MappingSpec(FIELDS, route, wrapped_values=wrapped)


@query("routed_field", f"SELECT event_id, {GROUP_SQL} AS customer_population_group_id FROM events")
def routed_field(spark, sf):
    return mapping.select_values(
        derived(spark, sf, inputs.MAPPED, payloads=True),
        "Payload",
        ["event_id"],
        lambda value: [mapping.population_group_route(value).alias("customer_population_group_id")],
    )


@query("routed_field_nested", f"SELECT event_id, {LEVEL_1_SQL} AS customer_account_structure_level_1_id FROM events")
def routed_field_nested(spark, sf):
    return mapping.select_values(
        derived(spark, sf, inputs.MAPPED, payloads=True),
        "Payload",
        ["event_id"],
        lambda value: [mapping.level_1_id_route(value).alias("customer_account_structure_level_1_id")],
    )


@query(
    "mapped_select",
    f"""SELECT event_id, 'ACC-' || user_id AS sf_account_id, {LEVEL_1_SQL} AS customer_account_structure_level_1_id,
       CAST(NULL AS VARCHAR) AS customer_population_group_id,
       CASE WHEN event_id % 3 = 1 THEN user_id END AS employee_cnt, '{{' || event_type AS note_txt,
       CAST(NULL AS VARCHAR) AS type_nm, DATE '2025-12-23' AS business_effective_dt, CAST(NULL AS VARCHAR) AS missing_cd,
       CAST(NULL AS BIGINT) AS missing_cnt, {TIMES_SQL} FROM events""",
)
def mapped_select(spark, sf):
    return mapping.map_payload(
        derived(spark, sf, inputs.MAPPED, payloads=True), T.StructType.fromDDL(TARGET), mapping_spec(wrapped=False), keep=("event_id",)
    )


@query(
    "mapped_select_value",
    f"""SELECT event_id, 'ACC-' || user_id AS sf_account_id, CAST(NULL AS VARCHAR) AS customer_account_structure_level_1_id,
       {GROUP_SQL} AS customer_population_group_id,
       CASE WHEN event_id % 3 <> 0 THEN user_id END AS employee_cnt, '{{' || event_type AS note_txt,
       event_type AS type_nm, DATE '2025-12-23' AS business_effective_dt, CAST(NULL AS VARCHAR) AS missing_cd,
       CAST(NULL AS BIGINT) AS missing_cnt, {TIMES_SQL} FROM events""",
)
def mapped_select_value(spark, sf):
    return mapping.map_payload(
        derived(spark, sf, inputs.MAPPED, payloads=True), T.StructType.fromDDL(TARGET), mapping_spec(wrapped=True), keep=("event_id",)
    )
