"""Whole loads: landing rows in, history table out."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F, types as T

from histflow import fixed_values as fv
from histflow.operators.mapping import MappingSpec, level_1_id_route
from histflow.plans import loads
from histflow.sources import tables
from workload import inputs
from workload.columns import VALID_SQL, WITH_CHECKED
from workload.documents import LEVEL_1_SQL, VALUE_A, documents_sql, wide_sql
from workload.history import CONTACTS_CLOSED, CONTACTS_SQL, WITH_GROUPS
from workload.registry import AS_OF_SQL, AS_OF_TEXT, OPEN_SQL, as_of, derived, key_sql, query

# Active customers before the load: two in three would change.
CUSTOMER_HISTORY = """
SELECT 'old-' || CAST(c_custkey AS STRING) AS sgk_customer_id, 'PCT' AS source_system_cd,
       CASE c_nationkey % 4 WHEN 0 THEN '3PY' WHEN 1 THEN 'PBM' WHEN 2 THEN 'HCB' ELSE c_mktsegment END AS business_unit_cd,
       CAST(c_custkey AS STRING) AS customer_id, 'Customer ' || CAST(c_custkey AS STRING) AS customer_nm,
       'ACC-' || CAST(c_custkey AS STRING) AS sf_account_id,
       CASE c_custkey % 5 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'false' ELSE 'True' END AS sf_platform_id_level_nm,
       CASE WHEN c_custkey % 7 = 0 THEN DATE '1900-01-01' ELSE DATE '2024-01-01' END AS business_effective_dt,
       CASE WHEN c_custkey % 2 = 0 THEN DATE '9999-12-31' ELSE DATE '2030-01-01' END AS business_expiration_dt,
       'Y' AS active_record_ind, TIMESTAMP '2025-01-01 00:00:00' AS record_start_dts,
       TIMESTAMP '9999-12-31 00:00:00' AS record_end_dts
FROM customer
"""
_DIFFERS = " OR ".join(f"v.{c} IS DISTINCT FROM t.{c}" for c in loads.CUSTOMER_WATCH)
_SGK = key_sql("v.customer_id", "v.customer_nm", "v.sf_account_id")


@query(
    "customer_load",
    WITH_CHECKED
    + f""", v AS (SELECT * FROM checked WHERE {VALID_SQL}), t AS ({CUSTOMER_HISTORY}),
  hit AS (SELECT t.sf_account_id FROM t JOIN v ON t.sf_account_id = v.sf_account_id WHERE {_DIFFERS})
  SELECT * REPLACE (CASE WHEN sf_account_id IN (SELECT sf_account_id FROM hit) THEN 'N' ELSE active_record_ind END AS active_record_ind,
    CASE WHEN sf_account_id IN (SELECT sf_account_id FROM hit) THEN {AS_OF_SQL} ELSE record_end_dts END AS record_end_dts) FROM t
  UNION ALL
  SELECT {_SGK}, 'PCT', v.business_unit_cd, v.customer_id, v.customer_nm, v.sf_account_id, v.sf_platform_id_level_nm,
    v.business_effective_dt, v.business_expiration_dt, 'Y', {AS_OF_SQL}, {OPEN_SQL}
  FROM v LEFT JOIN t ON t.sf_account_id = v.sf_account_id WHERE t.sf_account_id IS NULL OR {_DIFFERS}""",
)
def customer_load(spark, sf):
    landing = derived(spark, sf, inputs.CUSTOMERS)
    return loads.customer_load(landing, derived(spark, sf, CUSTOMER_HISTORY), as_of()).history


STRUCTURE_HISTORY = """
SELECT 'old' AS sgk_customer_account_structure_id, 'GC' || CAST(o_orderkey + 500 AS STRING) AS sf_group_census_id,
       'PCT' AS source_system_cd, 'PBM' AS business_unit_cd, 'ACC-' || CAST(o_custkey AS STRING) AS sf_account_id,
       CAST(NULL AS STRING) AS customer_id, CAST(NULL AS STRING) AS business_hash_key_id,
       CASE WHEN o_orderkey % 3 = 0 THEN NULL
            ELSE md5('PCT|Caremark|' || CASE WHEN (o_orderkey + 500) % 6 = 0 THEN 'X' ELSE 'LOB' END || '|' ||
                     CASE WHEN (o_orderkey + 500) % 5 = 0 THEN 'X' ELSE 'PS' || CAST((o_orderkey + 500) % 100 AS STRING) END ||
                     '|F|GC' || CAST(o_orderkey + 500 AS STRING)) END AS record_hash_key_id,
       CAST(NULL AS STRING) AS business_key_txt, CAST(NULL AS STRING) AS trust_nm,
       DATE '2020-01-01' AS business_effective_dt, DATE '9999-12-31' AS business_expiration_dt,
       TIMESTAMP '2025-01-01 00:00:00' AS record_start_dts, TIMESTAMP '9999-12-31 00:00:00' AS record_end_dts,
       'Y' AS active_record_ind
FROM orders
"""
_X = "coalesce({}, 'X')".format


@query(
    "account_structure_load",
    f"""WITH t AS ({STRUCTURE_HISTORY}), b AS (
      SELECT {key_sql('s.sf_group_census_id', 's.customer_id', 'o.customer_id')} AS sgk, s.sf_group_census_id, s.source_system_cd,
        CASE s.business_unit_cd WHEN 'Third_Party' THEN '3PY' WHEN 'Caremark' THEN 'PBM' ELSE 'HCB' END AS bu,
        s.sf_account_id, o.customer_id,
        md5({_X('s.customer_id')} || '|' || s.business_unit_cd || '|' || {_X('line_of_business_cd')}) AS business_hash,
        md5('PCT|' || s.business_unit_cd || '|' || {_X('line_of_business_cd')} || '|' || {_X('plan_sponsor_unique_id')} || '|' ||
            {_X('account_status_cd')} || '|' || s.sf_group_census_id) AS record_hash,
        md5({_X('s.customer_id')} || '|' || {_X('plan_sponsor_unique_id')} || '|' || s.sf_group_census_id) AS key_txt,
        s.business_effective_dt, DATE '9999-12-31' AS business_expiration_dt
      FROM ({inputs.STRUCTURES}) s LEFT JOIN ({inputs.OWNERS}) o ON s.sf_account_id = o.sf_account_id),
    hit AS (SELECT t.sf_group_census_id FROM t JOIN b ON t.sf_group_census_id = b.sf_group_census_id
            WHERE t.record_hash_key_id IS DISTINCT FROM b.record_hash)
    SELECT * REPLACE (CASE WHEN sf_group_census_id IN (SELECT sf_group_census_id FROM hit) THEN 'N' ELSE active_record_ind END AS active_record_ind,
      CASE WHEN sf_group_census_id IN (SELECT sf_group_census_id FROM hit) THEN {AS_OF_SQL} ELSE record_end_dts END AS record_end_dts) FROM t
    UNION ALL
    SELECT sgk, b.sf_group_census_id, b.source_system_cd, bu, b.sf_account_id, b.customer_id, business_hash, record_hash, key_txt,
      NULL, b.business_effective_dt, b.business_expiration_dt, {AS_OF_SQL}, {OPEN_SQL}, 'Y'
    FROM b LEFT JOIN t ON t.sf_group_census_id = b.sf_group_census_id
    WHERE t.sf_group_census_id IS NULL OR t.record_hash_key_id IS DISTINCT FROM b.record_hash""",
)
def account_structure_load(spark, sf):
    return loads.account_structure_load(
        derived(spark, sf, inputs.STRUCTURES),
        derived(spark, sf, inputs.OWNERS),
        derived(spark, sf, STRUCTURE_HISTORY),
        as_of(),
    ).history


@query(
    "customer_load_flags",
    WITH_CHECKED
    + f"""SELECT * REPLACE (CASE WHEN indicator_flag = 'N' AND sf_account_id IN (SELECT sf_account_id FROM checked WHERE {VALID_SQL})
      THEN 'Y' ELSE indicator_flag END AS indicator_flag) FROM landing""",
)
def customer_load_flags(spark, sf):
    landing = derived(spark, sf, inputs.CUSTOMERS)
    return loads.customer_load(landing, derived(spark, sf, CUSTOMER_HISTORY), as_of()).source


@query(
    "customer_load_rejected",
    WITH_CHECKED
    + f"""SELECT {AS_OF_SQL} AS audit_dts, customer_id, customer_nm, sf_account_id, not_null_status, datatype_status,
      valid_value_status, is_duplicate FROM checked WHERE NOT ({VALID_SQL})""",
)
def customer_load_rejected(spark, sf):
    landing = derived(spark, sf, inputs.CUSTOMERS)
    rejected = loads.customer_load(landing, derived(spark, sf, CUSTOMER_HISTORY), as_of()).rejected
    return rejected.select("audit_dts", "customer_id", "customer_nm", "sf_account_id", *loads.CUSTOMER_STATUSES, "is_duplicate")


_DOCUMENTS = ", ".join(fv.CATEGORIES.values())
CONFIGURATION_HISTORY = f"""
SELECT 'old' AS sgk_customer_product_configuration_id, 'C' || CAST(o_orderkey + 700 AS STRING) AS sf_product_configuration_id,
       'A' || CAST(o_orderkey + 700 AS STRING) AS sf_product_association_id, 'PBM' AS business_unit_cd,
       CAST(NULL AS STRING) AS customer_id, {', '.join(f"CAST(NULL AS STRING) AS {d}" for d in fv.CATEGORIES.values())},
       'A' AS business_hash_key_id, 'B' AS record_hash_key_id, 'Active' AS record_status_cd, 'Y' AS active_record_ind,
       TIMESTAMP '2025-01-01 00:00:00' AS record_start_dts, TIMESTAMP '9999-12-31 00:00:00' AS record_end_dts
FROM orders
"""


@query(
    "product_configuration_load",
    f"""WITH {documents_sql(VALUE_A, 'name')}, t AS ({CONFIGURATION_HISTORY}), ent AS ({inputs.ENTITLEMENT}),
    b AS (SELECT id, assoc, {wide_sql({c: d for c, d in fv.CATEGORIES.items()})} FROM docs GROUP BY 1, 2),
    hit AS (SELECT t.sf_product_configuration_id AS id FROM t JOIN b ON b.id = t.sf_product_configuration_id
            WHERE {' OR '.join(f"b.{d} IS NOT NULL" for d in fv.CATEGORIES.values())})
    SELECT * REPLACE (CASE WHEN sf_product_configuration_id IN (SELECT id FROM hit) THEN 'N' ELSE active_record_ind END AS active_record_ind,
      CASE WHEN sf_product_configuration_id IN (SELECT id FROM hit) THEN 'Inactive' ELSE record_status_cd END AS record_status_cd,
      CASE WHEN sf_product_configuration_id IN (SELECT id FROM hit) THEN {AS_OF_SQL} ELSE record_end_dts END AS record_end_dts) FROM t
    UNION ALL
    SELECT {key_sql('b.id', 'b.assoc')}, b.id, b.assoc,
      CASE CAST(substr(b.id, 2) AS BIGINT) % 4 WHEN 0 THEN '3PY' WHEN 1 THEN 'PBM' WHEN 2 THEN 'HCB' ELSE 'Medicare' END,
      ent.customer_id, {', '.join(f"b.{d}" for d in fv.CATEGORIES.values())},
      b.id || '-' || b.assoc, sha256(b.id), 'Active', 'Y', {AS_OF_SQL}, {OPEN_SQL}
    FROM b LEFT JOIN ent ON b.assoc = ent.sf_product_association_id
    WHERE b.id NOT IN (SELECT sf_product_configuration_id FROM t) OR b.id IN (SELECT id FROM hit)""",
)
def product_configuration_load(spark, sf):
    return loads.product_configuration_load(
        derived(spark, sf, inputs.CONFIGURATION, payloads="l_orderkey"),
        derived(spark, sf, inputs.ENTITLEMENT),
        derived(spark, sf, CONFIGURATION_HISTORY),
        as_of(),
    ).history


@query(
    "contacts_load",
    f"""WITH {CONTACTS_SQL} {CONTACTS_CLOSED}
    UNION ALL SELECT {key_sql('b.id')}, b.id, aci, acau, 'Y', 'Y', {AS_OF_SQL}, {OPEN_SQL}, {AS_OF_SQL}
    FROM b WHERE b.id NOT IN (SELECT id FROM t) OR b.id IN (SELECT id FROM hit)""",
)
def contacts_load(spark, sf):
    return loads.contacts_load(
        derived(spark, sf, inputs.CONTACTS), derived(spark, sf, inputs.CONTACTS_HISTORY), as_of()
    ).history


ACCOUNTS = """
SELECT 'ACC-' || CAST(c_custkey AS STRING) AS sf_account_id, 'before' AS customer_account_structure_level_1_id,
       CAST(0 AS BIGINT) AS employee_cnt, CAST(NULL AS TIMESTAMP) AS orig_src_pst_dts,
       CAST(NULL AS TIMESTAMP) AS source_last_process_dts
FROM customer
"""


@query(
    "mapped_load",
    f"""WITH m AS (SELECT 'ACC-' || user_id AS sf_account_id, {LEVEL_1_SQL} AS level_1, CASE WHEN event_id % 3 = 1 THEN user_id END AS cnt,
      TIMESTAMP '2025-12-22 18:15:02' AS orig, CASE WHEN event_id % 6 <> 0 THEN TIMESTAMP '2025-12-23 01:00:00' END AS last,
      event_id FROM events),
    b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sf_account_id ORDER BY last DESC NULLS LAST,
      level_1 DESC NULLS LAST, cnt DESC NULLS LAST) AS rn FROM m) r WHERE rn = 1), t AS ({ACCOUNTS})
    SELECT coalesce(b.sf_account_id, t.sf_account_id) AS sf_account_id,
      CASE WHEN b.sf_account_id IS NOT NULL THEN b.level_1 ELSE t.customer_account_structure_level_1_id END AS customer_account_structure_level_1_id,
      CASE WHEN b.sf_account_id IS NOT NULL THEN b.cnt ELSE t.employee_cnt END AS employee_cnt,
      b.orig AS orig_src_pst_dts, b.last AS source_last_process_dts
    FROM t FULL JOIN b ON t.sf_account_id = b.sf_account_id""",
)
def mapped_load(spark, sf):
    spec = MappingSpec(
        {"sf_account_id": "Account__c", "employee_cnt": "Count__c"},
        {"customer_account_structure_level_1_id": level_1_id_route},
    )
    target = derived(spark, sf, ACCOUNTS).withColumns(
        {c: F.col(c).cast(T.TimestampNTZType()) for c in ("orig_src_pst_dts", "source_last_process_dts")}
    )
    return loads.mapped_load(
        derived(spark, sf, inputs.MAPPED, payloads=True),
        target,
        spec,
        latest_by=["source_last_process_dts", "customer_account_structure_level_1_id", "employee_cnt"],
    ).history


_NEXT_ELEMENTS = f"SELECT * FROM ({inputs.ELEMENTS_CHECK}) e WHERE pos = 0 OR CAST(substr(id, 2) AS BIGINT) % 5 <> 0"
_UNIT = "CASE CAST(substr(id, 2) AS BIGINT) % 4 WHEN 0 THEN '3PY' WHEN 1 THEN 'PBM' WHEN 2 THEN 'HCB' ELSE 'Medicare' END"
_AS_NEW = f"id AS sf_product_configuration_id, assoc AS sf_product_association_id, {_UNIT} AS business_unit_cd, {_DOCUMENTS}"
_NEXT = "TIMESTAMP '2026-02-01 00:00:00'"


@query(
    "product_configuration_reload",
    f"""WITH b1 AS (WITH {documents_sql(VALUE_A, 'name')} SELECT id, assoc, {wide_sql(fv.CATEGORIES)} FROM docs GROUP BY 1, 2),
      b2 AS (WITH {documents_sql(VALUE_A, 'name', elements=_NEXT_ELEMENTS)} SELECT id, assoc, {wide_sql(fv.CATEGORIES)} FROM docs GROUP BY 1, 2),
      hit AS (SELECT b1.id FROM b1 JOIN b2 ON b1.id = b2.id WHERE {' OR '.join(f"b1.{d} IS DISTINCT FROM b2.{d}" for d in fv.CATEGORIES.values())})
    SELECT {_AS_NEW}, CASE WHEN id IN (SELECT id FROM hit) THEN 'Inactive' ELSE 'Active' END AS record_status_cd,
      CASE WHEN id IN (SELECT id FROM hit) THEN 'N' ELSE 'Y' END AS active_record_ind, {AS_OF_SQL} AS record_start_dts,
      CASE WHEN id IN (SELECT id FROM hit) THEN {_NEXT} ELSE {OPEN_SQL} END AS record_end_dts FROM b1
    UNION ALL SELECT {_AS_NEW}, 'Active', 'Y', {_NEXT}, {OPEN_SQL} FROM b2 WHERE id IN (SELECT id FROM hit)""",
)
def product_configuration_reload(spark, sf):
    """Two deliveries, one after the other: the history's documents are those of the first."""
    entitlement = derived(spark, sf, inputs.ENTITLEMENT)
    names = (
        "sf_product_configuration_id string, sf_product_association_id string, business_unit_cd string, "
        + ", ".join(f"{d} string" for d in fv.CATEGORIES.values())
        + ", record_status_cd string, active_record_ind string, record_start_dts timestamp_ntz, record_end_dts timestamp_ntz"
    )
    history = spark.createDataFrame([], names)
    for landing, moment in ((inputs.CONFIGURATION, AS_OF_TEXT), (inputs.NEXT_CONFIGURATION, "2026-02-01 00:00:00")):
        rows = derived(spark, sf, landing, payloads="l_orderkey")
        as_of_then, before = F.lit(moment).cast("timestamp_ntz"), history
        # what the load stages goes with its end, and the history before with the new one
        history = tables.stage_result(spark, lambda: loads.product_configuration_load(rows, entitlement, before, as_of_then).history, "reload")
        tables.discard(before)
    return history


# --- rejected rows and flags of the other loads ------------------------------------------------

# Some structures, contacts and configurations arrive several times in one batch.
REPEATED_STRUCTURES = inputs.STRUCTURES.replace(
    "'GC' || CAST(o_orderkey AS STRING) AS sf_group_census_id",
    "'GC' || CAST(CASE WHEN o_orderkey % 9 = 1 THEN o_orderkey - 1 WHEN o_orderkey % 9 = 5 THEN NULL ELSE o_orderkey END AS STRING) AS sf_group_census_id",
)
REPEATED_CONTACTS = inputs.CONTACTS.replace(
    "CAST(p_partkey AS STRING) AS ID", "CAST(CASE WHEN p_partkey % 7 = 2 THEN p_partkey - 1 ELSE p_partkey END AS STRING) AS ID"
)
_DELIVERED = """
SELECT ID, Product_Association_ID, 'Caremark' AS line_of_business, CAST(NULL AS STRING) AS Grouper_val, TIMESTAMP '2025-11-01 00:00:00' AS CreatedDate,
       CASE delivery WHEN 1 THEN TIMESTAMP '2025-12-01 00:00:00' WHEN 2 THEN TIMESTAMP '2025-12-02 00:00:00' ELSE TIMESTAMP '2025-12-03 00:00:00' END AS LastModifiedDate,
       'N' AS indicator_flag, Payload
FROM ({deliveries}) d
"""
DELIVERED = _DELIVERED.format(deliveries=inputs.DELIVERIES)
DELIVERED_CHECK = _DELIVERED.format(deliveries=inputs.DELIVERIES_CHECK)


@query(
    "account_structure_load_rejected",
    f"""SELECT {AS_OF_SQL} AS audit_dts, sf_group_census_id, sf_account_id, '{loads.REPEATED_KEY}' AS reject_reason
    FROM ({REPEATED_STRUCTURES}) s WHERE sf_group_census_id IN
      (SELECT sf_group_census_id FROM ({REPEATED_STRUCTURES}) r GROUP BY 1 HAVING count(*) > 1)""",
)
def account_structure_load_rejected(spark, sf):
    owners, target = derived(spark, sf, inputs.OWNERS), derived(spark, sf, STRUCTURE_HISTORY)
    load = loads.account_structure_load(derived(spark, sf, REPEATED_STRUCTURES), owners, target, as_of())
    return load.rejected.select("audit_dts", "sf_group_census_id", "sf_account_id", loads.REASON)


@query(
    "product_configuration_load_rejected",
    f"""WITH d AS (SELECT DISTINCT ID, Product_Association_ID, LastModifiedDate FROM ({DELIVERED_CHECK}) x)
    SELECT {AS_OF_SQL} AS audit_dts, ID AS sf_product_configuration_id, LastModifiedDate AS source_last_process_dts, e.customer_id,
      '{loads.REPEATED_KEY}' AS reject_reason
    FROM d LEFT JOIN ({inputs.ENTITLEMENT}) e ON Product_Association_ID = sf_product_association_id
    WHERE ID IN (SELECT ID FROM d GROUP BY ID HAVING count(*) > 1)""",
)
def product_configuration_load_rejected(spark, sf):
    landing = derived(spark, sf, DELIVERED, payloads="l_orderkey")
    entitlement, target = derived(spark, sf, inputs.ENTITLEMENT), derived(spark, sf, CONFIGURATION_HISTORY)
    load = loads.product_configuration_load(landing, entitlement, target, as_of(), per_delivery=["LastModifiedDate"])
    return load.rejected.select("audit_dts", "sf_product_configuration_id", "source_last_process_dts", "customer_id", loads.REASON)


@query(
    "contacts_load_rejected",
    f"""WITH p AS (SELECT * FROM ({REPEATED_CONTACTS}) c WHERE indicator_flag = 'Y')
    SELECT {AS_OF_SQL} AS audit_dts, ID AS id, '{loads.REPEATED_KEY}' AS reject_reason FROM p
    WHERE ID IN (SELECT ID FROM p GROUP BY ID HAVING count(*) > 1)""",
)
def contacts_load_rejected(spark, sf):
    load = loads.contacts_load(derived(spark, sf, REPEATED_CONTACTS), derived(spark, sf, inputs.CONTACTS_HISTORY), as_of())
    return load.rejected.select("audit_dts", "id", loads.REASON)


@query(
    "product_configuration_load_flags",
    f"""SELECT * REPLACE (CASE WHEN ID IN (SELECT sf_product_configuration_id FROM ({CONFIGURATION_HISTORY}) t)
      OR ID NOT IN (SELECT ID FROM ({DELIVERED_CHECK}) x GROUP BY ID HAVING count(DISTINCT LastModifiedDate) > 1) THEN 'Y' ELSE 'N' END AS indicator_flag)
    FROM ({DELIVERED_CHECK}) d""",
)
def product_configuration_load_flags(spark, sf):
    """Configurations whose deliveries are rejected stay pending, unless the history has them."""
    landing = derived(spark, sf, DELIVERED, payloads="l_orderkey")
    entitlement, target = derived(spark, sf, inputs.ENTITLEMENT), derived(spark, sf, CONFIGURATION_HISTORY)
    return loads.product_configuration_load(landing, entitlement, target, as_of(), per_delivery=["LastModifiedDate"]).source


@query(
    "contacts_load_flags",
    f"""WITH c AS ({REPEATED_CONTACTS}), p AS (SELECT ID FROM c WHERE indicator_flag = 'Y' GROUP BY ID HAVING count(*) = 1)
    SELECT * REPLACE (CASE WHEN indicator_flag = 'Y' AND (ID IN (SELECT ID FROM p) OR ID IN (SELECT id FROM ({inputs.CONTACTS_HISTORY}) t))
      THEN 'N' ELSE indicator_flag END AS indicator_flag) FROM c""",
)
def contacts_load_flags(spark, sf):
    return loads.contacts_load(derived(spark, sf, REPEATED_CONTACTS), derived(spark, sf, inputs.CONTACTS_HISTORY), as_of()).source


# --- further forms -------------------------------------------------------------------------------

# The payload is the object itself, not an array of it.
OBJECT_CONTACTS = f"""
SELECT ID, indicator_flag, CASE WHEN Payload = '[]' THEN '{{}}' ELSE substring(Payload, 2, length(Payload) - 2) END AS Payload
FROM ({inputs.CONTACTS}) c
"""


@query(
    "contacts_load_objects",
    f"""WITH {CONTACTS_SQL} {CONTACTS_CLOSED}
    UNION ALL SELECT {key_sql('b.id')}, b.id, aci, acau, 'Y', 'Y', {AS_OF_SQL}, {OPEN_SQL}, {AS_OF_SQL}
    FROM b WHERE b.id NOT IN (SELECT id FROM t) OR b.id IN (SELECT id FROM hit)""",
)
def contacts_load_objects(spark, sf):
    return loads.contacts_load(derived(spark, sf, OBJECT_CONTACTS), derived(spark, sf, inputs.CONTACTS_HISTORY), as_of()).history


_GROUPED = ", ".join(f"{'CAST(NULL AS STRING)' if i % 2 else chr(39) + 'keep' + chr(39)} AS {c}" for i, c in enumerate(fv.CHILDREN.values()))
GROUPED_CONFIGURATIONS = f"""
SELECT 'old-' || CAST(c_custkey AS STRING) AS sgk_customer_product_configuration_id, 'C' || CAST(c_custkey AS STRING) AS sf_product_configuration_id,
       'A' || CAST(c_custkey AS STRING) AS sf_product_association_id, 'G' || CAST(c_custkey AS STRING) AS customer_population_group_id,
       c_name AS program_rules, {_GROUPED}, CAST(NULL AS STRING) AS update_by, 'Active' AS record_status_cd,
       CASE WHEN c_custkey % 6 = 0 THEN 'N' ELSE 'Y' END AS active_record_ind, TIMESTAMP '2025-01-01 00:00:00' AS insert_dts,
       TIMESTAMP '2025-01-01 00:00:00' AS last_process_dts, TIMESTAMP '2025-01-01 00:00:00' AS record_start_dts,
       TIMESTAMP '9999-12-31 00:00:00' AS record_end_dts
FROM customer
"""
_HIT = "active_record_ind = 'Y' AND customer_population_group_id IN (SELECT grp FROM docs)"


@query(
    "reversion_load",
    WITH_GROUPS.replace(inputs.GROUP_HISTORY, GROUPED_CONFIGURATIONS)
    + f"""SELECT * REPLACE (CASE WHEN {_HIT} THEN 'N' ELSE active_record_ind END AS active_record_ind,
      CASE WHEN {_HIT} THEN 'Inactive' ELSE record_status_cd END AS record_status_cd,
      CASE WHEN {_HIT} THEN {AS_OF_SQL} ELSE record_end_dts END AS record_end_dts) FROM t
    UNION ALL
    SELECT {key_sql('sf_product_configuration_id', 'sf_product_association_id', 'customer_population_group_id')}, sf_product_configuration_id,
      sf_product_association_id, customer_population_group_id, program_rules, {", ".join(f"docs.{c}" for c in fv.CHILDREN.values())},
      '{fv.UPDATED_BY}', 'Active', 'Y', {AS_OF_SQL}, {AS_OF_SQL}, {AS_OF_SQL}, {OPEN_SQL}
    FROM t JOIN docs ON customer_population_group_id = docs.grp WHERE active_record_ind = 'Y'""",
)
def reversion_load(spark, sf):
    configurations = derived(spark, sf, inputs.GROUPS).withColumnRenamed("grp", "Grouper_val")
    children = derived(spark, sf, inputs.CHILD_ROWS, payloads=True).withColumnsRenamed({"grp": "Grouper_val", "payload": "Payload"})
    return loads.reversion_load(configurations, children, derived(spark, sf, GROUPED_CONFIGURATIONS), as_of(), order_by=["modified", "n"]).history


@query(
    "literal_source",
    f"""SELECT customer_id, customer_nm, sf_account_id, business_unit_cd, indicator_flag, business_effective_dt, segment
    FROM ({inputs.CUSTOMERS}) c WHERE indicator_flag = 'N'
    UNION ALL SELECT 'L1', 'By hand', 'ACC-L1', 'Aetna', 'N', DATE '2025-05-01', NULL
    UNION ALL SELECT NULL, NULL, 'ACC-L2', NULL, 'N', NULL, NULL""",
)
def literal_source(spark, sf):
    """Rows written out in code, appended by name to the landing rows; the missing columns are NULL."""
    landing = derived(spark, sf, inputs.CUSTOMERS).select(
        "customer_id", "customer_nm", "sf_account_id", "business_unit_cd", "indicator_flag", "business_effective_dt", "segment"
    )
    by_hand = tables.literal_rows(
        spark,
        [("N", "ACC-L1", "L1", "By hand", "Aetna", datetime.date(2025, 5, 1)), ("N", "ACC-L2", None, None, None, None)],
        T.StructType.fromDDL("indicator_flag string, sf_account_id string, customer_id string, customer_nm string, business_unit_cd string, business_effective_dt date"),
    )
    return tables.pending(tables.append_rows(landing, by_hand))
