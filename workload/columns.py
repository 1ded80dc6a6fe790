"""Scans, column functions and row checks over landing customers."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from histflow import fixed_values as fv, work_folder
from histflow.functions import scalar as fx
from histflow.operators import quality
from histflow.plans import loads
from histflow.sources import catalog, tables
from workload import inputs
from workload.registry import AS_OF_SQL, as_of, derived, key_sql, query, read

WITH_CUSTOMERS = f"WITH landing AS ({inputs.CUSTOMERS}) "
BU_SQL = (
    "CASE business_unit_cd WHEN 'Third_Party' THEN '3PY' WHEN 'Caremark' THEN 'PBM' "
    "WHEN 'Aetna' THEN 'HCB' ELSE business_unit_cd END"
)


def customers(spark, sf):
    return derived(spark, sf, inputs.CUSTOMERS)


@query("pending_scan", WITH_CUSTOMERS + "SELECT * FROM landing WHERE indicator_flag = 'N'")
def pending_scan(spark, sf):
    return tables.pending(customers(spark, sf))


@query(
    "ddl_schema",
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer",
)
def ddl_schema(spark, sf):
    declared = T.StructType.fromDDL("c_custkey bigint not null, c_name string, c_nationkey int, c_acctbal double")
    return tables.read_table(spark, f"{sf}/customer.parquet", declared)


# Customers with missing ids, names and dates, and a text where a number is declared.
DECLARED_CUSTOMER = "customer_id string not null, customer_nm string not null, sf_account_id string not null, segment bigint, business_effective_dt date"
_VIOLATED = """concat_ws(',', CASE WHEN customer_id IS NULL THEN 'customer_id' END, CASE WHEN customer_nm IS NULL THEN 'customer_nm' END,
  CASE WHEN sf_account_id IS NULL THEN 'sf_account_id' END, CASE WHEN segment IS NOT NULL AND TRY_CAST(segment AS BIGINT) IS NULL THEN 'segment' END)"""
_MIXED = f"""SELECT customer_id, customer_nm, sf_account_id, CASE WHEN segment = 'BUILDING' THEN segment WHEN segment = 'MACHINERY' THEN '12' END AS segment,
  business_effective_dt FROM ({inputs.CUSTOMERS}) c"""


def declared_customers(spark, sf):
    path = work_folder(spark, "declared")
    derived(spark, sf, _MIXED).write.parquet(path)
    return tables.constrained(spark.read.parquet(path), DECLARED_CUSTOMER)


@query(
    "ddl_not_null",
    f"""SELECT customer_id, customer_nm, sf_account_id, CAST(segment AS BIGINT) AS segment, business_effective_dt
    FROM ({_MIXED}) m WHERE {_VIOLATED} = ''""",
)
def ddl_not_null(spark, sf):
    return declared_customers(spark, sf)[0]


@query(
    "ddl_violations",
    f"SELECT *, {_VIOLATED} AS violated FROM ({_MIXED}) m WHERE {_VIOLATED} <> ''",
)
def ddl_violations(spark, sf):
    return declared_customers(spark, sf)[1].withColumn("violated", F.array_join("violated", ","))


@query(
    "layout_compact",
    "SELECT CAST(ts AS DATE) AS load_dt, event_type, count(*) AS n, min(user_id) AS least_user, TRUE AS shallow FROM events GROUP BY 1, 2",
)
def layout_compact(spark, sf):
    """Four appends to the same days, ordered again."""
    path = work_folder(spark, "layout")
    events = read(spark, sf, "events")
    for part in range(4):
        tables.layout_write(events.where(F.col("event_id") % 4 == part), path, "ts", ["event_id"])
    tables.layout_compact(spark, path, ["event_id"])
    table = spark.read.parquet(path)
    depth = tables.layout_overlap(table, "event_id").select("load_dt", (F.col("depth") <= 2).alias("shallow"))
    counted = table.groupBy("load_dt", "event_type").agg(F.count(F.lit(1)).alias("n"), F.min("user_id").alias("least_user"))
    return counted.join(depth, "load_dt")


@query(
    "layout_write",
    "SELECT CAST(ts AS DATE) AS load_dt, event_type, count(*) AS n, min(user_id) AS least_user FROM events GROUP BY 1, 2",
)
def layout_write(spark, sf):
    path = work_folder(spark, "layout")
    tables.layout_write(read(spark, sf, "events"), path, "ts", ["user_id"])
    written = spark.read.parquet(path)
    return written.groupBy("load_dt", "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.min("user_id").alias("least_user")
    )


@query(
    "literal_rows",
    """SELECT CAST(c_custkey AS VARCHAR) AS id,
       '[{"ACI_Client__c":"' || c_mktsegment || '","ACI_Contact__c":null,"AccountId":"' || c_name || '"}]' AS payload
       FROM customer""",
)
def literal_rows(spark, sf):
    payload = tables.json_payload(
        {
            "ACI_Client__c": F.col("c_mktsegment"),
            "ACI_Contact__c": F.lit(None).cast("string"),
            "AccountId": F.col("c_name"),
        }
    )
    return read(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("id"), payload.alias("payload"))


@query(
    "staged",
    WITH_CUSTOMERS
    + f"""SELECT indicator_flag, {BU_SQL} AS business_unit_cd, count(*) AS n, count(customer_id) AS with_id
       FROM landing GROUP BY 1, 2""",
)
def staged(spark, sf):
    source = customers(spark, sf).withColumn("business_unit_cd", fx.code_map("business_unit_cd", fv.BUSINESS_UNITS))
    written = tables.stage(source.select(fx.random_key().alias("id"), "*"), "customers")
    return written.groupBy("indicator_flag", "business_unit_cd").agg(
        F.countDistinct("id").alias("n"), F.count("customer_id").alias("with_id")
    )


@query(
    "append_named",
    f"""SELECT k, h, active, s, e FROM ({inputs.HISTORY}) t
    UNION ALL SELECT k, h, 'Y', {AS_OF_SQL}, NULL FROM ({inputs.BATCH}) b""",
)
def append_named(spark, sf):
    rows = derived(spark, sf, inputs.BATCH).select(
        F.lit("Y").alias("active"), "h", as_of().alias("s"), "k", F.lit(1).alias("unknown_to_target")
    )
    return tables.append_rows(derived(spark, sf, inputs.HISTORY), rows)


@query(
    "target_columns",
    "\nUNION ALL ".join(
        f"SELECT {i} AS ordinal_position, '{name}' AS column_name, '{kind}' AS data_type, count({name}) AS filled "
        f"FROM ({inputs.CUSTOMERS}) c"
        for i, (name, kind) in enumerate(
            [
                ("customer_id", "string"),
                ("customer_nm", "string"),
                ("sf_account_id", "string"),
                ("business_unit_cd", "string"),
                ("sf_platform_id_level_nm", "string"),
                ("indicator_flag", "string"),
                ("business_effective_dt", "date"),
                ("business_expiration_dt", "date"),
                ("segment", "string"),
            ],
            start=1,
        )
    ),
)
def target_columns(spark, sf):
    return catalog.column_profile(customers(spark, sf))


@query(
    "mapping_rows",
    """SELECT p_partkey, 'name' AS target_field, p_name AS source_field FROM part
       UNION ALL SELECT p_partkey, lower(p_type), '' FROM part""",
)
def mapping_rows(spark, sf):
    text = (
        """SELECT p_partkey, '{"field_mappings":[{"target_field":"name","source_field":"' || p_name ||
        '"},{"target_field":"' || lower(p_type) || '"}]}' AS doc FROM part"""
    )
    return catalog.mapping_rows(derived(spark, sf, text), "doc", keep=("p_partkey",))


@query(
    "bound_params",
    f"SELECT 'dev' AS env, {AS_OF_SQL} AS run_dts, c_mktsegment, count(*) AS n FROM customer GROUP BY c_mktsegment",
)
def bound_params(spark, sf):
    read(spark, sf, "customer").createOrReplaceTempView("dev_customer")
    return tables.bound_query(
        spark,
        "SELECT :env AS env, CAST(:run AS timestamp_ntz) AS run_dts, c_mktsegment, count(*) AS n "
        "FROM IDENTIFIER(:env || '_customer') GROUP BY c_mktsegment",
        env="dev",
        run="2026-01-01 00:00:00",
    )


@query("code_map", WITH_CUSTOMERS + f"SELECT sf_account_id, segment, {BU_SQL} AS business_unit_cd FROM landing")
def code_map(spark, sf):
    return customers(spark, sf).select(
        "sf_account_id", "segment", fx.code_map("business_unit_cd", fv.BUSINESS_UNITS).alias("business_unit_cd")
    )


@query(
    "code_map_ci",
    WITH_CUSTOMERS
    + """SELECT sf_account_id, segment, CASE upper(bu) WHEN 'THIRD_PARTY' THEN '3PY' WHEN 'CAREMARK' THEN 'PBM'
       WHEN 'AETNA' THEN 'HCB' ELSE bu END AS business_unit_cd, bu AS delivered
       FROM (SELECT *, CASE indicator_flag WHEN 'Y' THEN lower(business_unit_cd) ELSE business_unit_cd END AS bu
             FROM landing) l""",
)
def code_map_ci(spark, sf):
    mixed = customers(spark, sf).withColumn(
        "delivered", F.when(F.col("indicator_flag") == "Y", F.lower("business_unit_cd")).otherwise(F.col("business_unit_cd"))
    )
    return mixed.select(
        "sf_account_id",
        "segment",
        fx.code_map("delivered", fv.BUSINESS_UNITS, ignore_case=True).alias("business_unit_cd"),
        "delivered",
    )


@query(
    "sentinels",
    WITH_CUSTOMERS
    + """SELECT sf_account_id, segment, 'PCT' AS source_system_cd, 'Y' AS active_record_ind,
       coalesce(business_effective_dt, DATE '1900-01-01') AS effective,
       coalesce(business_expiration_dt, DATE '9999-12-31') AS expiration,
       TIMESTAMP '9999-12-31 00:00:00' AS record_end_dts FROM landing""",
)
def sentinels(spark, sf):
    return customers(spark, sf).select(
        "sf_account_id",
        "segment",
        F.lit(fv.SOURCE_SYSTEM).alias("source_system_cd"),
        F.lit("Y").alias("active_record_ind"),
        fx.default_date("business_effective_dt", fx.low_date()).alias("effective"),
        fx.default_date("business_expiration_dt", fx.high_date()).alias("expiration"),
        fx.open_end("timestamp_ntz").alias("record_end_dts"),
    )


@query(
    "hash_keys",
    WITH_CUSTOMERS
    + """SELECT sf_account_id, segment,
       md5(coalesce(customer_id, 'X') || '|' || coalesce(customer_nm, 'X') || '|' || coalesce(sf_platform_id_level_nm, 'X')) AS keyed,
       md5(concat_ws('|', customer_id, customer_nm, sf_platform_id_level_nm)) AS nulls_omitted,
       md5(customer_id) AS one, sha256(sf_account_id) AS sha FROM landing""",
)
def hash_keys(spark, sf):
    cols = ["customer_id", "customer_nm", "sf_platform_id_level_nm"]
    return customers(spark, sf).select(
        "sf_account_id",
        "segment",
        fx.md5_key(cols).alias("keyed"),
        fx.md5_key(cols, null_text=None).alias("nulls_omitted"),
        F.md5("customer_id").alias("one"),
        fx.sha256_key("sf_account_id").alias("sha"),
    )


@query("concat_key", WITH_CUSTOMERS + "SELECT sf_account_id, segment, customer_id || '-' || customer_nm AS business_key FROM landing")
def concat_key(spark, sf):
    return customers(spark, sf).select(
        "sf_account_id", "segment", fx.joined_key(["customer_id", "customer_nm"]).alias("business_key")
    )


@query(
    "surrogate_key",
    WITH_CUSTOMERS
    + f"SELECT sf_account_id, segment, {key_sql('sf_account_id', 'customer_id')} AS sgk FROM landing",
)
def surrogate_key(spark, sf):
    return customers(spark, sf).select(
        "sf_account_id", "segment", fx.surrogate_key(["sf_account_id", "customer_id"], as_of()).alias("sgk")
    )


@query(
    "safe_cast",
    """SELECT event_id, TRY_CAST(n AS BIGINT) AS as_number,
       CASE WHEN length(d) = 10 THEN TRY_CAST(d AS DATE) END AS as_date,
       CASE WHEN b IN ('true', 'false') THEN CAST(b AS BOOLEAN) END AS as_flag
       FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN event_type ELSE CAST(user_id AS VARCHAR) END AS n,
                    CASE WHEN event_id % 4 = 0 THEN '2025' ELSE strftime(ts, '%Y-%m-%d') END AS d,
                    CASE event_id % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'false' ELSE 't' END AS b FROM events) e""",
)
def safe_cast(spark, sf):
    e = F.col("event_id")
    events = read(spark, sf, "events").select(
        e,
        F.when(e % 3 == 0, F.col("event_type")).otherwise(F.col("user_id").cast("string")).alias("n"),
        F.when(e % 4 == 0, "2025").otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("d"),
        F.when(e % 3 == 0, "true").when(e % 3 == 1, "false").otherwise("t").alias("b"),
    )
    return events.select(
        "event_id",
        fx.safe_cast("n", "bigint").alias("as_number"),
        fx.safe_cast("d", "date").alias("as_date"),
        fx.safe_cast("b", "boolean").alias("as_flag"),
    )


# --- checks ------------------------------------------------------------------------------

NOT_NULL_SQL = """CASE WHEN l.business_unit_cd IS NULL OR l.customer_id IS NULL OR l.customer_nm IS NULL
  OR l.sf_account_id IS NULL THEN 'FAIL_NOT_NULL' ELSE 'PASS' END"""
DATATYPE_SQL = "CASE WHEN l.customer_id IS NULL THEN 'FAIL_DATATYPE' ELSE 'PASS' END"
ALLOWED_SQL = """CASE WHEN lower(l.sf_platform_id_level_nm) IN ('true', 'false') THEN 'PASS' ELSE 'FAIL_VALID_VALUE' END"""
CHECKED_SQL = f"""
  SELECT l.customer_id, l.customer_nm, l.sf_account_id, l.segment, {BU_SQL} AS business_unit_cd,
         l.sf_platform_id_level_nm, coalesce(l.business_effective_dt, DATE '1900-01-01') AS business_effective_dt,
         coalesce(l.business_expiration_dt, DATE '9999-12-31') AS business_expiration_dt,
         {NOT_NULL_SQL} AS not_null_status, {DATATYPE_SQL} AS datatype_status, {ALLOWED_SQL} AS valid_value_status,
         d.cnt IS NOT NULL AS is_duplicate
  FROM pending l LEFT JOIN dup d
    ON l.customer_id = d.customer_id AND l.customer_nm = d.customer_nm AND l.sf_account_id = d.sf_account_id
"""
WITH_CHECKED = (
    WITH_CUSTOMERS
    + f""", pending AS (SELECT * FROM landing WHERE indicator_flag = 'N'),
  dup AS (SELECT customer_id, customer_nm, sf_account_id, count(*) AS cnt FROM pending GROUP BY 1, 2, 3 HAVING count(*) > 1),
  checked AS ({CHECKED_SQL}) """
)
VALID_SQL = (
    "not_null_status = 'PASS' AND datatype_status = 'PASS' AND valid_value_status = 'PASS' AND NOT is_duplicate"
)


@query("rule_not_null", WITH_CUSTOMERS + f"SELECT sf_account_id, segment, {NOT_NULL_SQL} AS not_null_status FROM landing l")
def rule_not_null(spark, sf):
    source = loads.customer_source(customers(spark, sf).withColumn("indicator_flag", F.lit("N")), as_of())
    return source.select("sf_account_id", "segment", quality.not_null_rule(fv.REQUIRED_CUSTOMER_COLUMNS).alias("not_null_status"))


@query("rule_datatype", WITH_CUSTOMERS + f"SELECT sf_account_id, segment, {DATATYPE_SQL} AS datatype_status FROM landing l")
def rule_datatype(spark, sf):
    rule = quality.castable_rule({"customer_id": "bigint"})
    return customers(spark, sf).select("sf_account_id", "segment", rule.alias("datatype_status"))


@query("rule_allowed", WITH_CUSTOMERS + f"SELECT sf_account_id, segment, {ALLOWED_SQL} AS valid_value_status FROM landing l")
def rule_allowed(spark, sf):
    rule = quality.allowed_rule("sf_platform_id_level_nm", fv.PLATFORM_FLAG_VALUES)
    return customers(spark, sf).select("sf_account_id", "segment", rule.alias("valid_value_status"))


@query(
    "duplicate_keys",
    WITH_CUSTOMERS
    + """SELECT customer_id, customer_nm, sf_account_id, count(*) AS cnt FROM landing
       GROUP BY 1, 2, 3 HAVING count(*) > 1""",
)
def duplicate_keys(spark, sf):
    return quality.duplicate_keys(customers(spark, sf), fv.DUPLICATE_CUSTOMER_KEYS)


@query("valid_split", WITH_CHECKED + f"SELECT *, {VALID_SQL} AS is_valid FROM checked")
def valid_split(spark, sf):
    checked = loads.check_customers(loads.customer_source(customers(spark, sf), as_of()))
    return checked.select(
        "customer_id",
        "customer_nm",
        "sf_account_id",
        "segment",
        "business_unit_cd",
        "sf_platform_id_level_nm",
        "business_effective_dt",
        "business_expiration_dt",
        *loads.CUSTOMER_STATUSES,
        quality.DUPLICATE,
        quality.is_valid(loads.CUSTOMER_STATUSES).alias("is_valid"),
    )


@query(
    "audit_append",
    WITH_CHECKED
    + f"""SELECT {AS_OF_SQL} AS audit_dts, customer_id, customer_nm, sf_account_id, segment, not_null_status,
       datatype_status, valid_value_status, is_duplicate FROM checked WHERE NOT ({VALID_SQL})""",
)
def audit_append(spark, sf):
    checked = loads.check_customers(loads.customer_source(customers(spark, sf), as_of()))
    _, invalid = quality.split_valid(checked, loads.CUSTOMER_STATUSES)
    path = work_folder(spark, "audit")
    rows = quality.audit_rows(invalid, as_of()).select(
        "audit_dts", *fv.DUPLICATE_CUSTOMER_KEYS, "segment", *loads.CUSTOMER_STATUSES, quality.DUPLICATE
    )
    tables.append_named(rows, path, rows.schema)
    return spark.read.schema(rows.schema).parquet(path)


@query(
    "left_enrich",
    f"""SELECT s.sf_group_census_id, s.sf_account_id, o.customer_id FROM ({inputs.STRUCTURES}) s
       LEFT JOIN ({inputs.OWNERS}) o ON s.sf_account_id = o.sf_account_id""",
)
def left_enrich(spark, sf):
    source = loads.account_structure_source(
        derived(spark, sf, inputs.STRUCTURES), derived(spark, sf, inputs.OWNERS), as_of()
    )
    return source.select("sf_group_census_id", "sf_account_id", "customer_id")
