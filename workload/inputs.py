"""Input rows, derived from the whole given tables by portable SQL."""

from histflow.fixed_values import CHILDREN

# Landing customers: NULLs, bad values, and pairs of equal keys.
CUSTOMERS = """
SELECT CASE WHEN k % 97 = 0 THEN NULL ELSE CAST(k AS STRING) END AS customer_id,
       CASE WHEN k % 53 = 0 THEN NULL ELSE 'Customer ' || CAST(k AS STRING) END AS customer_nm,
       'ACC-' || CAST(k AS STRING) AS sf_account_id,
       CASE c_nationkey % 4 WHEN 0 THEN 'Third_Party' WHEN 1 THEN 'Caremark' WHEN 2 THEN 'Aetna'
            ELSE c_mktsegment END AS business_unit_cd,
       CASE k % 5 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'false' WHEN 2 THEN 'maybe' WHEN 3 THEN 'True'
            ELSE NULL END AS sf_platform_id_level_nm,
       CASE WHEN k % 3 = 0 THEN 'Y' ELSE 'N' END AS indicator_flag,
       CASE WHEN k % 7 = 0 THEN NULL ELSE DATE '2024-01-01' END AS business_effective_dt,
       CASE WHEN k % 11 = 0 THEN DATE '2027-06-30' ELSE NULL END AS business_expiration_dt,
       c_mktsegment AS segment
FROM (SELECT CASE WHEN c_custkey % 41 = 1 THEN c_custkey - 1 ELSE c_custkey END AS k,
             c_nationkey, c_mktsegment FROM customer) c
"""

# A flat history table and a source batch whose keys overlap it: the first 150
# keys are gone from the source, its last 150 are new; some hashes are NULL,
# some changed.
HISTORY = """
SELECT c_custkey AS k, 'H' || CAST(c_custkey % 10 AS STRING) AS h, 'Y' AS active,
       TIMESTAMP '2025-01-01 00:00:00' AS s, TIMESTAMP '9999-12-31 00:00:00' AS e FROM customer
UNION ALL
SELECT c_custkey, 'OLD', 'N', TIMESTAMP '2024-01-01 00:00:00', TIMESTAMP '2025-01-01 00:00:00' FROM customer
"""
BATCH = """
SELECT c_custkey + 150 AS k,
       CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 4 = 0 THEN 'NEW'
            ELSE 'H' || CAST((c_custkey + 150) % 10 AS STRING) END AS h
FROM customer
"""

# Messages about customers; several per key.
MESSAGES = """
SELECT o_custkey AS k, o_orderdate AS modified, o_orderkey AS n, o_orderstatus AS status,
       o_orderpriority AS priority
FROM orders
"""

# Attribute lists: one landing row per order with a JSON array of attributes.
# pos is the element's position (ties are equal text).
ATTRIBUTES = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag,
  '{"AttributeName__c":"' || CASE WHEN l_linenumber = 7 THEN 'Contracted LOB (Sub) Category'
      ELSE 'Attr ' || CAST(l_linenumber AS STRING) || ' (x)' END ||
  '","Attribute_Category__c":"' ||
  CASE l_suppkey % 11 WHEN 0 THEN 'Billing' WHEN 1 THEN 'Assigned Owner &amp; Contact Information'
    WHEN 2 THEN 'ROI/PGs' WHEN 3 THEN 'Reporting' WHEN 4 THEN 'Program Rules' WHEN 5 THEN 'Product Level'
    WHEN 6 THEN 'Client Type' WHEN 7 THEN 'Client Contract' WHEN 8 THEN 'Account Management'
    WHEN 9 THEN 'Implementation' ELSE 'Other' END ||
  '","Attribute_Value__c":' || CASE l_partkey % 5 WHEN 0 THEN 'null'
    WHEN 1 THEN '"p x; q;;' || l_returnflag || '"' ELSE '"' || CAST(l_partkey AS STRING) || '"' END ||
  ',"Grouper_ID__c":' || CASE WHEN l_suppkey % 7 = 0 THEN 'null'
    ELSE '"G' || CAST(l_orderkey % 9 AS STRING) || '"' END ||
  ',"LastModifiedBy":{"Name":{"value":"u' || CAST(l_orderkey % 3 AS STRING) || '"}}}' AS el
FROM lineitem
"""
_LANDING_CONFIGURATION = """
SELECT 'C' || CAST(l_orderkey AS STRING) AS ID, 'A' || CAST(l_orderkey AS STRING) AS Product_Association_ID,
       CASE l_orderkey % 4 WHEN 0 THEN 'third_party' WHEN 1 THEN 'Caremark' WHEN 2 THEN 'AETNA' ELSE 'Medicare' END
         AS line_of_business,
       'G' || CAST(l_orderkey AS STRING) AS Grouper_val,
       TIMESTAMP '2025-11-01 00:00:00' AS CreatedDate, TIMESTAMP '2025-12-01 00:00:00' AS LastModifiedDate,
       'N' AS indicator_flag, '[' || {aggregate} || ']' AS Payload
FROM ({attributes}) a
GROUP BY l_orderkey
"""
_ORDER = "l_linenumber, l_partkey, l_suppkey, l_returnflag"
CONFIGURATION = _LANDING_CONFIGURATION.format(
    aggregate=f"listagg(el, ',') WITHIN GROUP (ORDER BY {_ORDER})", attributes=ATTRIBUTES
)
# The next delivery: every fifth order comes with its first attribute alone, the others as they were.
NEXT_CONFIGURATION = _LANDING_CONFIGURATION.format(
    aggregate=f"listagg(el, ',') WITHIN GROUP (ORDER BY {_ORDER})",
    attributes=f"""SELECT * FROM (SELECT a.*, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_ORDER}) AS rn FROM ({ATTRIBUTES}) a) n
      WHERE rn = 1 OR l_orderkey % 5 <> 0""",
)
# The same attributes arriving in up to three deliveries per order.
_DELIVERIES = """
SELECT 'C' || CAST(l_orderkey AS STRING) AS ID, 'A' || CAST(l_orderkey AS STRING) AS Product_Association_ID,
       CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS delivery,
       '[' || {aggregate} || ']' AS Payload
FROM ({attributes}) a
GROUP BY l_orderkey, CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END
"""
DELIVERIES = _DELIVERIES.format(
    aggregate=f"listagg(el, ',') WITHIN GROUP (ORDER BY {_ORDER})", attributes=ATTRIBUTES
)
# The same text for the check engine, which orders aggregates by several columns in another way.
DELIVERIES_CHECK = _DELIVERIES.format(aggregate=f"string_agg(el, ',' ORDER BY {_ORDER})", attributes=ATTRIBUTES)
# Entitlements: an association has one customer; some have none.
ENTITLEMENT = """
SELECT 'A' || CAST(o_orderkey + 40 AS STRING) AS sf_product_association_id,
       CAST(o_custkey AS STRING) AS customer_id FROM orders
"""

# The attributes as the roll-ups see them, straight from the columns.
ELEMENTS_CHECK = f"""
SELECT 'C' || CAST(l_orderkey AS STRING) AS id, 'A' || CAST(l_orderkey AS STRING) AS assoc,
       row_number() OVER (PARTITION BY l_orderkey ORDER BY {_ORDER}) - 1 AS pos,
       CASE WHEN l_linenumber = 7 THEN 'Contracted LOB (Sub) Category'
            ELSE 'Attr ' || l_linenumber || ' (x)' END AS name,
       CASE l_suppkey % 11 WHEN 0 THEN 'Billing' WHEN 1 THEN 'Assigned Owner & Contact Information'
         WHEN 2 THEN 'ROI/PGs' WHEN 3 THEN 'Reporting' WHEN 4 THEN 'Program Rules' WHEN 5 THEN 'Product Level'
         WHEN 6 THEN 'Client Type' WHEN 7 THEN 'Client Contract' WHEN 8 THEN 'Account Management'
         WHEN 9 THEN 'Implementation' ELSE 'Other' END AS category,
       CASE l_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'p x; q;;' || l_returnflag
         ELSE CAST(l_partkey AS VARCHAR) END AS raw,
       l_returnflag AS flag, l_partkey % 5 AS kind,
       CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS delivery,
       CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE 'G' || l_orderkey % 9 END AS grouper,
       'u' || l_orderkey % 3 AS modified_by
FROM lineitem
"""

# Payloads to map: scalars, wrapped scalars, bad numbers, a routed field.
MAPPED = """
SELECT event_id,
  '{"Account__c":"ACC-' || CAST(user_id AS STRING) || '","Client_Category__c":"' ||
  CASE event_id % 4 WHEN 0 THEN 'Caremark' WHEN 1 THEN 'Aetna' WHEN 2 THEN 'Third_Party' ELSE 'Other' END ||
  '","ClientLevel__c":"' || CASE WHEN event_id % 3 = 0 THEN 'Plan Sponsor' ELSE 'Site' END ||
  '","Carrier_ID__c":"C' || CAST(user_id AS STRING) || '","Plan_Sponsor_ID__c":"P' || CAST(user_id AS STRING) ||
  '","Grouper_Id__c":"GI' || CAST(user_id AS STRING) || '","Grouper__c":"GR' || CAST(user_id AS STRING) ||
  '","Level_1_ID__c":' || CASE WHEN event_id % 5 = 0 THEN 'null' ELSE '"L' || CAST(user_id AS STRING) || '"' END ||
  ',"Count__c":' || CASE event_id % 3 WHEN 0 THEN '"n/a"' WHEN 1 THEN CAST(user_id AS STRING)
    ELSE '{"value":' || CAST(user_id AS STRING) || '}' END ||
  ',"Type__c":{"value":"' || event_type || '"},"Effective__c":"2025-12-22T23:15:02-05:00"' ||
  ',"Note__c":"{' || event_type || '","CreatedDate":"2025-12-22T18:15:02.000Z"' ||
  ',"LastModifiedDate":' || CASE WHEN event_id % 6 = 0 THEN '"soon"' ELSE '"2025-12-23T01:00:00.000Z"' END || '}' AS Payload
FROM events
"""

# Contacts: an array of one object with prefixed keys.
CONTACTS = """
SELECT CAST(p_partkey AS STRING) AS ID, CASE WHEN p_partkey % 4 = 0 THEN 'N' ELSE 'Y' END AS indicator_flag,
  CASE WHEN p_partkey % 19 = 0 THEN '[]' ELSE
  '[{"ACI_b":' || CASE WHEN p_size % 3 = 0 THEN 'null' ELSE '"' || p_brand || '"' END ||
  ',"ACI_a":' || CAST(p_size AS STRING) || ',"AcAu_x":' ||
  CASE WHEN p_size % 2 = 0 THEN 'null' ELSE '{"z":1,"y":[true]}' END ||
  ',"Billing_q":"No","line_of_business":"L' || CAST(p_size % 5 AS STRING) || '"}]' END AS Payload
FROM part
"""
CONTACTS_HISTORY = """
SELECT 'old-' || CAST(p_partkey AS STRING) AS surrogate_key, CAST(p_partkey + 200 AS STRING) AS id,
       CASE WHEN p_size % 4 = 0 THEN NULL ELSE '{"ACI_a":' || CAST(p_size AS STRING) || '}' END
         AS assigned_owner_contact_information,
       CASE WHEN p_size % 2 = 0 THEN '{}' ELSE '{"AcAu_x":{"y":[true],"z":1}}' END AS accreditation_audits,
       'Y' AS indicator_flag, 'Y' AS active_flg, TIMESTAMP '2025-01-01 00:00:00' AS effective_start_ts,
       TIMESTAMP '9999-12-31 00:00:00' AS effective_end_ts, TIMESTAMP '2025-01-01 00:00:00' AS load_ts
FROM part
"""

# Account levels: every line is a row of the structure of its order's account.
LEVELS = """
SELECT l_orderkey AS acct, l_linenumber AS line, l_partkey AS part,
       CASE WHEN l_linenumber = 7 THEN 'none' WHEN l_linenumber = 6 THEN 'Level 6'
            ELSE 'Level ' || CAST((l_linenumber - 1) % 4 + 1 AS STRING) END AS lvl,
       CAST(l_shipdate AS DATE) AS eff,
       CASE WHEN l_linenumber = 3 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS exp
FROM lineitem
"""

# Child collections: one landing row per order, several per group; groups are
# shifted so that some have no configuration and some no children. A collection is a
# JSON value over the order's number as delivered, and as canonical text; NULL: absent.
_N = "CAST(o_orderkey AS STRING)"
CHILD_VALUES = {
    "HEDISs__r": (f"""'[{{"Metric":"M' || {_N} || '"}}]'""", f"""'[{{"Metric":"M' || {_N} || '"}}]'"""),
    "Activity_Rules__r": (f"""'[{{"Months":12,"Id":"' || {_N} || '"}}]'""", f"""'[{{"Id":"' || {_N} || '","Months":12}}]'"""),
    "Engagement_Rules__r": (
        f"""CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE '{{"b":' || {_N} || ',"a":[1,2]}}' END""",
        f"""CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE '{{"a":[1,2],"b":' || {_N} || '}}' END""",
    ),
    "Reactivation_Rules__r": (f"""'"text ' || {_N} || '"'""", f"""'"text ' || {_N} || '"'"""),
    "CCNLs__r": ("""CASE WHEN o_orderkey % 4 = 0 THEN 'null' ELSE '[{"Id":"a"},{"Id":"b"}]' END""",) * 2,
    "Fulfillments__r": (_N, _N),
    "Program_Flips__r": ("'[ ]'", "'[]'"),
    "IVRs__r": ("CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END",) * 2,
    "Phone_Search__r": ("CAST(NULL AS STRING)", "CAST(NULL AS STRING)"),
    "Concurrent_Enrollment__r": ("'{ }'", "'{}'"),
    "SMS_Campaigns__r": (f"""'[{{"z":{{"y":true,"x":1.5}},"n":"' || {_N} || '"}}]'""", f"""'[{{"n":"' || {_N} || '","z":{{"x":1.5,"y":true}}}}]'"""),
    "Email_Campaigns__r": (f"'[[\"a\"], [' || {_N} || ']]'", f"'[[\"a\"],[' || {_N} || ']]'"),
    "Health_Optimizers__r": ("""'"é; ü"'""", """'"é; ü"'"""),
    "Call_Sheets__r": (f"""CASE WHEN o_orderkey % 5 = 0 THEN 'null' ELSE '[{{"Id":"c' || {_N} || '"}}]' END""",) * 2,
}
_CHILD_MEMBERS = " || ".join(f"""coalesce('"{name}":' || {value} || ',', '')""" for name, (value, _) in CHILD_VALUES.items())
CHILD_ROWS = f"""
SELECT o_orderkey AS n, 'G' || CAST(o_custkey + 100 AS STRING) AS grp, o_orderdate AS modified,
  '[{{' || {_CHILD_MEMBERS} || '"Id":"x"}}]' AS payload
FROM orders
"""
GROUPS = "SELECT 'G' || CAST(c_custkey AS STRING) AS grp FROM customer"
# Every second collection has a document before.
GROUP_HISTORY = f"""
SELECT c_custkey AS id, 'G' || CAST(c_custkey AS STRING) AS grp, c_name AS program_rules,
       {", ".join(("CAST(NULL AS STRING)" if i % 2 else "'keep'") + f" AS {c}" for i, c in enumerate(CHILDREN.values()))},
       'Active' AS status, 'Y' AS active,
       TIMESTAMP '2025-01-01 00:00:00' AS s, TIMESTAMP '9999-12-31 00:00:00' AS e
FROM customer
"""

# Account structures, several per account, and their current history.
STRUCTURES = """
SELECT 'GC' || CAST(o_orderkey AS STRING) AS sf_group_census_id,
       'ACC-' || CAST(o_custkey AS STRING) AS sf_account_id,
       CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE 'own-' || CAST(o_custkey AS STRING) END AS customer_id,
       'PCT' AS source_system_cd,
       CASE o_orderstatus WHEN 'O' THEN 'Third_Party' WHEN 'F' THEN 'Caremark' ELSE 'Aetna' END AS business_unit_cd,
       CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE 'LOB' END AS line_of_business_cd,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'PS' || CAST(o_orderkey % 100 AS STRING) END AS plan_sponsor_unique_id,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END AS account_status_cd,
       CAST(o_orderdate AS DATE) AS business_effective_dt, CAST(NULL AS DATE) AS business_expiration_dt
FROM orders
"""
OWNERS = """
SELECT 'ACC-' || CAST(c_custkey + 50 AS STRING) AS sf_account_id, CAST(c_custkey AS STRING) AS customer_id FROM customer
"""

# A history of customers' order statuses: one version per order day, but for the days of every
# third order; some versions end early, so that a gap follows. Customers without orders have none.
CHAIN_HISTORY = """
SELECT 'old-' || CAST(n AS STRING) AS id, k, h, CASE WHEN e IS NULL THEN 'Y' ELSE 'N' END AS active, s,
       coalesce(e, TIMESTAMP '9999-12-31 00:00:00') AS e
FROM (SELECT n, k, h, s, CASE WHEN n % 7 = 0 AND (nxt IS NULL OR s + INTERVAL '3' DAY < nxt) THEN s + INTERVAL '3' DAY ELSE nxt END AS e
      FROM (SELECT n, k, h, s, lead(s) OVER (PARTITION BY k ORDER BY s) AS nxt
            FROM (SELECT max(o_orderkey) AS n, o_custkey AS k, max(o_orderstatus) AS h, o_orderdate AS s
                  FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY o_custkey, o_orderdate) a) b) c
"""
# Every third order arrives late, among and behind the stored versions; some on days that are stored already,
# several of a customer at once, some customers not at all.
CHAIN_BATCH = """
SELECT o_orderkey AS n, o_custkey AS k, o_orderstatus AS h, o_orderdate AS since FROM orders WHERE o_orderkey % 3 = 0 AND o_custkey % 5 <> 0
UNION ALL
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus ELSE 'X' END, o_orderdate
FROM orders WHERE o_orderkey % 4 = 1 AND o_custkey % 5 <> 0
UNION ALL
SELECT o_orderkey, o_custkey, 'Y', o_orderdate + INTERVAL '1' DAY FROM orders WHERE o_orderkey % 16 = 2 AND o_custkey % 5 <> 0
"""
