"""History operators: expire, insert, merge, flags, levels, re-versioning."""

from __future__ import annotations

from pyspark.sql import functions as F

from histflow import fixed_values as fv, work_folder
from histflow.functions.scalar import level_number as level_of
from histflow.operators import chains, history as hx, levels, reversion
from histflow.plans import loads
from histflow.sources.ledger import Ledger
from histflow.sources.store import HistoryTable
from histflow.streaming import incremental
from histflow.streaming.incremental import landing_stream
from workload import inputs
from workload.documents import ACAU_SQL, ACI_SQL, CHILDREN_SQL
from workload.registry import AS_OF_SQL, OPEN_SQL, as_of, derived, query

FLAT = hx.History(keys=["k"], watch=["h"], active="active", start="s", end="e")
WITH_FLAT = f"WITH t AS ({inputs.HISTORY}), b AS ({inputs.BATCH}) "
CHANGED = "SELECT 1 FROM b WHERE b.k = t.k AND b.h IS DISTINCT FROM t.h"


def closed_sql(condition: str, end: str = AS_OF_SQL) -> str:
    return f"""SELECT k, h, CASE WHEN active = 'Y' AND {condition} THEN 'N' ELSE active END AS active, s,
      CASE WHEN active = 'Y' AND {condition} THEN {end} ELSE e END AS e FROM t"""


def flat(spark, sf):
    return derived(spark, sf, inputs.HISTORY), derived(spark, sf, inputs.BATCH)


@query(
    "expire_on_match",
    WITH_FLAT + closed_sql("k IN (SELECT k FROM b)", "TIMESTAMP '2025-12-31 00:00:00'"),
)
def expire_on_match(spark, sf):
    target, batch = flat(spark, sf)
    literal = hx.History(keys=["k"], active="active", start="s", end="e", end_rule="previous_day")
    return hx.expire(target, batch, literal, as_of())


@query(
    "expire_changed_hash",
    WITH_FLAT + closed_sql("EXISTS (SELECT 1 FROM b WHERE b.k = t.k AND b.h <> t.h)", "TIMESTAMP '2025-12-31 00:00:00'"),
)
def expire_changed_hash(spark, sf):
    target, batch = flat(spark, sf)
    literal = hx.History(
        keys=["k"], watch=["h"], active="active", start="s", end="e", end_rule="previous_day", null_safe=False
    )
    return hx.expire(target, batch, literal, as_of())


CONTACTS_SQL = f"""t AS ({inputs.CONTACTS_HISTORY}),
  b AS (SELECT CAST(p_partkey AS VARCHAR) AS id, {ACI_SQL} AS aci, {ACAU_SQL} AS acau FROM part WHERE p_partkey % 4 <> 0),
  hit AS (SELECT t.id FROM t JOIN b ON t.id = b.id WHERE coalesce(t.assigned_owner_contact_information, '{{}}') <> b.aci
          OR coalesce(t.accreditation_audits, '{{}}') <> b.acau)"""
CONTACTS_CLOSED = f"""SELECT surrogate_key, id, assigned_owner_contact_information, accreditation_audits, indicator_flag,
  CASE WHEN id IN (SELECT id FROM hit) THEN 'N' ELSE active_flg END AS active_flg, effective_start_ts,
  CASE WHEN id IN (SELECT id FROM hit) THEN {AS_OF_SQL} ELSE effective_end_ts END AS effective_end_ts,
  CASE WHEN id IN (SELECT id FROM hit) THEN {AS_OF_SQL} ELSE load_ts END AS load_ts FROM t"""


@query("expire_changed_json", f"WITH {CONTACTS_SQL} {CONTACTS_CLOSED}")
def expire_changed_json(spark, sf):
    source = loads.contacts_source(derived(spark, sf, inputs.CONTACTS), as_of())
    return hx.expire(derived(spark, sf, inputs.CONTACTS_HISTORY), source, loads.contacts_history(as_of()), as_of())


@query(
    "stream_apply",
    f"WITH t AS (SELECT * FROM ({inputs.HISTORY}) WHERE active = 'Y'), b AS ({inputs.BATCH}) "
    + closed_sql(f"EXISTS ({CHANGED})")
    + f""" UNION ALL SELECT b.k, b.h, 'Y', {AS_OF_SQL}, {OPEN_SQL} FROM b
       LEFT JOIN t ON t.k = b.k WHERE t.k IS NULL OR t.h IS DISTINCT FROM b.h""",
)
def stream_apply(spark, sf):
    """A batch by hand, then landing files by a stream, into one history table."""
    target, batch = flat(spark, sf)
    folder = work_folder(spark, "landing")
    batch.write.parquet(folder)
    table = HistoryTable(spark, work_folder(spark, "table"), target.schema, FLAT)
    before = F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")
    table.apply(target.where("active = 'Y'").select("k", "h"), before)
    stream = landing_stream(spark, folder, batch.schema)
    incremental.stream_apply(stream, table, lambda rows: rows, work_folder(spark, "checkpoint"), as_of=as_of()).awaitTermination()
    return table.read()


@query(
    "insert_new_or_changed",
    WITH_FLAT
    + f"""SELECT b.k, b.h, 'Y' AS active, {AS_OF_SQL} AS s, {OPEN_SQL} AS e FROM b
       LEFT JOIN t ON t.k = b.k AND t.active = 'Y' WHERE t.k IS NULL OR t.h IS DISTINCT FROM b.h""",
)
def insert_new_or_changed(spark, sf):
    target, batch = flat(spark, sf)
    return hx.insert_new_or_changed(target, batch, FLAT, as_of())


@query(
    "scd_actions",
    f"WITH b AS ({inputs.BATCH}) SELECT 'EXPIRE' AS action_type, k, h FROM b UNION ALL SELECT 'INSERT', k, h FROM b",
)
def scd_actions(spark, sf):
    return hx.scd_actions(derived(spark, sf, inputs.BATCH))


@query(
    "scd2_apply",
    WITH_FLAT
    + closed_sql(f"EXISTS ({CHANGED})")
    + f""" UNION ALL SELECT b.k, b.h, 'Y', {AS_OF_SQL}, {OPEN_SQL} FROM b
       LEFT JOIN t ON t.k = b.k AND t.active = 'Y' WHERE t.k IS NULL OR t.h IS DISTINCT FROM b.h""",
)
def scd2_apply(spark, sf):
    target, batch = flat(spark, sf)
    return hx.scd2_apply(target, batch, FLAT, as_of())


@query(
    "scd2_apply_always",
    WITH_FLAT
    + closed_sql(f"EXISTS ({CHANGED})")
    + f" UNION ALL SELECT b.k, b.h, 'Y', {AS_OF_SQL}, {OPEN_SQL} FROM b",
)
def scd2_apply_always(spark, sf):
    target, batch = flat(spark, sf)
    return hx.scd2_apply(target, batch, FLAT, as_of(), insert="always")


@query(
    "scd1_upsert",
    f"""WITH t AS (SELECT c_custkey AS k, 'H' || c_custkey % 10 AS h, c_mktsegment AS kept FROM customer),
       b AS ({inputs.BATCH})
       SELECT coalesce(b.k, t.k) AS k, CASE WHEN b.k IS NOT NULL THEN b.h ELSE t.h END AS h, kept
       FROM t FULL JOIN b ON t.k = b.k""",
)
def scd1_upsert(spark, sf):
    target = derived(
        spark,
        sf,
        "SELECT c_custkey AS k, 'H' || CAST(c_custkey % 10 AS STRING) AS h, c_mktsegment AS kept FROM customer",
    )
    return hx.scd1_upsert(target, derived(spark, sf, inputs.BATCH), ["k"])


@query(
    "latest_per_key",
    f"""SELECT k, modified, n, status, priority FROM (SELECT *, row_number() OVER (PARTITION BY k
       ORDER BY modified DESC, n DESC) AS rn FROM ({inputs.MESSAGES}) m) r WHERE rn = 1""",
)
def latest_per_key(spark, sf):
    return hx.latest_per_key(derived(spark, sf, inputs.MESSAGES), ["k"], ["modified", "n"])


@query(
    "mark_processed",
    f"""WITH m AS (SELECT *, CASE WHEN n % 3 = 0 THEN 'Y' ELSE 'N' END AS flag FROM ({inputs.MESSAGES}) x),
       t AS ({inputs.BATCH})
       SELECT k, modified, n, status, priority, CASE WHEN flag = 'N' AND k IN (SELECT k FROM t) THEN 'Y' ELSE flag END AS flag FROM m""",
)
def mark_processed(spark, sf):
    source = derived(spark, sf, inputs.MESSAGES).withColumn("flag", F.when(F.col("n") % 3 == 0, "Y").otherwise("N"))
    return hx.mark_processed(source, derived(spark, sf, inputs.BATCH), {"k": "k"}, flag="flag")


@query(
    "pending_ledger",
    f"""SELECT * FROM ({inputs.CUSTOMERS}) c WHERE indicator_flag = 'N' AND sf_account_id NOT IN
       (SELECT 'ACC-' || CAST(k AS VARCHAR) FROM ({inputs.BATCH}) b WHERE h = 'NEW' OR h IS NULL)""",
)
def pending_ledger(spark, sf):
    """Two batches' processed keys, one of them recorded again; what is left to do of the landing rows."""
    landing, batch = derived(spark, sf, inputs.CUSTOMERS), derived(spark, sf, inputs.BATCH)
    done = batch.select(F.concat(F.lit("ACC-"), F.col("k").cast("string")).alias("sf_account_id"), "h")
    ledger = Ledger(spark, work_folder(spark, "ledger"), landing.select("sf_account_id").schema)
    for number, rows in ((1, done.where("h = 'NEW'")), (2, done.where("h IS NULL")), (1, done.where("h = 'NEW'"))):
        ledger.record(rows, "customers", number)
    return ledger.pending(landing)


# --- chains --------------------------------------------------------------------------------

# Events of the customers in the batch: an end (0), a stored beginning (1), an arrived one (2). At one time the
# highest counts, and a stored version with its content stays itself.
CHAIN_SQL = f"""WITH t AS ({inputs.CHAIN_HISTORY}), b AS ({inputs.CHAIN_BATCH}),
  one AS (SELECT k, since, arg_max(h, struct_pack(n := n, h := h)) AS h, max(n) AS n FROM b GROUP BY k, since),
  ev AS (SELECT k, s AS pt, 1 AS kind, h, id, e AS old_e FROM t WHERE k IN (SELECT k FROM b)
    UNION ALL SELECT k, e, 0, NULL, NULL, NULL FROM t WHERE e < {OPEN_SQL} AND k IN (SELECT k FROM b)
    UNION ALL SELECT k, since, 2, h, 'new-' || n, NULL FROM one),
  said AS (SELECT *, first_value(h) OVER (PARTITION BY k, pt ORDER BY kind DESC) AS counts FROM ev),
  line AS (SELECT * FROM said QUALIFY row_number() OVER (PARTITION BY k, pt ORDER BY h IS NOT DISTINCT FROM counts DESC, kind) = 1),
  heads AS (SELECT * FROM line QUALIFY h IS DISTINCT FROM lag(h) OVER (PARTITION BY k ORDER BY pt)),
  spans AS (SELECT *, lead(pt) OVER (PARTITION BY k ORDER BY pt) AS e FROM heads)
  SELECT * FROM t WHERE k NOT IN (SELECT k FROM b)
  UNION ALL SELECT id, k, h, CASE WHEN e IS NULL THEN 'Y' ELSE 'N' END, pt, coalesce(e, {OPEN_SQL}) FROM spans WHERE h IS NOT NULL"""


@query("scd2_chain", CHAIN_SQL)
def scd2_chain(spark, sf):
    history = hx.History(
        keys=["k"], watch=["h"], active="active", start="s", end="e", on_insert={"id": F.concat(F.lit("new-"), F.col("n").cast("string"))}
    )
    return chains.chain_apply(
        derived(spark, sf, inputs.CHAIN_HISTORY), derived(spark, sf, inputs.CHAIN_BATCH), history, "since", as_of(), order_by=["n", "h"]
    )


# --- levels --------------------------------------------------------------------------------

NUMBER_SQL = "TRY_CAST(regexp_extract(lvl, '([0-9]+)', 1) AS BIGINT)"
WITH_LEVELS = f"WITH lines AS (SELECT *, {NUMBER_SQL} AS num FROM ({inputs.LEVELS}) l), "
PIVOT_SQL = "deepest AS (SELECT acct, max(num) AS max_level, " + ", ".join(
    f"max(CASE WHEN num = {n} THEN {c} END) AS level_{n}_{kind}_dt"
    for n in levels.LEVELS
    for kind, c in (("effective", "eff"), ("expiration", "exp"))
) + " FROM lines GROUP BY acct)"


@query("level_num", f"SELECT acct, line, part, lvl, {NUMBER_SQL} AS num FROM ({inputs.LEVELS}) l")
def level_num(spark, sf):
    return derived(spark, sf, inputs.LEVELS).select("acct", "line", "part", "lvl", level_of("lvl").alias("num"))


@query("level_pivot", WITH_LEVELS + PIVOT_SQL + " SELECT * FROM deepest")
def level_pivot(spark, sf):
    return levels.level_pivot(derived(spark, sf, inputs.LEVELS), "acct", "lvl", "eff", "exp")


@query(
    "level_update",
    WITH_LEVELS
    + PIVOT_SQL
    + " SELECT lines.acct, line, part, lvl, eff, exp, "
    + ", ".join(
        f"CASE WHEN num = max_level THEN level_{n}_effective_dt END AS level_{n}_effective_dt, "
        f"CASE WHEN num = max_level THEN coalesce(level_{n}_expiration_dt, DATE '9999-12-31') END AS level_{n}_expiration_dt"
        for n in levels.LEVELS
    )
    + " FROM lines LEFT JOIN deepest ON lines.acct = deepest.acct",
)
def level_update(spark, sf):
    return levels.level_update(derived(spark, sf, inputs.LEVELS), "acct", "lvl", "eff", "exp", prefix="level_")


# --- re-versioning ---------------------------------------------------------------------------

_CHILDREN = ", ".join(fv.CHILDREN.values())
WITH_GROUPS = f"""WITH t AS ({inputs.GROUP_HISTORY}), g AS ({inputs.GROUPS}),
  latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY modified DESC, n DESC) AS rn
             FROM ({inputs.CHILD_ROWS}) c) r WHERE rn = 1 AND grp IN (SELECT grp FROM g)),
  docs AS (SELECT grp, {CHILDREN_SQL} FROM latest JOIN orders ON o_orderkey = n) """
REVERSION_ROWS = f"""SELECT id, t.grp, program_rules, {", ".join(f"docs.{c}" for c in fv.CHILDREN.values())},
  'Active' AS status, 'Y' AS active, {AS_OF_SQL} AS s, {OPEN_SQL} AS e
  FROM t JOIN docs ON t.grp = docs.grp"""
REVERSION_CLOSED = f"""SELECT id, grp, program_rules, {_CHILDREN},
  CASE WHEN grp IN (SELECT grp FROM docs) THEN 'Inactive' ELSE status END AS status,
  CASE WHEN grp IN (SELECT grp FROM docs) THEN 'N' ELSE active END AS active, s,
  CASE WHEN grp IN (SELECT grp FROM docs) THEN {AS_OF_SQL} ELSE e END AS e FROM t"""


def grouped() -> hx.History:
    return hx.History(
        keys=["id"],
        active="active",
        start="s",
        end="e",
        on_close={"status": F.lit("Inactive")},
        on_insert={"status": F.lit("Active")},
    )


def group_documents(spark, sf):
    return reversion.children_of_groups(
        derived(spark, sf, inputs.GROUPS), derived(spark, sf, inputs.CHILD_ROWS), "grp", "payload", order_by=["modified", "n"]
    )


@query("reversion_rows", WITH_GROUPS + REVERSION_ROWS)
def reversion_rows(spark, sf):
    target = derived(spark, sf, inputs.GROUP_HISTORY)
    return reversion.reversion_rows(target, group_documents(spark, sf), grouped(), "grp", as_of())


@query("reversion_expire", WITH_GROUPS + REVERSION_CLOSED)
def reversion_expire(spark, sf):
    target = derived(spark, sf, inputs.GROUP_HISTORY)
    return reversion.reversion_expire(target, group_documents(spark, sf), grouped(), "grp", as_of())


@query("reversion_with_children", WITH_GROUPS + REVERSION_CLOSED + " UNION ALL " + REVERSION_ROWS)
def reversion_with_children(spark, sf):
    target = derived(spark, sf, inputs.GROUP_HISTORY)
    return reversion.reversion_with_children(target, group_documents(spark, sf), grouped(), "grp", as_of())
