import datetime as dt
import json

import pytest
from row_lists import rows
from pyspark.sql import functions as F, types as T

from histflow import fixed_values as fv
from histflow.operators import history as hx, levels, mapping, reversion
from histflow.plans import loads
from histflow.sources import catalog, schemas

OPEN_DAY = dt.date(9999, 12, 31)
D1, D2 = dt.date(2024, 1, 1), dt.date(2025, 1, 1)
OLD, OPEN = dt.datetime(2025, 1, 1), dt.datetime(9999, 12, 31)


def test_levels_on_the_deepest_row_only(spark):
    df = spark.createDataFrame(
        [
            ("a", "Level 1", D1, D2),
            ("a", "Level 3", D2, None),
            ("b", "none", D1, D2),
            ("c", "Level 7", D1, D2),
            (None, "Level 1", D1, D2),
        ],
        "acct string, lvl string, eff date, exp date",
    )
    got = {(r["acct"], r["lvl"]): r for r in levels.level_update(df, "acct", "lvl", "eff", "exp", "l").collect()}
    deep = got["a", "Level 3"]
    assert [deep[f"l{n}_effective_dt"] for n in levels.LEVELS] == [D1, None, D2, None]
    assert [deep[f"l{n}_expiration_dt"] for n in levels.LEVELS] == [D2, OPEN_DAY, OPEN_DAY, OPEN_DAY]
    assert all(got["a", "Level 1"][c] is None for c in levels.date_columns("l"))
    assert got["b", "none"]["l1_expiration_dt"] is None
    assert got["c", "Level 7"]["l1_effective_dt"] is None and got["c", "Level 7"]["l4_expiration_dt"] == OPEN_DAY
    assert got[None, "Level 1"]["l1_effective_dt"] is None
    assert len(got) == 5


def test_level_columns_keep_their_values_elsewhere(spark):
    df = spark.createDataFrame(
        [("a", "Level 1", D1, D2, D2), ("a", "Level 2", D1, D2, D1)], "acct string, lvl string, eff date, exp date, l1_effective_dt date"
    )
    got = {r["lvl"]: r["l1_effective_dt"] for r in levels.level_update(df, "acct", "lvl", "eff", "exp", "l").collect()}
    assert got == {"Level 1": D2, "Level 2": D1}


def mapped(spark, payload, wrapped=True):
    target = T.StructType.fromDDL(
        "SOURCE_LAST_PROCESS_DTS timestamp, n bigint, t string, business_effective_dt date, other_dt date, "
        "customer_population_group_id string, absent int, orig_src_pst_dts timestamp"
    )
    spec = mapping.MappingSpec(
        {"N": "n", "t": "a.b", "business_effective_dt": "eff", "other_dt": "eff", "absent": " "},
        {"customer_population_group_id": mapping.population_group_route},
        wrapped_values=wrapped,
    )
    df = spark.createDataFrame([(json.dumps(payload),)], "Payload string")
    return mapping.map_payload(df, target, spec)


def test_mapping_order_types_and_fallback(spark):
    got = mapped(
        spark,
        {
            "n": {"value": "12"},
            "a": {"b": "x"},
            "eff": "2025-12-22T23:15:02-05:00",
            "Client_Category__c": "Third_Party",
            "Grouper__c": "G",
            "LastModifiedDate": "2025-12-22T18:15:02.000Z",
        },
    )
    assert got.columns[-2:] == ["orig_src_pst_dts", "source_last_process_dts"]
    row = got.first()
    assert (row["n"], row["t"], row["customer_population_group_id"], row["absent"]) == (12, "x", "G", None)
    # only the two business dates go through a timestamp
    assert row["business_effective_dt"] == dt.date(2025, 12, 23) and row["other_dt"] is None
    assert row["orig_src_pst_dts"] is None and row["source_last_process_dts"] is not None
    assert mapped(spark, {"n": {"value": "12"}}, wrapped=False).first()["n"] is None


def test_mapping_document_round_trip(spark, tmp_path):
    spec = mapping.MappingSpec({"a": "x.y", "b": ""})
    path = tmp_path / "mapping.json"
    path.write_text(json.dumps(json.loads(catalog.mapping_document(spec)), indent=2))
    assert catalog.mapping_file(spark, str(path)).fields == {"a": "x.y", "b": ""}
    assert catalog.target_columns(spark.range(1)) == [(1, "id", "bigint")]


def test_reversion(spark):
    target = spark.createDataFrame(
        [("c1", "g1", "Active", "Y", OLD, OPEN, "p", None), ("c2", "g2", "Active", "Y", OLD, OPEN, "p", "kept")],
        "id string, grp string, status string, active string, s timestamp_ntz, e timestamp_ntz, program_rules string, activity_rule string",
    )
    cfg = spark.createDataFrame([("g1",), ("g1",), ("g2",)], "grp string")
    children = spark.createDataFrame(
        [("g1", 1, '[{"Activity_Rules__r":[{"Id":"old"}]}]'), ("g1", 2, '[{"Activity_Rules__r":[{"Id":"new"}]}]'), ("g9", 1, "[{}]")],
        "grp string, n int, payload string",
    )
    with pytest.raises(Exception, match="several source rows"):
        reversion.children_of_groups(cfg, children, "grp", "payload").collect()
    docs = reversion.children_of_groups(cfg, children, "grp", "payload", order_by=["n"])
    assert docs.columns == ["grp", *fv.CHILDREN.values()]
    history = hx.History(
        keys=["id"], active="active", start="s", end="e",
        on_close={"status": F.lit("Inactive")}, on_insert={"status": F.lit("Active")},
    )
    whole = reversion.reversion_with_children(target, docs, history, "grp", "2026-01-01 00:00:00")
    parts = reversion.reversion_expire(target, docs, history, "grp", "2026-01-01 00:00:00").unionByName(
        reversion.reversion_rows(target, docs, history, "grp", "2026-01-01 00:00:00")
    )
    assert rows(whole) == rows(parts)
    got = {(r["id"], r["active"]): r for r in whole.collect()}
    # a group only the configurations have stays as it is
    assert got["c2", "Y"]["activity_rule"] == "kept" and ("c2", "N") not in got
    assert got["c1", "Y"]["activity_rule"] == '[{"Id":"new"}]' and got["c1", "Y"]["program_rules"] == "p"
    assert got["c1", "N"]["status"] == "Inactive" and got["c1", "N"]["e"] == dt.datetime(2026, 1, 1)


def test_reversion_load_on_the_declared_table(spark):
    columns = {"customer_population_group_id": "g1", "sf_product_configuration_id": "c1", "active_record_ind": "Y", "billing_detail": "[]"}
    target = spark.createDataFrame([tuple(columns.values())], ", ".join(f"{c} string" for c in columns))
    from histflow.sources.tables import align

    empty = spark.createDataFrame([], schemas.CONFIGURATION_HISTORY)
    target = align(target, empty.schema)
    now = dt.datetime(2025, 1, 1)
    cfg = spark.createDataFrame([("g1",)], "Grouper_val string")
    children = spark.createDataFrame(
        [("g1", '[{"CCNLs__r":null,"SMS_Campaigns__r":[{"b":1,"a":2}]}]', now, now)],
        "Grouper_val string, Payload string, CreatedDate timestamp, LastModifiedDate timestamp",
    )
    got = {r["active_record_ind"]: r for r in loads.reversion_load(cfg, children, target, "2026-01-01 00:00:00").history.collect()}
    assert got["Y"]["care_connection_newsletter"] == "null" and got["Y"]["phone_search"] is None
    assert got["Y"]["sms_campaign"] == '[{"a":2,"b":1}]' and got["Y"]["billing_detail"] == "[]"
    assert got["Y"]["update_by"] == fv.UPDATED_BY and got["N"]["record_status_cd"] == "Inactive"


def test_account_structure_on_the_declared_table(spark):
    target = spark.createDataFrame([], schemas.ACCOUNT_STRUCTURE_HISTORY)
    assert len(target.columns) == 90
    landing = spark.createDataFrame(
        [("gc1", "acc", "PCT", "Caremark", None, None, None), ("gc2", "nobody", "PCT", "Aetna", "L", "p", "s")],
        "sf_group_census_id string, sf_account_id string, source_system_cd string, business_unit_cd string, "
        "line_of_business_cd string, plan_sponsor_unique_id string, account_status_cd string",
    ).withColumns({"business_effective_dt": F.lit(None).cast("date"), "business_expiration_dt": F.lit(None).cast("date")})
    owners = spark.createDataFrame([("acc", "cust")], "sf_account_id string, customer_id string")
    first = loads.account_structure_load(landing, owners, target, "2026-01-01 00:00:00").history
    got = {r["sf_group_census_id"]: r for r in first.collect()}
    assert got["gc1"]["customer_id"] == "cust" and got["gc2"]["customer_id"] is None
    assert got["gc1"]["business_unit_cd"] == "PBM" and got["gc1"]["business_effective_dt"] == dt.date(1900, 1, 1)
    assert got["gc1"]["master_customer_id"] is None
    again = loads.account_structure_load(landing, owners, first, "2026-02-01 00:00:00").history
    assert rows(again) == rows(first)
