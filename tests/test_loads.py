import datetime as dt
import hashlib
import json

from histflow.plans import loads
from histflow.sources import schemas

AS_OF = "2026-01-01 00:00:00"


def contact(i, payload, hour=0):
    return (str(i), "A", None, None, dt.datetime(2026, 1, 1, hour), None, None, "Y", json.dumps(payload))


def test_contacts_as_object_or_array_and_the_latest_of_several(spark):
    landing = spark.createDataFrame(
        [
            contact(1, {"ACI_a": "x", "AcAu_b": 1}),
            contact(2, [{"ACI_a": "x", "AcAu_b": 1}]),
            contact(3, [{"ACI_a": "old"}], 1),
            contact(3, [{"ACI_a": "new"}], 2),
            contact(4, "text"),
        ],
        spark.createDataFrame([], schemas.LANDING_CONTACTS).schema,
    )
    target = spark.createDataFrame([], schemas.CONTACTS_HISTORY)
    load = loads.contacts_load(landing, target, AS_OF, order_by=["LastModifiedDate"])
    got = {r.id: (r.assigned_owner_contact_information, r.accreditation_audits) for r in load.history.collect()}
    assert got == {"1": ('{"ACI_a":"x"}', '{"AcAu_b":1}'), "2": ('{"ACI_a":"x"}', '{"AcAu_b":1}'), "3": ('{"ACI_a":"new"}', "{}"), "4": ("{}", "{}")}
    assert {r.indicator_flag for r in load.source.collect()} == {"N"}


def test_account_keys_use_the_structures_own_customer(spark):
    landing = spark.createDataFrame(
        [("G1", "A1", "own", "Aetna", "LOB", "PS", "F", "PCT", None, None), ("G2", "A2", None, "Aetna", "LOB", "PS", "F", "PCT", None, None)],
        "sf_group_census_id string, sf_account_id string, customer_id string, business_unit_cd string, line_of_business_cd string, "
        "plan_sponsor_unique_id string, account_status_cd string, source_system_cd string, business_effective_dt date, business_expiration_dt date",
    )
    owners = spark.createDataFrame([("A1", "owner"), ("A2", "owner")], "sf_account_id string, customer_id string")
    got = {r.sf_group_census_id: r for r in loads.account_structure_source(landing, owners, AS_OF).collect()}
    assert {r.customer_id for r in got.values()} == {"owner"}
    assert got["G1"].business_hash_key_id == hashlib.md5(b"own|Aetna|LOB").hexdigest()
    assert got["G2"].business_hash_key_id == hashlib.md5(b"X|Aetna|LOB").hexdigest()
    assert got["G1"].business_key_txt == hashlib.md5(b"own|PS|G1").hexdigest()


def test_one_configuration_with_two_associations_is_two_versions(spark):
    payload = json.dumps([{"AttributeName__c": "A", "Attribute_Category__c": "Billing", "Attribute_Value__c": "1"}])
    now = dt.datetime(2026, 1, 1)
    landing = spark.createDataFrame(
        [("C1", "P1", "Aetna", "G", now, now, "N", payload), ("C1", "P2", "Aetna", "G", now, now, "N", payload)],
        "ID string, Product_Association_ID string, line_of_business string, Grouper_val string, CreatedDate timestamp_ntz, "
        "LastModifiedDate timestamp_ntz, indicator_flag string, Payload string",
    )
    entitlement = spark.createDataFrame([("P1", "c")], "sf_product_association_id string, customer_id string")
    source = loads.configuration_source(landing, entitlement)
    schema = source.withColumn("active_record_ind", source.update_by)
    target = schema.where("false").selectExpr("*", "CAST(NULL AS timestamp_ntz) AS record_start_dts", "CAST(NULL AS timestamp_ntz) AS record_end_dts", "'' AS sgk_customer_product_configuration_id")
    load = loads.product_configuration_load(landing, entitlement, target, AS_OF)
    rows = load.history.collect()
    assert sorted((r.sf_product_association_id, r.customer_id) for r in rows) == [("P1", "c"), ("P2", None)]
    assert len({r.sgk_customer_product_configuration_id for r in rows}) == 2
    again = loads.product_configuration_load(landing, entitlement, load.history, "2026-02-01 00:00:00").history
    assert again.where("active_record_ind = 'N'").count() == 0 and again.count() == 2


def test_configurations_of_one_delivery_do_not_move_to_be_told_apart(spark):
    """Without a repeated key no row is joined to the repeated keys."""
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), (None, 3)], "k string, n int")
    kept, rejected = loads._one_per_key(rows, ["k"], (), staging=True)
    assert kept.count() == 4 and rejected.count() == 0 and "Join" not in kept._jdf.queryExecution().optimizedPlan().toString()
    kept, rejected = loads._one_per_key(rows.unionByName(rows), ["k"], (), staging=True)
    assert sorted(r.n for r in kept.collect()) == [3, 3, 3, 3] and sorted(r.k for r in rejected.collect()) == ["a", "a", "b", "b"]


def test_rows_grouped_by_the_column_they_are_dealt_by_stay(spark):
    from histflow.sources import tables

    dealt = tables.dealt_out(spark.range(100).selectExpr("id % 7 AS k", "CAST(id AS STRING) AS text"), by=["k"])
    plan = dealt.groupBy("k").agg({"text": "max"})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(k") == 1 and dealt.count() == 100


def test_a_reload_keeps_only_the_last_history(spark, sf_dir, monkeypatch):
    """Neither the first history nor what the loads staged is left."""
    from pathlib import Path

    from histflow.session import work_folder
    from histflow.sources import tables
    from workload import QUERIES

    made = []

    def recorded(*args):
        made.append(work_folder(*args))
        return made[-1]

    monkeypatch.setattr(tables, "work_folder", recorded)
    out = QUERIES["product_configuration_reload"](spark, sf_dir)
    left = [p for p in made if Path(p.removeprefix("file:")).exists()]
    assert left == [out.staged_folder] and len(made) > 4


def test_rejected_deliveries_leave_the_staged_source_alone(spark, monkeypatch):
    """Deliveries are staged before they get their customer; that copy goes when the source is staged."""
    from pathlib import Path

    from histflow.session import work_folder
    from histflow.sources import tables

    made = []

    def recorded(*args):
        made.append(work_folder(*args))
        return made[-1]

    monkeypatch.setattr(tables, "work_folder", recorded)
    payload = json.dumps([{"AttributeName__c": "A", "Attribute_Category__c": "Billing", "Attribute_Value__c": "1"}])
    days = [dt.datetime(2026, 1, d) for d in (1, 2)]
    landing = spark.createDataFrame(
        [("C1", "P1", "Aetna", "G", days[0], days[0], "N", payload), ("C1", "P1", "Aetna", "G", days[0], days[1], "N", payload), ("C2", "P2", "Aetna", "G", days[0], days[0], "N", payload)],
        "ID string, Product_Association_ID string, line_of_business string, Grouper_val string, CreatedDate timestamp_ntz, "
        "LastModifiedDate timestamp_ntz, indicator_flag string, Payload string",
    )
    entitlement = spark.createDataFrame([("P1", "c")], "sf_product_association_id string, customer_id string")
    target = spark.createDataFrame([], schemas.CONFIGURATION_HISTORY)
    load = loads.product_configuration_load(landing, entitlement, target, AS_OF, per_delivery=["LastModifiedDate"])
    assert sorted((r.sf_product_configuration_id, r.source_last_process_dts.day, r.customer_id) for r in load.rejected.collect()) == [("C1", 1, "c"), ("C1", 2, "c")]
    assert sorted((r.ID, r.indicator_flag) for r in load.source.collect()) == [("C1", "N"), ("C1", "N"), ("C2", "Y")]
    left = sorted(p.split("/")[-1].rsplit("-", 1)[0] for p in made if Path(p.removeprefix("file:")).exists())
    assert left == ["configurations", "repeated-keys"] and any("/deliveries-" in p for p in made)
