import json

import pytest
from row_lists import rows
from pyspark.sql import functions as F

from histflow import fixed_values as fv
from histflow.operators import rollup
from histflow.plans import loads

LANDING = "ID string, Product_Association_ID string, n int, Payload string"
IDS = ["ID", "Product_Association_ID"]


def attribute(category, name, value, **more):
    return {"AttributeName__c": name, "Attribute_Category__c": category, "Attribute_Value__c": value, **more}


def landing(spark, *payloads):
    data = [(i, a, n, p if p is None or isinstance(p, str) else json.dumps(p)) for i, a, n, p in payloads]
    return spark.createDataFrame(data, LANDING)


def roll(df, **options):
    options = {"association": "Product_Association_ID", "order_by": ["n"], **options}
    got = rollup.eav_rollup(df, IDS, options.pop("documents", fv.CATEGORIES), **options)
    return {r["ID"]: r for r in got.collect()}


def test_payloads_without_elements_give_no_rows(spark):
    df = landing(spark, ("a", "x", 1, None), ("b", "x", 1, []), ("c", "x", 1, {"k": 1}), ("d", "x", 1, "[oops"))
    assert rollup.json_array_rows(df, "Payload", ["ID"]).count() == 0
    assert roll(df) == {}


def test_values_envelope_and_escapes(spark):
    df = landing(
        spark,
        (
            "a",
            "x",
            1,
            [
                attribute("Billing", "list", "p; q;;", Grouper_ID__c="G1", LastModifiedBy={"Name": {"value": "u"}}),
                attribute("Billing", "none", None, Grouper_ID__c="G2"),
                attribute("Billing", 'say "hi"', 'a "b"'),
                attribute("Owner", "dropped", "1"),
                attribute("Assigned Owner &amp; Contact Information", "only separators", ";;"),
                attribute("Billing", None, "no name", line_of_business="L"),
                attribute("Billing", "Grouper_ID__c", "attribute loses against the envelope"),
                3,
            ],
        ),
    )
    row = roll(df)["a"]
    assert json.loads(row["billing_detail"]) == [
        {
            "list": ["p", "q"],
            "none": None,
            'say "hi"': 'a "b"',
            "Attribute_Category__c": "Billing",
            "Client_External_Id__c": None,
            "Configured_Product__c": None,
            "Grouper_ID__c": "G2",
            "Product_Association_ID": "x",
            "line_of_business": "L",
            "LastModifiedBy": {"Name": {"Value": "u"}},
        }
    ]
    owner = json.loads(row["assigned_owner_contact_info"])[0]
    assert owner["only separators"] == [] and owner["Grouper_ID__c"] is None
    assert owner["Attribute_Category__c"] == "Assigned Owner & Contact Information"
    assert row["client_type"] is None
    assert row["billing_detail"] == json.dumps(json.loads(row["billing_detail"]), sort_keys=True, separators=(",", ":"))


def test_last_position_and_later_payload_win(spark):
    df = landing(
        spark,
        ("a", "x", 2, [attribute("Billing", "k", "later"), attribute("Billing", "late only", "1")]),
        ("a", "x", 1, [attribute("Billing", "k", "first"), attribute("Billing", "k", "second"), attribute("Billing", "early only", "1")]),
    )
    got = json.loads(roll(df, latest=["n"])["a"]["billing_detail"])[0]
    assert (got["k"], got["late only"], got["early only"]) == ("later", "1", "1")
    assert roll(df, latest=["n"])["a"]["n"] == 2


def test_one_row_per_delivery(spark):
    df = landing(
        spark,
        ("a", "x", 1, [attribute("Billing", "k", "1")]),
        ("a", "x", 2, [attribute("Billing", "k", "2")]),
        ("a", "x", 2, [attribute("Reporting", "r", "1")]),
        ("a", "x", 3, []),
    )
    got = rollup.eav_rollup(
        df, IDS, fv.CATEGORIES, association="Product_Association_ID", order_by=["n"], per_delivery=["n"]
    ).collect()
    assert sorted(r["n"] for r in got) == [1, 2]
    assert {json.loads(r["billing_detail"])[0]["k"] for r in got} == {"2"}
    assert all(r["reporting_detail"] for r in got)


def test_entity_with_unknown_categories_only_is_kept(spark):
    row = roll(landing(spark, ("a", "x", 1, [attribute("Something else", "k", "v")])))["a"]
    assert all(row[d] is None for d in fv.CATEGORIES.values())


def test_hot_entity_in_many_payloads(spark):
    # one entity holds two thirds of the landing rows
    entity = F.when(F.col("id") % 3 == 0, F.concat(F.lit("e"), F.col("id"))).otherwise("hot")
    element = F.struct(
        F.concat(F.lit("k"), (F.col("id") % 50)).alias("AttributeName__c"),
        F.lit("Billing").alias("Attribute_Category__c"),
        F.col("id").cast("string").alias("Attribute_Value__c"),
    )
    df = spark.range(3000).select(
        entity.alias("ID"), F.lit("x").alias("Product_Association_ID"), F.col("id").alias("n"), F.to_json(F.array(element)).alias("Payload")
    )
    hot = json.loads(roll(df)["hot"]["billing_detail"])[0]
    expected = {f"k{i % 50}": str(i) for i in range(3000) if i % 3}
    assert {k: v for k, v in hot.items() if k.startswith("k")} == expected


def test_arrays_keep_copies_and_order(spark):
    copy = attribute("Reporting", "r", "1")
    df = landing(spark, ("a", "x", 2, [copy]), ("a", "x", 1, [copy, attribute("Billing", "b", "1"), attribute("Reporting", "s", None)]))
    got = roll(df, documents={"Billing": "billing_detail"}, arrays={"Reporting": "reporting_detail", "Client Type": "client_type"})
    elements = json.loads(got["a"]["reporting_detail"])
    assert [e["AttributeName__c"] for e in elements] == ["r", "s", "r"]
    assert got["a"]["client_type"] is None and json.loads(got["a"]["billing_detail"])[0]["b"] == "1"


def test_listed_keys_and_clean_keys(spark):
    df = landing(
        spark,
        (
            "a",
            "x",
            1,
            [
                attribute("Billing", "Contracted LOB (Sub) Category", "Medicare Advantage; Group ;"),
                attribute("Billing", "Fee (per unit)", "a;b"),
                attribute("Program Rules", "Contracted LOB Sub Category", None),
            ],
        ),
    )
    row = roll(df, value_rule=rollup.listed_keys_values(fv.LIST_KEYS), clean_keys=True)["a"]
    billing, rules = (json.loads(row[c])[0] for c in ("billing_detail", "program_rules"))
    assert billing["Contracted_LOB_Sub_Category"] == ["Medicare_Advantage", "Group"]
    assert billing["Fee_per_unit"] == "a;b"
    assert rules["Contracted_LOB_Sub_Category"] == [] and rules["Attribute_Category__c"] == "Program Rules"


def test_kv_string_skips_unnamed(spark):
    df = landing(spark, ("a", "x", 1, [attribute("Billing", "k", "v"), attribute("Billing", None, "1"), attribute("Billing", "l", "p;q")]))
    got = rollup.kv_string_agg(rollup.attribute_rows(df, "Payload", ["ID"]), ["ID"], ["pos"])
    assert rows(got) == [("a", "Billing", '"k":"v","l":["p","q"]')]


def test_configuration_load_twice(spark):
    schema = (
        "ID string, Product_Association_ID string, line_of_business string, Grouper_val string, CreatedDate timestamp, "
        "LastModifiedDate timestamp, indicator_flag string, Payload string"
    )
    payload = json.dumps([attribute("Billing", "k", "v")])
    source = spark.sql("SELECT current_timestamp() AS t").first()["t"]
    rows_in = [("c1", "a1", "caremark", "g", source, source, "N", payload), ("c2", "a2", "x", "g", source, source, "Y", payload)]
    landed = spark.createDataFrame(rows_in, schema)
    owners = spark.createDataFrame([("a1", "cust")], "sf_product_association_id string, customer_id string")
    from histflow.sources import schemas

    target = spark.createDataFrame([], schemas.CONFIGURATION_HISTORY)
    as_of = "2026-01-01 00:00:00"
    for raw in (False, True):
        first = loads.product_configuration_load(landed, owners, target, as_of, raw_categories=raw)
        (row,) = first.history.collect()
        assert (row["customer_id"], row["business_unit_cd"], row["business_hash_key_id"]) == ("cust", "PBM", "c1-a1")
        assert row["record_status_cd"] == "Active" and row["customer_population_group_id"] == "g"
        assert {r["ID"]: r["indicator_flag"] for r in first.source.collect()} == {"c1": "Y", "c2": "Y"}
        again = loads.product_configuration_load(landed, owners, first.history, None, raw_categories=raw)
        assert rows(again.history) == rows(first.history)


def deliveries(spark):
    """Single payloads, entities in several deliveries, a delivery twice, payloads without elements, unknown ids."""
    data = [
        ("a", "x", 1, [attribute("Billing", "k", "1"), attribute("Reporting", "r", "p;q")]),
        ("a", "x", 2, [attribute("Billing", "k", "2", Grouper_ID__c="G"), attribute("Billing", "l", None)]),
        ("a", "x", 2, [attribute("Billing", "m", "3")]),
        ("a", "y", 3, [attribute("Billing", "k", "4")]),
        ("b", "x", 1, [attribute("Reporting", "r", "5")]),
        ("c", "x", 1, []),
        ("d", "x", 1, []),
        ("d", "x", 2, [attribute("Billing", "k", "6")]),
        (None, "x", 1, [attribute("Billing", "k", "7")]),
        ("e", None, None, [attribute("Billing", "k", "8")]),
        ("f", "x", None, [attribute("Billing", "k", "9")]),
        ("f", "x", 1, [attribute("Billing", "k", "10")]),
    ]
    return landing(spark, *data)


@pytest.mark.parametrize("options", [{}, {"order_by": ["n"]}, {"order_by": ["n"], "latest": ["n"]}, {"order_by": ["n"], "per_delivery": ["n"]}, {"order_by": ["n"], "arrays": {"Reporting": "reporting"}}])
def test_many_entities_with_several_payloads_merge_in_staged_steps(spark, monkeypatch, options):
    df = deliveries(spark)
    categories = {"Billing": "billing_detail", "Reporting": "reporting_detail"}
    if "arrays" in options:
        del categories["Reporting"]
    few = rollup.eav_rollup(df, IDS, categories, association="Product_Association_ID", **options)
    monkeypatch.setattr(rollup, "FEW", 0)
    many = rollup.eav_rollup(df, IDS, categories, association="Product_Association_ID", **options)
    assert many.columns == few.columns and rows(many) == rows(few)
    # a step's rows are read back: nothing is exploded any more, and payloads do not move
    plan = many._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "max(struct" not in plan
    if "per_delivery" in options:
        assert sorted((r.ID, r.n) for r in many.collect() if r.ID == "a" and r.Product_Association_ID == "x") == [("a", 1), ("a", 2)]
        assert not [r for r in many.collect() if r.ID == "d" and r.n == 1]


def test_a_single_delivery_is_rolled_up_without_a_join(spark):
    df = landing(spark, ("a", "x", 1, [attribute("Billing", "k", "1")]), ("b", "x", 2, [attribute("Billing", "k", "2")]), ("c", "x", 3, []))
    got = rollup.eav_rollup(df, IDS, fv.CATEGORIES, association="Product_Association_ID", order_by=["n"], per_delivery=["n"])
    assert sorted((r.ID, r.n, json.loads(r.billing_detail)[0]["k"]) for r in got.collect()) == [("a", 1, "1"), ("b", 2, "2")]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("from_json(") == 1
