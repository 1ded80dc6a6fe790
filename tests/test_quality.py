import datetime as dt

from row_lists import rows
from pyspark.sql import functions as F

from histflow.operators import quality
from histflow.plans import loads

CUSTOMER = (
    "customer_id string, customer_nm string, sf_account_id string, sf_platform_id_level_nm string, "
    "business_unit_cd string, indicator_flag string, business_effective_dt date, business_expiration_dt date, extra int"
)
AS_OF = "2026-01-01 00:00:00"


def landing(spark):
    day = dt.date(2024, 1, 1)
    return spark.createDataFrame(
        [
            ("1", "A", "ACC-1", "TRUE", "Caremark", "N", day, None, 1),
            ("2", None, "ACC-2", "true", "Other", "N", None, None, 2),
            ("3", "C", "ACC-3", "maybe", "Aetna", "N", day, None, 3),
            ("4", "D", "ACC-4", None, "Aetna", "N", day, None, 4),
            ("5", "E", "ACC-5", "false", "Aetna", "N", day, None, 5),
            ("5", "E", "ACC-5", "true", "Third_Party", "N", day, None, 6),
            (None, "F", "ACC-6", "true", "Aetna", "N", day, None, 7),
            (None, "F", "ACC-6", "true", "Aetna", "N", day, None, 8),
            ("9", "G", "ACC-9", "true", None, "N", day, None, 9),
            ("10", "H", "ACC-10", "true", "Aetna", "Y", day, None, 10),
        ],
        CUSTOMER,
    )


def test_statuses_and_duplicates(spark):
    checked = loads.check_customers(loads.customer_source(landing(spark), AS_OF))
    got = {r["extra"]: r for r in checked.collect()}
    assert 10 not in got
    assert [got[i]["not_null_status"] for i in (1, 2, 7, 9)] == ["PASS"] + ["FAIL_NOT_NULL"] * 3
    assert got[7]["datatype_status"] == "FAIL_DATATYPE" and got[1]["datatype_status"] == "PASS"
    assert [got[i]["valid_value_status"] for i in (1, 3, 4)] == ["PASS", "FAIL_VALID_VALUE", "FAIL_VALID_VALUE"]
    assert [got[i]["is_duplicate"] for i in (1, 5, 6, 7, 8)] == [False, True, True, False, False]
    assert got[1]["business_unit_cd"] == "PBM" and got[2]["business_effective_dt"] == dt.date(1900, 1, 1)


def test_split_is_a_partition(spark):
    checked = loads.check_customers(loads.customer_source(landing(spark), AS_OF))
    valid, invalid = quality.split_valid(checked, loads.CUSTOMER_STATUSES)
    assert [r["extra"] for r in valid.collect()] == [1]
    assert rows(valid.select("extra").unionByName(invalid.select("extra"))) == rows(checked.select("extra"))
    assert quality.audit_rows(invalid, AS_OF).columns[0] == "audit_dts"


def test_duplicates_with_a_hot_key(spark):
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"), "id"
    )
    flagged = quality.flag_duplicates(df, ["k"])
    assert rows(flagged.where("is_duplicate").select("id")) == rows(df.where("k = 'hot'").select("id"))
    assert flagged.count() == 6000


def test_castable_rule_counts_null_as_bad(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "v string")
    got = [r[0] for r in df.select(quality.castable_rule({"v": "bigint"})).collect()]
    assert got == ["PASS", "FAIL_DATATYPE", "FAIL_DATATYPE"]


def test_customer_load_and_second_run(spark):
    target = spark.createDataFrame(
        [],
        "sgk_customer_id string, customer_id string, customer_nm string, sf_account_id string, "
        "sf_platform_id_level_nm string, business_unit_cd string, business_effective_dt date, "
        "business_expiration_dt date, record_start_dts timestamp, record_end_dts timestamp, active_record_ind string",
    )
    first = loads.customer_load(landing(spark), target, AS_OF)
    assert [r["sf_account_id"] for r in first.history.collect()] == ["ACC-1"]
    assert first.rejected.count() == 8
    flags = {r["extra"]: r["indicator_flag"] for r in first.source.collect()}
    assert flags[1] == "Y" and flags[2] == "N" and flags[10] == "Y"
    later = "2026-02-01 00:00:00"
    again = loads.customer_load(landing(spark), first.history, later)
    assert rows(again.history) == rows(first.history)
    always = loads.customer_load(landing(spark), first.history, later, insert="always", end_rule="previous_day")
    ends = {r["active_record_ind"]: r["record_end_dts"] for r in always.history.collect()}
    assert ends["N"] == dt.datetime(2026, 1, 31) and ends["Y"].year == 9999
