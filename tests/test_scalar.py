import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F, types as T

from histflow import fixed_values as fv
from histflow.functions import scalar as fx


def one(spark, column, schema="x string", row=(None,)):
    return spark.createDataFrame([row], schema).select(column.alias("v")).first()[0]


@pytest.mark.parametrize(
    "text, sensitive, insensitive",
    [("Caremark", "PBM", "PBM"), ("caremark", "caremark", "PBM"), ("Other", "Other", "Other"), (None, None, None)],
)
def test_code_map(spark, text, sensitive, insensitive):
    assert one(spark, fx.code_map("x", fv.BUSINESS_UNITS), row=(text,)) == sensitive
    assert one(spark, fx.code_map("x", fv.BUSINESS_UNITS, ignore_case=True), row=(text,)) == insensitive


@pytest.mark.parametrize(
    "text, expected",
    [("a; b;;c", ["a", "b", "c"]), (";;", []), ("x", ["x"]), (None, None), ("a|b", ["a|b"])],
)
def test_split_list(spark, text, expected):
    assert one(spark, fx.split_list("x"), row=(text,)) == expected


def test_split_list_quotes_its_separator(spark):
    assert one(spark, fx.split_list("x", "|"), row=("ab|c",)) == ["ab", "c"]


@pytest.mark.parametrize(
    "text, expected",
    [("Owner &amp; Contact", "Owner & Contact"), ("Owner \\u0026amp; Contact", "Owner & Contact"), ("A & B", "A & B")],
)
def test_decode_ampersand(spark, text, expected):
    assert one(spark, fx.decode_ampersand("x"), row=(text,)) == expected


def test_clean_key(spark):
    assert one(spark, fx.clean_key("x"), row=("Fee (per unit) X_Y",)) == "Fee_per_unit_XY"


@pytest.mark.parametrize("text, expected", [("Level 3", 3), ("none", None), (None, None), ("L12 of 40", 12)])
def test_level_number(spark, text, expected):
    assert one(spark, fx.level_number("x"), row=(text,)) == expected


@pytest.mark.parametrize(
    "text, kind, expected",
    [
        ("x", "bigint", None),
        (" 12 ", "bigint", 12),
        ("1.5", "bigint", None),
        ("99999999999999999999", "bigint", None),
        ("2025", "date", None),
        ("2025-12-22", "date", dt.date(2025, 12, 22)),
        ("2025-12-22T18:15:02Z", "date", None),
        ("TRUE", "boolean", True),
        ("t", "boolean", None),
        ("10:00", "timestamp_ntz", None),
        ("2025-12-22T23:15:02-05:00", "timestamp_ntz", dt.datetime(2025, 12, 23, 4, 15, 2)),
        (None, "bigint", None),
    ],
)
def test_safe_cast(spark, text, kind, expected):
    assert one(spark, fx.safe_cast("x", kind), row=(text,)) == expected


def test_date_of_instant(spark):
    assert one(spark, fx.date_of_instant("x"), row=("2025-12-22T23:15:02-05:00",)) == dt.date(2025, 12, 23)
    assert one(spark, fx.date_of_instant("x"), row=("soon",)) is None


def test_hashes_of_nulls(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "p string, q string, r string")
    keyed = [r[0] for r in df.select(fx.md5_key(["p", "q", "r"])).collect()]
    literal = [r[0] for r in df.select(fx.md5_key(["p", "q", "r"], null_text=None)).collect()]
    digests = [r[0] for r in df.select(fx.content_digest(["p", "q", "r"])).collect()]
    assert keyed[0] == hashlib.md5(b"a|X|b").hexdigest() and keyed[0] != keyed[1]
    assert literal[0] == literal[1] == hashlib.md5(b"a|b").hexdigest()
    assert digests[0] != digests[1]


def test_content_digest_sees_through_separators(spark):
    df = spark.createDataFrame([("1:a", "b"), ("1", "a:b"), ("", None), (None, "")], "p string, q string")
    assert df.select(fx.content_digest(["p", "q"])).distinct().count() == 4


def test_joined_key_is_null_with_a_null_part(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None)], "p string, q string")
    assert [r[0] for r in df.select(fx.joined_key(["p", "q"])).collect()] == ["a-b", None]


def test_previous_midnight(spark):
    as_of = F.lit("2026-01-01 10:30:00").cast("timestamp_ntz")
    assert one(spark, fx.previous_midnight(as_of, "timestamp_ntz")) == dt.datetime(2025, 12, 31)


def test_surrogate_is_stable_and_random_is_not(spark):
    df = spark.range(100).select("id", fx.surrogate_key(["id"], F.lit("t")).alias("s"), fx.random_key().alias("r"))
    assert df.select("s").distinct().count() == df.select("r").distinct().count() == 100
    assert df.select("s").exceptAll(df.select("s")).count() == 0


def test_routes(spark):
    df = spark.createDataFrame([("a", "1", "2"), ("b", "1", "2"), ("c", "1", "2"), (None, "1", "2")], "k string, p string, q string")
    routed = fx.routed_field("k", {"a": F.col("p"), "b": F.col("q")})
    assert [r[0] for r in df.select(routed).collect()] == ["1", "2", None, None]


def test_typed_null(spark):
    assert spark.range(1).select(fx.typed_null(T.DateType()).alias("d")).schema["d"].dataType == T.DateType()


def test_surrogate_keys_do_not_collide(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("X", "c"), (None, "c")], "x string, y string")
    assert df.select(fx.surrogate_key(["x", "y"], F.lit("t"))).distinct().count() == 4


def test_a_type_suffix_is_no_number(spark):
    df = spark.createDataFrame([("1.5d",), ("1.5f",), ("1.5",), ("-.5e3",), ("x",)], "x string")
    assert [r[0] for r in df.select(fx.safe_cast("x", "double")).collect()] == [None, None, 1.5, -500.0, None]
