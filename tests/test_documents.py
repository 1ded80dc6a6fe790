import json

import pytest
from pyspark.sql import functions as F

from histflow.functions import documents as dx


def value(spark, text, path):
    df = spark.createDataFrame([(text,)], "t string")
    return df.select(dx.json_value(dx.document("t"), path)).first()[0]


@pytest.mark.parametrize(
    "text, path, expected",
    [
        ('{"a":{"b":1}}', "$.a", None),
        ('{"a":[1]}', "$.a", None),
        ('{"a":"{x"}', "$.a", "{x"),
        ('{"a":"[]"}', "$.a", "[]"),
        ('{"a":{}}', "$.a", None),
        ('{"a":null}', "$.a", None),
        ('{"a":null}', "$.b", None),
        ('{"a":{"b":{"c":"deep"}}}', "$.a.b.c", "deep"),
        ('{"a":true}', "$.a", "true"),
        ('{"a":12}', "$.a", "12"),
        ("not json", "$.a", None),
        (None, "$.a", None),
    ],
)
def test_json_value(spark, text, path, expected):
    assert value(spark, text, path) == expected
    df = spark.createDataFrame([(text,)], "t string").select(dx.document("t").alias("d"))
    assert dx.with_scalars(df, "d", {"v": path}).first()["v"] == expected


def test_wrapped_or_plain_field(spark):
    df = spark.createDataFrame([('{"f":{"value":"w"}}',), ('{"f":"p"}',), ("{}",)], "t string")
    wrapped = F.coalesce(dx.json_value(dx.document("t"), "$.f.value"), dx.json_value(dx.document("t"), "$.f"))
    assert [r[0] for r in df.select(wrapped).collect()] == ["w", "p", None]


def test_subtree_null_and_absent(spark):
    df = spark.createDataFrame([('[{"c":null,"d":[{"y":2,"x":1}]}]',)], "t string")
    got = df.select(*[dx.json_subtree(dx.document("t"), f"$[0].{k}") for k in "cde"]).first()
    assert tuple(got) == ("null", '[{"x":1,"y":2}]', None)


def test_canonical(spark):
    df = spark.createDataFrame([('{"b": 1.50, "a": {"d":1,"c":2}}',), ("nope",)], "t string")
    assert [r[0] for r in df.select(dx.canonical("t")).collect()] == ['{"a":{"c":2,"d":1},"b":1.5}', None]


@pytest.mark.parametrize("text, expected", [('[{"a":1},{"b":2}]', '{"a":1}'), ("[]", "{}"), ('{"a":1}', "{}"), (None, "{}")])
def test_first(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(F.to_json(dx.json_first("t"))).first()[0] == expected


@pytest.mark.parametrize(
    "text, aci, acau",
    [
        ('{"ACI_b":null,"ACI_a":1,"x":2}', '{"ACI_a":1}', "{}"),
        ('{"AcAu_q":{"z":1,"a":[true]}}', "{}", '{"AcAu_q":{"a":[true],"z":1}}'),
        ("{}", "{}", "{}"),
        ("[1]", "{}", "{}"),
        (None, "{}", "{}"),
    ],
)
def test_prefix_split(spark, text, aci, acau):
    df = spark.createDataFrame([(text,)], "t string").select(dx.document("t").alias("d"))
    assert tuple(df.select(dx.prefix_split("d", "ACI"), dx.prefix_split("d", "AcAu")).first()) == (aci, acau)


def test_same_document(spark):
    df = spark.createDataFrame([(None, "{}"), ('{"a":1}', None)], "a string, b string")
    assert [r[0] for r in df.select(dx.same_document("a", "b")).collect()] == [True, False]


@pytest.mark.parametrize("text", ['say "hi"', "back\\slash", "tab\tnew\nline", "äöü – 漢字", "", "a/b & <c>"])
def test_quote_is_json(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    assert json.loads(df.select(dx.json_quote("t")).first()[0]) == text


def test_repeated_key_keeps_the_payload(spark):
    df = spark.createDataFrame([('[{"a":1,"a":2},{"a":3}]',)], "t string")
    got = df.select(F.explode(dx.json_elements("t")).alias("e")).select(F.to_json("e")).collect()
    assert [r[0] for r in got] == ['{"a":2}', '{"a":3}']


def test_documents_differ_as_canonical_texts_do(spark):
    texts = [None, "{}", " { } ", "[]", "null", '{"a":1,"b":2}', '{"b":2, "a":1.0}', '{"a":1}', "not json", "{", "", '{"a":{}}', "\t{\n}"]
    df = spark.createDataFrame([(a, b) for a in texts for b in texts], "a string, b string")
    plain = dx.document_or_empty("a") != dx.document_or_empty("b")
    got = df.select("a", "b", dx.documents_differ("a", "b").alias("got"), plain.alias("want")).collect()
    assert [(r.a, r.b) for r in got if r.got != r.want] == [] and {r.got for r in got} == {True, False}
