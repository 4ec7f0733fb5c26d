"""Parsed documents against fields read from text."""

from __future__ import annotations

from pyspark.sql import functions as F

from lanemart.functions import json as JS

TEXTS = [
    None, "", "{", "[]", "7", '{"a": null}', '{"a": "x", "b": {"c": 1, "d": [true, "y"]}}', '{"a": 12, "b": "{\\"c\\": 2.5}"}',
    '{"a": " ", "b": {"c": "n/a"}}', '{"a": true, "b": {"c": -3e2}}', '{"a": "\u00e9\\u00e9"}',
]


def test_documents_give_what_text_fields_give(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id long, doc string")
    parsed = JS.with_document(df, F.col("doc"), "v")
    inner = JS.with_document(parsed, JS.document_text(F.col("v"), "b"), "w")
    got = inner.select("id", JS.document_text(F.col("v"), "a"), JS.document_double(F.col("v"), "b.c"), JS.document_double(F.col("w"), "c", 9))
    text = JS.json_text(F.col("doc"), "b")
    want = df.select(
        "id", JS.json_text(F.col("doc"), "a"), JS.json_double(F.when(F.col("id") != 7, text), "c"), JS.json_double(text, "c", 9)
    )
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert spark.range(1).select(F.try_parse_json(F.lit('{"a":1,"a":2}')).isNull()).first()[0]
    objects = parsed.select(JS.document_text(F.col("v"), "b")).collect()[6][0]
    assert objects == '{"c":1,"d":[true,"y"]}'


def test_one_parse_for_many_fields(spark):
    df = JS.with_document(spark.range(3).select(F.concat(F.lit('{"a":'), "id", F.lit("}")).alias("doc")), F.col("doc"), "v")
    fields = df.select(*[JS.document_text(F.col("v"), f"k{i}").alias(f"k{i}") for i in range(5)])
    plan = fields._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson(") == 1, plan
