"""Schemas of open documents against declared ones."""

import pytest
from pyspark.sql import types as T

from ledgerlake.functions import observed_schemas, schema_drift
from ledgerlake.functions.drift import drift, schema_paths

DECLARED = ("id string, n int, amount decimal(18,2), at timestamp, tags array<string>, lines array<struct<a: string, b: int>>")


def found(spark, docs, declared=DECLARED):
    return {r.path: (r.declared, r.observed, r.drift) for r in schema_drift(spark.createDataFrame([(d,) for d in docs], "doc string"), "doc", T.StructType.fromDDL(declared)).collect()}


def test_documents_as_declared_have_no_drift(spark):
    whole = '{"id":"a","n":1,"amount":2.5,"at":"2024-01-01T00:00:00Z","tags":["x"],"lines":[{"a":"q","b":2}]}'
    assert found(spark, [whole, whole.replace("2.5", "3")]) == {}


def test_new_missing_retyped_and_empty_paths(spark):
    docs = [
        '{"id":7,"n":1.5,"amount":"2.50","at":null,"tags":{"x":1},"lines":[{"a":"q","c":{"d":1}}],"more":[1]}',
        '{"id":7,"n":2,"at":null}',
    ]
    assert found(spark, docs) == {
        "id": ("string", "bigint", "retyped"),
        "n": ("int", "decimal(21,1)", "retyped"),
        "amount": ("decimal(18,2)", "string", "retyped"),
        "at": ("timestamp", "empty", "empty"),
        "tags": ("array", "object", "retyped"),
        "lines[].b": ("int", None, "missing"),
        "lines[].c": (None, "object", "new"),
        "more": (None, "array", "new"),
    }


def test_types_side_by_side_are_mixed(spark):
    assert found(spark, ['{"id":"a"}', '{"id":{"$oid":"a"}}'], "id string") == {"id": ("string", "mixed", "retyped")}


@pytest.mark.parametrize("docs", [[], [None, "", "{ no json"]])
def test_nothing_readable_has_no_drift(spark, docs):
    assert found(spark, docs) == {}
    frame = spark.createDataFrame([(d,) for d in docs], "doc string")
    assert [r.unreadable for r in observed_schemas(frame, "doc").collect()] == [len(docs)]


def test_documents_that_are_no_objects_lack_every_path(spark):
    assert {k: v[2] for k, v in found(spark, ["[1]", "5"], "id string, l array<int>").items()} == {"id": "missing", "l": "missing"}


def test_paths_of_nested_types(spark):
    dtype = T.StructType.fromDDL("a array<array<struct<b: int>>>, c struct<d: string>")
    assert [*schema_paths(dtype)] == ["a", "a[]", "a[][]", "a[][].b", "c", "c.d"]
    assert drift(dtype, dtype) == []
