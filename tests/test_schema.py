"""Every keyword of the schema compiler, by rows that break it and rows that do not."""

import json

import pytest
from pyspark.sql import functions as F

from lorequarry.operators import schema

DEFS = {
    "$defs": {
        "layer": {"type": "string", "pattern": "^(base|brand_[a-z]+)$"},
        "row": {
            "type": "object",
            "properties": {"id": {"type": "string", "minLength": 1}, "layer": {"$ref": "#/$defs/layer"}, "layers": {"type": "array", "items": {"$ref": "#/$defs/layer"}, "minItems": 1}, "on": {"type": "boolean"}, "n": {"type": "integer", "minimum": 0}},
            "required": ["id", "layer", "on"],
        },
        "gate": {"properties": {"status": {"enum": ["active", "draft"]}}, "if": {"properties": {"status": {"const": "draft"}}, "required": ["status"]}, "then": {"required": ["reason"]}},
        "loop": {"$ref": "#/$defs/loop"},
        "odd": {"dependentRequired": {}},
    }
}

#: (schema, value that fits, value that does not, its errors)
CASES = [
    ({"type": "string"}, "a", 1, ["<root>: type"]),
    ({"type": "integer"}, 1.0, 1.5, ["<root>: type"]),
    ({"type": "number"}, 1.5, "1.5", ["<root>: type"]),
    ({"type": "boolean"}, True, 1, ["<root>: type"]),
    ({"type": "null"}, None, 0, ["<root>: type"]),
    ({"type": ["string", "null"]}, None, [], ["<root>: type"]),
    ({"type": "object"}, {}, [], ["<root>: type"]),
    ({"enum": ["a", "é\"", 3]}, "é\"", "b", ["<root>: enum"]),
    ({"const": {"b": 1, "a": [2]}}, {"a": [2], "b": 1}, {"a": 2}, ["<root>: const"]),
    ({"pattern": "b+$"}, "abb", "bba", ["<root>: pattern"]),
    ({"minLength": 2}, "👍👍", "👍", ["<root>: minLength"]),
    ({"maxLength": 2}, "👍👍", "abc", ["<root>: maxLength"]),
    ({"minimum": 2}, 2, 1.9, ["<root>: minimum"]),
    ({"maximum": 2}, "9", 3, ["<root>: maximum"]),
    ({"exclusiveMinimum": 2}, 3, 2, ["<root>: exclusiveMinimum"]),
    ({"exclusiveMaximum": 2}, 1, 2, ["<root>: exclusiveMaximum"]),
    ({"multipleOf": 4}, 8, 9, ["<root>: multipleOf"]),
    ({"required": ["a"]}, {"a": None}, {"b": 1}, ["a: required"]),
    ({"properties": {"a": {"type": "string"}}}, {"b": 1}, {"a": 1}, ["a: type"]),
    ({"properties": {"a": {}}, "additionalProperties": False}, {"a": 1}, {"a": 1, "c": 1, "b": 2}, ["b: additionalProperties", "c: additionalProperties"]),
    ({"minProperties": 1}, {"a": 1}, {}, ["<root>: minProperties"]),
    ({"items": {"type": "integer"}}, [1, 2], [1, "x", None], ["1: type", "2: type"]),
    ({"minItems": 1}, [1], [], ["<root>: minItems"]),
    ({"maxItems": 1}, [1], [1, 2], ["<root>: maxItems"]),
    ({"uniqueItems": True}, [1, "1", {"a": 1}], [{"a": 1, "b": 2}, {"b": 2, "a": 1}], ["<root>: uniqueItems"]),
    ({"contains": {"const": 3}}, [1, 3], [1], ["<root>: contains"]),
    ({"allOf": [{"minimum": 1}, {"maximum": 3}]}, 2, 4, ["<root>: maximum"]),
    ({"anyOf": [{"type": "string"}, {"minimum": 5}]}, 6, 4, ["<root>: anyOf"]),
    ({"oneOf": [{"minimum": 1}, {"minimum": 5}]}, 3, 6, ["<root>: oneOf"]),
    ({"not": {"type": "string"}}, 1, "a", ["<root>: not"]),
    ({"if": {"minimum": 5}, "then": {"multipleOf": 5}, "else": {"multipleOf": 2}}, 10, 3, ["<root>: multipleOf"]),
    ({"properties": {"a": {"items": {"required": ["b"], "properties": {"b": {"enum": [1]}}}}}}, {"a": [{"b": 1}]}, {"a": [{"b": 1}, {}, {"b": 2}]}, ["a/1/b: required", "a/2/b: enum"]),
    (True, 1, None, []),
    (False, None, 1, ["<root>: false"]),
]


def test_each_keyword(spark):
    compiler = schema.Compiler(DEFS)
    df = spark.createDataFrame([(1,)], "i int")
    cells = []
    for k, (rule, good, bad, _) in enumerate(CASES):
        for name, value in (("g", good), ("b", bad)):
            cells.append(compiler.json_errors(rule, F.lit(json.dumps(value, ensure_ascii=False))).alias(f"{name}{k}"))
    row = df.select(*cells).first()
    for k, (rule, _, _, errors) in enumerate(CASES):
        assert row[f"b{k}"] == errors, rule
        assert row[f"g{k}"] == [] or rule is False, rule


def test_rows_of_cells_and_of_types(spark):
    """Text cells are read as what their property wants; typed columns as they are."""
    cells = spark.createDataFrame([(1, "a", "base", '["base"]', "true", "3"), (2, "", "brand_X", '["base", "x"]', "yes", "-1"), (3, None, None, "[]", None, "1.5"), (4, "a", "base", "base", "true", None)], "key int, id string, layer string, layers string, on string, n string")
    got = {}
    for r in schema.violations(cells, DEFS, "row", ["key"]).collect():
        got.setdefault(r["key"], []).append(r["error"])
    assert got == {2: ["id: minLength", "layer: pattern", "layers/1: pattern", "n: minimum", "on: type"], 3: ["id: required", "layer: required", "layers: minItems", "n: type", "on: required"], 4: ["layers: type"]}
    typed = spark.createDataFrame([(1, "a", "base", ["base"], True, 3), (2, "", "x", ["base", None], None, -1), (3, "b", "base", None, False, None)], "key int, id string, layer string, layers array<string>, on boolean, n int")
    assert [tuple(r) for r in schema.violations(typed, DEFS, "row", ["key"]).collect()] == [(2, e) for e in ("id: minLength", "layer: pattern", "layers/1: type", "n: minimum", "on: required")]
    assert schema.violations(typed.drop("on"), DEFS, "row", ["key"]).where("error = 'on: required'").count() == 3


def test_both_definitions_and_conditions(spark):
    df = spark.createDataFrame([("a", "base", True, "draft", None), ("b", "base", True, "draft", "r"), ("c", "base", True, "gone", None), ("d", "base", True, None, None)], "id string, layer string, on boolean, status string, reason string")
    assert [tuple(r) for r in schema.violations(df, DEFS, ["row", "gate"], ["id"]).collect()] == [("a", "reason: required"), ("c", "status: enum")]


def test_preflight_fails_closed(spark):
    df = spark.range(120).select(F.col("id").alias("key"), F.when(F.col("id") < 80, "").otherwise("x").alias("id"), F.lit("base").alias("layer"), F.lit(True).alias("on"))
    out = schema.preflight([("many", df, DEFS, "row", ["key"]), ("good", df.where("id = 'x'"), DEFS, "row", ["key"]), ("none", None, DEFS, "row", ["key"]), ("nowhere", df, DEFS, "absent", ["key"]), ("loop", df, DEFS, "loop", ["key"]), ("odd", df, DEFS, "odd", ["key"]), ("empty", df.limit(0), DEFS, "row", ["key"])])
    got = {r["name"]: r for r in out.collect()}
    assert (got["many"]["status"], got["many"]["checked_rows"], got["many"]["n_violations"], got["many"]["truncated"]) == ("fail", 120, 80, True)
    assert len(got["many"]["first"]) == 50 and got["many"]["first"][10] == "10 id: minLength"
    assert (got["good"]["status"], got["good"]["first"], got["empty"]["status"], got["empty"]["checked_rows"]) == ("pass", [], "pass", 0)
    for name, why in (("none", "missing"), ("nowhere", "no such"), ("loop", "itself"), ("odd", "cannot check")):
        assert got[name]["status"] == "fail" and why in got[name]["first"][0]


@pytest.mark.parametrize("text", ["{", "", None])
def test_unreadable_json(spark, text):
    df = spark.createDataFrame([(text,)], "t string").select(schema.Compiler(DEFS).json_errors({}, F.col("t")).alias("e"))
    assert df.first()["e"] == ["<root>: json"]
