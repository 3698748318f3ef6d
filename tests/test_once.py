"""What a row costs: cells read once, types asked once, rows handed on once."""

import pytest
from pyspark.sql import functions as F

from lorequarry.operators import bundles, documents, schema


def _plan(df):
    return df._jdf.queryExecution().analyzed().toString()


def test_a_cell_is_parsed_once_and_a_typed_row_needs_no_lambda(spark):
    cells = spark.createDataFrame([(1, '{"k":95}')], "id long, props string")
    rule = {"$defs": {"e": {"type": "object", "properties": {"id": {"type": "integer", "minimum": 0}, "props": {"type": "object", "required": ["k"], "properties": {"k": {"type": "integer", "maximum": 90}}}}, "required": ["id", "props"]}}}
    errors = schema.Compiler(rule).row_errors({"$ref": "#/$defs/e"}, cells.schema)
    executed = cells.select(errors)._jdf.queryExecution().optimizedPlan().toString()
    assert executed.lower().count("parsejson") == 1
    assert [r["error"] for r in schema.violations(cells, rule, "e", ["id"]).collect()] == ["props/k: maximum"]
    typed = cells.drop("props")
    assert "lambda" not in _plan(typed.select(schema.Compiler(rule).row_errors({"$ref": "#/$defs/e"}, typed.schema)))


def test_odd_names_and_json_nulls_of_members(spark):
    rule = {"required": ["a b", "n"], "properties": {"a b": {"type": "integer"}, "n": {"type": "null"}, "it's": {"maximum": 1}}}
    df = spark.createDataFrame([('{"a b":1,"n":null}',), ('{"a b":"x","n":0,"it\'s":2}',), ('[]',), ('{}',)], "t string")
    got = [r[0] for r in df.select(schema.Compiler({}).json_errors(rule, F.col("t"))).collect()]
    assert got == [[], ["a b: type", "it's: maximum", "n: type"], [], ["a b: required", "n: required"]]


def test_relations_together_equal_those_apart_and_store_nothing(spark):
    docs = spark.createDataFrame([(1, '{"p":{"a":[{"x":1,"y":"s"},{"x":"no"},3,null],"b":[{"x":"7","y":"not its own"}]}}'), (2, "bad"), (3, None), (4, '{"p":{"a":{"x":1},"b":[]}}')], "id int, doc string")
    wanted = {"$.p.a": "x int, y string", "$.p.b": "x int", "$.q": "z string"}
    out = documents.parted(docs, "id", "doc", wanted)
    assert out.columns == ["relation", "id", "place", "x", "y", "z"] and "Scan ExistingRDD" not in _plan(out.select("place")).replace(_plan(docs), "")
    got = sorted((tuple(r) for r in out.collect()), key=str)
    want = [(path, r["id"], r["place"], *(r[c] if c in r else None for c in "xyz")) for path, df in documents.relations(docs, "id", "doc", wanted).items() for r in df.collect()]
    assert got == sorted(want, key=str) and len(got) == 5
    with pytest.raises(ValueError, match="two types"):
        documents.parted(docs, "id", "doc", {"$.a": "x int", "$.b": "x string"})


def test_leaves_of_any_depth_in_one_pass(spark):
    """Brackets in strings and in unreadable texts are not depth; no level is stored before the sixteenth."""
    deep = "[" * 20 + "1" + "]" * 20
    texts = ['{"a":"[[[[\\"{{","b":{"c":[]}}', "[" * 3000, '"[[" ', deep]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, doc string")
    assert [r[0] for r in df.orderBy("id").select(documents.depth(documents.shape(F.col("doc")))).collect()] == [3, 3000, 0, 20]
    got = sorted((tuple(r) for r in documents.leaves(df, "id", "doc").collect()), key=str)
    assert got == sorted([(0, "/a", "string", '[[[["{{'), (0, "/b/c", "array", None), (1, "", "unreadable", None), (2, "", "string", "[["), (3, "/0" * 20, "number", "1")], key=str)
    flat = documents.leaves(df.where("id < 1"), "id", "doc")
    assert "Union" not in _plan(flat) and _plan(flat).count("variant_explode") == 3


def test_a_stored_bundle_is_parsed_once_for_all_its_rules(spark):
    df = spark.createDataFrame([('{"request_id":1}',)], "t string")
    errors = df.select(schema.Compiler({}).json_errors(bundles.SCHEMA, F.col("t")))
    assert errors._jdf.queryExecution().optimizedPlan().toString().lower().count("parsejson") == 1
    assert "request_id: type" in errors.first()[0] and "governance: required" in errors.first()[0]


def test_a_requests_items_are_one_list(spark):
    """One list for all parts, and maps whose keys stand in order are written as they are."""
    rest = [c for c in bundles.FIELDS if c not in (*bundles.PARTS, "evidence")]
    requests = spark.createDataFrame([tuple("r" for _ in rest)], ", ".join(f"{c} string" for c in rest))
    items = spark.createDataFrame([("r", "vector", 2, {"evidence_id": "e", "brand_layer": "x"}), ("r", "play_cards", 1, {"id": "c", "evidence_id": "e"}), ("r", "vector", 1, {"evidence_id": "f", "brand_layer": None})], "request_id string, part string, ord int, item map<string,string>")
    out = bundles.assemble(requests, items)
    assert _plan(out).count("collect_list(") == 1
    row = out.first()
    assert list(row["play_cards"][0]) == ["evidence_id", "id"] and row["evidence"] == [{"evidence_id": "e"}, {"brand_layer": None, "evidence_id": "f"}]
