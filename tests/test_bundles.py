"""Bundles, their log and replay, canonical JSON and nested documents against plain Python."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from lorequarry.functions import cases, text
from lorequarry.operators import bundles, documents, gates, policy, vectors
from lorequarry.operators.gates import CODES

GOOD = {
    "request_id": "r1", "tenant_id": "t1", "resolved_brand_layer": "brand_a", "allowed_layers": ["brand_a", "domain_general"], "content_type": "post", "recipe": {}, "business_brief": {"sku": "s"},
    "missing_fields": [], "fallback_status": "domain_only", "generation_constraints": [],
    "governance": {"gate_policy": "active_only", "granularity_layers": ["L1"], "traceability_required": True, "compile_run_id": "run", "source_manifest_hash": "m", "view_schema_version": "v"},
}
KINDS = "request_id string, tenant_id string, resolved_brand_layer string, allowed_layers array<string>, content_type string, recipe map<string,string>, business_brief map<string,string>, missing_fields array<string>, fallback_status string, generation_constraints array<string>, governance struct<gate_policy:string,granularity_layers:array<string>,traceability_required:boolean,compile_run_id:string,source_manifest_hash:string,view_schema_version:string>"
ITEMS = [("r1", "play_cards", 1, {"id": "c1", "evidence_id": "e2"}), ("r1", "domain_packs", 2, {"id": "p2", "evidence_id": "e1"}), ("r1", "domain_packs", 1, {"id": "p1", "evidence_id": "e2"}), ("r1", "vector", 1, {"evidence_id": "e1", "brand_layer": "x"}), ("r1", "vector", 2, {"evidence_id": "e3", "brand_layer": None}), ("r1", "runtime_assets", 1, {"id": "a1"})]


def _made(spark, items=ITEMS, **changes):
    bundle = {**GOOD, **changes}
    requests = spark.createDataFrame([tuple(tuple(v.values()) if k == "governance" else v for k, v in bundle.items())], KINDS)
    return bundles.with_json(bundles.assemble(requests, spark.createDataFrame(items, "request_id string, part string, ord int, item map<string,string>")))


def test_bundle_is_canonical(spark):
    row = _made(spark).first()
    want = {**GOOD, "domain_packs": [ITEMS[2][3], ITEMS[1][3]], "play_cards": [ITEMS[0][3]], "runtime_assets": [{"id": "a1"}], "brand_overlays": [], "evidence": [{"evidence_id": "e2"}, {"evidence_id": "e1"}, {"evidence_id": "e3", "brand_layer": None}]}
    assert row["context_bundle_json"] == json.dumps(want, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert row["context_bundle_hash"] == "sha256:" + hashlib.sha256(row["context_bundle_json"].encode()).hexdigest() and row["errors"] == []
    none = _made(spark, [("other", "vector", 1, {})]).first()
    assert none["domain_packs"] == [] and none["evidence"] == [] and none["errors"] == []


@pytest.mark.parametrize("change,error", [({"tenant_id": ""}, "tenant_id: minLength"), ({"resolved_brand_layer": "Brand"}, "resolved_brand_layer: pattern"), ({"allowed_layers": []}, "allowed_layers: minItems"), ({"fallback_status": "x"}, "fallback_status: enum"), ({"recipe": None}, "recipe: required"), ({"governance": {**GOOD["governance"], "granularity_layers": ["L9"]}}, "governance/granularity_layers/0: enum"), ({"governance": {**GOOD["governance"], "compile_run_id": None}}, "governance/compile_run_id: required")])
def test_bundle_errors(spark, change, error):
    assert _made(spark, **change).first()["errors"] == [error]


EXTRA = {"user_query_hash": F.lit, "classified_intent": F.lit, "selected_recipe_id": F.lit}


def _logged(spark, **models):
    extra = {k: F.lit("x") for k in EXTRA}
    return bundles.log_rows(_made(spark), extra, models, F.lit("2024-01-01T00:00:00Z"))


def test_log_row(spark):
    row = _logged(spark, embedding_model="e", rerank_model="").first()
    assert row["log_errors"] == [] and list(row.asDict())[:-1] == bundles.LOG_FIELDS
    assert (row["embedding_model"], row["rerank_model"], row["blocked_reason"], row["final_output_hash"]) == ("e", "disabled", "none", "disabled")
    assert json.loads(row["retrieved_pack_ids"]) == ["p1", "p2"] and json.loads(row["retrieved_evidence_ids"]) == ["e2", "e1", "e3"] and row["compile_run_id"] == "run"
    empty = bundles.log_rows(_made(spark), {"user_query_hash": F.lit(""), "classified_intent": F.lit(None), "selected_recipe_id": F.lit("x")}, {}, F.lit("t")).first()
    assert empty["log_errors"] == ["user_query_hash: empty", "classified_intent: empty"]


def test_replay_finds_each_change(spark):
    log = _logged(spark).drop("log_errors")
    views = spark.createDataFrame([(v, i, b, "run", "m", "v") for v, i, b in [("pack", "p1", "brand_a"), ("pack", "p2", "brand_a"), ("card", "c1", "domain_general"), ("asset", "a1", "brand_a")]], "view string, id string, brand_layer string, compile_run_id string, source_manifest_hash string, view_schema_version string")
    tenants = spark.createDataFrame([("t1", "brand_a", ["domain_general", "brand_a"])], "tenant_id string, brand_layer string, allowed_layers array<string>")
    ids = {"retrieved_pack_ids": "pack", "retrieved_play_card_ids": "card", "retrieved_asset_ids": "asset"}
    asked = spark.createDataFrame([("r1",)], "request_id string")

    def code(log=log, views=views, tenants=tenants, asked=asked):
        return tuple(bundles.replay(asked, log, views, tenants, ids).select("code", "consistency_hash").first())

    ok = code()
    assert ok[0] == CODES["ok"] and ok == code() and ok[1].startswith("sha256:")
    assert code(log.withColumn("created_at", F.lit("later"))) == ok
    assert code(log.withColumn("blocked_reason", F.lit("other")))[1] != ok[1]
    assert code(asked=spark.createDataFrame([("r2",)], "request_id string")) == (CODES["no_log"], None)
    assert code(log.withColumn("fallback_status", F.lit("x")))[0] == CODES["bad_enum"]
    for column in ("compile_run_id", "source_manifest_hash", "view_schema_version"):
        assert code(log.withColumn(column, F.lit("old")))[0] == CODES["governance_drift"]
        assert code(views=views.withColumn(column, F.when(F.col("id") == "p1", "old").otherwise(F.col(column))))[0] == CODES["governance_drift"]
    assert code(log.withColumn("allowed_layers", F.lit('["brand_a"]')))[0] == CODES["tenant_drift"]
    assert code(tenants=tenants.where("false"))[0] == CODES["tenant_drift"]
    assert code(views=views.where("id <> 'p2'"))[0] == CODES["unresolved_id"]
    assert code(views=views.withColumn("brand_layer", F.when(F.col("id") == "a1", "brand_z").otherwise(F.col("brand_layer"))))[0] == CODES["foreign_layer"]
    for old, new in (('"sku":"s"', '"sku":"t"'), ('"tenant_id"', '"tenant"'), ("{", "[")):
        assert code(log.withColumn("context_bundle_json", F.replace("context_bundle_json", F.lit(old), F.lit(new))))[0] == CODES["hash_drift"]
    assert code(log.withColumn("context_bundle_json", F.lit(None).cast("string")))[0] == CODES["hash_drift"]
    assert code(log.withColumn("content_type", F.lit("story")))[0] == CODES["field_drift"]


def _canonical(x):
    return json.dumps(x, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def test_canonical_json_at_every_level(spark):
    a = spark.sql("SELECT named_struct('z', 1, 'a', array(named_struct('y', null, 'b', map('k2', 1, 'k1', 2)))) AS n, 'é\"\n' AS t")
    b = spark.sql("SELECT 'é\"\n' AS t, named_struct('a', array(named_struct('b', map('k1', 2, 'k2', 1), 'y', null)), 'z', 1) AS n")
    want = _canonical({"n": {"z": 1, "a": [{"y": None, "b": {"k1": 2, "k2": 1}}]}, "t": 'é"\n'})
    for df in (a, b):
        assert df.select(text.canonical_json(df, ["n", "t"])).first()[0] == want
    assert a.select(text.canonical_hash(a, ["n", "t"])).first() == b.select(text.canonical_hash(b, ["t", "n"])).first()
    docs = ['{"n":{"z":1,"a":[2,{"d":null,"c":"x"}]}}', ' {"n" : {"a":[2,{"c":"x","d":null}], "z":1}}', "{bad", None]
    got = [r[0] for r in spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, d string").orderBy("i").select(text.canonical_text(F.col("d"))).collect()]
    assert got == [_canonical(json.loads(docs[0]))] * 2 + [None, None]


DOCS = ['{"a":[1,{"b":"x\\"\\n","c":[]},null,true,1.5],"d":{},"":{"é/":"y"}}', '"only"', "[]", "7", "{bad", None, '{"k":{"k":{"k":{"k":["deep"]}}}}']


def _walk(x, path=""):
    if isinstance(x, dict) and x:
        for k, v in x.items():
            yield from _walk(v, f"{path}/{k}")
    elif isinstance(x, list) and x:
        for i, v in enumerate(x):
            yield from _walk(v, f"{path}/{i}")
    else:
        kind = {dict: "object", list: "array", str: "string", bool: "boolean", type(None): "null"}.get(type(x), "number")
        yield path, kind, None if kind in ("object", "array", "null") else str(x).lower() if kind == "boolean" else str(x)


def test_leaves_equal_a_recursive_walk(spark):
    df = spark.createDataFrame([(i, d, "x") for i, d in enumerate(DOCS)], "id int, doc string, path string")
    want = set()
    for i, d in enumerate(DOCS):
        try:
            want |= {(i, *row) for row in _walk(json.loads(d))}
        except (TypeError, ValueError):
            want.add((i, "", "unreadable", None))
    got = [tuple(r) for r in documents.leaves(df, "id", "doc").collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert documents.leaves(df.limit(0), "id", "doc").count() == 0


def test_json_texts_read_escapes(spark):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(DOCS)], "i int, d string").orderBy("i")
    assert [r[0] for r in df.select(cases.json_texts(F.col("d"))).collect()] == [['x"\n', "y"], ["only"], [], [], [], [], ["deep"]]


def test_relations_of_one_document(spark):
    docs = spark.createDataFrame([(1, '{"p":{"a":[{"x":1,"y":"s"},{"x":"no"},3],"b":{"x":1}}}'), (2, "bad"), (3, None)], "id int, doc string")
    out = documents.relations(docs, "id", "doc", {"$.p.a": "x int, y string", "$.p.b": "x int", "$.q": "z string"})
    assert sorted(tuple(r) for r in out["$.p.a"].collect()) == [(1, 0, 1, "s"), (1, 1, None, None), (1, 2, None, None)]
    assert out["$.p.b"].count() == 0 and out["$.q"].columns == ["id", "place", "z"]


def test_update_by_decisions(spark):
    df = spark.createDataFrame([(1, "a", "", "on"), (2, "b", "n", "on"), (3, "c", None, "off")], "k int, v string, note string, state string")
    decided = spark.createDataFrame([(1, "A", "r"), (1, "A", "r"), (3, None, "q")], "k int, new_value string, reason string")
    out = policy.keyed_update(df, decided, "k", "v", "note", ("state", F.col("v") == "a", F.lit("reset")))
    assert sorted(tuple(r) for r in out.collect()) == [(1, "A", "r", "reset"), (2, "b", "n", "on"), (3, "c", "q", "off")]
    twice = decided.unionByName(spark.createDataFrame([(3, "Z", "q")], "k int, new_value string, reason string"))
    with pytest.raises(Exception, match="two decisions on 3"):
        policy.keyed_update(df, twice, "k", "v", "note").collect()


def test_nan_is_no_neighbour(spark):
    rows = [(1, [float("nan"), 1.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [float("inf"), 1.0]), (6, [1.0, None])]
    out = vectors.top_k(spark.createDataFrame(rows, "vec_id int, embedding array<double>"), [1.0, 0.0], 5)
    assert [r["vec_id"] for r in out.collect()] == [2]


def test_utc_in_another_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        df = spark.sql("SELECT timestamp_seconds(0) AS t, TIMESTAMP_NTZ '1970-01-01 08:00:00' AS n")
        assert tuple(df.select(cases.utc_text(F.col("t")), cases.utc_text(F.col("n"))).first()) == ("1970-01-01T00:00:00Z",) * 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_lineage_fails_closed(spark):
    """Each rule of S1 by one row that breaks it alone; nothing to compare with is a failure too."""
    good = ("v", "1", "P1", "m", "s", "r", None)
    rows = [good, ("v", "2", " ", "m", "s", "r", None), ("v", "3", "P9", "m", "s", "r", None), ("c", "4", "CT-x", "m", "s", "r", '["P1", "P9", " ", null]'), ("c", "5", "P1", "", None, "r", "{}"), ("c", "6", "CT-y", "m", "s", "r", "[bad"), ("v", "7", "P1", "x", "y", "z", "[]"), ("v", "8", None, "m", "s", "r", "")]
    df = spark.createDataFrame(rows, "view string, pk string, source_pack_id string, source_manifest_hash string, view_schema_version string, compile_run_id string, source_pack_ids string")
    packs = spark.createDataFrame([("P1",), (" P1 ",)], "pack_id string")
    ids = {"source_manifest_hash": "m", "view_schema_version": "s", "compile_run_id": "r"}
    got = sorted(tuple(str(x) for x in r[1:]) for r in gates.lineage_gate(df, packs, ids, {"c": "CT-"}, ["v", "c", "w"]).collect())
    assert got == sorted([("2", "empty_source"), ("3", "orphan_source"), ("4", "orphan_plural"), ("4", "empty_plural"), ("4", "empty_plural"), ("5", "wrong_prefix"), ("5", "malformed_plural"), ("6", "malformed_plural"), ("7", "source_manifest_hash_mismatch"), ("7", "view_schema_version_mismatch"), ("7", "compile_run_id_mismatch"), ("8", "empty_source"), ("None", "empty_view")])
    for expected in (None, {}, {**ids, "compile_run_id": ""}):
        assert [r["error"] for r in gates.lineage_gate(df, packs, expected, {}, ["v"]).collect()] == ["expected_ids_missing"]
    assert gates.lineage_gate(df.limit(1), packs, ids, {}, ["v"]).count() == 0
