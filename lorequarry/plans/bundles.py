"""Bundles of all orders, their log and its replay; nested documents taken apart."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import bundles, documents
from .catalog import query

STATUS = "CASE o_orderstatus WHEN 'F' THEN 'brand_full_applied' WHEN 'O' THEN 'domain_only' ELSE 'brand_partial_fallback' END"
GOVERNANCE = {"compile_run_id": "run1", "source_manifest_hash": "m1", "view_schema_version": "v1"}
MODELS = {"embedding_model": "e1", "embedding_model_version": "2", "model_policy_version": "p3"}

#: The canonical JSON of each order's bundle, as text.
JSON = f"""
WITH i AS (SELECT l_orderkey AS r, CASE l_returnflag WHEN 'A' THEN 'domain_packs' WHEN 'N' THEN 'play_cards' ELSE 'runtime_assets' END AS part, l_linenumber * 1000000000000 + l_partkey * 1000000 + l_suppkey AS ord,
    'P' || l_partkey AS id, 'E' || l_suppkey AS e, CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS place, NULL AS layer FROM lineitem
  UNION ALL SELECT l_orderkey, 'vector', l_linenumber * 1000000000000 + l_partkey * 1000000 + l_suppkey, NULL, 'E' || (l_suppkey + l_linenumber), 4, 'brand_' || lower(l_linestatus) FROM lineitem WHERE l_quantity > 25),
parts AS (SELECT r, part, '[' || string_agg('{{"evidence_id":"' || e || '","id":"' || id || '"}}', ',' ORDER BY ord) || ']' AS j, '[' || string_agg('"' || id || '"', ',' ORDER BY ord) || ']' AS ids FROM i WHERE part <> 'vector' GROUP BY 1, 2),
firsts AS (SELECT r, e, min(place * 10000000000000000 + ord) AS f, arg_min(CASE WHEN place < 4 THEN '{{"evidence_id":"' || e || '"}}' ELSE '{{"brand_layer":"' || layer || '","evidence_id":"' || e || '"}}' END, place * 10000000000000000 + ord) AS j FROM i GROUP BY 1, 2),
ev AS (SELECT r, '[' || string_agg(j, ',' ORDER BY f) || ']' AS j, '[' || string_agg('"' || e || '"', ',' ORDER BY f) || ']' AS ids FROM firsts GROUP BY 1),
b AS (SELECT o_orderkey, 't' || o_custkey % 3 AS tenant_id, {STATUS} AS status, o_orderpriority, coalesce(p.ids, '[]') AS p_ids, coalesce(c.ids, '[]') AS c_ids, coalesce(a.ids, '[]') AS a_ids, coalesce(ev.ids, '[]') AS e_ids,
  CASE WHEN o_orderstatus = 'P' THEN '["tone"]' ELSE '[]' END AS missing,
  '{{"allowed_layers":["brand_a","domain_general"],"brand_overlays":' || CASE WHEN o_orderstatus = 'F' THEN '[{{"precedence_rule":"brand_<name> > domain_general"}}]' ELSE '[]' END || ',"business_brief":{{"sku":"' || o_custkey || '"}},"content_type":"' || o_orderpriority
  || '","domain_packs":' || coalesce(p.j, '[]') || ',"evidence":' || coalesce(ev.j, '[]') || ',"fallback_status":"' || {STATUS} || '","generation_constraints":[],"governance":{{"compile_run_id":"run1","gate_policy":"active_only","granularity_layers":["L1","L2"],"source_manifest_hash":"m1","traceability_required":true,"view_schema_version":"v1"}},"missing_fields":'
  || CASE WHEN o_orderstatus = 'P' THEN '["tone"]' ELSE '[]' END || ',"play_cards":' || coalesce(c.j, '[]') || ',"recipe":{{}},"request_id":"' || o_orderkey || '","resolved_brand_layer":"' || CASE WHEN o_custkey % 3 = 2 THEN 'Brand A' ELSE 'brand_a' END || '","runtime_assets":' || coalesce(a.j, '[]') || ',"tenant_id":"t' || o_custkey % 3 || '"}}' AS j,
  CASE WHEN o_custkey % 3 = 2 THEN 'Brand A' ELSE 'brand_a' END AS layer FROM orders
  LEFT JOIN parts p ON p.r = o_orderkey AND p.part = 'domain_packs' LEFT JOIN parts c ON c.r = o_orderkey AND c.part = 'play_cards' LEFT JOIN parts a ON a.r = o_orderkey AND a.part = 'runtime_assets' LEFT JOIN ev ON ev.r = o_orderkey)
"""


def _bundles(t):
    """A bundle for each order; a third of the tenants have a layer of the wrong form."""
    key, none = F.col("o_orderkey").cast("string"), F.array().cast("array<string>")
    texts = lambda *w: F.array(*(F.lit(x) for x in w))
    governance = F.struct(F.lit("active_only").alias("gate_policy"), texts("L1", "L2").alias("granularity_layers"), F.lit(True).alias("traceability_required"), *(F.lit(v).alias(k) for k, v in GOVERNANCE.items()))
    requests = t("orders").select(
        key.alias("request_id"), F.concat(F.lit("t"), F.col("o_custkey") % 3).alias("tenant_id"), F.when(F.col("o_custkey") % 3 == 2, "Brand A").otherwise("brand_a").alias("resolved_brand_layer"), texts("brand_a", "domain_general").alias("allowed_layers"),
        F.col("o_orderpriority").alias("content_type"), F.create_map().cast("map<string,string>").alias("recipe"), F.create_map(F.lit("sku"), F.col("o_custkey").cast("string")).alias("business_brief"),
        F.when(F.col("o_orderstatus") == "P", texts("tone")).otherwise(none).alias("missing_fields"), F.expr(STATUS).alias("fallback_status"), none.alias("generation_constraints"), governance.alias("governance"),
    )
    lines = t("lineitem").withColumn("ord", F.expr("l_linenumber * 1000000000000 + l_partkey * 1000000 + l_suppkey")).withColumn("r", F.col("l_orderkey").cast("string"))
    part = F.when(F.col("l_returnflag") == "A", "domain_packs").when(F.col("l_returnflag") == "N", "play_cards").otherwise("runtime_assets")
    named = lambda n: F.concat(F.lit("E"), n)
    rows = lines.select(F.col("r").alias("request_id"), part.alias("part"), "ord", F.create_map(F.lit("id"), F.concat(F.lit("P"), "l_partkey"), F.lit("evidence_id"), named(F.col("l_suppkey"))).alias("item"))
    near = lines.where("l_quantity > 25").select(F.col("r").alias("request_id"), F.lit("vector").alias("part"), "ord", F.create_map(F.lit("evidence_id"), named(F.col("l_suppkey") + F.col("l_linenumber")), F.lit("brand_layer"), F.concat(F.lit("brand_"), F.lower("l_linestatus"))).alias("item"))
    over = t("orders").where("o_orderstatus = 'F'").select(key.alias("request_id"), F.lit("brand_overlays").alias("part"), F.lit(0).cast("long").alias("ord"), F.create_map(F.lit("precedence_rule"), F.lit("brand_<name> > domain_general")).alias("item"))
    return bundles.with_json(bundles.assemble(requests, rows.unionByName(near).unionByName(over)))


def _log(t):
    extra = {"user_query_hash": text.sha256_id(F.col("request_id")), "classified_intent": F.lit("content_generation"), "selected_recipe_id": F.when(F.col("content_type") != "5-LOW", F.concat(F.lit("R-"), "content_type")), "blocked_reason": F.array_join("missing_fields", ",")}
    return bundles.log_rows(_bundles(t), extra, MODELS, F.lit("2024-01-01T00:00:00Z"))


@query(JSON + """
SELECT o_orderkey::VARCHAR AS request_id, 'sha256:' || sha256(j) AS context_bundle_hash, length(j) AS n,
  concat_ws(',', CASE WHEN layer = 'Brand A' THEN 'resolved_brand_layer: pattern' END, CASE WHEN o_orderpriority = '5-LOW' THEN 'selected_recipe_id: empty' END) AS errors,
  sha256(concat_ws('|', o_orderkey, tenant_id, layer, '["brand_a","domain_general"]', 'sha256:' || sha256(o_orderkey::VARCHAR), 'content_generation', o_orderpriority, CASE WHEN o_orderpriority <> '5-LOW' THEN 'R-' || o_orderpriority ELSE '' END, p_ids, c_ids, a_ids, '[]', e_ids, status, missing,
    CASE WHEN missing = '[]' THEN 'none' ELSE 'tone' END, 'sha256:' || sha256(j), 'disabled', 'run1', 'm1', 'v1', 'e1', '2', 'disabled', 'disabled', 'disabled', 'p3', '2024-01-01T00:00:00Z', j)) AS row_sha256 FROM b""")
def bundle_log(spark, t):
    """Every order's bundle assembled, validated, hashed and laid out as a log row of 29 fields."""
    cells = F.sha2(F.concat_ws("|", *(F.coalesce(F.col(c), F.lit("")) for c in bundles.LOG_FIELDS)), 256)
    return _log(t).select("request_id", "context_bundle_hash", F.char_length("context_bundle_json").alias("n"), F.array_join("log_errors", ",").alias("errors"), cells.alias("row_sha256"))


@query(JSON + """,
x AS (SELECT *, CASE WHEN status = 'domain_only' AND o_orderpriority = '1-URGENT' THEN 'odd' ELSE status END AS told, p_ids <> '[]' AND regexp_matches(p_ids, '"P[0-9]*7"') AS lost, c_ids <> '[]' AND regexp_matches(c_ids, '"P[0-9]*5"') AS far FROM b)
SELECT o_orderkey::VARCHAR AS request_id, CASE WHEN status = 'brand_partial_fallback' THEN 2 WHEN told = 'odd' THEN 3 WHEN tenant_id = 't1' AND o_orderpriority = '2-HIGH' THEN 4 WHEN layer = 'Brand A' THEN 5
  WHEN lost THEN 6 WHEN far THEN 7 WHEN o_orderpriority = '3-MEDIUM' THEN 8 WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 9 ELSE 0 END AS code FROM x""")
def bundle_replay(spark, t):
    """The replay of every logged bundle, after the log and the views were changed in some rows."""
    log = _log(t).where("fallback_status <> 'brand_partial_fallback'").drop("log_errors")
    kind = F.col("content_type")
    odd = (F.col("fallback_status") == "domain_only") & (kind == "1-URGENT")
    log = log.withColumns({
        "compile_run_id": F.when((F.col("tenant_id") == "t1") & (kind == "2-HIGH"), "run0").otherwise(F.col("compile_run_id")),
        "context_bundle_json": F.when(kind == "3-MEDIUM", F.regexp_replace("context_bundle_json", '"tenant_id":"t', '"tenant_id":"u')).otherwise(F.col("context_bundle_json")),
        "tenant_id": F.when(kind == "4-NOT SPECIFIED", "t0").otherwise(F.col("tenant_id")),
        "content_type": F.when(kind == "4-NOT SPECIFIED", "other").otherwise(kind),
        "fallback_status": F.when(odd, "odd").otherwise(F.col("fallback_status")),
    })
    parts = t("part").select(F.concat(F.lit("P"), "p_partkey").alias("id"))
    view = lambda name, layer: parts.select(F.lit(name).alias("view"), "id", layer.alias("brand_layer"), *(F.lit(v).alias(k) for k, v in GOVERNANCE.items()))
    views = view("pack", F.lit("brand_a")).where("id NOT LIKE '%7'").unionByName(view("card", F.when(F.col("id").endswith("5"), "brand_z").otherwise("domain_general"))).unionByName(view("asset", F.lit("brand_a")))
    tenants = spark.createDataFrame([(f"t{i}", "brand_a", ["domain_general", "brand_a"]) for i in range(3)], "tenant_id string, brand_layer string, allowed_layers array<string>")
    ids = {"retrieved_pack_ids": "pack", "retrieved_play_card_ids": "card", "retrieved_asset_ids": "asset"}
    return bundles.replay(t("orders").select(F.col("o_orderkey").cast("string").alias("request_id")), log, views, tenants, ids).select("request_id", "code")


def _orders_as_json(t):
    """An order with its customer and lines as one JSON document."""
    lines = t("lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct(F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("part"), F.struct(F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status")).alias("marks")))).alias("lines"))
    rows = t("orders").join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left").join(t("customer"), F.col("c_custkey") == F.col("o_custkey"), "left")
    doc = F.struct(F.struct(F.col("c_name").alias("name"), F.array(F.struct(F.col("c_mktsegment").alias("segment"))).alias("segments")).alias("customer"), "lines", F.array().cast("array<string>").alias("notes"))
    return rows.select("o_orderkey", F.to_json(doc).alias("doc"))


@query("""
WITH l AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_returnflag, l_linestatus) - 1 AS i, * EXCLUDE (l_orderkey) FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)),
x AS (SELECT o_orderkey, '/customer/name' AS path, 'string' AS kind, c_name AS value FROM orders JOIN customer ON c_custkey = o_custkey UNION ALL SELECT o_orderkey, '/customer/segments/0/segment', 'string', c_mktsegment FROM orders JOIN customer ON c_custkey = o_custkey
  UNION ALL SELECT o_orderkey, '/notes', 'array', NULL FROM orders UNION ALL SELECT o_orderkey, '/customer/segments/0', 'object', NULL FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
  UNION ALL SELECT l_orderkey, '/lines/' || i || '/n', 'number', l_linenumber::VARCHAR FROM l UNION ALL SELECT l_orderkey, '/lines/' || i || '/part', 'number', l_partkey::VARCHAR FROM l
  UNION ALL SELECT l_orderkey, '/lines/' || i || '/marks/flag', 'string', l_returnflag FROM l UNION ALL SELECT l_orderkey, '/lines/' || i || '/marks/status', 'string', l_linestatus FROM l)
SELECT * FROM x""")
def document_leaves(spark, t):
    """Every value of every order's document, at any depth, with its path and kind."""
    return documents.leaves(_orders_as_json(t), "o_orderkey", "doc")


NINE = {"pack": "l_returnflag = 'A'", "card": "l_returnflag = 'N'", "asset": "l_returnflag = 'R'", "rule": "l_linestatus = 'F'", "evidence": "l_linestatus = 'O'", "relation": "l_linenumber > 1", "mapping": "l_discount > 0.05", "boundary": "l_tax > 0.04", "trace": "l_quantity > 25"}


@query(" UNION ALL ".join(f"SELECT '{name}' AS relation, l_orderkey AS document, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) - 1 AS place, 'P' || l_partkey AS id, l_linenumber AS line FROM lineitem WHERE {rule}" for name, rule in NINE.items()))
def nine_relations(spark, t):
    """One nested document a pack, parted into its nine relations by one reading."""
    fits = [F.coalesce(F.expr(rule), F.lit(False)).alias(name) for name, rule in NINE.items()]
    row = F.struct(F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("k"), F.concat(F.lit("P"), "l_partkey").alias("id"), *fits)
    packs = t("lineitem").groupBy(F.col("l_orderkey").alias("document")).agg(F.sort_array(F.collect_list(row)).alias("rows"))
    of = lambda name: F.transform(F.filter("rows", lambda x: x[name]), lambda x: F.struct(x["line"].alias("line"), x["k"].alias("k"), x["id"].alias("id"))).alias(name)
    docs = packs.select("document", F.to_json(F.struct(F.struct(*(of(name) for name in NINE)).alias("projection"))).alias("doc"))
    found = documents.parted(docs, "document", "doc", {f"$.projection.{name}": "id string, line int" for name in NINE})
    return found.select(F.substring_index("relation", ".", -1).alias("relation"), "document", F.col("place").cast("long").alias("place"), "id", "line")
