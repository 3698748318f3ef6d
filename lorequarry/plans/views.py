"""The seven views with all thirteen governance columns, their lineage gate, and mirrors by digest trees."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cases
from ..operators import gates, mirror
from ..operators.lineage import checkpoint_folder, cut, remove
from .catalog import query

IDS = {"compile_run_id": "run1", "source_manifest_hash": "m1", "view_schema_version": "v1"}
#: Each view's table, key, source, layer, granularity, gate, review and text, as expressions of both engines.
VIEWS = {
    "pack_view": ("orders", "o_orderkey", "'KP-' || o_custkey", "CASE WHEN o_orderstatus = 'F' THEN 'brand_a' ELSE 'domain_general' END", "CASE WHEN o_orderpriority = '5-LOW' THEN 'L2' ELSE 'L1' END", "CASE WHEN o_orderstatus = 'P' THEN 'draft' ELSE 'active' END", "CASE WHEN o_totalprice > 200000 THEN 'approved' ELSE 'needs_review' END", "'assertion: ' || o_orderpriority"),
    "play_card_view": ("part", "p_partkey", "'KP-' || p_partkey", "'domain_general'", "'L3'", "'active'", "'approved'", "'hook: ' || p_name || chr(10) || p_type"),
    "evidence_view": ("documents", "doc_id", "'KP-' || doc_id", "'domain_general'", "'L2'", "'active'", "'approved'", "coalesce(source, '') || chr(10) || coalesce(text, '')"),
    "runtime_asset_view": ("supplier", "s_suppkey", "CASE WHEN s_acctbal < 0 THEN '' ELSE 'KP-' || s_suppkey END", "'domain_general'", "'L1'", "'active'", "'approved'", "s_name"),
    "brand_overlay_view": ("customer", "c_custkey", "'KP-' || c_custkey", "'brand_' || lower(c_mktsegment)", "'L2'", "'active'", "'pending_review'", "c_mktsegment || chr(10) || c_name"),
    "generation_recipe_view": ("region", "r_regionkey", "CASE WHEN r_regionkey = 2 THEN 'R-' ELSE 'RECIPE-' END || r_regionkey", "'domain_general'", "'L1'", "'active'", "'approved'", "r_name"),
    "content_type_view": ("nation", "n_nationkey", "'CT-' || n_name", "'domain_general'", "'L1'", "'active'", "'approved'", "n_name"),
}


def _evidence(t) -> DataFrame:
    """(pk, evidence_ids): an order's suppliers, each once, sorted."""
    ids = F.array_sort(F.collect_set(F.concat(F.lit("E-"), "l_suppkey")))
    return t("lineitem").groupBy(F.col("l_orderkey").cast("string").alias("pk")).agg(ids.alias("evidence_ids"))


def _view(t, name: str) -> DataFrame:
    table, key, source, layer, granularity, gate, review, chunk = VIEWS[name]
    none = F.array().cast("array<string>")
    rows = t(table).select(F.lit(name).alias("view"), F.col(key).cast("string").alias("pk"), *(F.expr(e).alias(c) for c, e in (("source_pack_id", source), ("brand_layer", layer), ("granularity_layer", granularity), ("gate_status", gate), ("review_status", review))), F.sha2(F.expr(chunk.replace("chr(10)", r"'\n'")), 256).alias("chunk_text_hash"))
    rows = rows.join(_evidence(t), "pk", "left") if name == "pack_view" else rows.withColumn("evidence_ids", none)
    ids: Column = F.coalesce("evidence_ids", none)
    level = F.when(F.col("gate_status") == "active", "direct_quote").otherwise("inferred")
    return rows.withColumns({
        "evidence_ids": ids,
        "source_table_refs": F.when(F.size(ids) > 0, F.array(F.lit("07_evidence.csv"))).otherwise(none),
        "traceability_status": cases.traceability_of_pack(level, F.size(ids) > 0),
        "default_call_pool": F.col("gate_status") == "active",
        **{c: F.lit(v) for c, v in IDS.items()},
    })


COLUMNS = ["source_pack_id", "brand_layer", "granularity_layer", "gate_status", "source_table_refs", "evidence_ids", "traceability_status", "default_call_pool", "review_status", "compile_run_id", "source_manifest_hash", "view_schema_version", "chunk_text_hash"]
_EV = "(SELECT l_orderkey AS k, array_to_string(list_sort(list(DISTINCT 'E-' || l_suppkey)), ',') AS ids FROM lineitem GROUP BY 1)"


def _view_sql(name: str) -> str:
    table, key, source, layer, granularity, gate, review, chunk = VIEWS[name]
    ids, join = ("coalesce(ids, '')", f" LEFT JOIN {_EV} ON k = o_orderkey") if name == "pack_view" else ("''", "")
    return f"SELECT '{name}' AS view, {key}::VARCHAR AS pk, {source} AS source_pack_id, {layer} AS brand_layer, {granularity} AS granularity_layer, {gate} AS gate_status, {review} AS review_status, sha256({chunk}) AS chunk_text_hash, {ids} AS evidence_ids FROM {table}{join}"


ALL = "WITH v AS (" + " UNION ALL ".join(_view_sql(name) for name in VIEWS) + ")"


@query(ALL + """
SELECT view, pk, source_pack_id, brand_layer, granularity_layer, gate_status, review_status, chunk_text_hash, evidence_ids, CASE WHEN evidence_ids = '' THEN '' ELSE '07_evidence.csv' END AS source_table_refs,
  CASE WHEN evidence_ids = '' THEN 'missing' WHEN gate_status = 'active' THEN 'full' ELSE 'weak' END AS traceability_status, gate_status = 'active' AS default_call_pool, 'run1' AS compile_run_id, 'm1' AS source_manifest_hash, 'v1' AS view_schema_version FROM v""")
def governed_views(spark, t):
    """All rows of the seven views with the thirteen governance columns."""
    rows = reduce(DataFrame.unionByName, [_view(t, name).select("view", "pk", *COLUMNS) for name in VIEWS])
    return rows.withColumns({c: F.array_join(c, ",") for c in ("source_table_refs", "evidence_ids")})


@query(ALL + """,
p AS (SELECT 'KP-' || c_custkey AS pack FROM customer), x AS (SELECT *, CASE WHEN view = 'content_type_view' THEN '["KP-1", "KP-none", ""]' END AS plural FROM v),
e AS (SELECT view, pk, unnest([CASE WHEN view = 'pack_view' AND gate_status = 'draft' THEN 'view_schema_version_mismatch' END, CASE WHEN source_pack_id = '' THEN 'empty_source' END,
  CASE WHEN source_pack_id <> '' AND view NOT IN ('content_type_view', 'generation_recipe_view') AND source_pack_id NOT IN (SELECT pack FROM p) THEN 'orphan_source' END,
  CASE WHEN view = 'generation_recipe_view' AND NOT starts_with(source_pack_id, 'RECIPE-') THEN 'wrong_prefix' END,
  CASE WHEN view = 'content_type_view' THEN 'orphan_plural' END, CASE WHEN view = 'content_type_view' THEN 'empty_plural' END]) AS error FROM x)
SELECT view, pk, error FROM e WHERE error IS NOT NULL""")
def source_lineage(spark, t):
    """S1 in full over the seven views: three run ids, sources, prefixes and plural references."""
    rows = reduce(DataFrame.unionByName, [_view(t, name) for name in VIEWS])
    rows = rows.withColumn("view_schema_version", F.when((F.col("view") == "pack_view") & (F.col("gate_status") == "draft"), "v0").otherwise(F.col("view_schema_version")))
    rows = rows.withColumn("source_pack_ids", F.when(F.col("view") == "content_type_view", '["KP-1", "KP-none", ""]'))
    packs = t("customer").select(F.concat(F.lit("KP-"), "c_custkey").alias("pack_id"))
    return gates.lineage_gate(rows, packs, IDS, {"content_type_view": "CT-", "generation_recipe_view": "RECIPE-"}, list(VIEWS))


@query("""
SELECT o_orderkey, CASE WHEN o_totalprice > 499000 THEN 'only_left' ELSE 'mismatch' END AS status FROM orders WHERE o_totalprice > 499000 OR o_totalprice < 2000
UNION ALL SELECT -1 - s_suppkey, 'only_right' FROM supplier WHERE s_suppkey < 3""")
def mirror_tree(spark, t):
    """Orders against a mirror that lacks some, has others changed and a few of its own: stored with
    their digest trees, compared from the root, read only where digests differ."""
    folder = f"{checkpoint_folder(spark)}/mirror-{uuid.uuid4().hex}"
    shape, values = mirror.Shape(16, 2), ["o_custkey", "o_totalprice"]
    left = t("orders").select("o_orderkey", *values)
    right = left.where("o_totalprice <= 499000").withColumn("o_custkey", F.when(F.col("o_totalprice") < 2000, -1).otherwise(F.col("o_custkey")))
    own = t("supplier").where("s_suppkey < 3").select((-1 - F.col("s_suppkey")).alias("o_orderkey"), F.col("s_suppkey").alias("o_custkey"), F.col("s_acctbal").alias("o_totalprice"))
    try:
        for name, df in (("left", left), ("right", right)):
            mirror.save(df, f"{folder}/{name}", ["o_orderkey"], values, shape)
        mirror.append(own, f"{folder}/right", ["o_orderkey"], values, shape)
        return cut(mirror.difference(spark, f"{folder}/left", f"{folder}/right", ["o_orderkey"], values, shape))
    finally:
        remove(spark, folder)
