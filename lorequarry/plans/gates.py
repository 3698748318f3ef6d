"""The governance gates, checks before loading and replay, each query beside its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import gates, quality, relate
from .catalog import query

#: The views' governance columns from orders (packs) and customers (overlays), in both engines.
ROWS = """
SELECT 'pack_view' AS view, o_orderkey AS pk, CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE 'KP-' || o_custkey END AS source_pack_id, CASE WHEN o_orderkey % 8 = 0 THEN 'Brand X' WHEN o_orderkey % 2 = 0 THEN 'domain_general' ELSE 'brand_a1' END AS brand_layer,
  CASE WHEN o_orderpriority = '1-URGENT' THEN NULL WHEN o_orderpriority = '2-HIGH' THEN 'L4' ELSE 'L1' END AS granularity_layer, CASE o_orderstatus WHEN 'F' THEN 'active' WHEN 'O' THEN 'draft' ELSE ' ' END AS gate_status,
  CASE WHEN o_totalprice > 200000 THEN 'approved' END AS review_status, CASE WHEN o_orderkey % 50 = 0 THEN 'other' WHEN o_orderkey % 51 = 0 THEN NULL ELSE 'run1' END AS compile_run_id FROM orders
UNION ALL SELECT 'brand_overlay_view', c_custkey, 'KP-' || c_custkey, CASE WHEN c_nationkey = 0 THEN 'domain_general' ELSE 'brand_b' END, 'L2', 'active', NULL, 'run1' FROM customer
UNION ALL SELECT 'content_type_view', n_nationkey, CASE WHEN n_regionkey = 0 THEN 'XX-' ELSE 'CT-' END || n_name, 'needs_review', 'L3', 'active', NULL, 'run1' FROM nation"""
BROKEN = f"""
WITH r AS ({ROWS}), p AS (SELECT DISTINCT 'KP-' || c_custkey AS pack FROM customer WHERE c_acctbal > 0),
e AS (SELECT view, pk, unnest([CASE WHEN compile_run_id <> 'run1' THEN 'S1 run_mismatch' END, CASE WHEN source_pack_id = '' THEN 'S1 empty_source' END,
  CASE WHEN source_pack_id <> '' AND NOT CASE WHEN view = 'content_type_view' THEN starts_with(source_pack_id, 'CT-') ELSE pack IS NOT NULL END THEN 'S1 orphan_source' END,
  CASE WHEN trim(gate_status) = '' THEN 'S2 empty_gate' END, CASE WHEN trim(gate_status) NOT IN ('', 'active') AND coalesce(review_status, '') NOT IN ('approved', 'pending_review') THEN 'S2 not_reviewed' END,
  CASE WHEN NOT regexp_matches(brand_layer, '^(domain_general|needs_review|brand_[a-z][a-z0-9_]*)$') THEN 'S3 bad_layer' END, CASE WHEN view = 'brand_overlay_view' AND brand_layer = 'domain_general' THEN 'S3 base_overlay' END,
  CASE WHEN coalesce(granularity_layer, '') NOT IN ('L1', 'L2', 'L3') THEN 'S4 bad_granularity' END]) AS x FROM r LEFT JOIN p ON source_pack_id = pack)
"""


def _rows(t):
    order = t("orders").selectExpr(
        "'pack_view' AS view", "o_orderkey AS pk", "CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE 'KP-' || o_custkey END AS source_pack_id",
        "CASE WHEN o_orderkey % 8 = 0 THEN 'Brand X' WHEN o_orderkey % 2 = 0 THEN 'domain_general' ELSE 'brand_a1' END AS brand_layer",
        "CASE WHEN o_orderpriority = '1-URGENT' THEN NULL WHEN o_orderpriority = '2-HIGH' THEN 'L4' ELSE 'L1' END AS granularity_layer",
        "CASE o_orderstatus WHEN 'F' THEN 'active' WHEN 'O' THEN 'draft' ELSE ' ' END AS gate_status", "CASE WHEN o_totalprice > 200000 THEN 'approved' END AS review_status",
        "CASE WHEN o_orderkey % 50 = 0 THEN 'other' WHEN o_orderkey % 51 = 0 THEN NULL ELSE 'run1' END AS compile_run_id",
    )
    overlay = t("customer").selectExpr("'brand_overlay_view' AS view", "c_custkey AS pk", "'KP-' || c_custkey AS source_pack_id", "CASE WHEN c_nationkey = 0 THEN 'domain_general' ELSE 'brand_b' END AS brand_layer", "'L2' AS granularity_layer", "'active' AS gate_status", "CAST(NULL AS STRING) AS review_status", "'run1' AS compile_run_id")
    kind = t("nation").selectExpr("'content_type_view' AS view", "CAST(n_nationkey AS BIGINT) AS pk", "CASE WHEN n_regionkey = 0 THEN 'XX-' ELSE 'CT-' END || n_name AS source_pack_id", "'needs_review' AS brand_layer", "'L3' AS granularity_layer", "'active' AS gate_status", "CAST(NULL AS STRING) AS review_status", "'run1' AS compile_run_id")
    return order.unionByName(overlay).unionByName(kind)


def _broken(t):
    packs = t("customer").where("c_acctbal > 0").select(F.concat(F.lit("KP-"), "c_custkey").alias("pack_id"))
    return gates.row_gates(_rows(t), packs, "run1", {"content_type_view": "CT-"}, "brand_overlay_view")


@query(BROKEN + "SELECT view, pk, split_part(x, ' ', 1) AS gate, split_part(x, ' ', 2) AS error FROM e WHERE x IS NOT NULL")
def gate_violations(spark, t):
    """Every broken row gate (S1 lineage, S2 review, S3 tenant, S4 granularity), in one pass."""
    return _broken(t)


@query(BROKEN + """, b AS (SELECT split_part(x, ' ', 1) AS gate, count(*) AS n FROM e WHERE x IS NOT NULL GROUP BY 1), c AS (SELECT count(*) AS n_rows FROM r)
SELECT g.gate, n_rows, coalesce(n, 0) AS n_bad, CASE WHEN g.gate <> 'S9' AND n > 0 THEN 'fail' ELSE 'fail' END AS verdict FROM (VALUES ('S1'), ('S2'), ('S3'), ('S4'), ('S9')) g(gate) LEFT JOIN b ON b.gate = g.gate, c""")
def gate_verdicts(spark, t):
    """Verdicts of the row gates; a view without rows (recipes have none here) fails them all."""
    counts = _rows(t).groupBy("view").agg(F.count(F.lit(1)).alias("n"))
    broken = _broken(t).groupBy("gate").agg(F.count(F.lit(1)).alias("n"))
    return gates.verdicts(counts, broken, ["S1", "S2", "S3", "S4", "S9"], ["pack_view", "brand_overlay_view", "content_type_view", "generation_recipe_view"])


@query(BROKEN + """, b AS (SELECT split_part(x, ' ', 1) AS gate, count(*) AS n FROM e WHERE x IS NOT NULL AND view = 'brand_overlay_view' GROUP BY 1), c AS (SELECT count(*) AS n_rows FROM r WHERE view = 'brand_overlay_view')
SELECT g.gate, n_rows, coalesce(n, 0) AS n_bad, CASE WHEN n > 0 THEN 'fail' ELSE 'pass' END AS verdict FROM (VALUES ('S1'), ('S2'), ('S3'), ('S4')) g(gate) LEFT JOIN b ON b.gate = g.gate, c""")
def overlay_verdicts(spark, t):
    """The same gates on one view, where some pass."""
    own = lambda df: df.where("view = 'brand_overlay_view'")
    counts = own(_rows(t)).groupBy("view").agg(F.count(F.lit(1)).alias("n"))
    return gates.verdicts(counts, own(_broken(t)).groupBy("gate").agg(F.count(F.lit(1)).alias("n")), ["S1", "S2", "S3", "S4"], ["brand_overlay_view"])


@query("""
WITH p AS (SELECT page_id, unnest(CASE WHEN page_id % 5 = 0 THEN [NULL] ELSE ['n' || page_id % 30 || '/a', 'n' || page_id % 30 || '/b', 'other/b'] END) AS part FROM pages),
f AS (SELECT 'n' || n_nationkey || '/' || x AS part FROM nation, (VALUES ('a'), ('b')) y(x) WHERE n_regionkey <> 1)
SELECT page_id, part FROM p WHERE part IS NULL OR part NOT IN (SELECT part FROM f)""")
def source_parts_gate(spark, t):
    """S5: every part of a compound source exists; a row without parts is a violation too."""
    cell = F.when(F.col("page_id") % 5 == 0, " ").otherwise(F.concat(F.lit("n"), F.col("page_id") % 30, F.lit("/a & b & other/b")))
    names = t("nation").where("n_regionkey <> 1").select(F.explode(F.array(*(F.concat(F.lit("n"), "n_nationkey", F.lit(f"/{x}")) for x in "ab"))).alias("path"))
    return gates.part_gate(t("pages"), "page_id", text.compound_paths(cell), names, "path")


@query("""
SELECT value, missing_in FROM (SELECT DISTINCT n_name AS value, 'right' AS missing_in FROM nation WHERE n_regionkey < 3 AND n_name NOT IN (SELECT n_name FROM nation WHERE n_regionkey > 0)
UNION ALL SELECT DISTINCT n_name, 'left' FROM nation WHERE n_regionkey > 0 AND n_name NOT IN (SELECT n_name FROM nation WHERE n_regionkey < 3))""")
def coverage_set_gate(spark, t):
    """S7: two sides name the same set, in both directions."""
    side = lambda condition: t("nation").where(condition).select(F.concat(F.lit(" "), "n_name").alias("v"))
    return gates.set_gate(side("n_regionkey < 3"), side("n_regionkey > 0"), "v")


@query("""
WITH c AS (SELECT CASE WHEN vec_id % 40 = 0 THEN 'dup' ELSE 'chunk::' || vec_id END AS chunk_id, CASE WHEN vec_id % 11 = 0 THEN embedding[1:5] ELSE embedding END AS embedding, CASE WHEN vec_id % 13 = 0 THEN 'draft' ELSE 'active' END AS gate_status, CASE WHEN vec_id % 17 = 0 THEN '' ELSE 'run1' END AS compile_run_id FROM embeddings),
n AS (SELECT chunk_id, count(*) AS times FROM c GROUP BY 1), d AS (SELECT max(len(embedding)) AS dim FROM embeddings)
SELECT chunk_id, errors FROM (SELECT chunk_id, concat_ws(',', CASE WHEN len(embedding) <> dim THEN 'dimension' END, CASE WHEN times > 1 THEN 'duplicate' END, CASE WHEN compile_run_id = '' THEN 'empty_compile_run_id' END, CASE WHEN gate_status <> 'active' THEN 'gate' END) AS errors FROM c JOIN n USING (chunk_id), d) WHERE errors <> ''""")
def chunk_artifact_check(spark, t):
    """Chunks before loading: dimension, repeated ids, gate, batch anchor."""
    id_ = F.col("vec_id")
    rows = t("embeddings").select(F.when(id_ % 40 == 0, "dup").otherwise(F.concat(F.lit("chunk::"), id_)).alias("chunk_id"), F.when(id_ % 11 == 0, F.slice("embedding", 1, 5)).otherwise(F.col("embedding")).alias("embedding"), F.when(id_ % 13 == 0, "draft").otherwise("active").alias("gate_status"), F.when(id_ % 17 == 0, "").otherwise("run1").alias("compile_run_id"))
    size = t("embeddings").agg(F.max(F.size("embedding"))).first()[0]
    return gates.chunk_violations(rows, size, ["compile_run_id"]).select("chunk_id", F.array_join("errors", ",").alias("errors"))


@query("""
WITH m AS (SELECT l_orderkey || '' AS content_type, CASE WHEN l_linenumber = 7 THEN '' ELSE l_linenumber || '' END AS field_key, CASE l_returnflag WHEN 'A' THEN 'hard' WHEN 'N' THEN 'soft' ELSE 'odd' END AS lv, CASE WHEN l_linestatus = 'F' THEN 'block_brand_output' ELSE 'ask' END AS act, CASE WHEN l_quantity > 25 THEN 'why' ELSE ' ' END AS why FROM lineitem)
SELECT content_type, field_key, errors FROM (SELECT *, concat_ws(',', CASE WHEN field_key = '' THEN 'empty_key' END, CASE WHEN lv = 'hard' AND act <> 'block_brand_output' THEN 'hard_must_block' END, CASE WHEN lv = 'hard' AND trim(why) = '' THEN 'hard_without_reason' END, CASE WHEN lv = 'odd' THEN 'level' END, CASE WHEN lv = 'soft' AND act = 'block_brand_output' THEN 'soft_must_not_block' END) AS errors FROM m) WHERE errors <> ''""")
def conditional_rules(spark, t):
    """Requirement rules that contradict themselves: what a level demands of action and reason."""
    rows = t("lineitem").select(F.col("l_orderkey").cast("string").alias("content_type"), F.when(F.col("l_linenumber") == 7, "").otherwise(F.col("l_linenumber").cast("string")).alias("field_key"), F.when(F.col("l_returnflag") == "A", "hard").when(F.col("l_returnflag") == "N", "soft").otherwise("odd").alias("required_level"), F.when(F.col("l_linestatus") == "F", "block_brand_output").otherwise("ask").alias("fallback_action"), F.when(F.col("l_quantity") > 25, "why").otherwise(" ").alias("block_reason"))
    return gates.requirement_violations(rows).select("content_type", "field_key", F.array_join("errors", ",").alias("errors"))


@query("SELECT lower(trim(p_name)) AS alias, count(DISTINCT p_brand) AS n_ids FROM part WHERE trim(p_name) <> '' GROUP BY 1 HAVING count(DISTINCT p_brand) > 1")
def alias_map_check(spark, t):
    return gates.alias_violations(t("part").select(F.concat(F.lit(" "), F.upper("p_name")).alias("alias"), F.col("p_brand").alias("id")))


@query("""
WITH m AS (SELECT 'orders' AS rel, o_orderstatus AS grp, count(*) + CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS n FROM orders GROUP BY 2), d AS (SELECT 'orders' AS rel, o_orderstatus AS grp, count(*) AS n FROM orders WHERE o_orderstatus <> 'O' GROUP BY 2)
SELECT grp, CASE WHEN d.n IS NULL THEN 'only_left' WHEN m.n <> d.n THEN 'mismatch' ELSE 'same' END AS status FROM m LEFT JOIN d USING (grp)""")
def manifest_counts(spark, t):
    """A manifest's counts against what is there."""
    count = lambda df: df.groupBy(F.col("o_orderstatus").alias("grp")).agg(F.count(F.lit(1)).alias("n"))
    told = count(t("orders")).withColumn("n", F.col("n") + F.when(F.col("grp") == "P", 1).otherwise(0))
    return relate.difference(told, count(t("orders").where("o_orderstatus <> 'O'")), ["grp"], ["n"])


LOG = """
SELECT o_orderkey AS request_id, CASE WHEN o_orderkey % 10 = 0 THEN 'odd' ELSE 'brand_full_applied' END AS status, CASE WHEN o_orderkey % 11 = 0 THEN 'run0' ELSE 'run1' END AS compile_run_id, CASE WHEN o_orderkey % 12 = 0 THEN 'brand_z' ELSE 'brand_a' END AS layer,
  o_custkey AS id, o_orderpriority AS bundle, 'sha256:' || sha256(CASE WHEN o_orderkey % 13 = 0 THEN 'x' ELSE o_orderpriority END) AS bundle_hash, CASE WHEN o_orderkey % 14 = 0 THEN 0 ELSE o_orderkey END AS bundle_request_id FROM orders WHERE o_orderstatus <> 'P'"""
CODED = f"""
WITH log AS ({LOG}), v AS (SELECT c_custkey, CASE WHEN c_nationkey = 2 THEN 'brand_other' ELSE 'brand_a' END AS view_layer, CASE WHEN c_nationkey = 3 THEN 'run0' ELSE 'run1' END AS view_run FROM customer WHERE c_acctbal > 0),
c AS (SELECT o_orderkey AS request_id, CASE WHEN log.request_id IS NULL THEN 2 WHEN status = 'odd' THEN 3 WHEN log.compile_run_id <> 'run1' THEN 4 WHEN layer = 'brand_z' THEN 5 WHEN c_custkey IS NULL OR view_run <> 'run1' THEN 6 WHEN view_layer = 'brand_other' THEN 7
  WHEN bundle_hash <> 'sha256:' || sha256(bundle) THEN 8 WHEN bundle_request_id <> log.request_id THEN 9 ELSE 0 END AS code FROM orders LEFT JOIN log ON log.request_id = o_orderkey LEFT JOIN v ON c_custkey = id)
"""


def _codes(spark, t):
    key = F.col("o_orderkey")
    log = t("orders").where("o_orderstatus <> 'P'").select(
        key.alias("request_id"), F.when(key % 10 == 0, "odd").otherwise("brand_full_applied").alias("status"), F.when(key % 11 == 0, "run0").otherwise("run1").alias("compile_run_id"),
        F.when(key % 12 == 0, "brand_z").otherwise("brand_a").alias("layer"), F.array(F.lit("brand_a"), F.lit("domain_general")).alias("allowed_layers"), F.array("o_custkey").alias("ids"), F.col("o_orderpriority").alias("bundle"),
        F.concat(F.lit("sha256:"), F.sha2(F.when(key % 13 == 0, "x").otherwise(F.col("o_orderpriority")), 256)).alias("bundle_hash"), F.when(key % 14 == 0, 0).otherwise(key).alias("bundle_request_id"),
    )
    views = t("customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("id"), F.when(F.col("c_nationkey") == 2, "brand_other").otherwise("brand_a").alias("layer"), F.when(F.col("c_nationkey") == 3, "run0").otherwise("run1").alias("compile_run_id"))
    return gates.replay_codes(t("orders").select(key.alias("request_id")), log, views, ["brand_full_applied", "domain_only"], "run1")


@query(CODED + "SELECT request_id, code FROM c")
def replay_codes(spark, t):
    """The first failing check of each request's replay, for all requests by two joins."""
    return _codes(spark, t)


@query(CODED + "SELECT count(*) AS n, count(*) FILTER (WHERE code = 0) AS n_ok, round(count(*) FILTER (WHERE code = 0) / count(*), 4) AS rate, false AS all_pass FROM c")
def replay_rate(spark, t):
    return gates.replay_rate(_codes(spark, t))


@query("""
SELECT o_orderkey, concat_ws(',', CASE WHEN o_orderstatus = 'F' AND o_totalprice < 20000 THEN 'decision_without_reviewer' END, CASE WHEN c_custkey IS NULL THEN 'unknown_row' END, CASE WHEN o_orderstatus = 'P' THEN 'illegal_decision' END) AS errors
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > -900) ON c_custkey = o_custkey WHERE (o_orderstatus = 'F' AND o_totalprice < 20000) OR c_custkey IS NULL OR o_orderstatus = 'P'""")
def adjudication_contract(spark, t):
    """Decisions must be legal, name a reviewer and a row that exists."""
    known = t("customer").where("c_acctbal > -900").select("c_custkey")
    rows = t("orders").join(known, F.col("c_custkey") == F.col("o_custkey"), "left")
    rules = {"decision_without_reviewer": ~((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") < 20000)), "illegal_decision": F.col("o_orderstatus") != "P", "unknown_row": F.col("c_custkey").isNotNull()}
    order = ["decision_without_reviewer", "unknown_row", "illegal_decision"]
    found = quality.violations(rows, ["o_orderkey"], rules)
    return found.select("o_orderkey", F.array_join(F.array_intersect(F.array(*(F.lit(x) for x in order)), "errors"), ",").alias("errors"))


@query("""
WITH pol AS (SELECT n_name AS name, n_nationkey % 3 AS kind FROM nation WHERE n_regionkey <> 1), ref AS (SELECT DISTINCT n_name AS name FROM nation JOIN customer ON c_nationkey = n_nationkey WHERE c_acctbal > 9000)
SELECT name, missing_in FROM (SELECT name, 'right' AS missing_in FROM pol WHERE name NOT IN (SELECT name FROM ref) UNION ALL SELECT name, 'left' FROM ref WHERE name NOT IN (SELECT name FROM pol)) UNION ALL SELECT name, 'bad_kind' FROM pol WHERE kind = 2""")
def policy_closure(spark, t):
    """Policies and what refers to them name each other, and each policy's kind is legal."""
    rules = t("nation").where("n_regionkey <> 1").select(F.col("n_name").alias("name"), (F.col("n_nationkey") % 3).alias("kind"))
    used = t("nation").join(t("customer").where("c_acctbal > 9000"), F.col("c_nationkey") == F.col("n_nationkey"), "left_semi").select(F.col("n_name").alias("name"))
    sets = gates.set_gate(rules, used, "name").select(F.col("value").alias("name"), "missing_in")
    return sets.unionByName(quality.violations(rules, ["name"], {"bad_kind": F.col("kind") != 2}).select("name", F.get("errors", F.lit(0)).alias("missing_in")))


@query("SELECT p_partkey FROM part WHERE p_size % 4 = 0 OR p_size % 4 = 1")
def completeness_gate(spark, t):
    """S6: rows whose completeness is empty or blank."""
    status = F.when(F.col("p_size") % 4 == 0, " ").when(F.col("p_size") % 4 == 1, None).otherwise("partial")
    return quality.violations(t("part"), ["p_partkey"], {"completeness": F.trim(status) != ""}).select("p_partkey")
