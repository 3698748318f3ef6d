"""Queries on policies, gates, references, texts and replay, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import policy, quality, relate, rollup
from .catalog import query


@query("""
WITH v AS (SELECT c_nationkey AS key, false AS is_base, c_custkey AS ord, c_mktsegment AS value FROM customer
  UNION ALL SELECT s_nationkey, true, s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'BUILDING' ELSE 'S' || s_suppkey % 3 END FROM supplier),
s AS (SELECT key, bool_or(NOT is_base) AS brand, bool_or(is_base) AS base FROM v GROUP BY 1),
p AS (SELECT n_nationkey AS key, CASE n_nationkey % 5 WHEN 0 THEN 'override' WHEN 1 THEN 'append' WHEN 2 THEN 'block' WHEN 3 THEN 'needs_review' ELSE 'other' END AS action, n_nationkey % 2 = 0 AS allowed FROM nation),
d AS (SELECT key, brand, action, CASE WHEN action = 'override' AND brand AND base THEN CASE WHEN allowed THEN 'brand_overrides_domain' ELSE 'brand_wins_domain_rejected' END
  WHEN action = 'block' AND brand AND base THEN 'blocked' WHEN action = 'needs_review' THEN 'needs_review' WHEN action = 'other' THEN 'unknown_action_skipped' END AS decision FROM s JOIN p USING (key)),
m AS (SELECT key, is_base, ord, value FROM (SELECT *, row_number() OVER (PARTITION BY key, value ORDER BY is_base, ord) AS r FROM v JOIN d USING (key) WHERE action = 'append') WHERE r = 1
  UNION ALL SELECT key, is_base, ord, value FROM v JOIN d USING (key) WHERE action IN ('override', 'block', 'needs_review') AND is_base <> brand)
SELECT d.key, action, decision, is_base, ord, value FROM d LEFT JOIN m ON d.key = m.key""")
def policy_merge(spark, t):
    brand = t("customer").selectExpr("c_nationkey AS key", "'brand_x' AS layer", "c_custkey AS ord", "c_mktsegment AS value")
    base = t("supplier").selectExpr("s_nationkey AS key", "'domain_general' AS layer", "s_suppkey AS ord", "CASE WHEN s_suppkey % 2 = 0 THEN 'BUILDING' ELSE 'S' || s_suppkey % 3 END AS value")
    rules = t("nation").selectExpr("n_nationkey AS key", "CASE n_nationkey % 5 WHEN 0 THEN 'override' WHEN 1 THEN 'append' WHEN 2 THEN 'block' WHEN 3 THEN 'needs_review' ELSE 'other' END AS action", "n_nationkey % 2 = 0 AS allow_override")
    merged, decisions = policy.merge(brand.unionByName(base), rules)
    return decisions.join(merged, "key", "left").select("key", "action", "decision", "is_base", "ord", "value")


@query("""
SELECT c_custkey, CASE WHEN c_nationkey = 9 THEN NULL WHEN c_acctbal < 0 THEN 'blocked_missing_business_brief' WHEN c_nationkey = 3 THEN 'blocked_missing_required_brand_fields'
  WHEN c_mktsegment <> 'BUILDING' THEN 'domain_only' WHEN c_acctbal < 5000 THEN 'brand_partial_fallback' ELSE 'brand_full_applied' END AS status FROM customer""")
def fallback_state(spark, t):
    either = lambda bad, word, good: F.when(bad, word).otherwise(good)
    state = policy.fallback_state(either(F.col("c_acctbal") < 0, "missing", "complete"), F.when(F.col("c_nationkey") == 9, "odd").otherwise(either(F.col("c_nationkey") == 3, "missing", "not_applicable")), either(F.col("c_acctbal") < 5000, "partial_missing", "complete"), F.col("c_mktsegment") == "BUILDING")
    return t("customer").select("c_custkey", state.alias("status"))


MATRIX = [("1-URGENT", "R", "hard"), ("1-URGENT", "A", "soft"), ("2-HIGH", "N", "hard"), ("2-HIGH", "R", "none"), ("3-MEDIUM", "A", "soft"), ("4-NOT SPECIFIED", "A", "hard"), ("4-NOT SPECIFIED", "N", "hard")]


@query(f"""
WITH m(ct, f, lv) AS (VALUES {", ".join(str(r) for r in MATRIX)}),
h AS (SELECT DISTINCT l_orderkey, l_returnflag FROM lineitem),
g AS (SELECT o_orderkey, o_orderpriority, lv, CASE WHEN h.l_orderkey IS NULL THEN f END AS gap FROM orders LEFT JOIN m ON ct = o_orderpriority LEFT JOIN h ON l_orderkey = o_orderkey AND l_returnflag = f),
a AS (SELECT o_orderkey, o_orderpriority, count(lv) AS n, coalesce(string_agg(gap, ',' ORDER BY gap) FILTER (WHERE lv = 'hard'), '') AS missing_hard,
  coalesce(string_agg(gap, ',' ORDER BY gap) FILTER (WHERE lv = 'soft'), '') AS missing_soft FROM g GROUP BY 1, 2)
SELECT o_orderkey AS request_id, missing_hard, missing_soft, CASE WHEN n = 0 OR missing_hard <> '' THEN 'blocked_missing_required_brand_fields'
  WHEN missing_soft <> '' THEN 'brand_partial_fallback' ELSE 'brand_full_applied' END AS status FROM a""")
def requirement_check(spark, t):
    requests = t("orders").selectExpr("o_orderkey AS request_id", "o_orderpriority AS content_type")
    have = t("lineitem").selectExpr("l_orderkey AS request_id", "l_returnflag AS field_key")
    matrix = spark.createDataFrame(MATRIX, "content_type string, field_key string, required_level string")
    out = policy.missing_fields(requests, have, matrix)
    return out.select("request_id", F.array_join("missing_hard", ",").alias("missing_hard"), F.array_join("missing_soft", ",").alias("missing_soft"), "status")


@query("""
SELECT p_partkey, CASE WHEN p_size > 3 AND p_retailprice > 950 AND (p_size % 3 = 0 OR (p_brand <> 'Brand#12' AND p_size % 3 = 1)) THEN 'active' ELSE 'draft' END AS gate_status FROM part""")
def gate_status(spark, t):
    layer = F.when(F.col("p_brand") == "Brand#12", policy.BASE_LAYER).otherwise("brand_x")
    gates = [F.when(F.col("p_size") > 3, "pass").otherwise("fail"), F.when(F.col("p_retailprice") > 950, " pass ")]
    general = F.when(F.col("p_size") % 3 == 0, "pass").when(F.col("p_size") % 3 == 1, "partial")
    return t("part").select("p_partkey", policy.gate_status(layer, gates, general).alias("gate_status"))


@query("""
SELECT c_custkey, CASE WHEN s_suppkey IS NULL THEN c_mktsegment ELSE 'LAYER' || s_suppkey END AS c_mktsegment,
  CASE WHEN s_suppkey IS NULL THEN c_name ELSE c_name || ' | ' || s_name END AS c_name FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey""")
def keyed_update(spark, t):
    decided = t("supplier").selectExpr("s_suppkey AS c_custkey", "'LAYER' || s_suppkey AS new_value", "s_name AS reason")
    return policy.keyed_update(t("customer").select("c_custkey", "c_mktsegment", "c_name"), decided, "c_custkey", "c_mktsegment", "c_name")


@query("""
SELECT 'order_status' AS gate, count(*) AS n_rows, count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O', 'P')) AS n_bad, CASE WHEN n_rows > 0 AND n_bad = 0 THEN 'pass' ELSE 'fail' END AS verdict FROM orders
UNION ALL SELECT 'balance', count(*) AS n, count(*) FILTER (WHERE c_acctbal < 0) AS b, CASE WHEN n > 0 AND b = 0 THEN 'pass' ELSE 'fail' END FROM customer
UNION ALL SELECT 'no_rows', 0, 0, 'fail'""")
def governance_report(spark, t):
    return quality.gate_report([("order_status", t("orders"), F.col("o_orderstatus").isin("F", "O", "P")), ("balance", t("customer"), F.col("c_acctbal") >= 0), ("no_rows", t("part").where("false"), F.col("p_size") > 0)])


@query("""
SELECT p_partkey, try_cast(substr(p_brand, 7) AS INTEGER) AS brand_no, CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_type END AS size_bad FROM part""")
def cell_coercion(spark, t):
    cells = t("part").selectExpr("p_partkey", "substr(p_brand, 7) AS brand_no", "CASE WHEN p_size % 4 = 0 THEN '' ELSE p_type END AS size")
    return quality.coerce(cells, {"brand_no": "int", "size": "int"}).select("p_partkey", "brand_no", "size_bad")


@query("""
WITH v AS (SELECT l_orderkey, count(*) AS n, sum(('0x' || substr(sha256(l_partkey::VARCHAR), 1, 15))::BIGINT::HUGEINT)::VARCHAR AS d FROM lineitem GROUP BY 1),
g AS (SELECT l_orderkey, count(*) AS n, sum(('0x' || substr(sha256((l_partkey + CASE WHEN l_quantity > 49 THEN 1 ELSE 0 END)::VARCHAR), 1, 15))::BIGINT::HUGEINT)::VARCHAR AS d FROM lineitem WHERE l_discount < 0.1 OR l_linenumber = 1 GROUP BY 1)
SELECT o_orderkey, CASE WHEN v.n IS NULL THEN 'no_rows' WHEN g.n IS NULL OR g.n <> v.n THEN 'count_drift' WHEN g.d <> v.d THEN 'hash_drift' ELSE 'replayed' END AS status
FROM orders LEFT JOIN v ON v.l_orderkey = o_orderkey LEFT JOIN g ON g.l_orderkey = o_orderkey""")
def replay_check(spark, t):
    """The log's counts and digests were taken before some rows changed or came."""
    lines = t("lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    logged = lines.where("l_discount < 0.1 OR l_linenumber = 1").withColumn("old", F.col("l_partkey") + F.when(F.col("l_quantity") > 49, 1).otherwise(0))
    log = t("orders").select("o_orderkey").join(logged.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("n"), quality.digest_of("old").alias("d")), "o_orderkey", "left")
    return quality.replay(log.withColumn("n", F.coalesce("n", F.lit(0))), lines.select("o_orderkey", F.col("l_partkey").alias("value")), "o_orderkey", "n", "d", "value")


@query("""
SELECT DISTINCT o_orderkey, ref FROM (SELECT o_orderkey, unnest([o_custkey, o_custkey + 40]) AS ref FROM orders) WHERE ref NOT IN (SELECT c_custkey FROM customer)""")
def array_references(spark, t):
    return relate.orphan_refs(t("orders").select("o_orderkey", F.array("o_custkey", F.col("o_custkey") + 40).alias("refs")), "o_orderkey", "refs", t("customer"), "c_custkey")


@query("SELECT lower(trim(p_type)) AS alias, min(p_partkey) AS first_id, max(p_partkey) AS last_id FROM part GROUP BY 1")
def alias_routes(spark, t):
    part = t("part").select("p_type", "p_partkey")
    first = relate.alias_index(part, "p_type", "p_partkey", "p_partkey").withColumnRenamed("id", "first_id")
    last = relate.alias_index(part, "p_type", "p_partkey", "p_partkey", last=True).withColumnRenamed("id", "last_id")
    return first.join(last, "alias")


@query("SELECT o_orderkey, coalesce(c_mktsegment, 'synthetic') AS kind FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_nationkey < 10) ON o_custkey = c_custkey")
def lookup_with_default(spark, t):
    index = t("customer").where("c_nationkey < 10").select("c_custkey", "c_mktsegment")
    return t("orders").join(index, F.col("o_custkey") == F.col("c_custkey"), "left").select("o_orderkey", F.coalesce("c_mktsegment", F.lit("synthetic")).alias("kind"))


@query("""
SELECT CASE WHEN o_orderkey IS NULL THEN 'no_parent' WHEN l_linestatus = o_orderstatus THEN 'same' ELSE 'mismatch' END AS verdict, count(*) AS n
FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_totalprice > 100000) ON l_orderkey = o_orderkey GROUP BY 1""")
def child_matches_parent(spark, t):
    parent = t("orders").where("o_totalprice > 100000").select("o_orderkey", "o_orderstatus")
    both = t("lineitem").select("l_orderkey", "l_linestatus").join(parent, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    verdict = F.when(F.col("o_orderkey").isNull(), "no_parent").when(F.col("l_linestatus").eqNullSafe(F.col("o_orderstatus")), "same").otherwise("mismatch")
    return both.groupBy(verdict.alias("verdict")).agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT DISTINCT a.l_orderkey, a.l_linenumber, a.lv AS level, (SELECT min(b.l_linenumber) FROM lineitem b WHERE b.l_orderkey = a.l_orderkey AND b.l_linenumber > a.l_linenumber AND b.l_quantity::INT % 3 + 1 <= a.lv) AS scope_end
FROM (SELECT *, l_quantity::INT % 3 + 1 AS lv FROM lineitem) a""")
def descendant_scope(spark, t):
    lines = t("lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity").cast("int") % 3 + 1).alias("level"))
    return relate.scope_end(lines, "l_orderkey", "l_linenumber", "level", "scope_end").distinct()


@query("""
SELECT c_custkey, f AS format, p AS platform FROM customer JOIN (VALUES (0, 'long'), (0, 'short'), (1, 'short')) x(i, f) ON c_nationkey % 3 = i JOIN (VALUES (0, 'web'), (0, 'app'), (1, 'web')) y(j, p) ON c_nationkey % 2 = j
UNION ALL SELECT c_custkey, 'any', 'any' FROM customer WHERE c_nationkey % 3 = 2""")
def format_platform_pairs(spark, t):
    words = lambda *w: F.array(*(F.lit(x) for x in w)).cast("array<string>")
    formats = F.when(F.col("c_nationkey") % 3 == 0, words("long", "short")).when(F.col("c_nationkey") % 3 == 1, words("short")).otherwise(words())
    platforms = F.when(F.col("c_nationkey") % 2 == 0, words("web", "app")).otherwise(words("web"))
    return t("customer").select("c_custkey", F.explode(text.pairs(formats, platforms, ("any", "any"))).alias("x")).select("c_custkey", F.col("x.a").alias("format"), F.col("x.b").alias("platform"))


@query("""SELECT n_nationkey, 'sha256:' || sha256('{"n_name":"' || n_name || '","n_nationkey":' || n_nationkey || '}') AS h FROM nation""")
def canonical_json_hash(spark, t):
    nation = t("nation")
    return nation.select("n_nationkey", text.canonical_hash(nation, ["n_nationkey", "n_name"]).alias("h"))


@query("""
SELECT 'document::' || doc_id AS chunk_id, sha256(concat_ws(chr(10), lang, text)) AS text_hash FROM documents
UNION ALL SELECT 'benchmark::' || item_id, sha256(coalesce(text, '')) FROM benchmark""")
def chunk_union(spark, t):
    documents = t("documents").select(F.concat(F.lit("document::"), "doc_id").alias("chunk_id"), F.sha2(F.concat_ws("\n", "lang", "text"), 256).alias("text_hash"))
    return documents.unionByName(t("benchmark").select(F.concat(F.lit("benchmark::"), "item_id").alias("chunk_id"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_hash")))


@query("""
SELECT page_id, 0 AS pos, 'a/' || page_id AS path FROM pages UNION ALL SELECT page_id, 1, 'a/y' FROM pages UNION ALL SELECT page_id, 2, 'b/z' FROM pages""")
def compound_path_split(spark, t):
    source = F.concat(F.lit("a/"), F.col("page_id").cast("string"), F.lit(" & y & b/z & "))
    return t("pages").select("page_id", F.posexplode(text.compound_paths(source)).alias("pos", "path"))


@query("""
WITH x AS (SELECT conv_id, turn, coalesce(text, '') AS text, coalesce(lag(text) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST), '') AS quote FROM conversations),
y AS (SELECT *, list_filter(list_transform(regexp_split_to_array(quote, '[,.;!?]'), lambda p: trim(p, ' ')), lambda p: length(p) >= 6) AS ps FROM x)
SELECT conv_id, turn, CASE WHEN len(ps) > 0 THEN round(len(list_filter(ps, lambda p: contains(text, p)))::DOUBLE / len(ps), 4) ELSE 0.0 END AS rate FROM y""")
def phrase_hit_rate(spark, t):
    rows = relate.row_before(t("conversations").select("conv_id", "turn", "role", "text"), "conv_id", ["turn", "role", "text"], "text", "quote")
    rows = rows.select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("quote", F.lit("")).alias("quote"))
    return rows.select("conv_id", "turn", F.round(text.hit_rate(F.col("text"), text.phrases(F.col("quote"), 6)), 4).alias("rate"))


@query(r"""
SELECT doc_id, len(n) > 0 AND len(list_filter(n, lambda v: v::DOUBLE < 0 OR v::DOUBLE > 500)) = 0 AS in_band
FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[0-9]+(?:\.[0-9]+)?') AS n FROM documents)""")
def price_in_band(spark, t):
    return t("documents").select("doc_id", text.in_band(F.col("text"), 0, 500).alias("in_band"))


@query(r"""
SELECT level, count(*) AS n FROM (SELECT CASE WHEN regexp_matches(l, '(?s)^#{1,6}[ \t]+.+$') THEN length(regexp_extract(l, '^#+')) WHEN regexp_matches(l, '(?s)^[一二三四五六七八九十]+、[ \t]*.+$') THEN 2
  WHEN regexp_matches(l, '(?s)^[0-9]+(\.[0-9]+)*[ \t]+.+$') THEN len(string_split(regexp_extract(l, '^[0-9]+(\.[0-9]+)*'), '.')) + 1 END::BIGINT AS level
  FROM (SELECT CASE doc_id % 5 WHEN 0 THEN '## ' WHEN 1 THEN '三、' WHEN 2 THEN '6.1 ' WHEN 3 THEN '# ' ELSE '' END || rtrim(unnest(string_split(coalesce(text, ''), chr(10))), ' ') AS l FROM documents)) GROUP BY 1""")
def heading_levels(spark, t):
    mark = F.element_at(F.array(*(F.lit(m) for m in ("## ", "三、", "6.1 ", "# ", ""))), (F.col("doc_id") % 5 + 1).cast("int"))
    lines = t("documents").select("doc_id", F.explode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("l")).select(F.concat(mark, F.rtrim("l")).alias("l"))
    return lines.groupBy(text.heading_level(F.col("l")).cast("long").alias("level")).agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH r AS (SELECT doc_id, lang, sha256('42:' || doc_id) AS h FROM documents),
s AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY h, doc_id) AS k, count(*) OVER (PARTITION BY lang) AS n FROM r)
SELECT lang, doc_id FROM s WHERE k <= least(n, greatest(2, n // 6))""")
def stratified_sample(spark, t):
    return rollup.stratified(t("documents").select("lang", "doc_id"), "lang", "doc_id", 42).select("lang", "doc_id")


@query("""
SELECT p_partkey, 'p_type' AS field FROM part WHERE contains(p_type, 'ECON') UNION ALL SELECT p_partkey, 'p_name' FROM part WHERE contains(p_name, 'gadget') UNION ALL SELECT p_partkey, 'p_brand' FROM part WHERE contains(p_brand, '#12')""")
def residue_scan(spark, t):
    cells = t("part").unpivot("p_partkey", ["p_type", "p_name", "p_brand"], "field", "cell")
    hit = F.when(F.col("field") == "p_brand", F.col("cell").contains("#12")).otherwise(F.col("cell").contains("ECON") | F.col("cell").contains("gadget"))
    return cells.where(hit).select("p_partkey", "field")


@query("SELECT p_partkey, u.pos - 1 AS pos, w[u.pos] AS word FROM (SELECT p_partkey, string_split(p_name, ' ') AS w FROM part), unnest(range(1, len(w) + 1)) AS u(pos)")
def fan_out(spark, t):
    return t("part").select("p_partkey", F.posexplode(F.split("p_name", " ")).alias("pos", "word")).withColumn("pos", F.col("pos").cast("long"))


@query("SELECT o_orderpriority, bool_or(o_totalprice > 400000) AS any_large, round(max(o_totalprice) - min(o_totalprice), 2) AS spread, coalesce(min(o_orderkey) FILTER (WHERE o_orderstatus = 'Z'), 0) AS first_z FROM orders GROUP BY 1")
def group_flags(spark, t):
    z = F.min(F.when(F.col("o_orderstatus") == "Z", F.col("o_orderkey")))
    return t("orders").groupBy("o_orderpriority").agg(F.bool_or(F.col("o_totalprice") > 400000).alias("any_large"), F.round(F.max("o_totalprice") - F.min("o_totalprice"), 2).alias("spread"), F.coalesce(z, F.lit(0)).alias("first_z"))
