"""Retrieval per request, joins and aggregates of the compile and audit paths, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import cases, text
from ..operators import policy, relate, retrieval, rollup, scope, vectors
from .catalog import query


@query("""
WITH p(intent, view_type, n) AS (VALUES ('0', 'A', 3), ('0', 'N', 2), ('1', 'R', 4), ('2', 'A', 1), ('3', 'none', 2)),
q AS (SELECT c_custkey AS request_id, c_nationkey, (c_custkey % 5)::VARCHAR AS intent FROM customer),
s AS (SELECT s_suppkey, s_nationkey FROM supplier),
v AS (SELECT l_returnflag AS view_type, l_suppkey AS pk, s_nationkey AS layer, row_number() OVER () AS r, l_orderkey, l_linenumber, l_linestatus AS gate FROM lineitem JOIN s ON l_suppkey = s_suppkey),
d AS (SELECT view_type, layer, pk, min(l_orderkey) AS first_order FROM v WHERE gate = 'F' GROUP BY 1, 2, 3),
k AS (SELECT view_type, layer, pk, first_order, row_number() OVER (PARTITION BY view_type, layer ORDER BY pk) AS rank FROM d)
SELECT q.request_id, p.view_type, k.pk, k.first_order, CASE WHEN p.intent IS NULL THEN 'no_policy' WHEN k.pk IS NULL THEN 'empty' ELSE 'found' END AS verdict
FROM q LEFT JOIN p ON q.intent = p.intent LEFT JOIN k ON k.view_type = p.view_type AND k.layer = q.c_nationkey AND k.rank <= p.n""")
def retrieve_requests(spark, t):
    """Requests joined to their policy and to the first n rows of each view of their own layer.

    Views are scoped and cut to the greatest n of any policy before requests meet them, so a
    layer's rows are ranked once, however many requests ask for them.
    """
    rules = spark.createDataFrame([("0", "A", 3), ("0", "N", 2), ("1", "R", 4), ("2", "A", 1), ("3", "none", 2)], "intent string, view_type string, n int")
    requests = t("customer").select(F.col("c_custkey").alias("request_id"), F.col("c_nationkey").alias("layer"), (F.col("c_custkey") % 5).cast("string").alias("intent"))
    lines = t("lineitem").where("l_linestatus = 'F'").select(F.col("l_returnflag").alias("view_type"), F.col("l_suppkey").alias("pk"), "l_orderkey")
    view = lines.join(t("supplier").select(F.col("s_suppkey").alias("pk"), F.col("s_nationkey").alias("layer")), "pk").groupBy("view_type", "layer", "pk").agg(F.min("l_orderkey").alias("first_order"))
    most = max(r["n"] for r in rules.collect())
    top = scope.first_per(view, ["view_type", "layer"], ["pk"], most)
    top = retrieval.ranked_in(top, ["view_type", "layer"], ["pk"])
    asked = requests.join(F.broadcast(rules), "intent", "left")
    out = asked.join(top, ["view_type", "layer"], "left").where("rank IS NULL OR rank <= n")
    verdict = F.when(F.col("n").isNull(), "no_policy").when(F.col("pk").isNull(), "empty").otherwise("found")
    return out.select("request_id", "view_type", "pk", "first_order", verdict.alias("verdict"))


@query("""
SELECT c_custkey, c_mktsegment FROM customer WHERE c_nationkey = 3 AND (CASE WHEN c_custkey % 3 = 0 THEN '' ELSE lower(c_mktsegment) END IN ('', 'building'))""")
def overlay_rows(spark, t):
    """One layer's overlays: an empty target fits every content type; the base layer has none."""
    rows = t("customer").select("c_custkey", "c_mktsegment", F.col("c_nationkey").cast("string").alias("brand_layer"), F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.lower("c_mktsegment")).alias("target_content_type"))
    own, none = scope.overlays(rows, "3", policy.BASE_LAYER, "building"), scope.overlays(rows, policy.BASE_LAYER, policy.BASE_LAYER, "building")
    return own.unionByName(none).select("c_custkey", "c_mktsegment")


PAYLOAD = ["CASE label % 3 WHEN 0 THEN 'domain_general' WHEN 1 THEN 'brand_a' ELSE 'brand_b' END AS brand_layer", "CASE WHEN vec_id % 4 = 0 THEN 'draft' ELSE 'active' END AS gate_status", "CASE WHEN vec_id % 6 = 1 THEN NULL ELSE 'L' || (vec_id % 4)::INT END AS granularity_layer", "CASE WHEN vec_id % 2 = 0 THEN 'post' ELSE 'story' END AS content_type", "'run' || (vec_id % 2)::INT AS compile_run_id"]


@query(f"""
WITH v AS (SELECT vec_id, embedding, {", ".join(PAYLOAD)} FROM embeddings),
q AS (SELECT embedding AS e FROM embeddings WHERE vec_id = (SELECT min(vec_id) FROM embeddings)),
c AS (SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], e::DOUBLE[]), 9) AS score, content_type FROM v, q WHERE brand_layer IN ('domain_general', 'brand_a') AND gate_status = 'active' AND granularity_layer IN ('L1', 'L2', 'L3') AND compile_run_id = 'run1' ORDER BY score DESC, vec_id LIMIT 30)
SELECT vec_id, content_type FROM c ORDER BY score * CASE WHEN content_type = 'post' THEN 2 ELSE 1 END DESC, vec_id LIMIT 8""")
def two_stage_topk(spark, t):
    """Filter, the 30 nearest, a caller's rerank held to them, the best 8."""
    corpus = t("embeddings")
    asked = corpus.orderBy("vec_id").limit(1).first()["embedding"]
    rows = corpus.selectExpr("vec_id", "embedding", *(e.replace("(vec_id % 4)::INT", "int(vec_id % 4)").replace("(vec_id % 2)::INT", "int(vec_id % 2)") for e in PAYLOAD))
    rows = rows.where(retrieval.payload_filter(["domain_general", "brand_a"], extra={"compile_run_id": ["run1"]}))
    near = vectors.top_k(rows, asked, 30).withColumn("score", F.round("score", 9))
    score = lambda df: df.withColumn("rerank_score", F.col("score") * F.when(F.col("content_type") == "post", 2).otherwise(1))
    return retrieval.rerank(near, score, "vec_id", 8).select("vec_id", "content_type")


@query("""
SELECT c_custkey, CASE WHEN c_acctbal < 0 AND c_custkey % 4 <> 0 THEN 'invalid' WHEN c_custkey % 4 = 0 OR c_custkey % 5 = 0 THEN 'blocked_missing_business_brief' ELSE 'ok' END AS status,
  concat_ws(',', CASE WHEN c_custkey % 5 = 0 THEN 'sku' END, CASE WHEN c_custkey % 4 = 0 THEN 'price' END) AS blocked_fields,
  CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'tone' END AS missing_fields, CASE WHEN c_nationkey = 1 THEN 'extra' ELSE '' END AS unknown_fields FROM customer""")
def brief_check(spark, t):
    key, none = F.col("c_custkey"), F.lit(None).cast("string")
    entry = lambda name, value, there: F.when(there, F.struct(F.lit(name).alias("k"), value.alias("v")))
    pairs = F.array_compact(F.array(entry("sku", F.col("c_name"), key % 5 != 0), entry("price", F.col("c_acctbal").cast("string"), key % 4 != 0), entry("tone", none, key % 3 == 0), entry("extra", none, F.col("c_nationkey") == 1)))
    rows = t("customer").select("c_custkey", F.map_from_entries(pairs).alias("brief"))
    price = F.try_element_at(F.col("brief"), F.lit("price")).try_cast("double")
    found = retrieval.brief_check(F.col("brief"), ["sku", "price"], ["tone"], {"price": price < 0})
    lists = [F.array_join(f"x.{c}", ",").alias(c) for c in ("blocked_fields", "missing_fields", "unknown_fields")]
    return rows.select("c_custkey", found.alias("x")).select("c_custkey", "x.status", *lists)


@query(r"""
WITH m AS (SELECT conv_id, turn, role, text, CASE WHEN turn % 7 = 6 THEN ' ' ELSE coalesce(text, '') || ' SKU A' || conv_id || ' costs ' || turn * 40 || ' yuan. Founder' END AS g FROM conversations),
h AS (SELECT conv_id, turn, role, text, g, CASE WHEN trim(g) = '' THEN 0 ELSE CASE WHEN turn * 40 BETWEEN 40 AND 120 THEN 0 ELSE 1 END + CASE WHEN conv_id % 2 = 0 THEN 0 ELSE 1 END + 1 END AS n FROM m)
SELECT conv_id, turn, CASE WHEN trim(g) = '' THEN 'blocked_empty' WHEN n > 0 THEN 'blocked' ELSE 'pass' END AS status, n FROM h""")
def guardrail_scan(spark, t):
    """Hits of forbidden patterns; a hit that holds the brief's sku or lies in its price band passes."""
    said = F.concat(F.coalesce("text", F.lit("")), F.lit(" SKU A"), "conv_id", F.lit(" costs "), F.col("turn") * 40, F.lit(" yuan. Founder"))
    rows = t("conversations").select("conv_id", "turn", "role", "text", F.when(F.col("turn") % 7 == 6, " ").otherwise(said).alias("g"))
    rows = rows.withColumn("row", F.xxhash64("conv_id", "turn", "role", "text"))
    sku = F.when(F.col("conv_id") % 2 == 0, F.concat(F.lit("A"), "conv_id"))
    patterns = [("sku", r"sku [A-Z]*[0-9]+", F.contains(F.col("hit"), sku)), ("price", r"[0-9]+(?:\.[0-9]+)? yuan", retrieval.price_passes(F.col("hit"), F.lit(40.0), F.lit(120.0))), ("founder", r"\bfounder\b", None)]
    hits = retrieval.forbidden_hits(rows, ["row"], "g", patterns).groupBy("row").agg(F.count(F.lit(1)).alias("n"))
    n = F.coalesce("n", F.lit(0))
    return rows.join(hits, "row", "left").select("conv_id", "turn", retrieval.guardrail_status(F.col("g"), n, F.lit(0)).alias("status"), n.alias("n"))


@query("""
SELECT event_id, CASE event_type WHEN 'purchase' THEN 'ok' WHEN 'view' THEN 'ok' ELSE 'needs_review' END AS intent_status, CASE event_type WHEN 'purchase' THEN 'generate' END AS policy_key,
  CASE event_type WHEN 'purchase' THEN 'direct_map' WHEN 'view' THEN 'unsupported_intent_no_policy' ELSE 'unknown_intent' END AS bridge,
  CASE WHEN user_id % 9 = 0 THEN 'blocked' WHEN event_type IN ('purchase', 'view') AND value > 50 AND user_id % 2 = 0 THEN 'ok' ELSE 'needs_review' END AS preflight FROM events""")
def intent_preflight(spark, t):
    """Exact intents, the policy that each has, and the request's aggregate state."""
    kind = F.col("event_type")
    intent = F.when(kind == "purchase", "content_generation").when(kind == "view", "quality_check").otherwise("odd")
    known = intent.isin("content_generation", "quality_check")
    key = cases.lookup(intent, cases.POLICY_OF_INTENT)
    status = F.when(known, "ok").otherwise("needs_review")
    bridge = F.when(~known, "unknown_intent").when(key.isNull(), "unsupported_intent_no_policy").otherwise("direct_map")
    state = retrieval.preflight(F.col("user_id") % 9 != 0, status, F.when(F.col("value") > 50, "ok"), F.when(F.col("user_id") % 2 == 0, "complete").otherwise("missing"))
    return t("events").select("event_id", status.alias("intent_status"), key.alias("policy_key"), bridge.alias("bridge"), state.alias("preflight"))


@query("""
WITH b AS (SELECT o_orderkey, '{"content_type":"' || o_orderpriority || '","evidence":[' || coalesce(e, '') || '],"missing_fields":' || CASE WHEN o_orderstatus = 'P' THEN '["tone"]' ELSE '[]' END || ',"request_id":' || o_orderkey || '}' AS j, o_orderstatus
  FROM orders LEFT JOIN (SELECT l_orderkey, string_agg(l_suppkey::VARCHAR, ',' ORDER BY f) AS e FROM (SELECT l_orderkey, l_suppkey, min(l_linenumber * 1000000 + l_suppkey) AS f FROM lineitem GROUP BY 1, 2) GROUP BY 1) ON l_orderkey = o_orderkey)
SELECT o_orderkey AS request_id, 'sha256:' || sha256(j) AS bundle_hash, length(j) AS n, CASE WHEN o_orderstatus = 'P' THEN 'tone' ELSE 'none' END AS blocked_reason, 'disabled' AS rerank_model FROM b""")
def context_bundles(spark, t):
    """A bundle per request as canonical JSON with its hash: evidence in first-seen order, each once,
    and the log row's words for what is empty."""
    first = t("lineitem").groupBy("l_orderkey", "l_suppkey").agg(F.min(F.col("l_linenumber") * 1000000 + F.col("l_suppkey")).alias("f"))
    evidence = first.groupBy("l_orderkey").agg(retrieval.in_arrival_order("l_suppkey", "f").alias("evidence"))
    rows = t("orders").join(evidence, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    missing = F.when(F.col("o_orderstatus") == "P", F.array(F.lit("tone"))).otherwise(F.array().cast("array<string>"))
    rows = rows.select(F.col("o_orderkey").alias("request_id"), F.col("o_orderpriority").alias("content_type"), F.coalesce("evidence", F.array().cast("array<bigint>")).alias("evidence"), missing.alias("missing_fields"))
    fields = ["request_id", "content_type", "evidence", "missing_fields"]
    out = rows.select("request_id", text.canonical_hash(rows, fields).alias("bundle_hash"), F.char_length(text.canonical_json(rows, fields)).alias("n"), F.array_join("missing_fields", ",").alias("blocked_reason"), F.lit("").alias("rerank_model"))
    return retrieval.disabled_if_empty(retrieval.disabled_if_empty(out, ["blocked_reason"], "none"), ["rerank_model"])


@query("""
WITH w AS (SELECT l_orderkey, l_returnflag AS c, count(*) AS n, min(l_linenumber) AS f FROM lineitem GROUP BY 1, 2)
SELECT l_orderkey, arg_max(c, (n, CASE c WHEN 'A' THEN 0 WHEN 'N' THEN -1 ELSE -2 END)) AS top_flag, string_agg(c, ',' ORDER BY f, c) AS arrival FROM w GROUP BY 1""")
def keyword_argmax(spark, t):
    """The category with most hits, ties to the earliest of a fixed order; categories as they came."""
    n = t("lineitem").groupBy("l_orderkey", F.col("l_returnflag").alias("c")).agg(F.count(F.lit(1)).alias("n"), F.min("l_linenumber").alias("f"))
    place = F.when(F.col("c") == "A", 0).when(F.col("c") == "N", -1).otherwise(-2)
    return n.groupBy("l_orderkey").agg(F.max_by("c", F.struct("n", place)).alias("top_flag"), F.array_join(retrieval.in_arrival_order("c", "f"), ",").alias("arrival"))


@query("""
WITH c AS (SELECT 'orders' AS tbl, o_orderstatus AS grp, count(*) AS n FROM orders GROUP BY 2 UNION ALL SELECT 'customer', c_mktsegment, count(*) FROM customer GROUP BY 2 UNION ALL SELECT 'part', p_type, count(*) FROM part GROUP BY 2)
SELECT tbl, grp, n FROM c UNION ALL SELECT tbl, 'total', sum(n)::BIGINT FROM c GROUP BY 1 UNION ALL SELECT 'all', 'total', sum(n)::BIGINT FROM c""")
def report_rollup(spark, t):
    """Counts by table and group, a total for each table and for all, from the counts themselves."""
    one = lambda name, col: t(name).groupBy(F.col(col).alias("grp")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("tbl"), "grp", "n")
    counts = one("orders", "o_orderstatus").unionByName(one("customer", "c_mktsegment")).unionByName(one("part", "p_type"))
    total = counts.rollup("tbl").agg(F.sum("n").alias("n"))
    return counts.unionByName(total.select(F.coalesce("tbl", F.lit("all")).alias("tbl"), F.lit("total").alias("grp"), "n"))


@query("""
SELECT p1.p_partkey, s1.s_name AS state, s2.s_name AS next_state FROM part p1 JOIN supplier s1 ON p1.p_size % 10 = s1.s_suppkey JOIN supplier s2 ON s2.s_suppkey = s1.s_suppkey + 1 WHERE p1.p_brand = 'Brand#12'""")
def self_join_states(spark, t):
    """A register joined twice: a state and the one that follows it; the brand is a parameter."""
    a, b = t("supplier").alias("a"), t("supplier").alias("b")
    rows = t("part").where(F.col("p_brand") == "Brand#12")
    both = rows.join(a, F.expr("p_size % 10 = a.s_suppkey")).join(b, F.expr("b.s_suppkey = a.s_suppkey + 1"))
    return both.selectExpr("p_partkey", "a.s_name AS state", "b.s_name AS next_state")


@query("""
SELECT o_orderkey, CASE WHEN c_acctbal > 8000 THEN c_mktsegment WHEN o_orderstatus = 'F' THEN 'auto_accepted' ELSE NULL END AS decision,
  CASE WHEN c_acctbal > 8000 THEN 'reviewer' WHEN o_orderstatus = 'F' THEN 'auto' ELSE '' END AS by_whom FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 8000) ON c_custkey = o_custkey AND c_nationkey % 3 = o_orderkey % 3""")
def review_overlay(spark, t):
    """A composite-key left join: a reviewer's decision overwrites, else some rows accept themselves."""
    review = t("customer").where("c_acctbal > 8000").select("c_custkey", (F.col("c_nationkey") % 3).alias("part_"), "c_mktsegment")
    both = t("orders").join(review, (F.col("o_custkey") == F.col("c_custkey")) & (F.col("o_orderkey") % 3 == F.col("part_")), "left")
    matched, auto = F.col("c_custkey").isNotNull(), F.col("o_orderstatus") == "F"
    return both.select("o_orderkey", F.when(matched, F.col("c_mktsegment")).when(auto, "auto_accepted").alias("decision"), F.when(matched, "reviewer").when(auto, "auto").otherwise("").alias("by_whom"))


@query("""
WITH l AS (SELECT l_partkey, l_returnflag, min(l_orderkey * 10 + l_linenumber) AS o FROM lineitem GROUP BY 1, 2)
SELECT p_partkey, o // 10 AS first_order, CASE WHEN contains(p_name, 'gear') THEN 1 ELSE 0 END AS hit FROM part JOIN l ON l_partkey = p_partkey AND l_returnflag = CASE WHEN p_size % 2 = 0 THEN 'A' ELSE 'R' END
WHERE p_partkey IN (SELECT l_partkey FROM lineitem)""")
def first_match(spark, t):
    """The first line that fits a part in both keys, parts in a co-located semi-join."""
    lines = t("lineitem").select("l_partkey", "l_returnflag", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("o"))
    first = retrieval.first_of_each(lines, ["l_partkey", "l_returnflag"], ["o"])
    part = t("part").withColumn("flag", F.when(F.col("p_size") % 2 == 0, "A").otherwise("R"))
    part = part.join(t("lineitem").select(F.col("l_partkey").alias("p_partkey")), "p_partkey", "left_semi")
    out = part.join(first, (F.col("p_partkey") == F.col("l_partkey")) & (F.col("flag") == F.col("l_returnflag")))
    return out.select("p_partkey", F.expr("o div 10").alias("first_order"), F.col("p_name").contains("gear").cast("int").alias("hit"))


@query("""
SELECT l_orderkey, l_linenumber, instr(p_name, w) AS at FROM (SELECT *, CASE l_returnflag WHEN 'A' THEN 'widget' WHEN 'N' THEN 'gear' ELSE 'o' END AS w FROM lineitem) JOIN part ON l_partkey = p_partkey WHERE instr(p_name, w) > 0""")
def phrase_join(spark, t):
    """Phrases found in the document that their key names: an equi-join, then a containment."""
    word = F.when(F.col("l_returnflag") == "A", "widget").when(F.col("l_returnflag") == "N", "gear").otherwise("o")
    both = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", word.alias("w")).join(t("part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    return both.select("l_orderkey", "l_linenumber", F.expr("instr(p_name, w)").cast("long").alias("at")).where("at > 0")


@query("""
WITH y AS (SELECT c_custkey AS k, c_mktsegment || '  x' AS q FROM customer WHERE c_nationkey < 20), c AS (SELECT c_custkey AS k, c_mktsegment || CASE WHEN c_custkey % 7 = 0 THEN ' y' ELSE ' x' END AS q FROM customer WHERE c_nationkey > 5)
SELECT k, CASE WHEN y.k IS NULL THEN 'csv_only' WHEN c.k IS NULL THEN 'doc_only' ELSE 'quote_differs' END AS issue FROM y FULL JOIN c USING (k) WHERE y.k IS NULL OR c.k IS NULL OR regexp_replace(y.q, ' +', ' ', 'g') <> c.q""")
def field_sync(spark, t):
    """Two registers of one thing: what either lacks, and quotes that differ beyond white space."""
    docs = t("customer").where("c_nationkey < 20").select(F.col("c_custkey").alias("k"), cases.folded(F.concat("c_mktsegment", F.lit("  x"))).alias("q"))
    csv = t("customer").where("c_nationkey > 5").select(F.col("c_custkey").alias("k"), cases.folded(F.concat("c_mktsegment", F.when(F.col("c_custkey") % 7 == 0, " y").otherwise(" x"))).alias("q"))
    issue = F.when(F.col("status") == "only_right", "csv_only").when(F.col("status") == "only_left", "doc_only").when(F.col("status") == "mismatch", "quote_differs")
    return relate.difference(docs, csv, ["k"], ["q"]).select("k", issue.alias("issue")).where("issue IS NOT NULL")


@query("""
WITH p AS (SELECT 'customer' AS rel, c_custkey AS id, unnest([c_nationkey, c_nationkey + 3]) AS part FROM customer UNION ALL SELECT 'supplier', s_suppkey, unnest([s_nationkey]) FROM supplier)
SELECT rel, count(*) AS n_parts, count(*) FILTER (WHERE part NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 4)) AS n_lost FROM p GROUP BY 1""")
def reverse_trace(spark, t):
    """Parts that rows of several relations name, against the inventory of what exists."""
    customer = t("customer").select(F.lit("customer").alias("rel"), F.explode(F.array("c_nationkey", F.col("c_nationkey") + 3)).alias("part"))
    parts = customer.unionByName(t("supplier").select(F.lit("supplier").alias("rel"), F.col("s_nationkey").alias("part")))
    there = t("nation").where("n_regionkey <> 4").select(F.col("n_nationkey").alias("part"), F.lit(1).alias("hit"))
    return parts.join(there, "part", "left").groupBy("rel").agg(F.count(F.lit(1)).alias("n_parts"), F.count_if(F.col("hit").isNull()).alias("n_lost"))


@query("""
WITH r AS (SELECT event_id, user_id, event_type, ts FROM events ORDER BY ts DESC, event_id DESC LIMIT 200)
SELECT event_id, CASE WHEN c_custkey IS NULL THEN NULL ELSE (CASE WHEN event_type = 'view' THEN 'BUILDING' ELSE c_mktsegment END) = c_mktsegment END AS ok FROM r LEFT JOIN customer ON c_custkey = user_id * 20""")
def expected_mapping(spark, t):
    """Recent rows against an expected mapping: true, false, or null for a key that nobody knows."""
    recent = t("events").orderBy(F.desc("ts"), F.desc("event_id")).limit(200)
    both = recent.join(t("customer").select("c_custkey", "c_mktsegment"), F.col("c_custkey") == F.col("user_id") * 20, "left")
    logged = F.when(F.col("event_type") == "view", "BUILDING").otherwise(F.col("c_mktsegment"))
    return both.select("event_id", F.when(F.col("c_custkey").isNotNull(), logged == F.col("c_mktsegment")).alias("ok"))


@query("""
SELECT coalesce(c_custkey::VARCHAR, 'mpv::' || s_suppkey) AS run, s_suppkey, c_name FROM supplier LEFT JOIN (SELECT * FROM customer WHERE c_nationkey < 12) ON c_custkey = s_suppkey""")
def deploy_pairs(spark, t):
    """Two sides matched on a version; a side without a run gets a placeholder key."""
    runs = t("customer").where("c_nationkey < 12").select("c_custkey", "c_name")
    return t("supplier").join(runs, F.col("c_custkey") == F.col("s_suppkey"), "left").select(F.coalesce(F.col("c_custkey").cast("string"), F.concat(F.lit("mpv::"), "s_suppkey")).alias("run"), "s_suppkey", "c_name")


@query("""
SELECT event_id, event_type FROM (SELECT event_id, event_type, ts FROM events ORDER BY event_id DESC LIMIT 15)""")
def tail_events(spark, t):
    return retrieval.latest(t("events").select("event_id", "event_type"), ["event_id"], 15)


@query("""
WITH a AS (SELECT c_nationkey AS k FROM customer), b AS (SELECT s_nationkey AS k FROM supplier)
SELECT DISTINCT k, k IN (SELECT k FROM a) AS by_name, k IN (SELECT k FROM b) AS by_id FROM (SELECT k FROM a UNION SELECT k FROM b)""")
def closure_union(spark, t):
    """Two closures as one set, each member with the closure that it came from."""
    one = lambda df, c, a, b: df.select(F.col(c).alias("k"), F.lit(a).alias("by_name"), F.lit(b).alias("by_id"))
    both = one(t("customer"), "c_nationkey", True, False).unionByName(one(t("supplier"), "s_nationkey", False, True))
    return both.groupBy("k").agg(F.bool_or("by_name").alias("by_name"), F.bool_or("by_id").alias("by_id"))


@query("""
SELECT r_regionkey, array_to_string(list_filter(CASE WHEN r_regionkey % 2 = 0 THEN ['pack', 'card', 'asset'] ELSE ['card', 'pack', 'overlay'] END, lambda v: v IN ('pack', 'card', 'overlay')), ',') AS views FROM region""")
def requested_views(spark, t):
    """Required and optional views in order, each once, of those that can be served."""
    names = lambda *w: F.array(*(F.lit(x) for x in w))
    even = F.col("r_regionkey") % 2 == 0
    asked = F.array_distinct(F.concat(F.when(even, names("pack", "card")).otherwise(names("card", "pack")), F.when(even, names("pack", "asset")).otherwise(names("overlay"))))
    return t("region").select("r_regionkey", F.array_join(F.filter(asked, lambda v: v.isin("pack", "card", "overlay")), ",").alias("views"))


@query("""
SELECT l_orderkey, l_linenumber, l_suppkey, 'new' AS src FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
UNION ALL SELECT o_orderkey, 0, o_custkey, 'old' FROM orders WHERE o_orderstatus = 'F'""")
def incremental_projection(spark, t):
    """New documents alone are unfolded into rows and added; what is there stays as it is."""
    old = t("orders").where("o_orderstatus = 'F'")
    nested = t("lineitem").join(old.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_anti")
    fresh = nested.select("l_orderkey", "l_linenumber", "l_suppkey", F.lit("new").alias("src"))
    return fresh.unionByName(old.select(F.col("o_orderkey").alias("l_orderkey"), F.lit(0).alias("l_linenumber"), F.col("o_custkey").alias("l_suppkey"), F.lit("old").alias("src")))


@query("""
WITH RECURSIVE e AS (SELECT p_partkey // 3 AS parent, p_partkey AS child FROM part WHERE p_partkey > 0), l AS (SELECT p_partkey AS node, 0 AS level FROM part WHERE p_partkey = 0 UNION ALL SELECT child, level + 1 FROM l JOIN e ON node = parent)
SELECT node, max(level) AS level FROM l GROUP BY 1""")
def task_levels(spark, t):
    """Topological levels of a task graph; what stands on a cycle has none and is not returned."""
    edges = t("part").where("p_partkey > 0").select(F.expr("p_partkey div 3").alias("parent"), F.col("p_partkey").alias("child"))
    return relate.levels(edges).select("node", "level")


@query("""
SELECT count(*) AS total, array_to_string(list(c_custkey ORDER BY c_custkey)[1:50], ',') AS first_50 FROM customer WHERE c_acctbal < 0""")
def truncated_errors(spark, t):
    """The first fifty violations and how many there are; each task keeps fifty at most."""
    bad = t("customer").where("c_acctbal < 0").select("c_custkey")
    first = bad.orderBy("c_custkey").limit(50).agg(F.array_sort(F.collect_list("c_custkey")).alias("ids"))
    return bad.agg(F.count(F.lit(1)).alias("total")).join(F.broadcast(first)).select("total", F.array_join("ids", ",").alias("first_50"))


@query("""
WITH x AS (SELECT view_type, pk, row_number() OVER (PARTITION BY view_type ORDER BY pk) AS place FROM (SELECT 'b' AS view_type, r_regionkey AS pk FROM region UNION ALL SELECT 'a', n_nationkey FROM nation)) SELECT * FROM x""")
def sorted_chunks(spark, t):
    """Chunks in the order of view and key, with the place that the order gives them."""
    rows = t("region").select(F.lit("b").alias("view_type"), F.col("r_regionkey").alias("pk")).unionByName(t("nation").select(F.lit("a").alias("view_type"), F.col("n_nationkey").alias("pk")))
    return rows.withColumn("place", F.row_number().over(Window.partitionBy("view_type").orderBy("pk")).cast("long")).orderBy("view_type", "pk")


@query("""
SELECT o_orderkey, CASE WHEN h IS NULL THEN 'only_left' WHEN h = sha256(o_orderkey || '|' || o_orderstatus) THEN 'same' ELSE 'conflict' END AS status FROM orders LEFT JOIN (SELECT l_orderkey, sha256(l_orderkey || '|' || max(l_linestatus)) AS h FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""")
def copy_plan(spark, t):
    """What an idempotent copy would do: missing files are copied, equal ones left, others conflict."""
    left = t("orders").select("o_orderkey", F.sha2(F.concat_ws("|", F.col("o_orderkey").cast("string"), "o_orderstatus"), 256).alias("h"))
    right = t("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_linestatus").alias("s"))
    right = right.select("o_orderkey", F.sha2(F.concat_ws("|", F.col("o_orderkey").cast("string"), "s"), 256).alias("h"))
    status = F.when(F.col("status") == "mismatch", "conflict").otherwise(F.col("status"))
    return relate.difference(left, right, ["o_orderkey"], ["h"]).where("status <> 'only_right'").select("o_orderkey", status.alias("status"))


@query("""
SELECT p_partkey, (p_brand ~ '^[A-Z][a-z]*#[0-9]+$' AND length(p_brand) BETWEEN 7 AND 8) AS brand_ok, p_name = '' OR p_size > 25 AS empty_or_large, p_type IN ('ECONOMY', 'STANDARD') AS known, p_name ~ '(^|[^a-z])(sk|key)[a-z0-9]{8,}' AS secret FROM part""")
def register_checks(spark, t):
    """Domain by pattern and length, an emptiness disjunction, enums with extensions, secrets."""
    allowed = spark.createDataFrame([("ECONOMY",), ("STANDARD",)], "p_type string").distinct().withColumn("known", F.lit(True))
    rows = t("part").join(F.broadcast(allowed), "p_type", "left")
    brand = F.col("p_brand").rlike("^[A-Z][a-z]*#[0-9]+$") & F.char_length("p_brand").between(7, 8)
    return rows.select("p_partkey", brand.alias("brand_ok"), ((F.col("p_name") == "") | (F.col("p_size") > 25)).alias("empty_or_large"), F.coalesce("known", F.lit(False)).alias("known"), F.col("p_name").rlike("(^|[^a-z])(sk|key)[a-z0-9]{8,}").alias("secret"))


@query("""
SELECT sha256(string_agg(c, '' ORDER BY p)) AS manifest_hash, substr(sha256(string_agg(c, '' ORDER BY p)), 1, 16) AS run_id, count(*) AS n FROM (SELECT h[1:3] AS p, sha256(string_agg(h, '' ORDER BY h)) AS c FROM (SELECT sha256(page_id || chr(31) || url || chr(31) || length(html)) AS h FROM pages) GROUP BY 1)""")
def manifest_hash(spark, t):
    """A manifest's hash (nested by prefix, so no task holds all entries) and the run id from it."""
    entries = t("pages").select("page_id", "url", F.char_length("html").alias("n_chars"))
    return rollup.manifest(entries, ["page_id", "url", "n_chars"])


@query(None)
def longest_overlaps(spark, t):
    """The longest piece of a turn's text that stands in the turn before it, folded, with where it
    begins, its line and an excerpt of 80 characters. SQL has no longest common substring."""
    rows = relate.row_before(t("conversations").select("conv_id", "turn", "role", "text"), "conv_id", ["turn", "role", "text"], "text", "quote")
    rows = rows.select("conv_id", "turn", F.col("text").alias("raw"), cases.folded(F.col("text")).alias("text"), cases.folded(F.col("quote")).alias("quote"))
    found = rows.withColumn("x", text.longest_overlap(F.col("text"), F.col("quote")))
    piece = F.substr("text", F.col("x.start") + 1, F.col("x.length"))
    head = F.split_part(F.ltrim(piece), F.lit(" "), F.lit(1))
    line = F.when(F.col("x.start") >= 0, F.regexp_count(F.call_function("substring_index", F.col("raw"), head, F.lit(1)), F.lit("\n")) + 1)
    return found.select("conv_id", "turn", "x.start", "x.length", line.alias("line"), F.substring(piece, 1, 80).alias("excerpt"))


@query("""
WITH k AS (SELECT l_orderkey, list(DISTINCT l_returnflag) AS ks FROM lineitem GROUP BY 1)
SELECT o_orderkey, concat_ws(',', CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') AND NOT coalesce(list_contains(ks, 'R'), false) THEN 'R' END, CASE WHEN o_orderpriority = '1-URGENT' AND NOT coalesce(list_contains(ks, 'A'), false) THEN 'A' END) AS missing
FROM orders LEFT JOIN k ON l_orderkey = o_orderkey""")
def evidence_keys(spark, t):
    """Hard fields of a content type that no nested row of the bundle names; other types ask none."""
    keys = t("lineitem").groupBy("l_orderkey").agg(F.collect_set("l_returnflag").alias("ks"))
    hard = F.when(F.col("o_orderpriority") == "1-URGENT", F.array(F.lit("R"), F.lit("A"))).when(F.col("o_orderpriority") == "2-HIGH", F.array(F.lit("R"))).otherwise(F.array().cast("array<string>"))
    rows = t("orders").join(keys, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    missing = F.array_except(hard, F.coalesce("ks", F.array().cast("array<string>")))
    return rows.select("o_orderkey", F.array_join(missing, ",").alias("missing"))
