"""The compiled views and their derived columns, each query beside its SQL.

The driver's tables stand for packs (orders with their line items), cards and registers (parts),
evidence (documents), assets (suppliers), content types (nations) and overlays (customers).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cases, text
from .catalog import query

KINDS = ["direct_quote", "paraphrase_high", "paraphrase_mid", "paraphrase_low", "inferred", "low", "structural_induction"]
_KIND = f"[{', '.join(repr(k) for k in KINDS)}][(p_size % 7 + 1)::INT]"


def _kind(i):
    return F.element_at(F.array(*(F.lit(k) for k in KINDS)), (i % 7 + 1).cast("int"))


@query(f"""
WITH k AS (SELECT p_partkey, p_size, p_retailprice, {_KIND} AS raw FROM part),
n AS (SELECT *, CASE WHEN raw = 'low' THEN 'paraphrase_low' WHEN raw = 'structural_induction' THEN NULL ELSE raw END AS level FROM k)
SELECT p_partkey, level, CASE WHEN p_size % 4 = 0 THEN 'missing' WHEN raw IN ('direct_quote', 'paraphrase_high') THEN 'full' WHEN raw IN ('paraphrase_low', 'inferred') THEN 'weak' ELSE 'partial' END AS pack_trace,
  CASE WHEN level = 'direct_quote' THEN 'full' WHEN level IN ('paraphrase_high', 'paraphrase_mid') THEN 'partial' ELSE 'weak' END AS evidence_trace,
  CASE WHEN level IN ('direct_quote', 'paraphrase_high') THEN 'high' WHEN level = 'paraphrase_mid' THEN 'mid' ELSE 'low' END AS quality,
  CASE WHEN p_size % 5 = 0 THEN 'direct_quote_verified' WHEN p_size / 50.0 >= 0.3 THEN 'paraphrase_located' ELSE 'needs_human_review' END AS adjudication,
  CASE WHEN p_size % 5 = 0 THEN 'T1_strict_direct_quote' WHEN p_size / 50.0 >= 0.3 THEN 'T2_paraphrase_authentic' ELSE 'T3_suspect' END AS tier,
  CASE WHEN p_size % 3 = 0 THEN 'pending_review' WHEN p_size % 3 = 1 THEN 'approved' ELSE 'needs_review' END AS review,
  CASE WHEN p_size < 5 THEN 'missing' WHEN p_size - 4 >= 10 THEN 'complete' ELSE 'partial' END AS coverage,
  CASE WHEN p_size * 20 >= 300 THEN 'high' WHEN p_size * 20 >= 100 THEN 'medium' ELSE 'low' END AS priority FROM n""")
def evidence_cases(spark, t):
    raw, size = _kind(F.col("p_size")), F.col("p_size")
    level, strict, rate = cases.normal_level(raw), size % 5 == 0, size / 50.0
    return t("part").select(
        "p_partkey", level.alias("level"), cases.traceability_of_pack(raw, size % 4 != 0).alias("pack_trace"), cases.traceability_of_evidence(level).alias("evidence_trace"),
        cases.trace_quality(level).alias("quality"), cases.adjudicated(strict, rate).alias("adjudication"), cases.tier(strict, rate).alias("tier"),
        cases.review_status(F.when(size % 3 == 0, True), F.when(size % 3 == 1, " keep ").otherwise(" ")).alias("review"),
        cases.coverage(F.greatest(F.lit(0), size - 4)).alias("coverage"), cases.priority(size * 20).alias("priority"),
    )


@query("""
WITH e AS (SELECT l_orderkey, list(CASE WHEN l_linenumber % 2 = 0 THEN 'EV-' || l_partkey ELSE 'EV-' || l_suppkey END ORDER BY l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN 'EV-' || l_partkey ELSE 'EV-' || l_suppkey END) AS ids, bool_or(l_returnflag = 'R') AS r FROM lineitem GROUP BY 1)
SELECT o_orderkey, 'KP ' || replace(lower(o_orderpriority), '-', ' ') AS title,
  CASE WHEN ids IS NULL THEN 'missing' WHEN o_orderkey % 3 = 0 THEN 'full' WHEN o_orderkey % 3 = 1 THEN 'partial' ELSE 'weak' END AS traceability,
  CASE WHEN o_orderstatus = 'P' THEN 'pending_review' WHEN o_orderstatus = 'F' THEN 'approved' ELSE 'needs_review' END AS review_status,
  concat_ws(',', CASE WHEN ids IS NOT NULL THEN '07_evidence.csv' END, CASE WHEN o_orderstatus = 'F' THEN '09_call_mapping.csv' END) AS source_table_refs,
  coalesce(array_to_string(ids, ','), '') AS evidence_ids,
  concat_ws(' | ', CASE WHEN o_orderstatus <> 'O' THEN 'not_applicable_when: ' || o_orderstatus END, CASE WHEN r THEN 'alternative_path: returned' END) AS alternative_boundary,
  sha256(concat_ws(chr(10), 'assertion: ' || o_orderpriority, CASE WHEN o_totalprice > 200000 THEN 'success: large' END)) AS chunk_text_hash
FROM orders LEFT JOIN e ON l_orderkey = o_orderkey WHERE o_totalprice > 1000""")
def pack_view(spark, t):
    """The pack view's projection; packs of at most 1000 count as drafts and are left out."""
    even = F.col("l_linenumber") % 2 == 0
    entry = F.struct("l_linenumber", F.when(even, F.col("l_partkey")).alias("id"), F.when(~even, F.col("l_suppkey")).alias("bare"))
    # numbers are shuffled; their texts are made after
    named = lambda x: F.struct(x["l_linenumber"].alias("l_linenumber"), F.concat(F.lit("EV-"), x["id"]).alias("id"), F.concat(F.lit(" EV-"), x["bare"], F.lit(" ")).alias("bare"))
    evidence = t("lineitem").groupBy("l_orderkey").agg(F.collect_list(entry).alias("e"), F.bool_or(F.col("l_returnflag") == "R").alias("returned"))
    evidence = evidence.select("l_orderkey", "returned", F.array_sort(F.transform("e", named)).alias("evidence"))
    packs = t("orders").where("o_totalprice > 1000").join(evidence, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    status, calls = F.col("o_orderstatus"), F.when(F.col("o_orderstatus") == "F", F.array(F.lit(1)))
    level = F.element_at(F.array(F.lit("direct_quote"), F.lit("paraphrase_mid"), F.lit("inferred")), (F.col("o_orderkey") % 3 + 1).cast("int"))
    boundary = [("not_applicable_when", F.when(status != "O", status)), ("alternative_path", F.when(F.col("returned"), "returned"))]
    chunk = [("assertion", F.col("o_orderpriority")), ("success", F.when(F.col("o_totalprice") > 200000, "large").otherwise(" "))]
    return packs.select(
        "o_orderkey", F.concat(F.lit("KP "), cases.title_of(F.concat(F.lit("KP-"), F.lower("o_orderpriority")), "KP-")).alias("title"),
        cases.traceability_of_pack(level, F.col("evidence").isNotNull()).alias("traceability"), cases.review_status(status == "P", F.when(status == "F", "ok")).alias("review_status"),
        F.array_join(cases.names_of_filled({"07_evidence.csv": F.col("evidence"), "09_call_mapping.csv": calls}), ",").alias("source_table_refs"),
        F.array_join(cases.ids_of(F.col("evidence")), ",").alias("evidence_ids"), cases.labelled(boundary, " | ").alias("alternative_boundary"),
        F.sha2(cases.labelled(chunk, "\n"), 256).alias("chunk_text_hash"),
    )


@query("""
SELECT p_partkey, CASE WHEN p_size % 9 = 0 THEN '' ELSE split_part(replace(p_name, ' ', '-'), '-', 1) END AS content_type, p_size % 6 AS steps_count,
  coalesce(array_to_string(range(1, p_size % 6 + 1), ','), '') AS steps,
  CASE n WHEN 5 THEN 'complete' WHEN 4 THEN 'partial' WHEN 3 THEN 'partial' ELSE 'stub' END AS completeness_status,
  sha256('hook: ' || p_name || chr(10) || 'anti_pattern: ' || CASE WHEN p_size % 2 = 0 THEN p_type ELSE '' END) AS chunk_text_hash
FROM (SELECT *, (p_size % 6 > 0)::INT + (p_size % 2 = 0)::INT + (p_size > 10)::INT + (p_size > 20)::INT + (p_retailprice > 950)::INT AS n FROM part)""")
def play_card_view(spark, t):
    size = F.col("p_size")
    id_ = F.when(size % 9 == 0, F.concat(F.lit("XX-"), "p_name")).otherwise(F.concat(F.lit("PC-size_part-"), F.translate("p_name", " ", "-")))
    anti = F.when(size % 2 == 0, F.col("p_type")).otherwise("")
    there = (size % 6 > 0, anti != "", size > 10, size > 20, F.col("p_retailprice") > 950)
    chunk = F.concat(F.lit("hook: "), "p_name", F.lit("\nanti_pattern: "), anti)
    return t("part").select("p_partkey", cases.first_segment(id_, "^PC-[a-z_]+-(.+)$").alias("content_type"), (size % 6).alias("steps_count"), F.array_join(cases.numbered(size % 6), ",").alias("steps"), cases.completeness(*there).alias("completeness_status"), F.sha2(chunk, 256).alias("chunk_text_hash"))


@query("""
SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'direct_quote' WHEN 1 THEN 'paraphrase_low' ELSE 'inferred' END AS inference_level, CASE doc_id % 3 WHEN 0 THEN 'high' ELSE 'low' END AS trace_quality,
  CASE doc_id % 3 WHEN 0 THEN 'full' ELSE 'weak' END AS traceability_status, greatest(coalesce(n_chars, 0) - 1000, 0) AS line_no, sha256(source || '#' || coalesce(lang, '') || chr(10) || text) AS chunk_text_hash
FROM documents WHERE coalesce(text, '') <> '' AND coalesce(source, '') <> ''""")
def evidence_view(spark, t):
    """Evidence rows; those without a source or a quote are violations and left out."""
    raw = F.element_at(F.array(F.lit("direct_quote"), F.lit("low"), F.lit(" inferred ")), (F.col("doc_id") % 3 + 1).cast("int"))
    level = cases.normal_level(raw)
    line = F.greatest(F.coalesce(F.col("n_chars").cast("string").try_cast("long"), F.lit(0)) - 1000, F.lit(0))
    chunk = F.concat("source", F.lit("#"), F.coalesce("lang", F.lit("")), F.lit("\n"), "text")
    rows = t("documents").where("text <> '' AND source <> ''")
    return rows.select("doc_id", level.alias("inference_level"), cases.trace_quality(level).alias("trace_quality"), cases.traceability_of_evidence(level).alias("traceability_status"), line.alias("line_no"), F.sha2(chunk, 256).alias("chunk_text_hash"))


@query("""
SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN 'template' WHEN s_suppkey % 4 = 1 THEN 'checklist' ELSE NULL END AS asset_type,
  concat_ws(',', CASE WHEN s_suppkey % 4 NOT IN (0, 1) THEN 'asset_type' END, CASE WHEN length(s_name) < 18 THEN 'title' END, CASE WHEN s_acctbal < 0 THEN 'summary' END) AS errors,
  'asset::' || s_suppkey AS chunk_id FROM supplier""")
def runtime_asset_view(spark, t):
    """Assets with the register's own checks: a closed type list, least lengths, a summary."""
    kind = cases.choose(F.col("s_suppkey") % 4, {"template": [0], "checklist": [1]})
    broken = cases.fired([("asset_type", kind.isNull()), ("title", F.char_length("s_name") < 18), ("summary", F.col("s_acctbal") < 0)])
    return t("supplier").select("s_suppkey", kind.alias("asset_type"), F.array_join(broken, ",").alias("errors"), F.concat(F.lit("asset::"), "s_suppkey").alias("chunk_id"))


@query("""
SELECT n_nationkey, coalesce(string_agg(DISTINCT c_mktsegment, ',' ORDER BY c_mktsegment), '') AS packs, count(c_custkey) AS n,
  CASE WHEN count(c_custkey) = 0 THEN 'missing' WHEN count(c_custkey) >= 10 THEN 'complete' ELSE 'partial' END AS coverage_status
FROM nation LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 7000) ON c_nationkey = n_nationkey GROUP BY 1""")
def content_type_view(spark, t):
    """Every type with its sorted members, those without any included."""
    packs = t("customer").where("c_acctbal > 7000").groupBy("c_nationkey").agg(F.array_sort(F.collect_set("c_mktsegment")).alias("packs"), F.count(F.lit(1)).alias("n"))
    rows = t("nation").join(packs, F.col("n_nationkey") == F.col("c_nationkey"), "left")
    n = F.coalesce("n", F.lit(0))
    return rows.select("n_nationkey", F.coalesce(F.array_join("packs", ","), F.lit("")).alias("packs"), n.alias("n"), cases.coverage(n).alias("coverage_status"))


@query("""
SELECT c_custkey, c_nationkey % 4 + 1 AS precedence,
  CASE WHEN c_nationkey % 4 = 3 AND c_custkey % 2 = 0 THEN lower(c_mktsegment) ELSE '' END AS target_content_type
FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'""")
def brand_overlay_view(spark, t):
    """Overlays of brand layers alone: rows of the base layer (one segment here) are pruned."""
    kind = F.element_at(F.array(*(F.lit(k) for k in cases.PRECEDENCE)), (F.col("c_nationkey") % 4 + 1).cast("int"))
    rows = t("customer").where("c_mktsegment <> 'HOUSEHOLD'").withColumn("kind", kind)
    id_ = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("KP-x-ctype-"), F.lower("c_mktsegment"))).otherwise("KP-x")
    target = F.when(F.col("kind") == "content_type_overlay", cases.after_marker(id_, "-ctype-")).otherwise("")
    return rows.select("c_custkey", cases.lookup(F.col("kind"), cases.PRECEDENCE).alias("precedence"), target.alias("target_content_type"))


@query("""
SELECT n_nationkey, f AS output_format, p AS platform, 'RECIPE-' || substr(sha256(n_nationkey || '|' || f || '|' || p), 1, 10) AS recipe_id, substr(sha1(n_name), 1, 12) AS short_name
FROM nation, (VALUES ('long'), ('short')) x(f), (VALUES ('web'), ('app')) y(p) WHERE n_regionkey <> 2
UNION ALL SELECT n_nationkey, 'any', 'any', 'RECIPE-' || substr(sha256(n_nationkey || '|any|any'), 1, 10), substr(sha1(n_name), 1, 12) FROM nation WHERE n_regionkey = 2""")
def generation_recipe_view(spark, t):
    words = lambda *w: F.array(*(F.lit(x) for x in w)).cast("array<string>")
    some = F.col("n_regionkey") != 2
    rows = t("nation").select("n_nationkey", "n_name", F.explode(text.pairs(F.when(some, words("long", "short")).otherwise(words()), words("web", "app"), ("any", "any"))).alias("x"))
    id_ = F.concat(F.lit("RECIPE-"), F.substring(F.sha2(F.concat_ws("|", F.col("n_nationkey").cast("string"), "x.a", "x.b"), 256), 1, 10))
    return rows.select("n_nationkey", F.col("x.a").alias("output_format"), F.col("x.b").alias("platform"), id_.alias("recipe_id"), F.substring(F.sha1("n_name"), 1, 12).alias("short_name"))


@query("""
WITH c AS (
  SELECT 'pack_view' AS view_type, o_orderkey AS pk, 'assertion: ' || o_orderpriority AS x FROM orders
  UNION ALL SELECT 'play_card_view', p_partkey, 'hook: ' || p_name || chr(10) || 'anti_pattern: ' || p_type FROM part
  UNION ALL SELECT 'evidence_view', doc_id, coalesce(source, '') || '#' || coalesce(lang, '') || chr(10) || coalesce(text, '') FROM documents
  UNION ALL SELECT 'runtime_asset_view', s_suppkey, s_name || chr(10) || 'asset_type:supplier' FROM supplier
  UNION ALL SELECT 'brand_overlay_view', c_custkey, c_mktsegment || chr(10) || c_name FROM customer
  UNION ALL SELECT 'generation_recipe_view', r_regionkey, 'recipe_id: ' || r_regionkey || chr(10) || 'platform: ' || r_name FROM region
  UNION ALL SELECT 'content_type_view', n_nationkey, 'canonical_id: ' || n_nationkey || chr(10) || 'name_en: ' || n_name FROM nation)
SELECT view_type, view_type || '::' || pk AS chunk_id, sha256(x) AS chunk_text_hash,
  CASE WHEN pk % 10 = 0 THEN 'drift' ELSE 'same' END AS stored FROM c""")
def chunk_texts(spark, t):
    """The seven views' chunks in one relation, held against stored hashes (every tenth is stale)."""
    lit, cat = F.lit, F.concat
    empty = lambda c: F.coalesce(c, lit(""))
    views = [
        ("pack_view", "orders", "o_orderkey", cat(lit("assertion: "), "o_orderpriority")),
        ("play_card_view", "part", "p_partkey", cat(lit("hook: "), "p_name", lit("\nanti_pattern: "), "p_type")),
        ("evidence_view", "documents", "doc_id", cat(empty("source"), lit("#"), empty("lang"), lit("\n"), empty("text"))),
        ("runtime_asset_view", "supplier", "s_suppkey", cat("s_name", lit("\nasset_type:supplier"))),
        ("brand_overlay_view", "customer", "c_custkey", cat("c_mktsegment", lit("\n"), "c_name")),
        ("generation_recipe_view", "region", "r_regionkey", cat(lit("recipe_id: "), "r_regionkey", lit("\nplatform: "), "r_name")),
        ("content_type_view", "nation", "n_nationkey", cat(lit("canonical_id: "), "n_nationkey", lit("\nname_en: "), "n_name")),
    ]
    chunks = None
    for name, table, key, x in views:
        one = t(table).select(lit(name).alias("view_type"), F.col(key).cast("long").alias("pk"), F.sha2(x, 256).alias("chunk_text_hash"))
        chunks = one if chunks is None else chunks.unionByName(one)
    stored = F.when(F.col("pk") % 10 == 0, F.sha2(lit("old"), 256)).otherwise(F.col("chunk_text_hash"))
    return chunks.select("view_type", cat("view_type", lit("::"), "pk").alias("chunk_id"), "chunk_text_hash", F.when(stored == F.col("chunk_text_hash"), "same").otherwise("drift").alias("stored"))


@query("""
SELECT event_id, CASE WHEN event_id % 4 = 3 THEN NULL ELSE json_extract_string(props, '$.k')::INT END AS k,
  CASE WHEN event_id % 3 = 0 THEN 2 ELSE 0 END AS n_list, coalesce(CASE WHEN event_id % 4 = 3 THEN NULL ELSE json_extract_string(props, '$.k') END, event_type) AS k_or_type, CASE WHEN event_id % 2 = 0 THEN 'a,' || event_type ELSE '' END AS texts,
  strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS at FROM events""")
def json_cells(spark, t):
    """Lists, fields with a fallback and text values of JSON cells; bad cells are empty, not errors."""
    cell = F.when(F.col("event_id") % 4 == 3, "{broken").otherwise(F.col("props"))
    k = cases.json_field(cell, "$.missing", "$.k")
    as_list = F.when(F.col("event_id") % 3 == 0, '["x", "y"]').when(F.col("event_id") % 3 == 1, "no list")
    nested = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('{"k": {"n": ["a", 1]}, "t": "'), "event_type", F.lit('"}')))
    return t("events").select("event_id", k.try_cast("int").alias("k"), F.size(cases.json_list(as_list)).alias("n_list"), F.coalesce(k, "event_type").alias("k_or_type"), F.array_join(cases.json_texts(nested), ",").alias("texts"), cases.utc_text(F.col("ts")).alias("at"))


@query(r"""
WITH x AS (SELECT item_id, coalesce(text, '') AS raw FROM benchmark),
f AS (SELECT item_id, raw, trim(regexp_replace(raw, '[ \t\n\x0B\f\r]+', ' ', 'g'), ' ') AS folded FROM x)
SELECT item_id, sha256(folded) AS folded, contains(folded, replace(substr(folded, 5, 30), '.', '.')) AS held,
  len(list_filter(list_transform(regexp_split_to_array(folded, '[,.;!?]'), lambda p: trim(p, ' ')), lambda p: length(p) >= 8)[1:5]) AS n_phrases FROM f""")
def folded_phrases(spark, t):
    """Texts with marks folded, strict containment after folding, and the first five phrases."""
    typographic = F.translate(F.coalesce("text", F.lit("")), ".,", "。，")
    folded = cases.folded(typographic)
    back = F.translate(F.col("f"), ",", ",")
    rows = t("benchmark").select("item_id", folded.alias("f"))
    return rows.select("item_id", F.sha2("f", 256).alias("folded"), F.contains(back, F.substring("f", 5, 30)).alias("held"), F.size(F.slice(text.phrases(F.col("f"), 8), 1, 5)).cast("long").alias("n_phrases"))


@query("""
SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN true WHEN p_size % 4 = 1 THEN contains(p_name, 'widget') WHEN p_size % 4 = 2 THEN contains(p_name, 'gear') OR contains(p_name, 'cold') ELSE contains(p_name, 'g') END AS anchored FROM part""")
def anchor_match(spark, t):
    size = F.col("p_size")
    anchor = F.when(size % 4 == 0, " § ").when(size % 4 == 1, "6.1 widget").when(size % 4 == 2, "§gear + cold").otherwise("g")
    return t("part").select("p_partkey", cases.anchored(anchor, F.col("p_name")).alias("anchored"))


@query("""
WITH d AS (SELECT doc_id, coalesce(text, '') AS b, coalesce(n_chars, 0) AS n, CASE doc_id % 5 WHEN 0 THEN 'covered_by_pack' WHEN 1 THEN 'unprocessable' ELSE 'pending_decision' END AS s, CASE WHEN doc_id % 7 = 0 THEN '#C1 card' WHEN doc_id % 11 = 0 THEN 'never do' ELSE 'plain' END AS h FROM documents),
k AS (SELECT *, lower(h || chr(10) || substr(b, 1, 500)) AS f FROM d),
m AS (SELECT *, contains(f, 'the')::INT + contains(f, 'que')::INT AS n2, contains(f, 'oux')::INT + contains(f, 'elle')::INT AS n3 FROM k)
SELECT doc_id, CASE WHEN s = 'unprocessable' THEN 'L_NA' WHEN s = 'covered_by_pack' THEN CASE WHEN n2 > 0 THEN 'L2' ELSE 'L1' END WHEN h = 'never do' OR n < 100 THEN 'L_NA' WHEN n3 > 0 THEN 'L3' WHEN n2 > 0 OR h = '#C1 card' THEN 'L2' ELSE 'L1' END AS layer,
  CASE WHEN s = 'unprocessable' THEN 'high' WHEN s = 'covered_by_pack' THEN CASE WHEN n2 > 0 THEN 'low' ELSE 'high' END WHEN h = 'never do' THEN 'high' WHEN n < 100 THEN 'medium' WHEN n3 = 2 THEN 'high' WHEN n3 = 1 THEN 'low'
    WHEN n2 = 2 OR h = '#C1 card' THEN 'high' WHEN n2 = 1 THEN 'low' WHEN n >= 300 THEN 'medium' ELSE 'low' END AS confidence FROM m""")
def layer_decisions(spark, t):
    id_ = F.col("doc_id")
    status = F.when(id_ % 5 == 0, "covered_by_pack").when(id_ % 5 == 1, "unprocessable").otherwise("pending_decision")
    heading = F.when(id_ % 7 == 0, "#C1 card").when(id_ % 11 == 0, "never do").otherwise("plain")
    found = cases.layer_decision(status, heading, F.col("text"), F.coalesce("n_chars", F.lit(0)), ["the", "que"], ["oux", "elle"], ["never do"])
    return t("documents").select("doc_id", found.alias("x")).select("doc_id", "x.layer", "x.confidence")


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'Owner' || o_custkey ELSE o_orderstatus END AS owner, CASE WHEN o_orderkey % 2 = 0 THEN 'f-' || o_orderkey ELSE o_orderstatus END AS field,
  CASE WHEN o_orderkey % 5 = 0 THEN 'to be added' ELSE 'First of ' || o_orderpriority END AS definition,
  CASE WHEN o_orderkey % 3 = 0 THEN 'a,b c' WHEN o_orderkey % 3 = 1 THEN 'x,y,z' ELSE '' END AS steps,
  CASE WHEN o_orderkey % 3 = 0 THEN 'v' || o_custkey ELSE NULL END AS k, 'PRE-' || o_orderkey AS id, substr(CASE WHEN o_orderkey % 4 = 0 THEN o_orderpriority ELSE 'parent text' END, 1, 300) AS inherited FROM orders""")
def repaired_cells(spark, t):
    """Fields back-filled from ids, first sentences, step lists, inline maps, prefixes, inheritance."""
    key, lit = F.col("o_orderkey"), F.lit
    id_ = F.when(key % 2 == 0, F.concat(lit("FD-Owner"), "o_custkey", lit("-f-"), key)).otherwise("none")
    given = F.when(key % 2 == 0, "").otherwise(F.col("o_orderstatus"))
    pattern = "^FD-([A-Za-z0-9_]+)-(.+)$"
    back = lambda i: F.coalesce(cases.filled(given), F.regexp_extract(id_, pattern, i))
    definition = F.when(key % 5 == 0, " ").otherwise(F.concat(lit("First of "), "o_orderpriority", lit("。 More. ")))
    step = F.when(key % 3 == 0, '["a", "b c"]').when(key % 3 == 1, " x; y\n;z ")
    mapped = F.when(key % 3 == 0, F.concat(lit("{a: 1, k: v"), "o_custkey", lit("}"))).otherwise("{}")
    bare = F.when(key % 2 == 0, key.cast("string")).otherwise(F.concat(lit("PRE-"), key))
    return t("orders").select(
        "o_orderkey", back(1).alias("owner"), back(2).alias("field"), cases.first_sentence(definition, 200, "to be added").alias("definition"),
        F.array_join(cases.steps(step), ",").alias("steps"), F.try_element_at(cases.inline_map(mapped), lit("k")).alias("k"),
        cases.prefixed(bare, "PRE-").alias("id"), cases.inherited(F.when(key % 4 == 0, F.col("o_orderpriority")).otherwise(" "), lit("parent text"), "none").alias("inherited"),
    )


@query("""
SELECT c_custkey, concat_ws(',', CASE WHEN c_custkey % 10 = 0 THEN 'ID' END, CASE WHEN c_mktsegment = 'BUILDING' THEN 'SEGMENT' END, CASE WHEN c_acctbal < 0 THEN 'BALANCE' END) AS triggers,
  CASE WHEN c_custkey % 10 = 0 OR c_mktsegment = 'BUILDING' OR c_acctbal < 0 THEN 'true_positive' WHEN c_nationkey = 3 THEN 'false_positive' ELSE 'clean' END AS verdict,
  CASE c_nationkey % 3 WHEN 0 THEN 'text' WHEN 1 THEN 'text,image' ELSE '' END AS input_types, 'customer' AS table_name FROM customer""")
def trigger_classes(spark, t):
    """Fired rules; none fired but a hit in the rationale is a false positive. Default arrays by key."""
    rules = [("ID", F.col("c_custkey") % 10 == 0), ("SEGMENT", F.col("c_mktsegment") == "BUILDING"), ("BALANCE", F.col("c_acctbal") < 0)]
    found = cases.fired(rules)
    method = F.element_at(F.array(F.lit("write"), F.lit("draw"), F.lit("odd")), (F.col("c_nationkey") % 3 + 1).cast("int"))
    defaults = cases.lookup(method, {"write": "text", "draw": "text,image"}, "")
    return t("customer").select("c_custkey", F.array_join(found, ",").alias("triggers"), F.when(F.size(found) > 0, "true_positive").when(F.col("c_nationkey") == 3, "false_positive").otherwise("clean").alias("verdict"), defaults.alias("input_types"), cases.table_name(F.lit("03_customer.csv")).alias("table_name"))


@query("""
WITH r AS (SELECT n_nationkey, 'ContentType = Long-' || CASE WHEN n_regionkey < 3 THEN 'form' ELSE 'odd' END || ' and ContentType=short;' || n_name AS x FROM nation)
SELECT n_nationkey, CASE WHEN contains(x, 'form') THEN 'long_form,short' ELSE 'short' END AS tokens FROM r""")
def harvested_tokens(spark, t):
    x = F.concat(F.lit("ContentType = Long-"), F.when(F.col("n_regionkey") < 3, "form").otherwise("odd"), F.lit(" and ContentType=short;"), "n_name")
    return t("nation").select("n_nationkey", F.array_join(cases.harvested(x, r"ContentType\s*=\s*([A-Za-z0-9_-]+)", ["long_form", "short"]), ",").alias("tokens"))
