"""Every registered query of the library proper, with its SQL.

The driver's tables stand for the views: o_orderstatus and c_mktsegment for scopes, orders and
line items for packs and evidence, events for the request log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import quality, relate, rollup, scope, vectors

QUERIES: dict = {}
ORACLES: dict = {}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None):
    """Register a function (spark, table) under its name beside its SQL, if SQL can express it."""

    def add(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(spark, lambda name: _read(spark, sf_dir, name))
        QUERIES[f.__name__].__doc__ = f.__doc__
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


@query("""
SELECT c_mktsegment, o_orderkey, o_totalprice, rn FROM (
  SELECT c_mktsegment, o_orderkey, o_totalprice,
         row_number() OVER (PARTITION BY c_mktsegment ORDER BY o_totalprice DESC, o_orderkey)::INT AS rn
  FROM orders JOIN customer ON o_custkey = c_custkey
  WHERE o_orderstatus = 'O' AND c_mktsegment IN ('BUILDING', 'MACHINERY')) WHERE rn <= 5""")
def scoped_topn(spark, t):
    orders = t("orders").where("o_orderstatus = 'O'").select("o_orderkey", "o_custkey", "o_totalprice")
    customer = scope.scoped(t("customer"), {"c_mktsegment": ["BUILDING", "MACHINERY"]}, {"no_such_column": ["x"]}).select("c_custkey", "c_mktsegment")
    view = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    rank = F.row_number().over(Window.partitionBy("c_mktsegment").orderBy(F.desc("o_totalprice"), "o_orderkey"))
    return view.withColumn("rn", rank).where("rn <= 5").select("c_mktsegment", "o_orderkey", "o_totalprice", "rn")


@query("SELECT p_partkey, p_brand, p_size FROM part WHERE p_brand IN ('Brand#12', 'Brand#23', 'Brand#34') AND p_size IN (1, 2, 3, 4, 5, 11, 12, 13, 14, 21, 22, 23, 31, 32, 33)")
def tenant_filter(spark, t):
    return scope.scoped(t("part"), {"p_brand": ["Brand#12", "Brand#23", "Brand#34"], "p_size": [1, 2, 3, 4, 5, 11, 12, 13, 14, 21, 22, 23, 31, 32, 33]}, {"no_such_column": ["active"]}).select("p_partkey", "p_brand", "p_size")


@query("""
SELECT drop_reason, count(*) AS n FROM (
  SELECT CASE WHEN NOT coalesce(c_mktsegment IN ('BUILDING', 'MACHINERY'), false) THEN 'scope'
              WHEN NOT coalesce(c_acctbal > 0, false) THEN 'inactive'
              WHEN NOT coalesce(c_nationkey < 12, false) THEN 'granularity' ELSE 'kept' END AS drop_reason FROM customer) GROUP BY 1""")
def drop_counters(spark, t):
    reason = scope.drop_reason([("scope", F.col("c_mktsegment").isin("BUILDING", "MACHINERY")), ("inactive", F.col("c_acctbal") > 0), ("granularity", F.col("c_nationkey") < 12)])
    return t("customer").groupBy(reason.alias("drop_reason")).agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT c_nationkey, c_custkey, c_name FROM (
  SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY CASE WHEN c_acctbal > 0 THEN 0 ELSE 1 END,
    CASE c_mktsegment WHEN 'BUILDING' THEN 0 WHEN 'MACHINERY' THEN 1 ELSE 2 END, c_custkey) AS r FROM customer) WHERE r = 1""")
def priority_pick(spark, t):
    order = [F.when(F.col("c_acctbal") > 0, 0).otherwise(1), F.when(F.col("c_mktsegment") == "BUILDING", 0).when(F.col("c_mktsegment") == "MACHINERY", 1).otherwise(2), "c_custkey"]
    return scope.first_per(t("customer"), ["c_nationkey"], order).select("c_nationkey", "c_custkey", "c_name")


@query("""
WITH n AS (SELECT o_custkey, count(*) AS n FROM orders WHERE o_totalprice > 250000 GROUP BY 1)
SELECT c_custkey AS o_custkey, coalesce(n, 0) AS n, CASE WHEN n = 1 THEN 'found' WHEN n IS NULL THEN 'not_found' ELSE 'ambiguous' END AS verdict FROM customer LEFT JOIN n ON c_custkey = o_custkey""")
def point_lookup(spark, t):
    asked = t("customer").select(F.col("c_custkey").alias("o_custkey"))
    return scope.exactly_one(asked, t("orders").where("o_totalprice > 250000"), ["o_custkey"])


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def view_head(spark, t):
    return scope.head(t("orders"), [F.desc("o_totalprice"), "o_orderkey"], 20).select("o_orderkey", "o_totalprice")


@query("SELECT p_partkey, p_name FROM part WHERE p_type ILIKE '%econ%' AND p_brand ILIKE 'brand_1%' AND p_size NOT IN (1, 2)")
def like_filters(spark, t):
    """LIKE folds case; `_` is any one character."""
    return t("part").where(F.col("p_type").ilike("%econ%") & F.col("p_brand").ilike("brand_1%") & ~F.col("p_size").isin(1, 2)).select("p_partkey", "p_name")


@query("""
SELECT c_custkey, concat_ws(',', CASE WHEN c_acctbal < 0 THEN 'balance' END, CASE WHEN NOT regexp_matches(c_name, '^Customer#[0-9]{9}$') THEN 'name' END,
  CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE') THEN 'segment' END) AS errors FROM customer
WHERE NOT regexp_matches(c_name, '^Customer#[0-9]{9}$') OR c_acctbal < 0 OR c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE')""")
def row_validation(spark, t):
    rules = {"name": F.col("c_name").rlike("^Customer#[0-9]{9}$"), "balance": F.col("c_acctbal") >= 0, "segment": F.col("c_mktsegment").isin("BUILDING", "MACHINERY", "AUTOMOBILE")}
    return quality.violations(t("customer"), ["c_custkey"], rules).select("c_custkey", F.array_join("errors", ",").alias("errors"))


@query("SELECT s_nationkey, count(*) AS n_lines, min(l_shipdate) AS first_ship FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F' GROUP BY 1")
def three_way_join(spark, t):
    lines, supplier = t("lineitem").select("l_orderkey", "l_suppkey", "l_shipdate"), t("supplier").select("s_suppkey", "s_nationkey")
    orders = t("orders").where("o_orderstatus = 'F'").select("o_orderkey")
    both = lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return both.groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n_lines"), F.min("l_shipdate").alias("first_ship"))


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL AND o_totalprice > 250000)")
def orphan_keys(spark, t):
    return relate.orphans(t("customer"), "c_custkey", t("orders").where("o_totalprice > 250000"), "o_custkey").select("c_custkey", "c_mktsegment")


@query("""
WITH a AS (SELECT c_custkey AS k, c_nationkey AS v FROM customer),
b AS (SELECT o_custkey + 7 AS k, (min(o_orderkey) % 25)::INT AS v FROM orders GROUP BY 1)
SELECT status, count(*) AS n FROM (SELECT CASE WHEN a.k IS NULL THEN 'only_right' WHEN b.k IS NULL THEN 'only_left'
  WHEN a.v IS NOT DISTINCT FROM b.v THEN 'same' ELSE 'mismatch' END AS status FROM a FULL JOIN b ON a.k = b.k) GROUP BY 1""")
def mirror_diff(spark, t):
    left = t("customer").select(F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("v"))
    right = t("orders").groupBy((F.col("o_custkey") + 7).alias("k")).agg((F.min("o_orderkey") % 25).cast("int").alias("v"))
    return relate.difference(left, right, ["k"], ["v"]).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT event_id, user_id, last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS)
  OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS last_purchase FROM events""")
def floor_lookup(spark, t):
    out = relate.latest_before(t("events").select("event_id", "user_id", "ts", "event_type"), "user_id", ["ts", "event_id"], F.col("event_type") == "purchase", "event_id", "last_purchase")
    return out.select("event_id", "user_id", "last_purchase")


@query("""
WITH RECURSIVE edges AS (SELECT p_partkey // 2 AS parent, p_partkey AS child FROM part WHERE p_partkey > 1),
down AS (SELECT p_partkey AS node FROM part WHERE p_size = 7 UNION SELECT child FROM down JOIN edges ON node = parent),
hit AS (SELECT child AS node FROM edges WHERE parent IN (SELECT node FROM down))
SELECT DISTINCT node FROM hit""")
def flagged_ancestors(spark, t):
    edges = t("part").where("p_partkey > 1").select(F.expr("p_partkey div 2").alias("parent"), F.col("p_partkey").alias("child"))
    return relate.below(edges, t("part").where("p_size = 7").select(F.col("p_partkey").alias("node")))


@query("""
SELECT k, src FROM (SELECT o_custkey AS k, 'old' AS src FROM orders WHERE o_orderkey % 4 = 0
UNION ALL SELECT k, 'new' FROM (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderkey % 4 <> 0) n
WHERE k NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 4 = 0))""")
def append_unseen_keys(spark, t):
    rows = t("orders").select(F.col("o_custkey").alias("k"), "o_orderkey")
    old = rows.where("o_orderkey % 4 = 0").select("k", F.lit("old").alias("src"))
    new = rows.where("o_orderkey % 4 <> 0").select("k", F.lit("new").alias("src"), "o_orderkey")
    return relate.append_new(old, new, ["k"], ["o_orderkey"])


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n, count(DISTINCT o_custkey) AS n_customers FROM orders GROUP BY 1, 2")
def group_counts(spark, t):
    return t("orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("o_custkey").alias("n_customers"))


@query("SELECT c_nationkey, string_agg(DISTINCT c_mktsegment, ',' ORDER BY c_mktsegment) AS segments, count(*) AS n FROM customer GROUP BY 1")
def sorted_sets(spark, t):
    return t("customer").groupBy("c_nationkey").agg(rollup.joined_set("c_mktsegment").alias("segments"), F.count(F.lit(1)).alias("n"))


@query("SELECT s.o_orderstatus, count(o.o_orderkey) AS n FROM (VALUES ('F'), ('O'), ('P'), ('Z')) s(o_orderstatus) LEFT JOIN orders o ON o.o_orderstatus = s.o_orderstatus GROUP BY 1")
def zero_filled_counts(spark, t):
    return rollup.zero_filled(t("orders"), "o_orderstatus", ["F", "O", "P", "Z"])


@query("SELECT l_suppkey, round(CASE WHEN count(*) = 0 THEN 0 ELSE 100.0 * count(*) FILTER (WHERE l_returnflag = 'R') / count(*) END, 1) AS pct_returned FROM lineitem GROUP BY 1")
def coverage_ratio(spark, t):
    return t("lineitem").groupBy("l_suppkey").agg(rollup.share(F.count_if(F.col("l_returnflag") == "R"), F.count(F.lit(1))).alias("pct_returned"))


@query("SELECT l_orderkey, arg_max(l_linenumber, (l_extendedprice, -l_linenumber)) AS line, max(l_extendedprice) AS price FROM lineitem GROUP BY 1")
def best_of_group(spark, t):
    return t("lineitem").groupBy("l_orderkey").agg(F.max_by("l_linenumber", F.struct("l_extendedprice", -F.col("l_linenumber"))).alias("line"), F.max("l_extendedprice").alias("price"))


@query("""
SELECT sum(n)::BIGINT AS n_rows, sha256(string_agg(s, '' ORDER BY p)) AS signature FROM (
  SELECT h[1:3] AS p, count(*) AS n, sha256(string_agg(h, '' ORDER BY h)) AS s FROM (
    SELECT sha256(o_orderkey::VARCHAR || chr(31) || o_custkey::VARCHAR || chr(31) || coalesce(o_orderstatus, '')) AS h FROM orders) GROUP BY 1)""")
def table_signature(spark, t):
    return rollup.table_signature(t("orders"), ["o_orderkey", "o_custkey", "o_orderstatus"])


@query("SELECT c_custkey, sha256(c_custkey::VARCHAR || chr(31) || coalesce(c_name, '') || chr(31) || coalesce(c_mktsegment, '')) AS h FROM customer")
def row_hashes(spark, t):
    return t("customer").select("c_custkey", rollup.row_hash(["c_custkey", "c_name", "c_mktsegment"]).alias("h"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(spark, t):
    return t("lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query("SELECT event_type, count(*) AS n, min(event_id) AS first_seen FROM events GROUP BY 1 ORDER BY n DESC, first_seen")
def most_common(spark, t):
    return t("events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_seen")).orderBy(F.desc("n"), "first_seen")


@query("""
SELECT before, event_type AS after, count(*) AS n FROM (SELECT event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events)
WHERE before IS NOT NULL GROUP BY 1, 2""")
def transition_matrix(spark, t):
    rows = relate.row_before(t("events").select("user_id", "ts", "event_id", "event_type"), "user_id", ["ts", "event_id"], "event_type", "before")
    return rows.select("before", F.col("event_type").alias("after")).where("before IS NOT NULL").groupBy("before", "after").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT event_id, user_id, sum(CASE WHEN event_type = 'login' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS section FROM events""")
def section_ids(spark, t):
    rows = t("events").select("event_id", "user_id", "ts", "event_type")
    return relate.running_count(rows, "user_id", ["ts", "event_id"], F.col("event_type") == "login", "section").select("event_id", "user_id", "section")


@query("SELECT event_id, user_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 15")
def latest_n(spark, t):
    return t("events").orderBy(F.desc("ts"), F.desc("event_id")).limit(15).select("event_id", "user_id", "event_type")


@query("SELECT user_id, arg_max(event_type, (ts, event_id)) AS state, max(event_id) AS top_id FROM events GROUP BY 1")
def last_writer_wins(spark, t):
    return t("events").groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("state"), F.max("event_id").alias("top_id"))


@query("""
SELECT 'nation' AS view_type, n_nationkey::BIGINT AS id, n_name AS name FROM nation UNION ALL SELECT 'region', r_regionkey, r_name FROM region
UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier""")
def union_views(spark, t):
    parts = [t(n).select(F.lit(n).alias("view_type"), F.col(k).cast("long").alias("id"), F.col(v).alias("name")) for n, k, v in (("nation", "n_nationkey", "n_name"), ("region", "r_regionkey", "r_name"), ("supplier", "s_suppkey", "s_name"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("(SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier) EXCEPT SELECT n_nationkey FROM nation WHERE n_regionkey = 1")
def set_algebra(spark, t):
    k = lambda name, c: t(name).select(F.col(c).alias("k"))
    return k("customer", "c_nationkey").intersect(k("supplier", "s_nationkey")).subtract(t("nation").where("n_regionkey = 1").select(F.col("n_nationkey").alias("k")))


@query("""
WITH q AS (SELECT embedding AS e FROM embeddings WHERE vec_id = (SELECT min(vec_id) FROM embeddings))
SELECT vec_id, label FROM embeddings, q WHERE label IN (0, 1, 2, 3)
ORDER BY list_cosine_similarity(embedding::DOUBLE[], e::DOUBLE[]) DESC, vec_id LIMIT 8""")
def vector_topk(spark, t):
    corpus = t("embeddings")
    asked = corpus.orderBy("vec_id").limit(1).first()["embedding"]
    return vectors.top_k(scope.scoped(corpus, {"label": [0, 1, 2, 3]}), asked, 8).select("vec_id", "label")


@query("""
SELECT * FROM (SELECT q.vec_id AS query_id, c.vec_id, row_number() OVER (PARTITION BY q.vec_id
  ORDER BY round(list_cosine_similarity(c.embedding::DOUBLE[], q.embedding::DOUBLE[]), 9) DESC, c.vec_id) AS rank
  FROM embeddings q, embeddings c WHERE q.vec_id % 50 = 0) WHERE rank <= 8""")
def vector_topk_each(spark, t):
    corpus = t("embeddings")
    return vectors.top_k_each(corpus, corpus.where("vec_id % 50 = 0"), 8).select("query_id", "vec_id", "rank")


@query("SELECT o_orderpriority, o_orderstatus, count(*) FILTER (WHERE o_orderstatus IN ('F','O')) AS allowed, count(*) FILTER (WHERE o_orderstatus NOT IN ('F','O')) AS leaked FROM orders GROUP BY 1, 2")
def leak_count(spark, t):
    ok = F.array_contains(F.array(F.lit("F"), F.lit("O")), F.col("o_orderstatus"))
    return t("orders").groupBy("o_orderpriority", "o_orderstatus").agg(F.count_if(ok).alias("allowed"), F.count_if(~ok).alias("leaked"))
