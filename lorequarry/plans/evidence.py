"""Evidence whose place no key names: phrases, quotes and vectors against whole tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text
from ..operators import ann, phrases
from .catalog import query

PIECES = """p AS (SELECT DISTINCT item_id, p FROM (SELECT item_id, trim(unnest(regexp_split_to_array(text, '[,.;!?]')), ' ') AS p FROM benchmark) WHERE length(p) >= {least})"""


def _pieces(t, least: int):
    """(item_id, p): what stands between the marks of the benchmark's items."""
    return t("benchmark").select("item_id", F.explode(text.phrases(F.col("text"), least)).alias("p"))


@query(f"""
WITH {PIECES.format(least=16)}
SELECT doc_id, item_id, count(*) AS n, min(instr(text, p)) - 1 AS first_at FROM documents JOIN p ON contains(text, p) GROUP BY 1, 2""")
def phrase_documents(spark, t):
    """The documents that hold phrases of a benchmark item, how many, and where the first stands."""
    hits = phrases.find(t("documents"), "doc_id", "text", _keyed(_pieces(t, 16)), "k", "p")
    return hits.groupBy("doc_id", F.col("k.item_id").alias("item_id")).agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first_at"))


def _keyed(pieces):
    """A piece is met once in a document, however many items share it."""
    return pieces.select(F.struct("item_id", "p").alias("k"), "p")


@query(f"""
WITH {PIECES.format(least=6)},
c AS (SELECT item_id FROM benchmark b WHERE EXISTS (SELECT 1 FROM documents d WHERE contains(d.text, b.text))),
h AS (SELECT DISTINCT item_id, doc_id FROM p JOIN documents ON contains(text, p) WHERE item_id NOT IN (SELECT item_id FROM c))
SELECT b.item_id, count(doc_id) AS n, coalesce(array_to_string(list(doc_id ORDER BY doc_id) FILTER (WHERE doc_id IS NOT NULL)[1:5], ','), '') AS ids
FROM (SELECT DISTINCT item_id FROM benchmark WHERE item_id NOT IN (SELECT item_id FROM c)) b LEFT JOIN h ON h.item_id = b.item_id GROUP BY 1""")
def uncovered_references(spark, t):
    """Items that no document holds whole, with the documents that still hold a piece: how many, the first five."""
    docs, items = t("documents"), t("benchmark").select("item_id", F.col("text").alias("p"))
    wanted = items.withColumn("whole", F.lit(True)).unionByName(_pieces(t, 6).withColumn("whole", F.lit(False)))
    hits = phrases.find(docs, "doc_id", "text", wanted.select(F.struct("item_id", "whole").alias("k"), "p"), "k", "p").select("doc_id", "k.*").distinct()
    left = items.select("item_id").distinct().join(hits.where("whole").select("item_id").distinct(), "item_id", "left_anti")
    named = hits.where("NOT whole").join(left, "item_id", "left_semi")
    n = named.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy("doc_id"))  # five rows leave a task for each item
    first = named.withColumn("r", rank).where("r <= 5").groupBy("item_id").agg(F.array_join(F.array_sort(F.collect_list("doc_id")), ",").alias("ids"))
    return left.join(n, "item_id", "left").join(first, "item_id", "left").select("item_id", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("ids", F.lit("")).alias("ids"))


@query(None)
def cited_overlaps(spark, t):
    """The longest piece of each benchmark item in each document that holds a phrase of it: where it
    begins, how long it is, its share of the item in percent, and the line. SQL has no longest common substring."""
    cited = phrases.find(t("documents"), "doc_id", "text", _pieces(t, 16), "item_id", "p").select("doc_id", "item_id").distinct()
    # quotes go to the pairs by item, short rows; documents' texts are shuffled by document alone
    pairs = cited.join(t("benchmark").select("item_id", F.col("text").alias("quote")), "item_id").join(t("documents").select("doc_id", "text"), "doc_id")
    found = pairs.withColumn("x", text.longest_overlap(F.col("text"), F.col("quote")))
    line = F.size(F.split(F.substr("text", F.lit(1), F.col("x.start")), "\n"))
    return found.select("doc_id", "item_id", "x.start", "x.length", F.floor(100 * F.col("x.length") / F.char_length("quote")).alias("percent"), line.alias("line"))


@query(None)
def vector_lists_topk(spark, t):
    """The eight nearest that a payload filter leaves, for every id divisible by 50, by inverted
    lists. Approximate, so no SQL; the tests hold it to a recall of 0.9."""
    corpus = t("embeddings").withColumn("gate_status", F.when(F.col("vec_id") % 4 == 0, "draft").otherwise("active"))
    lists = ann.train(corpus)
    found = ann.search(ann.assign(corpus, lists), lists, corpus.where("vec_id % 50 = 0"), 8, F.col("gate_status") == "active")
    return found.select("query_id", "vec_id", "rank")
