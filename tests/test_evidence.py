"""Phrase search, overlaps and approximate vector search against brute force."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from lorequarry.functions.text import common_piece
from lorequarry.operators import ann, phrases, vectors
from lorequarry.plans import catalog

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("shard_bytes", [1 << 20, 100])
def test_find(spark, shard_bytes):
    """Nested, overlapping and shared phrases; one shard and several."""
    docs = [(1, "abcabc 👍 the end"), (2, None), (3, ""), (4, "ab"), (4, "ab"), (None, "the end the end"), (6, "x" * 300_000 + "bc")]
    wanted = [("a", "abc"), ("b", "bc"), ("c", "c 👍 the"), ("d", "the end"), ("e", "the end"), ("e", "the end"), ("e", "nd the"), ("f", None), ("g", ""), (None, "ab"), ("h", "zzz")]
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, key string, at int")
    got = phrases.find(df, "doc_id", "text", spark.createDataFrame(wanted, "key string, phrase string"), "key", "phrase", shard_bytes)
    want = sorted(str((i, k, t.find(p))) for i, t in docs for k, p in set(wanted) if k and t and p and p in t)
    assert sorted(str(tuple(r)) for r in got.collect()) == want
    assert phrases.find(df, "doc_id", "text", spark.createDataFrame([], "key string, phrase string"), "key", "phrase").count() == 0
    assert phrases.find(df.limit(0), "doc_id", "text", spark.createDataFrame(wanted, "key string, phrase string"), "key", "phrase").count() == 0


def _brute(t, q):
    for n in range(min(len(t), len(q)), 0, -1):
        at = [x for x in (t.find(q[i : i + n]) for i in range(len(q) - n + 1)) if x >= 0]
        if at:
            return min(at), n
    return -1, 0


def test_common_piece():
    rnd = random.Random(0)
    for _ in range(4000):
        letters = rnd.choice(["ab", "abc", "abcdefgh"])
        t, q = ("".join(rnd.choice(letters) for _ in range(rnd.randrange(25))) for _ in range(2))
        assert common_piece(t, q) == _brute(t, q)


def test_common_piece_is_linear():
    rnd = random.Random(0)
    t, q = ("".join(rnd.choice("abcdefgh ijk") for _ in range(n)) for n in (1_000_000, 10_000))
    began = time.process_time()
    start, n = common_piece(t, q)
    assert time.process_time() - began < 4 and t[start : start + n] in q


def test_cited_overlaps(spark):
    rows = catalog.QUERIES["cited_overlaps"](spark, SMALL).collect()
    docs, items = ({r[0]: r[1] for r in spark.read.parquet(f"{SMALL}/{n}.parquet").select(k, "text").collect()} for n, k in (("documents", "doc_id"), ("benchmark", "item_id")))
    assert rows
    for r in rows[:6]:
        assert (r["start"], r["length"]) == _brute(docs[r["doc_id"]], items[r["item_id"]])
        assert r["line"] == docs[r["doc_id"]][: r["start"]].count("\n") + 1


FILTERS = ["true", "label < 5", "vec_id % 4 <> 0", "label = 3", "vec_id % 7 = 1 AND label <> 2"]


@pytest.mark.parametrize("where", FILTERS)
def test_lists_recall(spark, where):
    """At least nine in ten of the exact nearest under each filter, whatever it leaves."""
    corpus = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    lists = ann.train(corpus)
    queries = corpus.where("vec_id % 50 = 0")
    pairs = lambda df: {(r["query_id"], r["vec_id"]) for r in df.collect()}
    want = pairs(vectors.top_k_each(corpus.where(where), queries, 8))
    got = pairs(ann.search(ann.assign(corpus, lists), lists, queries, 8, F.expr(where)))
    assert len(got & want) >= 0.9 * len(want)


def test_lists_prune_and_scores_are_exact(spark, tmp_path, monkeypatch):
    """Clustered vectors need few probes; a saved index reads only probed lists; small blocks change nothing."""
    rng = np.random.default_rng(4)
    heads = rng.normal(size=(40, 16)) * 4
    made = heads[rng.integers(0, 40, 3000)] + rng.normal(size=(3000, 16)) * 0.3
    rows = [(i, v) for i, v in enumerate(made.tolist())] + [(9001, None), (9002, [1.0]), (9003, [float("nan")] * 16), (9004, [0.0] * 16), (None, made[0].tolist()), (7, made[7].tolist())]
    corpus = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    lists = ann.train(corpus, lists=40)
    assert lists.probes_for(3000) <= 4 and lists.probes_for(1) == 40
    ann.save(ann.assign(corpus, lists), lists, str(tmp_path))
    index, again = ann.load(spark, str(tmp_path))
    assert np.array_equal(again.centers, lists.centers) and again.probes == lists.probes
    assert "PartitionFilters: [isnotnull(list" in index.where("list = 3")._jdf.queryExecution().executedPlan().toString()
    queries = corpus.where("vec_id % 50 = 0 OR vec_id > 9000")
    one = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in ann.search(index, again, queries, 5).collect()}
    monkeypatch.setattr(ann, "BLOCK", 7)
    assert one == {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in ann.search(index, again, queries, 5).collect()}
    exact = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in vectors.top_k_each(corpus, queries, 5).collect()}
    assert sum(one.get(q) == v for q, v in exact.items()) >= 0.9 * len(exact)
    assert ann.search(index, again, queries, 5, F.lit(False)).count() == 0
    none = corpus.limit(0)
    assert ann.search(ann.assign(none, ann.train(none)), ann.train(none), queries, 5).count() == 0
