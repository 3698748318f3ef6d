"""Ordered operators on hot keys, scopes, closures and levels against plain Python."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lorequarry.operators import relate


@pytest.fixture
def hot(monkeypatch):
    """Keys of more than 50 rows count as hot, if they have two partitions' share."""
    monkeypatch.setattr(relate, "HOT_ROWS", 50)


@pytest.fixture(scope="module")
def rows(spark):
    """One key holds two thirds of the rows, one is null, the others have a few."""
    rnd = random.Random(3)
    made = [(1 if i % 3 else (None if i % 2 else rnd.randrange(2, 30)), i // 2, i, rnd.choice([None, "a", "b", "b"])) for i in range(1200)]
    return spark.createDataFrame(made, "k int, at long, i long, v string").repartition(5)


def _by_key(df):
    groups = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r["at"], r["i"])):
        groups[r["k"]].append(r)
    return groups


@pytest.mark.parametrize("which", ["usual", "hot"])
def test_ordered_operators(spark, rows, which, request):
    if which == "hot":
        request.getfixturevalue("hot")
        assert relate.hot_keys(rows, "k").count() == 1
    else:
        assert relate.hot_keys(rows, "k") is None
    got = {name: {r["i"]: r["x"] for r in df.collect()} for name, df in {
        "latest": relate.latest_before(rows, "k", ["at", "i"], F.col("v") == "a", "i", "x"),
        "before": relate.row_before(rows, "k", ["at", "i"], "v", "x"),
        "count": relate.running_count(rows, "k", ["at", "i"], F.col("v") == "b", "x"),
        "place": relate.place(rows, "k", ["at", "i"], "x"),
    }.items()}
    for group in _by_key(rows).values():
        last, before, n = None, None, 0
        for place, r in enumerate(group, 1):
            last, n = (r["i"] if r["v"] == "a" else last), n + (r["v"] == "b")
            assert (got["latest"][r["i"]], got["before"][r["i"]], got["count"][r["i"]], got["place"][r["i"]]) == (last, before, n, place)
            before = r["v"]


def _ends(rows):
    out = {}
    for i, (k, p, n) in enumerate(rows):
        later = [q for a, q, m in rows if k is not None and a == k and None not in (p, n, q, m) and q > p and m <= n]
        out[i] = min(later, default=None)
    return out


@pytest.mark.parametrize("which", ["usual", "hot"])
def test_scope_end(spark, which, request):
    if which == "hot":
        request.getfixturevalue("hot")
    rnd = random.Random(8)
    made = [(1 if i % 3 else rnd.choice([None, 2, 3]), rnd.choice([None, *range(300)]), rnd.choice([None, 1, 2, 3, 5, 40])) for i in range(700)]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(made)], "k int, p int, level int, i int").repartition(6)
    out = relate.scope_end(df, "k", "p", "level", "end")
    assert out.columns == ["k", "p", "level", "i", "end"] and relate.scope_end(df.limit(0), "k", "p", "level", "end").count() == 0
    assert {r["i"]: r["end"] for r in out.collect()} == _ends(made)


def test_scope_end_of_one_long_document(spark):
    """A key of 300,000 rows is cut into ranges; ends are those of one pass over all of it."""
    df = spark.range(300_000).select(F.lit(7).alias("k"), F.col("id").alias("p"), (F.xxhash64("id") % 6 + F.when(F.col("id") % 50_000 == 0, -100).otherwise(0)).alias("level"))
    got = {r["p"]: r["end"] for r in relate.scope_end(df, "k", "p", "level", "end").select("p", "end").collect()}
    stack = []
    for r in sorted(df.collect(), key=lambda r: -r["p"]):
        while stack and stack[-1][0] > r["level"]:
            stack.pop()
        assert got[r["p"]] == (stack[-1][1] if stack else None)
        stack.append((r["level"], r["p"]))


def _graph(edges):
    down, up = defaultdict(set), defaultdict(set)
    for a, b in edges:
        if a is not None and b is not None:
            down[a].add(b)
            up[b].add(a)
    return down, up


def _reached(edges, start):
    down, _ = _graph(edges)
    found, todo = set(), list(start)
    while todo:
        for b in down[todo.pop()] - found:
            found.add(b)
            todo.append(b)
    return found


def _levels(edges):
    down, up = _graph(edges)
    out = {a: 0 for a in list(down) if not up[a]}
    todo = list(out)
    while todo:
        for b in down[todo.pop()]:
            if b not in out and all(a in out for a in up[b]):
                out[b] = 1 + max(out[a] for a in up[b])
                todo.append(b)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_closures_and_levels_of_graphs(spark, seed):
    rnd = random.Random(seed)
    forest = [(rnd.randrange(max(0, b - 5), b), b) for b in range(1, 60) if b % 17]
    more = [(a, b) for a, b in ((rnd.randrange(60), rnd.randrange(60)) for _ in range((0, 12, 40, 25)[seed])) if a < b or seed == 3]
    edges = [*forest, *more, forest[0], (None, 3), (4, None)]
    edges += [(100, 101), (101, 102), (102, 100), (102, 103), (103, 104), (104, 30)] if seed % 2 else []
    start = [rnd.randrange(60), rnd.randrange(60), *([101] if seed % 2 else []), None]
    df = spark.createDataFrame(edges, "parent long, child long")
    got = [r[0] for r in relate.below(df, spark.createDataFrame([(s,) for s in start], "node long")).collect()]
    assert len(got) == len(set(got)) and set(got) == _reached(edges, [s for s in start if s is not None])
    placed = [tuple(r) for r in relate.levels(df).select("node", "level").collect()]
    assert len(placed) == len(dict(placed)) and dict(placed) == _levels(edges)


def test_a_long_chain_takes_few_rounds(spark):
    n = 100_000
    single = spark.range(1, n).select(F.col("id").alias("node"), (F.col("id") - 1).alias("up"))
    at, rounds = relate.climb(single, spark.createDataFrame([(40_000,)], "node long"))
    assert rounds <= 18
    assert at.where("hit").count() == n - 40_001 and at.where("open OR top <> 0 OR steps <> node").count() == 0
