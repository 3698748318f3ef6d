"""Components against union-find: chains, hubs with hot sides, random graphs, odd edges."""

import random

import pytest

from lorequarry.llm import components as C


def settled(edges):
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            one, two = sorted((top(a), top(b)))
            up[two] = one
    return {x: top(x) for x in list(up)}


def graph(kind):
    rng = random.Random(kind)
    if kind == "chain":
        ids = rng.sample(range(1000), 60)
        return list(zip(ids, ids[1:]))
    if kind == "hubs":  # a middle hub with lesser and greater neighbours, tied to another
        return [(500, x) for x in range(400, 600) if x != 500] + [(900, x) for x in range(1000, 1200)] + [(900, 599)]
    if kind == "random":
        return [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    return [(1, 1), (2, 1), (1, 2), (None, 3), (4, None), (-5, 2), (2**62, -5)]


@pytest.mark.parametrize("least_hot", [20, 10**6])
@pytest.mark.parametrize("kind", ["chain", "hubs", "random", "odd"])
def test_components_equal_union_find(spark, monkeypatch, kind, least_hot):
    monkeypatch.setattr(C, "LEAST_HOT", least_hot)
    edges = graph(kind)
    rows = C.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(rows) == len({r["node"] for r in rows})
    assert {r["node"]: r["component"] for r in rows} == settled(edges)


def test_no_edges(spark):
    assert C.components(spark.createDataFrame([], "a long, b long")).count() == 0
