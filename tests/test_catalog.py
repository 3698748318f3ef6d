"""Each query against its SQL on the smallest tables, and the operators' edge cases."""

import duckdb
import pytest
from pyspark.sql import functions as F

from lorequarry.operators import gates, relate, retrieval, rollup, scope, vectors
from lorequarry.plans import catalog
from lorequarry.sources import readers, writers

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events embeddings documents pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", catalog.ORACLES)
def test_against_sql(spark, con, name):
    df = catalog.QUERIES[name](spark, SMALL)
    found = con.execute(catalog.ORACLES[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    rows = df.collect()
    assert rows and _rows(df.columns, rows) == _rows(columns, found.fetchall())


def test_longest_overlaps_equal_brute_force(spark):
    """Each turn's longest common piece with the turn before it, by trying all pieces."""
    got = {(r["conv_id"], r["turn"]): r["length"] for r in catalog.QUERIES["longest_overlaps"](spark, SMALL).collect()}
    rows = spark.read.parquet(f"{SMALL}/conversations.parquet").orderBy("conv_id", "turn").limit(12).collect()
    fold = lambda t: " ".join((t or "").split())
    for a, b in zip(rows, rows[1:]):
        if a["conv_id"] == b["conv_id"]:
            x, y = fold(b["text"]), fold(a["text"])
            best = next((n for n in range(min(len(x), len(y)), 0, -1) if any(y[i : i + n] in x for i in range(len(y) - n + 1))), 0)
            assert got[b["conv_id"], b["turn"]] == best


def test_head_bounds(spark):
    df = spark.range(1200)
    with pytest.raises(ValueError):
        scope.head(df, ["id"], 0)
    assert scope.head(df, ["id"], 5000).count() == scope.MAX_ITEMS and scope.head(df, ["id"], 1100, None).count() == 1100


def test_scope_never_opens(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "brand_layer string, rank int")
    assert scope.scoped(df, {"brand_layer": ["a"]}, {"none": ["x"]}).count() == 1
    for required in ({"tenant": ["a"]}, {"brand_layer": []}):
        with pytest.raises(ValueError):
            scope.scoped(df, required)
    with pytest.raises(ValueError):
        retrieval.payload_filter([])
    assert scope.first_per(df, ["brand_layer"], ["rank"]).columns == ["brand_layer", "rank"]


def test_rerank_is_held_to_the_candidates(spark):
    near = spark.createDataFrame([(1, 0.1), (2, 0.2), (3, 0.3)], "id int, score double")
    best = retrieval.rerank(near, lambda d: d.where("id <> 3").withColumn("rerank_score", F.lit(0.0)), "id", 2)
    assert [r["id"] for r in best.collect()] == [1, 2]
    with pytest.raises(ValueError, match="its own"):
        retrieval.rerank(near, lambda d: d.withColumn("id", F.col("id") + 1).withColumn("rerank_score", F.lit(0.0)), "id", 2)


def test_levels_leave_cycles_out(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (1, 3), (5, 6), (6, 5), (6, 7)], "parent long, child long")
    assert {r["node"]: r["level"] for r in relate.levels(edges).collect()} == {1: 0, 2: 1, 3: 2}
    assert relate.levels(edges.limit(0)).count() == 0


def test_empty_gates_fail_and_empty_replays_pass(spark):
    counts = spark.createDataFrame([("a", 3)], "view string, n long")
    none = spark.createDataFrame([], "gate string, n long")
    assert gates.verdicts(counts, none, ["S1"], ["a", "b"]).first()["verdict"] == "fail"
    assert gates.verdicts(counts, none, ["S1"], ["a"]).first()["verdict"] == "pass"
    assert tuple(gates.replay_rate(spark.createDataFrame([], "code int")).first()) == (0, 0, 0.0, True)


def test_drop_reason_takes_null_as_failed(spark):
    df = spark.createDataFrame([(None,), (1,)], "x int")
    reasons = {r[0] for r in df.select(scope.drop_reason([("first", F.col("x") > 0)])).collect()}
    assert reasons == {"first", "kept"}


def test_below_ends_on_a_cycle(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (8, 9)], "parent long, child long")
    assert {r[0] for r in relate.below(edges, spark.createDataFrame([(1,)], "node long")).collect()} == {1, 2, 3}


def test_difference_with_nulls(spark):
    a = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "k int, v string")
    b = spark.createDataFrame([(1, None), (2, "z"), (4, "y")], "k int, v string")
    assert {r["k"]: r["status"] for r in relate.difference(a, b, ["k"], ["v"]).collect()} == {1: "same", 2: "mismatch", 3: "only_left", 4: "only_right"}


def test_signature_ignores_order_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "k int, v string")
    sign = lambda d: rollup.table_signature(d, ["k", "v"]).first()
    assert sign(df) == sign(df.orderBy(F.desc("k")).repartition(3)) != sign(df.distinct())
    assert sign(df.limit(0))["n_rows"] == 0


def test_vectors_without_length_are_left_out(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, [1.0, 1.0])], "vec_id int, embedding array<float>")
    assert [r["vec_id"] for r in vectors.top_k(df, [2.0, 0.0], 5).collect()] == [2, 3]


def test_vector_search_of_many_equals_brute_force(spark, monkeypatch):
    """Ties, more queries and rows than a block, odd vectors, fewer rows than k."""
    monkeypatch.setattr(vectors, "QUERY_BLOCK", 3)
    monkeypatch.setattr(vectors, "ROW_BLOCK", 5)
    rows = [(i, [float(i % 3), float(i % 4), 1.0]) for i in range(40)]
    odd = [(90, None), (91, [0.0, 0.0, 0.0]), (92, [1.0, None, 1.0]), (93, [1.0, 2.0]), (None, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame([*reversed(rows), *odd], "vec_id long, embedding array<float>").repartition(3)

    def cosine(a, b):
        return round(sum(x * y for x, y in zip(a, b)) / (sum(x * x for x in a) ** 0.5 * sum(y * y for y in b) ** 0.5), 9)

    for k in (1, 7, 60):
        want = {(q, r, i) for q, v in rows if q % 5 == 0 for r, (_, i) in enumerate(sorted((-cosine(v, w), i) for i, w in rows)[:k], 1)}
        got = [(r["query_id"], r["rank"], r["vec_id"]) for r in vectors.top_k_each(df, df.where("vec_id % 5 = 0"), k).collect()]
        assert len(got) == len(set(got)) and {x for x in got if x[0] < 90} == want
    assert vectors.top_k_each(df, df.limit(0), 3).count() == 0 and vectors.top_k_each(df.limit(0), df, 3).count() == 0



def test_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,v\n1,"two\nlines"\n2,"a ""b"""\n')
    assert {r["k"]: r["v"] for r in readers.csv_table(spark, str(tmp_path / "a.csv"), "k int, v string").collect()} == {1: "two\nlines", 2: 'a "b"'}
    (tmp_path / "b.csv").write_text("k,v\n1,x\n2,y,z\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        readers.csv_table(spark, str(tmp_path / "b.csv"), "k int, v string").collect()
    good, bad = readers.csv_repairable(spark, str(tmp_path / "b.csv"), "k int, v string")
    assert [r["k"] for r in good.collect()] == [1] and bad.first()["raw"] == "2,y,z"
    (tmp_path / "c.jsonl").write_text('{"k": 1}\n\n{"k": 2}\n')
    assert readers.json_lines(spark, str(tmp_path / "c.jsonl"), "k int").count() == 2
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "x.md").write_text("lead\n# One\nbody\n## Two\n")
    assert [(r["title"], r["level"], r["body"]) for r in readers.sections(spark, str(tmp_path / "d")).orderBy("pos").collect()] == [(None, 0, "lead"), ("One", 1, "body"), ("Two", 2, "")]
    assert readers.inventory(spark, str(tmp_path / "d")).first()["size"] == 23


def test_append_twice_adds_once(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "k int, v string")
    for _ in range(2):
        writers.append_unseen(rows, str(tmp_path / "log"), ["k"])
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2
    assert writers.publish({"t": rows}, str(tmp_path), "v1") == {"t": 3}
    with pytest.raises(ValueError):
        writers.publish({"t": rows}, str(tmp_path), "")


def test_hot_key_spans_ranges(spark):
    """Running values of a key with most rows (and of null) are carried from range to range."""
    rows = [(1 if i % 4 else None if i % 8 else i, i, "m" if i in (5, 12, 300) else None if i % 7 == 0 else f"v{i}") for i in range(800)]
    df = spark.createDataFrame(rows, "k long, i long, v string").repartition(5)
    assert relate.ranges(df, "k", ["i"]).where("k = 1").groupBy("_range").count().agg(F.max("count")).first()[0] < 400
    last, count, before = {}, {}, {}
    want = {}
    for k, i, v in rows:
        last[k] = i if v == "m" else last.get(k)
        count[k] = count.get(k, 0) + (v == "m")
        want[i] = (last[k], count[k], before.get(k))
        before[k] = v
    mark = F.col("v") == "m"
    a = {r["i"]: r["x"] for r in relate.latest_before(df, "k", ["i"], mark, "i", "x").collect()}
    b = {r["i"]: r["x"] for r in relate.running_count(df, "k", ["i"], mark, "x").collect()}
    c = {r["i"]: r["x"] for r in relate.row_before(df, "k", ["i"], "v", "x").collect()}
    assert {i: (a[i], b[i], c[i]) for i in a} == want
