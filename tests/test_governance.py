"""Edge cases of policies, gates, text expressions and the request log."""

import uuid

import pytest
from pyspark.sql import functions as F

from lorequarry.functions import cases, text
from lorequarry.operators import policy, quality, relate, rollup
from lorequarry.sources import writers
from lorequarry.streaming import log as stream_log


def _one(spark, column, **cells):
    schema = ", ".join(f"{k} string" for k in cells)
    return spark.createDataFrame([tuple(cells.values())], schema).select(column.alias("x")).first()["x"]


def test_fallback_rejects_unknown_inputs(spark):
    state = policy.fallback_state(F.col("b"), F.col("r"), F.col("s"), F.col("o") == "y")
    cases = {("complete", "complete", "complete", "y"): "brand_full_applied", ("missing", "missing", "complete", "n"): "blocked_missing_business_brief", ("odd", "complete", "complete", "y"): None, ("complete", "complete", "complete", None): None}
    for (b, r, s, o), expected in cases.items():
        assert _one(spark, state, b=b, r=r, s=s, o=o) == expected


def test_merge_actions(spark):
    rows = [(k, layer, i, v) for k in ("over", "app", "stop", "odd", "none") for i, (layer, v) in enumerate([("domain_general", "d"), ("brand_a", "b"), ("domain_general", "b"), ("", "z"), (None, "z"), ("brand_a", None)])]
    values = spark.createDataFrame(rows, "key string, layer string, ord int, value string")
    rules = spark.createDataFrame([("over", "override", False), ("app", "append", False), ("stop", "block", True), ("odd", "drop", True), ("unused", "append", True)], "key string, action string, allow_override boolean")
    merged, decisions = policy.merge(values, rules)
    found = {}
    for r in sorted(merged.collect(), key=lambda r: (r["is_base"], r["ord"])):
        found.setdefault(r["key"], []).append(r["value"])
    assert found == {"over": ["b"], "app": ["b", "d"], "stop": ["b"]}
    assert {r["key"]: r["decision"] for r in decisions.collect()} == {"over": "brand_wins_domain_rejected", "app": None, "stop": "blocked", "odd": "unknown_action_skipped"}


def test_missing_matrix_type_is_blocked(spark):
    out = policy.missing_fields(spark.createDataFrame([(1, "x"), (2, "y")], "request_id int, content_type string"), spark.createDataFrame([(1, "a")], "request_id int, field_key string"), spark.createDataFrame([("x", "a", "hard"), ("x", "b", "soft")], "content_type string, field_key string, required_level string"))
    assert {r["request_id"]: (r["missing_soft"], r["status"]) for r in out.collect()} == {1: (["b"], "brand_partial_fallback"), 2: ([], "blocked_missing_required_brand_fields")}


def test_texts(spark):
    space = uuid.uuid4()
    for name in ("a", "", "é😀"):
        assert _one(spark, text.uuid5(str(space), F.col("n")), n=name) == str(uuid.uuid5(space, name))
    assert _one(spark, text.compound_paths(F.col("p")), p="x.md & y.md") == ["x.md", "y.md"]
    assert _one(spark, text.compound_paths(F.col("p")), p=None) == []
    levels = {"## a": 2, "三、b": 2, "6 c": 2, "6.1.2 d": 4, "plain": None, "#none": None}
    for line, level in levels.items():
        assert _one(spark, text.heading_level(F.col("l")), l=line) == level
    for price, ok in {"12 to 20": True, "5 or 900": False, "none": False, None: False}.items():
        assert _one(spark, text.in_band(F.col("p"), 1, 100), p=price) is ok
    assert _one(spark, text.token(F.col("p")), p=" Ab c-D ") == "ab_c_d"
    assert _one(spark, text.casefold(F.col("a")) == text.casefold(F.col("b")), a="straße", b="STRASSE")
    assert _one(spark, cases.json_texts(F.col("j")), j='{"k": {"n": ["a\\"b", 1]}, "t": "c", "": "d"}') == ['a"b', "c", "d"]
    assert _one(spark, cases.folded(F.col("t")), t=" “a”、b。\t ​c ") == '"a",b. c'
    assert _one(spark, cases.steps(F.col("s")), s="[broken; x") == ["[broken", "x"]
    assert _one(spark, F.to_json(cases.inline_map(F.col("m"))), m="{a: 1, b: c:d}") == '{"a":"1","b":"c:d"}'
    assert _one(spark, F.size(cases.numbered(F.col("n").cast("int"))), n="0") == 0


@pytest.mark.parametrize("t, q, expected", [("say hello world", "xhello wx", (4, 7)), ("abab", "ab", (0, 2)), ("", "a", (-1, 0)), (None, "a", (-1, 0)), ("a", None, (-1, 0)), ("abc", "xyz", (-1, 0))])
def test_longest_overlap(spark, t, q, expected):
    assert tuple(_one(spark, text.longest_overlap(F.col("t"), F.col("q")), t=t, q=q)) == expected


def test_rules_take_null_as_broken(spark):
    df = spark.createDataFrame([(1, None, ""), (2, 3, "x"), (3, 9, " 4 ")], "k int, v int, c string")
    assert {r["k"]: r["errors"] for r in quality.violations(df, ["k"], {"small": F.col("v") < 5, "key": F.col("k") > 0}).collect()} == {1: ["small"], 3: ["small"]}
    assert {r["k"]: (r["c"], r["c_bad"]) for r in quality.coerce(df, {"c": "int"}).collect()} == {1: (None, None), 2: (None, "x"), 3: (4, None)}


def test_references_without_parents_are_not_judged(spark):
    df = spark.createDataFrame([(1, [5, 6, None]), (2, [])], "k int, refs array<int>")
    parents = spark.createDataFrame([(5,)], "id int")
    assert [tuple(r) for r in relate.orphan_refs(df, "k", "refs", parents, "id").collect()] == [(1, 6)]
    assert relate.orphan_refs(df, "k", "refs", parents.limit(0), "id").count() == 0


def test_sample_of_small_and_null_groups(spark):
    df = spark.createDataFrame([("a", 1)] + [("b", i) for i in range(30)] + [(None, 7), (None, 8), (None, 9)], "g string, id int")
    sizes = {r["g"]: r["count"] for r in rollup.stratified(df, "g", "id", 1).groupBy("g").count().collect()}
    assert sizes == {"a": 1, "b": 5, None: 2}


def test_log_rejects_a_known_key_and_keeps_what_the_mirror_lost(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a")], "request_id int, v string")
    path, outbox = str(tmp_path / "log"), str(tmp_path / "outbox")

    def broken(_):
        raise OSError("mirror is down")

    assert writers.log_rows(rows, path, "request_id", broken, outbox) == "pending"
    with pytest.raises(ValueError, match="request_id"):
        writers.log_rows(rows, path, "request_id")
    assert spark.read.parquet(path).count() == 1 and spark.read.json(outbox).first()["status"] == "pending"
    assert writers.log_rows(rows.withColumn("request_id", F.lit(2)), path, "request_id", lambda df: df.count()) == "mirrored"


def test_stream_appends_each_key_once(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "out")
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "request_id int, v string")
    for _ in range(2):
        rows.write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.schema).parquet(source)
        stream_log.append_stream(stream, path, ["request_id"], str(tmp_path / "state")).awaitTermination()
    assert spark.read.parquet(path).count() == 2
