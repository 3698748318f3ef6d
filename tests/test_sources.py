"""Scans and sinks on small files."""

import json

import pytest
from pyspark.sql import functions as F

from lorequarry.sources import readers, writers


def test_csv_forms(spark, tmp_path):
    (tmp_path / "a.csv").write_text('b,a\n" x ",\n"y,""z""",2\n')
    header, rows = readers.csv_positional(spark, str(tmp_path / "a.csv"))
    assert header == ["b", "a"] and [tuple(r) for r in rows.collect()] == [(" x ", ""), ('y,"z"', "2")]
    assert [tuple(r) for r in readers.stripped(rows).collect()] == [("x", ""), ('y,"z"', "2")]
    assert readers.csv_table(spark, str(tmp_path / "no.csv"), "a int", missing_ok=True).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.csv_table(spark, str(tmp_path / "no.csv"), "a int").count()
    (tmp_path / "r.csv").write_text("k,v\n1,x\n2,y,z\n3,a,b,c\n")
    _, bad = readers.csv_repairable(spark, str(tmp_path / "r.csv"), "k int, v string")
    assert [r["cells"] for r in readers.joined_overflow(bad, 2, 1).collect()] == [["2", "y,z"]]


def test_header_faults(spark, tmp_path):
    for name, raw in {"good": b"k,v\n1,2\n", "bom": b"\xef\xbb\xbfk,v\n", "crlf": b"k,v\r\n", "head": b"v,k\n"}.items():
        (tmp_path / f"{name}.csv").write_bytes(raw)
    found = {r["path"].split("/")[-1]: r["errors"] for r in readers.header_faults(spark, str(tmp_path), ["k", "v"]).collect()}
    assert found == {"bom.csv": ["bom"], "crlf.csv": ["crlf"], "head.csv": ["header"]}


def test_documents_by_folder(spark, tmp_path):
    for folder, name, text in (("brand_a", "p1", '{"x": [1, {"y": "z"}]}'), ("domain_general", "p1", "{}"), ("domain_general", "p2", '{"q": 1}'), ("other", "p3", "[]")):
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / f"{name}.json").write_text(text)
    files = readers.whole_texts(spark, str(tmp_path), "*.json")
    assert files.count() == 4 and readers.whole_texts(spark, str(tmp_path), "*.json", ["brand_a", "none"]).count() == 1
    assert readers.whole_texts(spark, str(tmp_path), folders=["none"]).count() == 0
    docs = readers.parsed(readers.whole_texts(spark, str(tmp_path), "*.json", ["brand_a", "domain_general"]), json.loads)
    asked = spark.createDataFrame([("p1.json",), ("p2.json",), ("p9.json",)], "name string")
    got = {r["name"]: (r["folder"], r["doc"]) for r in readers.by_folder(docs, asked, ["domain_general", "brand_a"]).collect()}
    assert got == {"p1.json": ("domain_general", "{}"), "p2.json": ("domain_general", '{"q": 1}'), "p9.json": (None, None)}
    with pytest.raises(Exception, match="no mapping"):
        readers.parsed(files, json.loads).collect()
    assert readers.config(spark, str(tmp_path / "domain_general" / "p2.json"), ["q"]) == {"q": 1}
    with pytest.raises(ValueError, match="lacks"):
        readers.config(spark, str(tmp_path / "domain_general" / "p2.json"), ["z"])
    out = readers.as_markdown(docs.where("folder = 'brand_a'"), "doc").first()["markdown"]
    assert out == "# x\n- 1\n## y\nz"


def test_markdown_scans(spark, tmp_path):
    (tmp_path / "t.md").write_text("---\ntitle: 'A b'\ntags: [x, \"y\"]\nparts:\n  - p q\n  - r\ndone: true\n---\n| id | state |\n|----|:---:|\n| 1 | ok |\n| 2 | pending |\n| too | many | cells |\nsource_md: \"a/b.md\"\nsource_md: c\n")
    path = str(tmp_path / "t.md")
    assert [(r["id"], r["state"]) for r in readers.markdown_table(spark, path, ["id", "state"], "pending").collect()] == [("1", "ok")]
    assert readers.first_field(spark, path, "source_md").first()["value"] == "a/b.md"
    assert readers.first_field(spark, path, "nothing").first()["value"] is None
    got = {r["key"]: (r["value"], r["items"]) for r in readers.front_matter(spark, path).collect()}
    assert got["title"] == ("A b", None) and got["tags"][1] == ["x", "y"] and got["parts"] == ("", ["p q", "r"]) and got["done"] == ("true", None)
    (tmp_path / "r.txt").write_text("head\n[S1 source]\n  status: pass\nx\n[S2 gate]\nstatus: fail\n[S3 none]\n")
    assert [(r["gate"], r["status"]) for r in readers.gate_statuses(spark, str(tmp_path / "r.txt")).collect()] == [("S1", "pass"), ("S2", "fail"), ("S3", None)]


def test_publish_moves_the_pointer_last(spark, tmp_path):
    root, one = str(tmp_path / "pub"), spark.range(3)
    writers.publish({"a": one, "b": one}, root, "v1")
    with pytest.raises(Exception, match="boom|raise_error"):
        writers.publish({"a": spark.range(5), "b": one.select(F.raise_error(F.lit("boom")).alias("id"))}, root, "v2")
    assert writers.published(spark, root, "a").count() == 3
    writers.publish({"a": spark.range(4), "b": one}, root, "v3")
    assert writers.published(spark, root, "a").count() == 4
    writers.point(spark, root, "v1")
    assert writers.published(spark, root, "a").count() == 3
    with pytest.raises(ValueError):
        writers.point(spark, root, "v9")


def test_appends_keep_the_first_of_a_key(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = spark.createDataFrame([(1, 9, "late"), (1, 2, "first"), (2, 1, "x")], "k int, at int, v string")
    writers.append_unseen(rows, path, ["k"], ["at"])
    writers.append_unseen(rows.withColumn("v", F.lit("new")).union(spark.createDataFrame([(3, 1, "y")], "k int, at int, v string")), path, ["k"], ["at"])
    assert {(r["k"], r["v"]) for r in spark.read.parquet(path).collect()} == {(1, "first"), (2, "x"), (3, "y")}


def test_sorted_csv_and_unchanged_writes(spark, tmp_path):
    df = spark.createDataFrame([(2, ["b", "a"], {"z": 1, "a": 2}, True, None), (1, [], {}, False, 'q"')], "k int, l array<string>, m map<string,int>, f boolean, t string")
    writers.csv_sorted(df, str(tmp_path / "c"), ["k", "l", "m", "f", "t"], ["k"])
    text = "".join(p.read_text() for p in sorted((tmp_path / "c").glob("part-*")))
    assert text.replace("k,l,m,f,t\n", "") == '1,[],{},false,"q"""\n2,"[""b"",""a""]","{""a"":2,""z"":1}",true,\n'
    stamped = lambda x: df.select("k", "t").withColumn("at", F.lit(x))
    assert [writers.write_if_changed(stamped(x), str(tmp_path / "w"), ["at"]) for x in (1, 2)] == [True, False]
    assert writers.write_if_changed(stamped(3).limit(1), str(tmp_path / "w"), ["at"])


def test_upserts_and_guards(spark, tmp_path):
    space = "6ba7b811-9dad-11d1-80b4-00c04fd430c8"
    rows = lambda v: spark.createDataFrame([("a", v, v), ("b", 1, v)], "chunk_id string, at int, v int")
    writers.upsert(rows(1), str(tmp_path / "u"), "v1", "chunk_id", space, "at")
    got = writers.upsert(rows(2), str(tmp_path / "u"), "v2", "chunk_id", space, "at").collect()
    assert {r["chunk_id"]: r["v"] for r in got}["a"] == 2 and len(got) == 2 and all(len(r["point_id"]) == 36 for r in got)
    assert writers.table_ddl(spark.range(1), "t", "it's") == "CREATE TABLE IF NOT EXISTS serving.t (id BIGINT) USING PARQUET COMMENT 'it''s'"
    with pytest.raises(ValueError):
        writers.table_ddl(spark.range(1), "t; drop", "x")
    writers.guard_read_only("SELECT 'drop; it' FROM t;")
    for bad in ("DELETE FROM t", "SELECT 1; DROP TABLE t", "WITH x AS (SELECT 1) INSERT INTO t SELECT * FROM x", ""):
        with pytest.raises(ValueError):
            writers.guard_read_only(bad)
    with pytest.raises(ValueError):
        writers.guard_schema("INSERT INTO old.t SELECT 1", ["old"])
    with pytest.raises(ValueError):
        writers.guard_path("/tmp/x", "/log")
    writers.ledger(spark, str(tmp_path / "l"), "v1", {"who": "me"})
    with pytest.raises(ValueError):
        writers.ledger(spark, str(tmp_path / "l"), "", {})
    spark.range(3).write.mode("overwrite").option("path", str(tmp_path / "t")).saveAsTable("some_rows")
    assert {r["name"]: r["n"] for r in readers.table_counts(spark, ["some_rows", "no_rows"]).collect()} == {"some_rows": 3, "no_rows": None}
    spark.sql("DROP TABLE some_rows")


def test_reconcile_replays_what_the_mirror_lacks(spark, tmp_path):
    log, mirror, sent = spark.range(5).toDF("k"), spark.createDataFrame([(0,), (1,), (9,)], "k long"), []
    assert writers.reconcile(log, mirror, "k", lambda df: sent.extend(r["k"] for r in df.collect()), str(tmp_path / "o")) == (3, 1)
    assert sorted(sent) == [2, 3, 4] and spark.read.json(str(tmp_path / "o")).count() == 3
