"""Cases that were once wrong: long tags, WARC files of any version, ids beside nulls, fits' bounds."""

import gzip
import time

import numpy as np
import pytest

from lorequarry.llm import linededup, minhash, packing, quality, warc


@pytest.mark.parametrize("n", [20, 500, 50_000])
def test_a_tag_may_have_any_number_of_parts(n):
    page = "<p>one</p><div " + " ".join(f'a{i}="v"' for i in range(n)) + ' z="a > b">two</div>'
    assert warc.plain_text(page) == "one\ntwo"


def test_ends_of_tags():
    cases = {
        '<a title="x>y" href=\'/u\'>t</a>': ("t", ["/u"]),
        '<a title="x>y href=/u>t</a>': ("y href=/u>t", []),  # the quote never closes
        "<a b='1\"' href=\"/v\">t</a>": ("t", ["/v"]),
        '<p x=">">a</p>b < c > d': ("a\nb < c > d", []),
        "a <b": ("a <b", []),
    }
    for page, (text, links) in cases.items():
        assert (warc.plain_text(page), warc.page_facts(page)[2]) == (text, links), page


@pytest.mark.parametrize("part", ['<a =">"', '<a x="', "<a x='\">", "<a =\">\" ='>'", "<", "<a ", "<!--", "<a x=\"'>"])
def test_odd_pages_take_linear_time(part):
    took = []
    for n in (20_000, 80_000):
        began = time.process_time()
        warc.page_facts(part * n + ">")
        took.append(time.process_time() - began)
    assert took[1] < 12 * max(took[0], 0.05)


def _records(version, bodies):
    out = []
    for k, body in enumerate(bodies):
        raw = warc.response(f"http://a/{k}", body, f"{version}{k}", "2024-01-01T00:00:00Z")
        out.append(raw.replace(b"WARC/1.1", version.encode(), 1))
    return b"".join(out)


def test_warc_of_any_version(spark, tmp_path):
    """Versions may be mixed, bodies may hold what begins a record, or a whole one."""
    inner = _records("WARC/1.1", ["<p>inner</p>"]).decode()
    plain = ["<p>one</p>", "<p>two</p>\r\n\r\nWARC/1.1\r\nx", f"<p>three</p>{inner}<p>end</p>", "<p>four</p>\r\n\r\nWARC/1.0\r\nContent-Length: 9999\r\n\r\nz", ""]
    (tmp_path / "a.warc").write_bytes(_records("WARC/1.0", plain) + _records("WARC/1.1", plain[:2]))
    (tmp_path / "b.warc").write_bytes(_records("WARC/1.0", ["<p>b1</p>", "<p>b2</p>", "<p>b3</p>"]))
    (tmp_path / "c.warc.gz").write_bytes(b"".join(gzip.compress(_records(v, ["<p>" + "c" * 9000 + f"{v}</p>"])) for v in ("WARC/1.0", "WARC/1.1")))
    for block in ("134217728", "400"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", block)
        try:
            records = warc.read_warc(spark, str(tmp_path))
            assert records.count() == 7 + 3 + 2
            out = warc.derivatives(records).where("record_type <> 'metadata'").collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert {r["record_type"] for r in out} == {"conversion"} and len(out) == 12
        texts = {bytes(r["record"]).partition(b"\r\n\r\n")[2].strip().decode().split("\n")[0].split("WARC")[0].strip() for r in out}
        assert {"one", "two", "three", "four", "b1", "b2", "b3", "", "c" * 9000} == texts


def _pieces(spark, lengths, first=0):
    rows = [(first + i, 0, 0, int(n), int(n) * 7) for i, n in enumerate(lengths)]
    return spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")


def test_packing_keeps_ids_and_leaves_other_columns(spark):
    big = 2**53 + 1
    rows = [(big, 0, 0, 5, 1, "x", 0), (None, 0, 0, 6, 2, "y", 0), (big + 1, 0, 0, 4096, 3, None, 0), (None, 0, 0, 6, 2, "y", 0)]
    df = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long, extra string, fill int")
    got = packing.pack(df)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert sorted((str(r["doc_id"]), r["length"]) for r in got.collect()) == sorted((str(r[0]), r[3]) for r in rows)


LENGTHS = {
    "uniform": lambda rng: rng.integers(1, 4097, 4096),
    "lognormal": lambda rng: np.clip(rng.lognormal(6.2, 1, 4096).astype(int), 1, 4096),
    "short": lambda rng: rng.integers(1, 200, 8192),
    "middle": lambda rng: rng.integers(800, 2200, 3000),
    "few sizes": lambda rng: np.repeat([1300, 900, 2000, 700], 500),
}


@pytest.mark.parametrize("name", LENGTHS)
def test_packing_needs_no_more_than_best_fit(name):
    lengths = LENGTHS[name](np.random.default_rng(3))
    found = packing.fewest_bins(lengths, 4096)
    assert sorted(i for b in found for i in b) == list(range(len(lengths)))
    assert max(lengths[b].sum() for b in found) <= 4096
    yard = packing.best_fit(lengths, 4096, np.argsort(-lengths, kind="stable"))
    assert -(-lengths.sum() // 4096) <= len(found) <= len(yard)
    if name in ("lognormal", "short"):
        assert len(found) == -(-lengths.sum() // 4096)


def test_pack_with_its_second_deal(spark):
    """Many groups: bins are gapless and close to the least number, as what is left of each is dealt anew."""
    lengths = np.clip(np.random.default_rng(6).lognormal(6.2, 1, 3000).astype(int), 1, 4096)
    got = packing.pack(_pieces(spark, lengths), group=400).toPandas().sort_values(["sequence_id", "offset"])
    assert sorted(got.length) == sorted(lengths) and got.doc_id.is_unique
    fill = got.groupby("sequence_id").length.sum()
    assert (got.groupby("sequence_id").length.cumsum() - got.length == got.offset).all() and fill.max() <= 4096
    assert len(fill) <= -(-lengths.sum() // 4096) + 3


def _fitted(spark, docs, labels, monkeypatch, **bounds):
    """The documents that a fit uses."""
    used = []
    descent = quality.dual_descent
    monkeypatch.setattr(quality, "dual_descent", lambda idx, at, *a: used.append(len(at) - 1) or descent(idx, at, *a))
    df = spark.createDataFrame(docs, "doc_id long, text string, quality string")
    quality.train(df, spark.createDataFrame(labels, "doc_id long, quality int"), **bounds)
    return used


def test_fits_are_bounded_in_documents_and_bytes(spark, monkeypatch):
    docs = [(i, f"text number {i} " * 20, "x") for i in range(40)] + [(7, "again and again", "x")] * 500 + [(None, "none", "x")]
    labels = [(i, i % 2) for i in range(40)] + [(3, 1), (None, 1)]
    assert _fitted(spark, docs, labels, monkeypatch) == [32]  # of 40, every fifth is set aside
    assert _fitted(spark, docs, labels, monkeypatch, max_rows=10) == [8]
    few = _fitted(spark, docs, labels, monkeypatch, max_bytes=3000)
    assert 0 < few[0] < 32
    model = quality.train(spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int"))
    assert quality.score(spark.createDataFrame([(1, None), (1, "a")], "doc_id long, text string"), model).count() == 2


def test_whole_score_by_brute_force(spark):
    """Features, ratios, weights and the sigmoid of a fit give the scores that plain sums give."""
    docs = [(i, f"word{i % 3} Word{i} 12 {'!' * (i % 2)} é") for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    m = quality.train(df, spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int"))
    got = {r["doc_id"]: r["score"] for r in quality.score(df, m).collect()}
    for i, text in docs[:20]:
        data = np.frombuffer(text.encode(), np.uint8)
        own = set(quality.features(data, np.array([0, len(data)]), m.bits)[0].tolist())
        r = {k: float(m.r[k]) for k in own}
        norm = sum(v * v for v in r.values()) ** 0.5
        margin = sum(v * float(m.w[k]) for k, v in r.items()) / norm + m.bias
        assert got[i] == pytest.approx(1 / (1 + np.exp(-(m.slope * margin + m.offset))), rel=1e-6)
        assert (got[i] > 0.5) == (i % 2 == 1)


def test_nothing_stays_behind_when_a_query_fails(spark, monkeypatch):
    """Tables, folders and settings of line dedup go, whatever ends it."""
    setting = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    before, tables = spark.conf.get(setting, None), {t.name for t in spark.catalog.listTables()}
    gone = []
    monkeypatch.setattr(linededup, "remove", lambda s, folder: gone.append(folder))
    monkeypatch.setattr(linededup.Runs, "add", lambda self, run: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        linededup.dedup_lines(spark.createDataFrame([(1, "a long enough line"), (2, "another long line")], "doc_id long, text string"))
    assert len(gone) == 1 and spark.conf.get(setting, None) == before and {t.name for t in spark.catalog.listTables()} == tables


def test_near_duplicates_get_no_runtime_filters(spark, docs_of, tmp_path):
    """The last join gathers no Bloom filters of fixed size in one task and sends none through the driver."""
    text = "one two three four five six seven eight"
    docs = docs_of([(5, text), (2, text), (3, "nothing like the others at all"), (4, None), (None, text), (5, text + " nine")])
    docs.write.parquet(str(tmp_path / "docs"))  # files have a size, by which Spark decides
    docs = spark.read.parquet(str(tmp_path / "docs"))
    # what Spark does with large tables
    large = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    before = {k: spark.conf.get(k) for k in large}
    try:
        for k, v in large.items():
            spark.conf.set(k, v)
        got = minhash.near_duplicates(docs)
        assert "might_contain" not in got._jdf.queryExecution().optimizedPlan().toString()
        assert sorted((r["doc_id"] or 0, r["component_id"]) for r in got.collect()) == [(0, None), (2, 2), (3, 3), (4, 4), (5, 2), (5, 2)]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
