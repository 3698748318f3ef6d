"""The ten operators against brute force, exact round trips and held-out accuracy."""

import gzip
import hashlib
import io
import re
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lorequarry.llm import chat, decontam, huffman, langid, linededup, minhash, packing, quality, queries, simhash, warc

SMALL = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "a b c d e f g"), (4, "a b c d e f g"), (None, "a b c d e f g"), (5, "word " * 60_000), (6, "É\x00x 👍 1²")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}


@pytest.fixture
def odd(spark):
    """Nulls, empty and long texts, repeated rows and columns with clashing names."""
    rows = [(*r, "en", 1, 1, True, 0.0) for r in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n_lines int, component_id int, kept boolean, score double")


@pytest.mark.parametrize("name", queries.ORACLES)
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({queries.ORACLES[name]})").fetchall()
    assert Counter(map(tuple, df.select(columns).collect())) == Counter(want)


def test_line_dedup_reads_runs_as_they_stand(spark, docs, monkeypatch):
    """The runs' side of a merge is neither shuffled nor sorted."""
    plans = []
    new = linededup.Runs.new
    monkeypatch.setattr(linededup.Runs, "new", lambda self, keys: [new(self, keys), plans.append(new(self, keys)._jdf.queryExecution().executedPlan().toString())][0])
    linededup.dedup_lines(docs).count()
    joins = [p for p in plans if "SortMergeJoin" in p]
    assert joins
    for p in joins:
        scans = p.count("lorequarry_run")
        assert scans and p.count("Exchange hashpartitioning") == 1 and p.count("Sort [") == 1


def test_line_dedup_keeps_columns_of_any_name(spark):
    names = ["id", "drop", "lines", "keep", "_id", "_keep"]
    df = spark.createDataFrame([(1, "a long enough line\nx", *names), (2, "a long enough line", *names)], "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    out = linededup.dedup_lines(df)
    assert out.columns == [*df.columns, "n_lines", "n_dropped", "kept_text"]
    assert {(r["doc_id"], r["id"], r["_keep"], r["kept_text"]) for r in out.collect()} == {(1, "id", "_keep", "a long enough line\nx"), (2, "id", "_keep", "")}


def test_line_dedup_odd(odd):
    out = linededup.dedup_lines(odd, batches=3)
    assert out.count() == len(ODD)
    assert out.where("doc_id IN (1, 2)").select("n_lines", "n_dropped", "kept_text").distinct().collect() == [(1, 0, "")]
    assert linededup.dedup_lines(odd.limit(0)).count() == 0


@pytest.mark.parametrize("batches,fanout", [(1, 2), (7, 2), (5, 3)])
def test_line_dedup_does_not_depend_on_runs(docs, batches, fanout):
    rows = lambda d: sorted(tuple(r) for r in d.select("doc_id", "n_dropped", "kept_text").collect())
    assert rows(linededup.dedup_lines(docs, batches=batches, fanout=fanout)) == rows(linededup.dedup_lines(docs))


def test_language_id(spark, odd):
    got = queries.op2_language_id(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = got.where("held_out AND lang IS NOT NULL")
    assert held.where("lang = lang_pred").count() >= 0.97 * held.count()
    out = langid.predict(odd, langid.train(odd))
    assert out.count() == len(ODD) and out.columns.count("score") == 1
    assert {r["lang_pred"] for r in out.where("doc_id IN (1, 2, 3)").collect()} == {"und"}
    assert {r["lang_pred"] for r in langid.predict(odd, langid.train(odd.limit(0))).collect()} == {"und"}


def _shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def _components(sets, percent):
    up = {i: i for i in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                up[y] = x
    return {i: top(i) for i in sets}


@pytest.mark.parametrize("words,percent", [(3, 85), (5, 80)])
def test_near_duplicates(docs, texts, words, percent):
    sets = {i: _shingles(t, words) for i, t in texts.items()}
    want = {i: (len(sets[i]), c, c == i) for i, c in _components(sets, percent).items()}
    assert {r[0]: tuple(r)[1:] for r in minhash.near_duplicates(docs, words, percent).collect()} == want


def test_near_duplicates_of_many_in_small_blocks(docs_of, monkeypatch):
    """A bucket with chains of near copies, compared in blocks of a few members."""
    monkeypatch.setattr(minhash, "BLOCK", 4)
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):
        w = list(base)
        for j in rng.integers(0, 120, i % 6):
            w[j] = f"x{i}_{j}"
        rows.append((i, " ".join(w)))
    sets = {i: _shingles(t, 3) for i, t in rows}
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs_of(rows), 3, 85).collect()}
    assert got == _components(sets, 85)


def test_near_duplicates_odd(odd):
    got = [tuple(r) for r in minhash.near_duplicates(odd, 3, 85).collect()]
    assert len(got) == len(ODD) and sum(r[0] is None and r[2] is None and r[3] for r in got) == 1
    assert minhash.near_duplicates(odd.limit(0)).count() == 0


def _words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def test_decontamination(spark, docs, texts):
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    runs = lambda t: {tuple(w[i : i + 5]) for w in [_words(t)] for i in range(len(w) - 4)}
    items = {r["item_id"]: runs(r["text"]) for r in bench.collect()}
    whole = {(d, i) for d, t in texts.items() for own in [runs(t)] for i, r in items.items() if r and len(own & r) >= 0.9 * len(r)}
    part = {(d, i) for d, t in texts.items() for own in [runs(t)] for i, r in items.items() if own & r}
    got = {(r["doc_id"], r["item_id"]) for r in decontam.leaks(docs, bench).collect()}
    assert whole and whole <= got <= part
    left = decontam.without_leaks(docs, bench)
    assert left.columns == docs.columns
    assert {r["doc_id"] for r in left.collect()} == texts.keys() - {d for d, _ in got}


def test_decontamination_by_wand_equals_brute_force(spark, docs_of):
    rng = np.random.default_rng(1)
    item = lambda n: " ".join(f"t{x}" for x in rng.zipf(1.3, n) % 300)
    items = [(i, item(12)) for i in range(40)]
    rows = [(i, " ".join([item(30), items[i % 40][1] if i % 3 else "", item(30)])) for i in range(60)]
    held = decontam.indexes(docs_of(items).withColumnRenamed("doc_id", "item_id"))[0].value
    h, at = decontam._hashed([t for _, t in rows])
    for a, b in zip(at[:-1], at[1:]):
        terms = np.flatnonzero(np.isin(held.vocab, h[a:b])).tolist()
        score = Counter()
        for t in terms:
            for i, w in zip(*held.postings[t]):
                score[i] += w
        want = {i for i, s in score.items() if s >= 0.4}
        blocks = held.block_max.shape[1]
        assert {i for k in range(blocks) for i, _ in held.wand(terms, k, 0.4)} == want


def test_decontamination_ignores_case_marks_and_odd_rows(spark, docs_of, odd):
    bench = docs_of([(1, "Où est la ñandú, près du marché? Elle dort, là-bas."), (2, None), (3, "!!")]).withColumnRenamed("doc_id", "item_id")
    rows = docs_of([(1, "x OÙ EST LA ÑANDÚ  PRÈS DU MARCHÉ — “ELLE” DORT LÀ BAS y"), (2, "Où est le train")])
    assert [r["doc_id"] for r in decontam.leaks(rows, bench).collect()] == [1]
    assert decontam.leaks(odd, bench).count() == 0 and decontam.without_leaks(odd, bench.limit(0)).count() == len(ODD)


def test_decontamination_of_items_without_words(spark, docs_of, docs):
    marks = docs_of([(2, "!!"), (3, "... ?")]).withColumnRenamed("doc_id", "item_id")
    assert decontam.leaks(docs, marks).count() == 0 and decontam.without_leaks(docs, marks).count() == docs.count()


def test_decontamination_asks_for_question_and_answer(spark, docs_of):
    words = [f"w{i}" for i in range(30)]
    bench = docs_of([(1, " ".join(words) + ". seven red boats")]).withColumnRenamed("doc_id", "item_id")
    rows = docs_of([(1, " ".join(words) + " so seven red boats"), (2, " ".join(words) + " and nothing else"), (3, "seven red boats")])
    assert [r["doc_id"] for r in decontam.leaks(rows, bench).collect()] == [1]


def test_fingerprints(spark, texts, odd):
    got = {r["doc_id"]: r for r in queries.op5_document_fingerprints(spark, SMALL).collect()}
    order = sorted(texts)
    whole = {i: int(r["fingerprint"], 16) for i, r in got.items()}
    for i, after in zip(order, order[1:] + order[:1]):
        t, f = texts[i], texts[after]
        half = len(t) // 2
        assert got[i]["edited_sha256"] == hashlib.sha256((t[: len(t) - half] + f[:half]).encode()).hexdigest()
        assert got[i]["n_chars"] == len(t)
        assert got[i]["near_next"] == pytest.approx(1 - (whole[i] ^ whole[after]).bit_count() / 128)
        if i % 50 == 0:
            assert got[i]["n_near"] == sum((whole[i] ^ v).bit_count() <= 3 for v in whole.values()) - 1
    assert simhash.fingerprint_table(odd).count() == len(ODD) and simhash.fingerprint_table(odd.limit(0)).count() == 0


def test_fingerprints_find_near_copies(spark, docs_of):
    """Words changed in 300: all near copies are found, and no unrelated text."""
    rng = np.random.default_rng(5)
    base = [f"w{x}" for x in rng.integers(0, 400, 300)]
    rows = [(0, " ".join(base))]
    for i, changed in enumerate((0, 1, 3, 6, 10), 1):
        w = list(base)
        for j in rng.choice(300, changed, replace=False):
            w[j] = f"x{i}_{j}"
        rows.append((i, " ".join(w)))
    rows += [(i, " ".join(f"y{x}" for x in rng.integers(0, 400, 300))) for i in range(50, 60)]
    sets = {i: _shingles(t, 3) for i, t in rows}
    copies = [i for i in range(1, 60) if i in sets and len(sets[0] & sets[i]) >= 0.8 * len(sets[0] | sets[i])]
    got = {r["doc_id"]: r for r in simhash.fingerprint_table(docs_of(rows)).collect()}
    whole = {i: int(r["fingerprint"], 16) for i, r in got.items()}
    assert copies == [1, 2, 3, 4, 5] and got[0]["n_near_copies"] == 5 and got[50]["n_near_copies"] == 0
    assert got[0]["n_near"] == sum((whole[0] ^ whole[i]).bit_count() <= 3 for i in copies) < 5
    assert got[1]["n_near_copies"] is None


def test_within_radius_equals_brute_force(spark, monkeypatch):
    """Any radius, copies counted, asked fingerprints in several blocks."""
    monkeypatch.setattr(simhash, "BLOCK", 3)
    rng = np.random.default_rng(6)
    bits = rng.integers(0, 2, (8, 128))
    rows = [b ^ (rng.random(128) < p) for b in bits for p in (0.1, 0.1, 0.1, 0.02, 0.02, 0.01)] + [bits[0]] * 3
    f = [tuple(int(x) for x in np.packbits(b).view(">i8")) for b in rows]
    all_ = spark.createDataFrame([(i, *x) for i, x in enumerate(f)], "doc_id long, f1 long, f2 long")
    asked = all_.where("doc_id % 3 = 0")
    by = lambda found: {r["doc_id"]: r["near"] for r in asked.join(found, ["f1", "f2"]).collect()}
    got = by(simhash.within_radius(asked, all_, 0, 14, 28, 70))
    monkeypatch.setattr(simhash, "ASKED", 5)
    assert by(simhash.within_radius(asked, all_, 0, 14, 28, 70)) == got
    for radius in (0, 1, 2, 3, 4, 5, 6, 16):
        n = {i: sum(int((rows[i] != b).sum()) <= radius for b in rows) for i in range(0, len(rows), 3)}
        assert by(simhash.by_tables(asked, all_, radius)) == n
    with pytest.raises(ValueError, match="tables"):
        simhash.block_masks(28)
    want = {i: [sum(int((rows[i] != b).sum()) <= r for b in rows) for r in (0, 14, 28, 70)] for i in range(0, len(rows), 3)}
    assert got == want
    words, out = np.array(f).view(np.uint64), np.zeros((4, len(want)), np.int64)
    simhash._counts(np.ascontiguousarray(words[::3].T), words, np.ones(len(rows), int), [0, 14, 28, 70], out)
    assert out.T.tolist() == list(want.values())


def _library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.word_bpe())


def test_packing(spark, texts, odd):
    tok = _library()
    ids = {i: np.array(tok.encode(t, add_special_tokens=False).ids + [1], "<u4") for i, t in texts.items()}
    got = queries.op6_best_fit_packing(spark, SMALL).toPandas()
    assert got.groupby("doc_id").length.sum().to_dict() == {i: len(x) for i, x in ids.items()}
    for r in got.itertuples():
        assert r.start == 4096 * r.piece and zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) == r.ids_crc32
    got = got.sort_values(["sequence_id", "offset"])
    assert (got.groupby("sequence_id").length.cumsum() - got.length == got.offset).all()
    assert got.groupby("sequence_id").length.sum().max() <= 4096
    assert got.sequence_id.nunique() <= -(-got.length.sum() // 4096) * 1.02 + 1
    assert packing.pack(packing.token_pieces(odd, queries.word_bpe())).count() >= len(ODD)
    assert packing.pack(packing.token_pieces(odd.limit(0), queries.word_bpe())).count() == 0


def _fewest(lengths, capacity):
    """The least number of bins, by trying all ways."""
    best = len(lengths)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(lengths):
            best = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + lengths[i] <= capacity:
                place(i + 1, [*bins[:k], bins[k] + lengths[i], *bins[k + 1 :]])
        place(i + 1, [*bins, lengths[i]])

    place(0, [])
    return best


def test_local_search_against_all_ways():
    rng = np.random.default_rng(4)
    over = 0
    for _ in range(60):
        lengths = rng.integers(1, 60, 8)
        bins, _ = packing.local_search(lengths, [[i] for i in range(8)], 100)
        over += len(bins) - _fewest(lengths.tolist(), 100)
    assert 0 <= over <= 6


def test_local_search_makes_every_kind_of_change_and_keeps_all():
    rng = np.random.default_rng(2)
    made, bins_, yard, square = Counter(), 0, 0, lambda lengths, bins: sum(int(lengths[b].sum()) ** 2 for b in bins)
    for _ in range(30):
        lengths = rng.integers(1, 100, 200)
        first = packing.best_fit(lengths, 200, np.arange(200))
        bins, changes = packing.local_search(lengths, first, 200)
        made.update(changes)
        assert len(bins) <= len(first) and sorted(x for b in bins for x in b) == list(range(200))
        assert max(int(lengths[b].sum()) for b in bins) <= 200
        assert square(lengths, bins) >= square(lengths, first)
        bins_, yard = bins_ + len(bins), yard + len(packing.best_fit(lengths, 200, np.argsort(-lengths)))
    assert min(made.values()) > 0 and bins_ <= 1.01 * yard


def test_token_files(spark, texts, odd, tmp_path):
    tok, start, want = _library(), 0, {}
    for i in sorted(texts):
        x = np.array(tok.encode(texts[i], add_special_tokens=False).ids + [1], "<u4")
        want[i] = (start, len(x), zlib.crc32(x.tobytes()))
        start += len(x)
    assert {r[0]: tuple(r)[1:] for r in queries.op7_token_output(spark, SMALL).collect()} == want
    for name, rows in (("odd", odd), ("none", odd.limit(0))):
        huffman.write_ids(rows, queries.word_bpe(), str(tmp_path / name))
        assert huffman.read_ids(spark, str(tmp_path / name)).count() == rows.count()


@pytest.mark.parametrize("counts", [[5], [1, 1], [2**i for i in range(40)], [3] * 300, [0, 7, 0, 1]])
def test_code_lengths(counts):
    lengths = huffman.code_lengths(np.array(counts))
    used = lengths[lengths > 0].astype(int)
    assert (lengths > 0).tolist() == [c > 0 for c in counts] and used.max() <= huffman.LIMIT
    assert sum(2.0**-n for n in used) <= 1


def test_quality(spark, odd):
    sf = "/root/testdata/sf0.01"
    got = queries.op9_quality_classifier(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    assert got.where("predicted = quality").count() >= 0.95 * got.count()
    model = quality.train(odd, odd.select("doc_id", F.lit(1).alias("quality")))
    assert quality.score(odd, model).where("score >= 0 AND score <= 1").count() == len(ODD)


def test_warc_round_trip(spark):
    pages = spark.createDataFrame([(1, "http://a/", "<title>T</title><p>One</p><script>x</script><p>Two &amp; <b>three</b></p>"), (2, None, None), (2, None, None)], "page_id long, url string, html string")
    source = warc.responses(pages)
    out = warc.derivatives(source)
    assert out.count() == 6 and warc.derivatives(source.limit(0)).count() == 0
    for r in out.where("page_id = 1").collect():
        (headers, block), = warc.parse(io.BytesIO(bytes(r["record"])))
        h = dict(headers)
        assert h["WARC-Type"] == r["record_type"] and h["WARC-Refers-To"] == r["refers_to"] and h["WARC-Block-Digest"] == warc.digest(block)
        if r["record_type"] == "conversion":
            assert block.decode() == "One\nTwo & three"


@pytest.mark.parametrize(
    "page,want",
    [
        ("<head><title>T</title><body><p>Hello</p>", "Hello"),
        ("<html><head><title>T</title><meta name=d content='a > b'><link rel=x><p>Hello</p><div>you</div>", "Hello\nyou"),
        ("<head><style>x</style>Hello", "Hello"),
        ("<head lang=en><title>T</title><script>x</script></head><body>Hello</body>", "Hello"),
        ('<head><meta content="1 > 0"></head>Hello', "Hello"),
        ("<title-bar>Menu</title-bar><p>One</p><template-x>two</template-x><head-line>three</head-line>", "Menu\nOne\ntwothree"),
        ("<p-x>a</p-x>b<script-y>c</script-y><style>no</style >d", "abc d"),
        ("<script>x</script-not></script>Hello", "Hello"),
        ("<p>One</p><script>never closed <p>no</p>", "One"),
        ("<a href=x\">Hello</a> 1 < 2", "Hello 1 < 2"),
    ],
)
def test_plain_text_of_open_heads_and_custom_elements(page, want):
    assert warc.plain_text(page) == want


def test_title_and_links_of_custom_elements(spark):
    page = "<head><title-bar>No</title-bar><a-b href=/no></a-b><title>Yes</title><body><a href=/yes>x</a>"
    out = warc.derivatives(warc.responses(spark.createDataFrame([(1, "http://a/", page)], "page_id long, url string, html string")))
    (_, meta), = warc.parse(io.BytesIO(bytes(out.where("record_type = 'metadata'").first()["record"])))
    assert "title: Yes\r\n" in meta.decode() and "outlink: /yes\r\n" in meta.decode() and "/no" not in meta.decode()


RECORD = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x>\r\nContent-Length: 5\r\n\r\n<p>ab\r\n\r\n"


@pytest.mark.parametrize(
    "raw,kinds",
    [
        (RECORD, ["conversion", "metadata"]),
        (RECORD.replace(b"Content-Length: 5\r\n", b""), ["malformed"]),
        (RECORD.replace(b"WARC-Record-ID: <urn:x>\r\n", b""), ["malformed"]),
        (RECORD.replace(b"<urn:x>", b"<urn:\xe9>"), ["conversion", "metadata"]),
        (RECORD + RECORD[:-8], ["conversion", "malformed", "metadata"]),
        (b"no record", ["malformed"]),
        (b"\x1f\x8bbroken", ["malformed"]),
        (None, []),
        (b"", []),
    ],
)
def test_warc_malformed_records_give_a_row(raw, kinds):
    rows = list(warc._derived(1, raw or b""))
    assert sorted(r[1] for r in rows) == kinds
    assert all(r[8] for r in rows)


def test_warc_scan_is_linear():
    for bad in ("<a ", "<title>", "<script ", "<", "<!--", '<a b="', "<p x='", '<a b=">"', "<a b=1 ", "<script >"):
        for tail in ("", ">", '">'):
            began = time.perf_counter()
            warc.page_facts(bad * 50_000 + tail)
            assert time.perf_counter() - began < 10, (bad, tail)


def test_warc_bodies_in_codings():
    page = b"<p>Hello</p>"
    chunked = b"5\r\n<p>He\r\n7;x=1\r\nllo</p>\r\n0\r\n\r\n"
    for line, body in (("Content-Encoding: gzip", gzip.compress(page)), ("Content-Encoding: deflate", zlib.compress(page)), ("Transfer-Encoding: chunked", chunked), ("Content-Encoding: gzip", page)):
        block = f"HTTP/1.1 200 OK\r\n{line}\r\n\r\n".encode() + body
        (_, _, content, _), = [r for r in warc.derive([("WARC-Record-ID", "<urn:x>")], block) if r[0] == "conversion"]
        assert content == b"Hello"


def test_read_warc_files(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://a/{i}", f"<p>Page {i}\r\n\r\n</p>" + "x" * i) for i in range(40)], "page_id long, url string, html string")
    raw = [bytes(r["record"]) for r in warc.responses(pages).collect()]
    (tmp_path / "a.warc").write_bytes(b"".join(raw[:20]))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(x) for x in raw[20:]))
    got = warc.derivatives(warc.read_warc(spark, str(tmp_path)))
    want = warc.derivatives(warc.responses(pages))
    rows = lambda d: Counter(tuple(r) for r in d.select("record_type", "record_id", "record").collect())
    assert rows(got) == rows(want)


def test_chat_deep_quotes(spark):
    rows = [(1, 0, "a", "hello there"), (1, 1, "b", "> " * 20_000 + "deep\n> hello there\nyes")]
    got = {r["turn"]: r["reply_to"] for r in chat.reply_ordered(spark.createDataFrame(rows, CHAT)).collect()}
    assert got == {0: None, 1: 0}


def test_chat_odd(spark):
    rows = [(1, 0, "user", "Hello there\nfriend"), (1, 1, "bot", "> hello   there\n> friend\nyes"), (1, 2, "user", ">> hello there\n>> friend\n> yes\nok"), (1, 2, "user", None), (None, 1, "x", "> yes"), (2, None, None, "")]
    got = [tuple(r) for r in chat.reply_ordered(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()]
    assert len(got) == 6
    by = {(r[0], r[1], r[8]): r for r in got}
    assert by[1, 1, "yes"][4] == 0 and by[1, 2, "ok"][4] == 1 and by[1, 2, "ok"][5] == 0


CHAT = "conv_id long, turn long, role string, text string"


def test_chat_links_parts_of_paragraphs(spark):
    """Interleaved, nested, trimmed, re-wrapped and shortened quotes: (reply_to, root, quotes, linked)."""
    rows = [
        (1, 0, "a", "A\nB"),
        (1, 1, "b", "> A\nyes\n> B\nno"),
        (1, 2, "a", ">> B\n> no\nwhy"),
        (2, 0, "a", "First line\nIt works. Is it fast? I think\nso, mostly."),
        (2, 1, "b", "Other words\nA"),
        (2, 2, "c", "> is it FAST?\nyes"),
        (2, 3, "d", "> It works.  Is it fast?\n> I think so, mostly.\nre-wrapped"),
        (2, 4, "e", "> [...]\n> other words\nshortened"),
        (2, 5, "f", "> yes\n> re-wrapped\nthe latest original of the lines"),
        (2, 6, "g", "> nobody said this\n\n> First line\n\n> First line\nx"),
        (2, 7, "h", "> later words\nnot yet said"),
        (2, 8, "i", "later words"),
        (3, 0, "a", "A"),
        (3, 1, "a", "> B\nin another conversation"),
    ]
    got = {(r["conv_id"], r["turn"]): (r["reply_to"], r["root_turn"], r["n_quotes"], r["n_linked"]) for r in chat.reply_ordered(spark.createDataFrame(rows, CHAT)).collect()}
    quoted = {
        (1, 1): (0, 0, 2, 2),
        (1, 2): (1, 0, 2, 2),
        (2, 2): (0, 0, 1, 1),
        (2, 3): (0, 0, 1, 1),
        (2, 4): (1, 1, 1, 1),
        (2, 5): (3, 0, 1, 1),
        (2, 6): (0, 0, 3, 2),
        (2, 7): (None, 7, 1, 0),
        (3, 1): (None, 1, 1, 0),
    }
    assert got == {(c, t): quoted.get((c, t), (None, t, 0, 0)) for c, t, *_ in rows}


@pytest.mark.parametrize("most", [0, 10])
def test_chat_whole_quotes_against_sql(spark, monkeypatch, most):
    """The SQL's own rule: quotes of whole paragraphs and bodies, nested ones included."""
    monkeypatch.setattr(chat, "BROADCAST_CONVERSATIONS", most)
    rows = [
        (1, 0, "a", "One line\nof two\n\nSecond paragraph"),
        (1, 1, "b", "> one  line\n> of two\nyes"),
        (1, 2, "a", ">> One line\n>> of two\n> yes\nok"),
        (1, 3, "c", "> One line\n> of two\n> Second paragraph\nwhole body"),
        (1, 4, "d", "> never said\n> so\nhm"),
        (1, 5, "b", "> ok\n\n> whole body\nthe latest"),
        (2, 0, "a", "> ok\nno such"),
    ]
    df = spark.createDataFrame(rows, CHAT)
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    out = chat.reply_ordered(df)
    want = con.execute(f"SELECT {', '.join(out.columns)} FROM ({queries.ORACLES['op3_chat_quotations']})").fetchall()
    assert Counter(map(tuple, out.collect())) == Counter(want) and any(r[4] is not None for r in want)
