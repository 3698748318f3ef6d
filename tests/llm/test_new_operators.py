"""Repetition, periodic runs and whitening against SQL and brute force."""

import hashlib
import math
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from lorequarry.llm import queries, repetition, runs, whitening

SMALL = "/root/testdata/sf0.001"
WORD = r"[^\x20\x09-\x0D]+"
ODD = [(1, None), (2, ""), (3, " \n\t\r\n"), (4, "a b c " * 40), (4, "a b c " * 40), (None, "x y z " * 20), (5, "word " * 60_000), (6, "É\x00x 👍 1²\r\n# <é> 50%\n\n# <é> 50%")]


@pytest.fixture
def odd(spark):
    rows = [(*r, 1, True, "l", [1]) for r in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words int, kept boolean, start string, runs array<int>")


def test_repetition_odd(spark, odd):
    out = {(r["doc_id"], r["n_words"]): r for r in repetition.coverage(odd).collect()}
    assert repetition.coverage(odd).count() == len(ODD) and repetition.coverage(odd.limit(0)).count() == 0
    for i in (1, 2, 3):
        assert out[i, 0]["base_failed"] and not out[i, 0]["kept"]
    assert out[6, 10 - 1]["n_symbols"] == 8 and out[6, 9]["n_dup_lines"] == 1
    assert out[5, 60_000]["n_repeat_words"] == 60_000 and out[None, 60]["base_failed"]


def test_repetition_verdict(spark):
    fresh = lambda n, k: " ".join(f"w{k}{i}" for i in range(n))
    one = fresh(12, "x")
    texts = [(1, fresh(200, "a")), (2, fresh(60, "b") + f"\n{one}\n{one}\n{one}\n{one}"), (3, fresh(200, "c") + " " + one + " y " + one)]
    got = {r["doc_id"]: r for r in repetition.coverage(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert [got[i]["base_failed"] for i in (1, 2, 3)] == [False] * 3
    assert [got[i]["kept"] for i in (1, 2, 3)] == [True, False, True]
    assert got[2]["n_dup_lines"] == 3 and got[2]["dup_line_chars"] == 3 * sum(map(len, one.split()))


def test_collisions_change_nothing(monkeypatch):
    """With hashes of two bits all pieces and windows are told apart by what they are."""
    text = ("one two three one two three\n" * 3 + "four five\nsix two three one two").encode()
    data, offsets = np.frombuffer(text * 2, np.uint8), np.array([0, len(text), 2 * len(text)])
    want = repetition.measured(data, offsets)
    monkeypatch.setattr(repetition, "words", lambda *a: (lambda h, *r: (h % np.uint64(4), *r))(*runs.words(*a)))
    monkeypatch.setattr(repetition, "mix", lambda x: x % np.uint64(4))
    got = repetition.measured(data, offsets)
    assert {k: v.tolist() for k, v in got.items()} == {k: v.tolist() for k, v in want.items()}


def _runs(w):
    """All runs of a list by definition."""
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if size >= max(6, 4 * q) and not any(all(w[k] == w[k + r] for k in range(i, i + size - r)) for r in range(1, q)):
                out.append((i, size, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_by_definition():
    rnd = random.Random(5)
    for _ in range(1500):
        k, n = rnd.choice([1, 2, 2, 3, 5]), rnd.randrange(70)
        w = [rnd.randrange(k) for _ in range(n)]
        if n > 8 and rnd.random() < 0.7:
            a = rnd.randrange(n)
            p = 1 + rnd.randrange(max(1, (n - a) // 3))
            w[a:] = [w[a + (i - a) % p] for i in range(a, n)]
        want = _runs(w)
        assert [tuple(r) for r in runs.runs(np.array(w, np.int64)).tolist()] == want
        cut = [(s + x, m, q) for x, y in runs.stretches(np.array(w, np.int64), np.zeros(n, np.int64)) for s, m, q in runs.runs(np.array(w[x:y])).tolist()]
        assert sorted(cut, key=lambda r: (r[0], r[2])) == want


def test_common_extensions():
    rnd = random.Random(2)
    text = [rnd.randrange(1, 3) for _ in range(300)] + [1, 2, 2] * 40
    tree, n = runs.SuffixTree(text), len(text)
    i, j = np.array([(a, b) for a in range(0, n, 3) for b in range(n) if a != b]).T

    def lce(a, b):
        k = 0
        while max(a, b) + k < n and text[a + k] == text[b + k]:
            k += 1
        return k

    assert tree.common(i, j).tolist() == [lce(a, b) for a, b in zip(i.tolist(), j.tolist())]
    assert np.argsort(tree.rank).tolist() == sorted(range(n + 1), key=lambda k: text[k:])
    assert np.argsort(tree.reverse_rank()).tolist() == sorted(range(n + 1), key=lambda k: [-x for x in text[k:]])


def _expected_runs(doc_id, text):
    w = re.findall(WORD, text or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = _runs(w)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha("".join("%d,%d,%d\n" % r for r in found)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_periodic_runs_query(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect() if len(r["text"] or "") < 8000}
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op12_periodic_runs(spark, SMALL).collect()}
    assert sum(v[0] > 0 for v in got.values()) > 5
    for i, text in docs.items():
        assert got[i] == _expected_runs(i, text), i


def test_periodic_runs_odd(spark, odd):
    out = {(r["doc_id"], r["n_runs"]): r for r in runs.periodic_runs(odd).collect()}
    assert runs.periodic_runs(odd).count() == len(ODD) and runs.periodic_runs(odd.limit(0)).count() == 0
    for i in (1, 2, 3):
        assert out[i, 0]["collapsed"] == "" and out[i, 0]["start"] is None and out[i, 0]["runs"] == []
    assert (out[5, 1]["length"], out[5, 1]["period"], out[5, 1]["collapsed"]) == (60_000, 1, "word")
    assert out[4, 1]["collapsed"] == "a b c" and out[None, 1]["exponent_milli"] == 20_000
    assert out[6, 0]["collapsed"] == "É\x00x 👍 1² # <é> 50% # <é> 50%"


def _white(rows):
    """Rows (id, vector) whitened in plain numpy and whole numbers."""
    kept = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    n, d = len(kept), len(kept[0][1])
    sums = [sum(x[k] for _, x in kept) for k in range(d)]
    y = np.array([[n * x[k] - sums[k] for k in range(d)] for _, x in kept], object)
    v = (y.T.dot(y) / n**3).astype(float)
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(-values)[:32]
    z = (y / n).astype(float) @ vectors[:, order] / np.sqrt(values[order])
    return [i for i, _ in kept], n, [sum(a * a for a in r) for r in y], z, values[order] / np.trace(v)


def test_whitening_query(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").orderBy("vec_id").collect()]
    ids, n, deviation, z, explained = _white(rows)
    got = {(r["vec_id"], r["component"]): r for r in queries.op13_embedding_whitening(spark, SMALL).collect()}
    assert len(got) == len(ids) * 32
    for k in range(32):
        own = np.array([got[i, k + 1]["whitened"] for i in ids])
        sign = np.sign(own @ z[:, k])
        assert np.abs(own - sign * z[:, k]).max() < 1e-7
        assert abs(got[ids[0], k + 1]["explained"] / explained[k] - 1) < 1e-9
    assert [got[i, 1]["deviation"] for i in ids] == deviation
    assert {r["n"] for r in got.values()} == {n} and max(r["identity_error"] for r in got.values()) < 1e-9


def test_whitening_odd(spark):
    rnd = np.random.default_rng(0)
    rows = [(k, v, 1) for k, v in enumerate(rnd.normal(size=(40, 3)).tolist())]
    rows += [(40, None, 1), (41, [1.0, None, 2.0], 1), (42, [1.0, math.nan, 2.0], 1), (43, [math.inf, 0.0, 2.0], 1), (44, [], 1), (None, [1.0, 2.0, 3.0], 1), (1, rows[1][1], 1), (45, [1.0, 5.0], 1), (46, [2.0, 5.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, component int")
    out = whitening.whiten(df)
    three = out.where("component = 3")
    assert three.count() == 42 and three.where("vec_id IS NULL").count() == 1 and three.where("vec_id = 1").count() == 2
    _, n, _, z, _ = _white([(i, v) for i, v, _ in rows if v is None or len(v) == 3])
    assert {r["n"] for r in three.collect()} == {n}
    assert sorted(abs(r["whitened"]) for r in three.collect()) == pytest.approx(sorted(abs(z[:, 2])))
    # two vectors of two entries differ in one direction alone
    two = {r["vec_id"]: r for r in out.where("vec_id IN (45, 46)").collect()}
    assert {abs(r["whitened"]) for r in two.values()} == {1.0} and {r["component"] for r in two.values()} == {1}
    assert out.where("vec_id BETWEEN 40 AND 44").count() == 0
    assert whitening.whiten(df.limit(0)).count() == 0


def test_squares_are_exact():
    y = np.random.default_rng(1).integers(-(1 << 49), 1 << 49, (300, 4))
    want = [sum(int(a[i]) ** 2 if i == j else int(a[i] + a[j]) ** 2 for a in y) for i in range(4) for j in range(i, 4)]
    assert whitening.squares(y).tolist() == want
    with pytest.raises(OverflowError):
        whitening.squares(np.array([[1 << 50]]))
