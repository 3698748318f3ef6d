"""The pipeline's stages and its run against plain Python, and brute force for the classifiers."""

import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pytest

import corpus_pipeline as P
from lorequarry.llm import langid, quality, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [(1, None), (2, ""), (3, "12 34 \n\t"), (4, "the cat sat on the mat today"), (4, "the cat sat on the mat today"), (4, "another text of the same document"), (None, "the cat sat on the mat today"), (5, "word " * 60_000)]
SMALL = "/root/testdata/sf0.001"


def frame(spark, rows, extra=""):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) + (("x",) * bool(extra)) for i, t in rows], SCHEMA + extra)


def texts(df):
    return Counter((r["doc_id"], r["text"]) for r in df.collect())


@pytest.fixture
def odd(spark):
    return frame(spark, ODD, ", score string")


def test_stages_on_odd_rows(spark, odd):
    """Nulls, empty and long texts, repeated rows, an extra column of a clashing name."""
    left = {
        "language_id": Counter(ODD[3:]),
        "line_dedup": Counter((i, t or "") for i, t in ODD),
        "near_dedup": Counter([*ODD[:4], *ODD[5:]]),
        "decontamination": Counter(ODD),
    }
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, odd, SMALL)
        assert out.columns == P.COLUMNS, name
        assert texts(out) == left[name], name
        assert stage(spark, odd.limit(0), SMALL).count() == 0
    packed = P.STAGES[-1][1](spark, odd, SMALL)
    assert packed.where("start = 0").count() == len(ODD) and P.STAGES[-1][1](spark, odd.limit(0), SMALL).count() == 0


def shingles(text, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def test_run_equals_plain_python(spark, tmp_path):
    """Planted copies, leaks, shared lines and texts without letters."""
    rng = np.random.default_rng(8)
    vocabulary = {"en": ["stone", "river", "which", "through", "night", "water", "house", "green"], "de": ["über", "straße", "nicht", "wasser", "grün", "häuser", "schnee", "zwischen"]}
    said = lambda lang, n: " ".join(f"{vocabulary[lang][x % 8]}{chr(97 + x // 8 % 26)}{chr(97 + x // 208)}" for x in rng.integers(0, 4000, n))
    item = "which rivera through waterb nightc houses greend stonee ran past us? " + said("en", 12) + "."
    rows = [(i, said("en" if i % 2 else "de", 80), "en" if i % 2 else "de") for i in range(60)]
    footer = "all rights are kept by the house of green stones"
    for i in (10, 20, 31):
        rows[i] = (i, rows[i][1] + "\n" + footer, rows[i][2])
    rows += [(100, rows[5][1], "en"), (101, rows[7][1].replace(rows[7][1].split()[3], "changed"), "en"), (102, "0123 4567 -- 89", "en"), (103, said("en", 40) + "\n" + item + "\n" + said("en", 40), "en"), (104, None, "en"), (105, footer, "en")]
    spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    kept = [(i, t) for i, t, _ in rows if t and any(c.isalpha() for c in t)]
    held: dict[str, int] = {}
    for i, t in kept:
        for line in t.split("\n"):
            if len(line.strip()) >= 10:
                held[line.strip().lower()] = min(i, held.get(line.strip().lower(), i))
    lined = []
    for i, t in kept:
        lines = [x for x in t.split("\n") if len(x.strip()) < 10 or held[x.strip().lower()] == i]
        if lines:
            lined.append((i, "\n".join(lines)))
    sets = {i: shingles(t) for i, t in lined}
    near = [(i, t) for i, t in lined if not any(j < i and sets[i] and 10 * len(sets[i] & s) >= 8 * len(sets[i] | s) for j, s in sets.items())]
    clean = [(i, t) for i, t in near if "which rivera through" not in t]
    assert len(kept) - len(lined) == 2 and len(lined) - len(near) == 1 and len(near) - len(clean) == 1

    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for (name, stage), want in zip(P.STAGES[:-1], (kept, lined, near, clean)):
        docs = stage(spark, docs, str(tmp_path))
        assert texts(docs)[None, None] == 0 and Counter(i for i, _ in texts(docs)) == Counter(i for i, _ in want), name
    assert texts(docs) == Counter(clean)
    out = P.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in out} == {i for i, _ in clean}
    fill = Counter()
    for r in sorted(out, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == fill[r["sequence_id"]]
        fill[r["sequence_id"]] += r["length"]
    assert max(fill.values()) <= 4096


def test_language_id_equals_brute_force(spark):
    """Counts of letter n-grams in dictionaries give the same languages and posteriors."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang")
    bits, smoothing = 20, 0.5
    model = langid.train(docs, bits=bits, smoothing=smoothing)
    rows = docs.collect()

    def grams(text):
        s = re.sub(" +", " ", "".join(c.lower() if c.isalpha() else " " for c in f" {text or ''} "))
        return [s[i : i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1) if " " not in (s[i : i + n] if n == 1 else s[i + 1 : i + n - 1])]

    counts, priors = {}, Counter()
    for r in rows:
        if r["lang"] is not None:
            counts.setdefault(r["lang"], Counter()).update(grams(r["text"]))
            priors[r["lang"]] += 1
    total = {k: sum(c.values()) + smoothing * 2**bits for k, c in counts.items()}
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(docs, model).collect()}
    for r in rows[:60]:
        g = grams(r["text"])
        if not g:
            assert got[r["doc_id"]] == ("und", 0.0)
            continue
        log = {k: np.log(priors[k] / sum(priors.values())) + sum(np.log((c[x] + smoothing) / total[k]) for x in g) for k, c in counts.items()}
        best = max(log, key=log.get)
        assert got[r["doc_id"]][0] == best
        assert got[r["doc_id"]][1] == pytest.approx(1 / sum(np.exp(v - log[best]) for v in log.values()), abs=0.02)


def test_more_languages_than_the_bound(spark):
    df = spark.createDataFrame([(f"lang{i}", f"text {chr(97 + i)}" * 9) for i in range(6)], "lang string, text string")
    with pytest.raises(ValueError, match="max_languages"):
        langid.train(df, max_languages=5)
    assert len(langid.train(df, max_languages=None).langs) == 6


def test_dual_descent_reaches_the_least_loss():
    """The hinge loss after coordinate descent against a long subgradient descent."""
    rng = np.random.default_rng(3)
    rows = [np.sort(rng.choice(30, 6, replace=False)) for _ in range(80)]
    y = np.where([3 in r or 5 in r for r in rows], 1, -1)
    r = rng.normal(1, 0.3, 30)
    x = np.zeros((80, 30))
    for k, i in enumerate(rows):
        x[k, i] = r[i] / np.sqrt((r[i] ** 2).sum())
    loss = lambda w, b: 0.5 * (w @ w + b * b) + np.maximum(0, 1 - y * (x @ w + b)).sum()
    at = np.concatenate([[0], np.cumsum([len(i) for i in rows])])
    w, b = quality.dual_descent(np.concatenate(rows), at, y, r, 1.0, 200)
    v, c, best = np.zeros(30), 0.0, np.inf
    for t in range(1, 20_000):
        active = y * (x @ v + c) < 1
        v, c = v - (v - (y[active] @ x[active])) / t, c - (c - y[active].sum()) / t
        best = min(best, loss(v, c))
    assert loss(w, b) <= 1.01 * best


class _Text(HTMLParser):
    """A second reading of pages, by Python's own parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.raw = [], 0

    def handle_starttag(self, tag, attrs):
        if tag in warc._RAW:
            self.raw += 1
            self.out.append(" ")
        elif tag in warc._BREAKS:
            self.out.append("\n")

    handle_startendtag = handle_starttag

    def handle_endtag(self, tag):
        if tag in warc._RAW:
            self.raw = max(0, self.raw - 1)
        elif tag in warc._BREAKS:
            self.out.append("\n")

    def handle_data(self, data):
        if not self.raw:
            self.out.append(data.replace("\r", " ").replace("\n", " "))


def test_plain_text_equals_another_parser(spark):
    for row in spark.read.parquet(f"{SMALL}/pages.parquet").collect():
        other = _Text()
        other.feed(row["html"] or "")
        other.close()
        lines = (re.sub(r"[^\S\n]+", " ", x.replace("\xa0", " ")).strip() for x in "".join(other.out).split("\n"))
        assert warc.plain_text(row["html"] or "") == "\n".join(x for x in lines if x)
