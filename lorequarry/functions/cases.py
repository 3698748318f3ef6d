"""Derived columns of the compiled views: states, buckets, ids and parts of nested documents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Inference levels, from the closest to the source to the farthest.
LEVELS = ("direct_quote", "paraphrase_high", "paraphrase_mid", "paraphrase_low", "inferred")
LEVEL_ALIASES = {"low": "paraphrase_low"}
#: Precedence of overlay kinds, intents that a retrieval policy knows.
PRECEDENCE = {"founder_persona": 1, "brand_voice": 2, "team_persona_overlay": 3, "content_type_overlay": 4}
POLICY_OF_INTENT = {"content_generation": "generate"}
#: Typographic marks and the ASCII marks that stand for them.
MARKS, PLAIN = "“”‘’、。，：；？！—–−（）【】", "\"\"'',.,:;?!---()[]"
BLANKS = "[   \\t\\n\\x0B\\f\\r]+"


def filled(c: Column) -> Column:
    """The trimmed text, null where nothing is left."""
    return F.nullif(F.trim(c), F.lit(""))


def choose(value: Column, cases: Mapping[str, Sequence], default: Column | str | None = None) -> Column:
    """The first label whose list holds the value, else the default."""
    out = reduce(lambda w, kv: w.when(value.isin(*kv[1]), kv[0]), cases.items(), F.when(F.lit(False), F.lit(None)))
    return out.otherwise(default)


def lookup(value: Column, table: Mapping, default=None) -> Column:
    """The value that a small fixed table gives, else the default."""
    pairs = F.create_map(*(F.lit(x) for kv in table.items() for x in kv))
    return F.coalesce(F.try_element_at(pairs, value), F.lit(default))


def normal_level(level: Column) -> Column:
    """A known inference level or what an alias stands for; null for all others, a violation."""
    level = F.trim(level)
    return F.when(level.isin(*LEVELS), level).otherwise(lookup(level, LEVEL_ALIASES))


def traceability_of_pack(level: Column, has_evidence: Column) -> Column:
    level = F.coalesce(F.trim(level), F.lit(""))
    return F.when(~F.coalesce(has_evidence, F.lit(False)), "missing").otherwise(choose(level, {"full": LEVELS[:2], "partial": LEVELS[2:3], "weak": LEVELS[3:]}, "partial"))


def traceability_of_evidence(level: Column) -> Column:
    return choose(level, {"full": LEVELS[:1], "partial": LEVELS[1:3]}, "weak")


def trace_quality(level: Column) -> Column:
    return choose(level, {"high": LEVELS[:2], "mid": LEVELS[2:3]}, "low")


def review_status(required: Column, decision: Column) -> Column:
    return F.when(F.coalesce(required, F.lit(False)), "pending_review").when(filled(decision).isNotNull(), "approved").otherwise("needs_review")


def coverage(n: Column) -> Column:
    return F.when(n == 0, "missing").when(n >= 10, "complete").otherwise("partial")


def completeness(*present: Column) -> Column:
    """complete if all are there, partial if at most two lack, else stub."""
    n = reduce(Column.__add__, (F.coalesce(p, F.lit(False)).cast("int") for p in present))
    return F.when(n == len(present), "complete").when(n >= len(present) - 2, "partial").otherwise("stub")


def title_of(id_: Column, prefix: str) -> Column:
    """The id without its prefix, hyphens as spaces; other ids stand as they are."""
    id_ = F.trim(id_)
    return F.when(id_.startswith(prefix), F.translate(F.substr(id_, F.lit(len(prefix) + 1)), "-", " ")).otherwise(id_)


def labelled(parts: Sequence[tuple[str, Column]], sep: str) -> Column:
    """`label: text` of each part that has a text, joined."""
    return F.concat_ws(sep, *(F.concat(F.lit(f"{name}: "), filled(c)) for name, c in parts))


def first_segment(id_: Column, pattern: str) -> Column:
    """What the pattern's group captures, up to its first hyphen; empty where it does not fit."""
    return F.split_part(F.regexp_extract(id_, pattern, 1), F.lit("-"), F.lit(1))


def after_marker(text: Column, marker: str) -> Column:
    """What follows the first marker; empty without one."""
    at = F.instr(text, marker)
    return F.when(at > 0, F.substr(text, at + len(marker))).otherwise("")


def names_of_filled(arrays: Mapping[str, Column]) -> Column:
    """The names whose arrays hold something, in the order given."""
    return F.array_compact(F.array(*(F.when(F.size(F.coalesce(a, F.array())) > 0, F.lit(name)) for name, a in arrays.items())))


def ids_of(entries: Column, key: str = "id", bare: str = "bare") -> Column:
    """Ids of nested entries, struct<id, bare>: the key or the bare text, trimmed, empty ones gone."""
    ids = F.transform(entries, lambda e: F.coalesce(filled(e[key]), filled(e[bare])))
    return F.array_compact(F.coalesce(ids, F.array().cast("array<string>")))


def harvested(text: Column, pattern: str, canonical: Sequence[str]) -> Column:
    """Tokens that the pattern's group finds, normalised, known, each once, sorted."""
    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), lambda t: F.translate(F.lower(F.trim(t)), "- ", "__"))
    return F.array_sort(F.array_distinct(F.filter(found, lambda t: t.isin(*canonical))))


def numbered(n: Column) -> Column:
    """1 to n as steps; none for null, zero or less."""
    return F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))


def folded(text: Column) -> Column:
    """Typographic marks as ASCII, zero-width spaces gone, runs of blanks as one space."""
    return F.btrim(F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), MARKS + "​", PLAIN), BLANKS, " "))


def anchored(anchor: Column, text: Column) -> Column:
    """Whether any fragment of three characters or more of the anchor is in the text, blanks
    aside; an anchor of shorter fragments is looked up whole, an empty one always holds."""
    bare = lambda c: F.regexp_replace(F.translate(F.coalesce(c, F.lit("")), MARKS + "​§", PLAIN), BLANKS, "")
    parts = F.transform(F.split(F.coalesce(anchor, F.lit("")), "[+·,、;]+"), lambda p: F.struct(p.alias("p"), F.split(p, BLANKS).alias("subs")))
    whole = F.transform(parts, lambda x: bare(x["p"]))
    subs = F.filter(F.transform(F.flatten(F.transform(parts, lambda x: x["subs"])), bare), lambda s: ~s.rlike("^[0-9.]+$"))
    fragments = F.filter(F.concat(whole, subs), lambda f: F.char_length(f) >= 3)
    held = bare(text)
    return F.when(bare(anchor) == "", True).when(F.size(fragments) > 0, F.exists(fragments, lambda f: F.contains(held, f))).otherwise(F.contains(held, bare(anchor)))


def adjudicated(strict: Column, rate: Column) -> Column:
    return F.when(strict, "direct_quote_verified").when(rate >= 0.30, "paraphrase_located").otherwise("needs_human_review")


def tier(strict: Column, rate: Column) -> Column:
    return F.when(strict, "T1_strict_direct_quote").when(rate >= 0.3, "T2_paraphrase_authentic").otherwise("T3_suspect")


def priority(length: Column) -> Column:
    return F.when(length >= 300, "high").when(length >= 100, "medium").otherwise("low")


def keyword_hits(text: Column, words: Sequence[str]) -> Column:
    """The words that the text holds, case aside, in the order given."""
    text = F.lower(F.coalesce(text, F.lit("")))
    return F.filter(F.array(*(F.lit(w) for w in words)), lambda w: F.contains(text, F.lower(w)))


def layer_decision(status: Column, heading: Column, body: Column, length: Column, l2: Sequence[str], l3: Sequence[str], negative: Sequence[str]) -> Column:
    """struct<layer, action, confidence, review> of a section; the first rule that applies."""
    full = F.concat(F.coalesce(heading, F.lit("")), F.lit("\n"), F.substring(F.coalesce(body, F.lit("")), 1, 500))
    n2, n3 = F.size(keyword_hits(full, l2)), F.size(keyword_hits(full, l3))
    give = lambda layer, action, confidence, review: F.struct(F.lit(layer).alias("layer"), F.lit(action).alias("action"), F.lit(confidence).alias("confidence"), (review if isinstance(review, Column) else F.lit(review)).alias("review"))
    return (
        F.when(status == "unprocessable", give("L_NA", "unprocessable", "high", False))
        .when(status == "duplicate_or_redundant", give("L_NA", "duplicate", "high", False))
        .when((status == "covered_by_pack") & (n2 > 0), give("L2", "extract_l1", "low", True))
        .when(status == "covered_by_pack", give("L1", "extract_l1", "high", False))
        .when(F.size(keyword_hits(heading, negative)) > 0, give("L_NA", "unprocessable", "high", False))
        .when((length < 100) & (status == "pending_decision"), give("L_NA", "unprocessable", "medium", length < 50))
        .when(n3 >= 2, give("L3", "defer_l3_to_runtime_asset", "high", False))
        .when(n3 == 1, give("L3", "defer_l3_to_runtime_asset", "low", True))
        .when((n2 >= 2) | heading.rlike("#C[0-9]"), give("L2", "extract_l2", "high", False))
        .when(n2 == 1, give("L2", "extract_l2", "low", True))
        .when(length >= 300, give("L1", "extract_l1", "medium", True))
        .otherwise(give("L1", "extract_l1", "low", True))
    )


def first_sentence(text: Column, most: int, default: str) -> Column:
    """The first sentence, cut at `most` characters; the default where there is none."""
    first = F.trim(F.element_at(F.split(F.trim(F.coalesce(text, F.lit(""))), "[；。.\\n]", 2), 1))
    return F.coalesce(F.nullif(F.substring(first, 1, most), F.lit("")), F.lit(default))


def steps(text: Column) -> Column:
    """A step list: a JSON list, or texts parted by semicolons or line ends."""
    text = F.trim(F.coalesce(text, F.lit("")))
    parts = F.filter(F.transform(F.split(text, "[;；\\n]"), lambda p: F.trim(p)), lambda p: p != "")
    return F.when(text.startswith("["), F.coalesce(F.from_json(text, "array<string>"), parts)).otherwise(parts)


def inline_map(text: Column) -> Column:
    """`{k: v, k: v}` as a map of texts."""
    inner = F.regexp_replace(F.trim(text), "^\\{|\\}$", "")
    return F.map_from_entries(F.transform(F.filter(F.split(inner, ","), lambda p: F.contains(p, F.lit(":"))), lambda p: F.struct(F.trim(F.split_part(p, F.lit(":"), F.lit(1))), F.trim(F.substr(p, F.instr(p, ":") + 1)))))


def json_list(text: Column) -> Column:
    """The list of texts in a cell; empty where it is none."""
    return F.coalesce(F.from_json(text, "array<string>"), F.array().cast("array<string>"))


def json_field(text: Column, *paths: str) -> Column:
    """The first path of an object cell that holds something."""
    return F.coalesce(*(F.nullif(F.get_json_object(text, p), F.lit("")) for p in paths))


def json_texts(text: Column) -> Column:
    """All text values of a JSON cell, however deep, in order, with their escapes read; keys are no
    values. A cell that is no JSON has none."""
    string = r'"(?:[^"\\]|\\.)*+"'
    values = F.regexp_extract_all(F.regexp_replace(text, string + r"\s*:", ""), F.lit(string), F.lit(0))
    read = F.from_json(F.concat(F.lit("["), F.array_join(values, ","), F.lit("]")), "array<string>")
    return F.coalesce(F.when(F.try_parse_json(text).isNotNull(), read), F.array().cast("array<string>"))


def table_name(file: Column) -> Column:
    return F.regexp_replace(file, r"^[0-9]+_|\.csv$", "")


def inherited(child: Column, parent: Column, default: str, most: int = 300) -> Column:
    """The child's text, else its parent's, else the default; cut at `most` characters."""
    return F.substring(F.coalesce(filled(child), filled(parent), F.lit(default)), 1, most)


def fired(rules: Sequence[tuple[str, Column]]) -> Column:
    """The names of the rules that hold, in order; null does not hold."""
    return F.array_compact(F.array(*(F.when(F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules)))


def prefixed(id_: Column, prefix: str) -> Column:
    return F.when(id_.startswith(prefix), id_).otherwise(F.concat(F.lit(prefix), id_))


def utc_text(ts: Column) -> Column:
    """ISO-8601 in UTC with seconds, whatever the session's zone; a time without zone is in that zone."""
    return F.date_format(F.convert_timezone(F.current_timezone(), F.lit("UTC"), ts.cast("timestamp_ntz")), "yyyy-MM-dd'T'HH:mm:ss'Z'")
