"""Text expressions of the compiled views; all but one stay in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Heading forms (Markdown, Chinese numeral with a comma, dotted number).
MARKDOWN = r"(?s)^(#{1,6})[ \t]+(.+)$"
NUMERAL = r"(?s)^([一二三四五六七八九十]+)、[ \t]*(.+)$"
DOTTED = r"(?s)^([0-9]+(?:\.[0-9]+)*)[ \t]+(.+)$"
NUMBER = r"[0-9]+(?:\.[0-9]+)?"


def heading_level(line: Column) -> Column:
    """Level of a heading line, null for other lines: number of marks; 2 for a numeral; 2 plus
    the dots of a dotted number. The first form that fits decides."""
    return (
        F.when(line.rlike(MARKDOWN), F.char_length(F.regexp_extract(line, MARKDOWN, 1)))
        .when(line.rlike(NUMERAL), 2)
        .when(line.rlike(DOTTED), F.size(F.split(F.regexp_extract(line, DOTTED, 1), r"\.")) + 1)
    )


def compound_paths(text: Column) -> Column:
    """`a/x & y & b/z` as [a/x, a/y, b/z]: later parts without a folder take the first one's.
    Null or blank gives an empty array."""
    parts = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), " & "), lambda p: F.trim(p)), lambda p: p != "")
    folder = F.regexp_extract(F.try_element_at(parts, F.lit(1)), r"^(.+)/[^/]*$", 1)
    return F.transform(parts, lambda p, i: F.when((i == 0) | p.contains("/") | (folder == ""), p).otherwise(F.concat(folder, F.lit("/"), p)))


def phrases(text: Column, least: int) -> Column:
    """What stands between ASCII punctuation marks, trimmed, if at least that long."""
    return F.filter(F.transform(F.split(text, "[,.;!?]"), lambda p: F.trim(p)), lambda p: F.char_length(p) >= least)


def hit_rate(text: Column, wanted: Column, none: float | None = 0.0) -> Column:
    """Share of the wanted phrases that the text holds; `none` where none is wanted."""
    hits = F.size(F.filter(wanted, lambda p: F.contains(text, p)))
    return F.when(F.size(wanted) > 0, hits / F.size(wanted)).otherwise(F.lit(none))


def in_band(text: Column, low: float | Column, high: float | Column) -> Column:
    """True if the text holds numbers and each lies in the band."""
    numbers = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(NUMBER), F.lit(0))
    return (F.size(numbers) > 0) & F.forall(numbers, lambda n: n.cast("double").between(low, high))


def token(text: Column) -> Column:
    """Trimmed, lower-cased, hyphens and spaces as underscores."""
    return F.translate(F.lower(F.trim(text)), "- ", "__")


def pairs(left: Column, right: Column, default: tuple[str, str]) -> Column:
    """All pairs of two small arrays, as array<struct<a,b>>; the default if either is empty."""
    crossed = F.flatten(F.transform(left, lambda a: F.transform(right, lambda b: F.struct(a.alias("a"), b.alias("b")))))
    return F.when(F.size(crossed) > 0, crossed).otherwise(F.array(F.struct(F.lit(default[0]).alias("a"), F.lit(default[1]).alias("b"))))


def sorted_keys(value: Column, kind: T.DataType) -> Column:
    """A value with the fields of its structs and the keys of its maps sorted, at every level."""
    if isinstance(kind, T.StructType):
        fields = [sorted_keys(value[f.name], f.dataType).alias(f.name) for f in sorted(kind, key=lambda f: f.name)]
        return F.when(value.isNotNull(), F.struct(*fields)) if fields else value
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: sorted_keys(x, kind.elementType))
    if isinstance(kind, T.MapType) and isinstance(kind.valueType, T.AtomicType):
        # most maps are in order already
        return F.when(F.map_keys(value) == F.sort_array(F.map_keys(value)), value).otherwise(F.map_from_entries(F.sort_array(F.map_entries(value))))
    if isinstance(kind, T.MapType):
        keys = F.array_sort(F.map_keys(value))
        return F.map_from_arrays(keys, F.transform(keys, lambda k: sorted_keys(F.element_at(value, k), kind.valueType)))
    return value


def canonical_json(df: DataFrame, columns: Sequence[str]) -> Column:
    """Compact JSON of columns of `df` with keys sorted at every level, nulls written."""
    fields = [sorted_keys(F.col(c), df.schema[c].dataType).alias(c) for c in sorted(columns)]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def canonical_text(text: Column) -> Column:
    """A JSON text written anew: compact, keys sorted at every level; null if it cannot be read.

    A VARIANT keeps its keys sorted. Whole numbers written with a point lose it.
    """
    return F.to_json(F.try_parse_json(text))


def sha256_id(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text, 256))


def canonical_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    """`sha256:` and the digest of the columns' canonical JSON."""
    return sha256_id(canonical_json(df, columns))


def uuid5(namespace: str, name: Column) -> Column:
    """Name-based UUID, version 5, of `name` in a namespace given as a UUID text."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(name, "UTF-8")))
    variant = F.element_at(F.array(*(F.lit(x) for x in "89ab")), (F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4) + 1)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def casefold(text: Column) -> Column:
    """Case folding: upper then lower, so that ß and SS meet.

    The empty text between them keeps the optimizer from dropping the first.
    """
    return F.lower(F.concat(F.upper(text), F.lit("")))


def _automaton(s: str) -> tuple[list[dict[str, int]], list[int], list[int], list[int]]:
    """The suffix automaton of a text: transitions, links, lengths and first ends of its states."""
    to, link, length, end, last = [{}], [-1], [0], [-1], 0
    for at, c in enumerate(s):
        new, p = len(to), last
        to.append({})
        link.append(0)
        length.append(length[last] + 1)
        end.append(at)
        while p >= 0 and c not in to[p]:
            to[p][c] = new
            p = link[p]
        if p >= 0:
            q = to[p][c]
            if length[q] != length[p] + 1:
                to.append(to[q].copy())
                link.append(link[q])
                length.append(length[p] + 1)
                end.append(end[q])
                twin = len(to) - 1
                link[q] = twin
                while p >= 0 and to[p].get(c) == q:
                    to[p][c] = twin
                    p = link[p]
                q = twin
            link[new] = q
        last = new
    return to, link, length, end


def common_piece(text: str, quote: str) -> tuple[int, int]:
    """(start in the text, length) of the longest piece that both hold, where the text first holds it.

    Linear in both: the longer one passes the automaton of the shorter, which takes about half a
    kilobyte a character.
    """
    inside = len(text) < len(quote)
    to, link, length, end = _automaton(text if inside else quote)
    best, start, v, n = 0, -1, 0, 0
    for at, c in enumerate(quote if inside else text):
        while c not in to[v] and v:
            v = link[v]
            n = length[v]
        if c not in to[v]:
            continue
        v, n = to[v][c], n + 1
        if n >= best:
            here = (end[v] if inside else at) - n + 1
            if n > best or here < start:
                best, start = n, here
    return start, best


@F.pandas_udf(T.StructType().add("start", "integer").add("length", "integer"))
def longest_overlap(text: pd.Series, quote: pd.Series) -> pd.DataFrame:
    """The longest piece of the quote that the text holds, where it first stands there (code points).

    No built-in function can. Nothing shared, null or empty: start -1, length 0.
    """
    return pd.DataFrame([common_piece(t or "", q or "") for t, q in zip(text, quote)], columns=["start", "length"])
