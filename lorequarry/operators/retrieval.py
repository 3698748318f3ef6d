"""The request path: filters that cannot be removed, two-stage search, briefs, texts, bundles."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import in_band

#: What a payload filter always asks for besides the layers.
ACTIVE, GRANULARITY = "active", ("L1", "L2", "L3")


def payload_filter(layers: Sequence[str], content_type: str | None = None, extra: Mapping[str, Sequence] | None = None, names: Mapping[str, str] | None = None) -> Column:
    """Layer, gate and granularity, which no caller can take away, then the type and extra terms.

    `names` maps brand_layer, gate_status, granularity_layer and content_type to other columns.
    No allowed layer is an error; null fails.
    """
    if not layers:
        raise ValueError("no layer is allowed")
    c = lambda name: F.col((names or {}).get(name, name))
    keep = c("brand_layer").isin(*layers) & (c("gate_status") == ACTIVE) & c("granularity_layer").isin(*GRANULARITY)
    if content_type:
        keep = keep & (c("content_type") == content_type)
    for name, values in (extra or {}).items():
        keep = keep & F.col(name).isin(*values)
    return F.coalesce(keep, F.lit(False))


def rerank(candidates: DataFrame, score: Callable[[DataFrame], DataFrame], id_: str, k: int) -> DataFrame:
    """The k best of the candidates after the caller's `score`, which returns them with a column
    `rerank_score`; it may drop candidates, but one that was not among them is an error."""
    candidates = candidates.cache()
    try:
        scored = score(candidates)
        intruders = scored.join(candidates.select(id_), id_, "left_anti").select(id_).limit(5).collect()
        if intruders:
            raise ValueError(f"rerank brought candidates of its own: {[r[0] for r in intruders]}")
        return scored.orderBy(F.desc("rerank_score"), id_).limit(k)
    finally:
        candidates.unpersist()


def brief_check(brief: Column, hard: Sequence[str], soft: Sequence[str], invalid: Mapping[str, Column]) -> Column:
    """struct<status, blocked_fields, missing_fields, unknown_fields, invalid_fields> of a map of
    texts: hard fields that lack block, soft ones are told, so are keys of neither list; a given
    value that breaks its rule is invalid and decides first."""
    keys = F.coalesce(F.map_keys(brief), F.array().cast("array<string>"))
    lacking = lambda names: F.filter(F.array(*(F.lit(n) for n in names)), lambda n: ~F.array_contains(keys, n))
    wrong = F.array_compact(F.array(*(F.when(F.array_contains(keys, F.lit(n)) & F.coalesce(bad, F.lit(True)), F.lit(n)) for n, bad in invalid.items())))
    unknown = F.array_sort(F.array_except(keys, F.array(*(F.lit(n) for n in [*hard, *soft]))))
    blocked = lacking(hard)
    status = F.when(F.size(wrong) > 0, "invalid").when(F.size(blocked) > 0, "blocked_missing_business_brief").otherwise("ok")
    return F.struct(status.alias("status"), blocked.alias("blocked_fields"), lacking(soft).alias("missing_fields"), unknown.alias("unknown_fields"), wrong.alias("invalid_fields"))


def forbidden_hits(df: DataFrame, keys: Sequence[str], text: str, patterns: Sequence[tuple[str, str, Column | None]]) -> DataFrame:
    """(keys, fp_id, hit): every match of every pattern, case aside.

    A pattern is (id, Java regex, None or a condition on `hit` that lets it pass).
    """

    def hits(name: str, pattern: str) -> Column:
        every = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(f"(?i){pattern}"), F.lit(0))
        return F.transform(every, lambda h: F.struct(F.lit(name).alias("fp_id"), h.alias("hit")))

    found = F.flatten(F.array(*(hits(name, pattern) for name, pattern, _ in patterns)))
    rows = df.select(*df.columns, F.explode(found).alias("x")).select(*df.columns, "x.fp_id", "x.hit")
    for name, _, passes in patterns:
        if passes is not None:
            rows = rows.where(~((F.col("fp_id") == name) & F.coalesce(passes, F.lit(False))))
    return rows.select(*keys, "fp_id", "hit")


def price_passes(hit: Column, low: Column, high: Column) -> Column:
    """Every number of the hit lies in the brief's band; without a band or a number it does not."""
    return in_band(hit, low, high)


def guardrail_status(text: Column, n_hits: Column, n_missing: Column) -> Column:
    """An empty text is blocked before anything else is asked."""
    return F.when(F.trim(F.coalesce(text, F.lit(""))) == "", "blocked_empty").when((n_hits > 0) | (n_missing > 0), "blocked").otherwise("pass")


def preflight(tenant_ok: Column, intent: Column, content_type: Column, brief: Column) -> Column:
    ok = lambda c: F.coalesce(c.isin("ok", "complete"), F.lit(False))
    return F.when(~F.coalesce(tenant_ok, F.lit(False)), "blocked").when(ok(intent) & ok(content_type) & ok(brief), "ok").otherwise("needs_review")


def disabled_if_empty(df: DataFrame, columns: Sequence[str], word: str = "disabled") -> DataFrame:
    """`df` with the word where one of the columns is null or empty."""
    return df.withColumns({c: F.coalesce(F.nullif(F.trim(F.col(c)), F.lit("")), F.lit(word)) for c in columns})


def first_of_each(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key by a total order of columns, as one aggregate: no sort of a key's rows."""
    rest = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(*order)).alias("best")
    return df.groupBy(*keys).agg(best).select(*keys, "best.*")


def in_arrival_order(value: str, order: str) -> Column:
    """A group's values in the order of `order`, as an array (the caller bounds the group)."""
    return F.transform(F.array_sort(F.collect_list(F.struct(order, value))), lambda x: x[value])


def latest(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The last n rows by a total order, in that order."""
    return df.orderBy(*(F.desc(c) for c in order)).limit(n).orderBy(*order)


def ranked_in(df: DataFrame, keys: Sequence[str], order: Sequence, name: str = "rank") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
