"""Policies as plans: gate status, fallback states, required fields, merging by precedence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quality import violations

#: The base layer, and below the states of gates, reviews and fallbacks.
BASE_LAYER = "domain_general"


def gate_status(layer: Column, universal: Sequence[Column], general: Column) -> Column:
    """active if all universal gates pass and the generality gate does; off the base layer that
    one may be partial. Null gates do not pass."""
    passes = F.lit(True)
    for gate in universal:
        passes = passes & F.coalesce(F.trim(gate) == "pass", F.lit(False))
    general = F.coalesce(F.trim(general), F.lit(""))
    enough = (general == "pass") | (F.coalesce(F.trim(layer) != BASE_LAYER, F.lit(True)) & (general == "partial"))
    return F.when(passes & enough, "active").otherwise("draft")


def fallback_state(brief: Column, required: Column, soft: Column, overlay: Column) -> Column:
    """The first state that applies; null, a violation, if an input is null or outside its closed
    list (`illegal_inputs` names those)."""
    known = brief.isin("complete", "missing") & required.isin("complete", "missing", "not_applicable") & soft.isin("complete", "partial_missing", "not_applicable") & overlay.isNotNull()
    return (
        F.when(~F.coalesce(known, F.lit(False)), F.lit(None))
        .when(brief == "missing", "blocked_missing_business_brief")
        .when(required == "missing", "blocked_missing_required_brand_fields")
        .when(~overlay, "domain_only")
        .when(soft == "partial_missing", "brand_partial_fallback")
        .otherwise("brand_full_applied")
    )


def illegal_inputs(df: DataFrame, keys: Sequence[str], brief: str, required: str, soft: str, overlay: str) -> DataFrame:
    """(keys, errors) of rows that fallback_state cannot decide, with the inputs at fault."""
    closed = {brief: ("complete", "missing"), required: ("complete", "missing", "not_applicable"), soft: ("complete", "partial_missing", "not_applicable")}
    rules = {name: F.col(name).isin(*values) for name, values in closed.items()}
    return violations(df, keys, {**rules, overlay: F.col(overlay).isNotNull()})


def missing_fields(requests: DataFrame, have: DataFrame, matrix: DataFrame) -> DataFrame:
    """(request_id, content_type, missing_hard, missing_soft, status) for each request.

    `requests` (request_id, content_type), `have` (request_id, field_key), `matrix`
    (content_type, field_key, required_level). A type that the matrix lacks is blocked. The
    lists are sorted; a type's rows in the matrix bound them.
    """
    matrix = matrix.select("content_type", "field_key", "required_level").distinct()
    asked = requests.select("request_id", "content_type").join(matrix, "content_type", "left")
    held = have.select("request_id", "field_key").distinct().withColumn("_held", F.lit(True))
    asked = asked.join(held, ["request_id", "field_key"], "left")
    gap = F.col("_held").isNull() & (F.col("field_key") != "")
    lacking = lambda level: F.array_sort(F.collect_set(F.when(gap & (F.col("required_level") == level), F.col("field_key"))))
    out = asked.groupBy("request_id", "content_type").agg(lacking("hard").alias("missing_hard"), lacking("soft").alias("missing_soft"), F.count("required_level").alias("_rules"))
    status = F.when((F.col("_rules") == 0) | (F.size("missing_hard") > 0), "blocked_missing_required_brand_fields").when(F.size("missing_soft") > 0, "brand_partial_fallback").otherwise("brand_full_applied")
    return out.withColumn("status", status).drop("_rules")


def merge(values: DataFrame, policy: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(merged values, decisions) of `values` (key, layer, ord, value) under `policy` (key, action, allow_override).

    Rows with null or empty layers or null values are ignored, as are keys without a rule.
    Other layers win over the base layer. Both results stay one row a value and one row a key,
    so no task holds a key's values: (key, is_base, ord, value) in the order (is_base, ord),
    and (key, action, decision), decision null where there was no conflict.
    """
    rows = values.where("layer <> '' AND value IS NOT NULL").select("key", (F.col("layer") == BASE_LAYER).alias("is_base"), "ord", "value")
    sides = rows.groupBy("key").agg(F.bool_or(~F.col("is_base")).alias("_brand"), F.bool_or("is_base").alias("_base"))
    ruled = sides.join(policy.select("key", "action", "allow_override"), "key")
    both, action = F.col("_brand") & F.col("_base"), F.col("action")
    decision = (
        F.when((action == "override") & both, F.when(F.col("allow_override"), "brand_overrides_domain").otherwise("brand_wins_domain_rejected"))
        .when((action == "block") & both, "blocked")
        .when(action == "needs_review", "needs_review")
        .when(~action.isin("override", "append", "block", "needs_review"), "unknown_action_skipped")
    )
    kept = rows.join(ruled, "key")
    first = kept.where("action = 'append'").groupBy("key", "value").agg(F.min(F.struct("is_base", "ord")).alias("_at")).select("key", "_at.is_base", "_at.ord", "value")
    one_side = kept.where(action.isin("override", "block", "needs_review") & (F.col("is_base") != F.col("_brand"))).select("key", "is_base", "ord", "value")
    return first.unionByName(one_side), ruled.select("key", "action", decision.alias("decision"))


def keyed_update(df: DataFrame, decisions: DataFrame, key: str, column: str, note: str, reset: tuple[str, Column, Column] | None = None) -> DataFrame:
    """`df` with `column` overwritten where `decisions` (key, new_value, reason) names the row;
    the reason joins the note after a bar.

    `reset` (name, when, value) also sets another column of decided rows where the condition on
    the old row holds. Two decisions on one key raise an error when a row meets them; equal ones
    count as one.
    """
    one = decisions.select(key, F.struct("new_value", "reason").alias("_d")).distinct().groupBy(key).agg(F.first("_d").alias("_d"), F.count(F.lit(1)).alias("_n"))
    many = F.raise_error(F.concat(F.lit("two decisions on "), F.col(key).cast("string")))
    d = one.select(key, F.when(F.col("_n") > 1, many.cast(one.schema["_d"].dataType)).otherwise(F.col("_d")).alias("_d"))
    reason = F.col("_d.reason")
    noted = F.when(reason.isNotNull(), F.concat_ws(" | ", F.nullif(F.col(note), F.lit("")), reason)).otherwise(F.col(note))
    new = {column: F.coalesce(F.col("_d.new_value"), F.col(column)), note: noted}
    if reset:
        name, when, value = reset
        new[name] = F.when(F.col("_d").isNotNull() & when, value).otherwise(F.col(name))
    return df.join(d, key, "left").withColumns(new).select(df.columns)
