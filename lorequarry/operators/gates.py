"""Governance gates as violations: one pass over the views' rows for all row gates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .policy import BASE_LAYER

#: Layer names, granularities, reviews that let a row be inactive.
LAYER = "^(domain_general|needs_review|brand_[a-z][a-z0-9_]*)$"
GRANULARITY = ("L1", "L2", "L3")
REVIEWED = ("approved", "pending_review")
GOVERNANCE = ("view", "pk", "source_pack_id", "brand_layer", "granularity_layer", "gate_status", "review_status", "compile_run_id")


def _text(name: str) -> Column:
    return F.trim(F.coalesce(F.col(name), F.lit("")))


def row_gates(rows: DataFrame, packs: DataFrame, run_id: str, synthetic: Mapping[str, str], overlay_view: str) -> DataFrame:
    """(view, pk, gate, error) of every broken row gate, S1 to S4, of `rows` (GOVERNANCE).

    S1: the run id is the recomputed one, the source is filled and names a row of `packs`
    (pack_id); views in `synthetic` name themselves with a prefix instead. S2: an inactive row
    needs a review. S3: the layer is known, overlays are not of the base layer. S4: granularity.
    """
    there = packs.select(F.trim("pack_id").alias("pack")).distinct().withColumn("found", F.lit(True))
    rows = rows.select(*GOVERNANCE).withColumn("pack", _text("source_pack_id")).join(there, "pack", "left")
    prefix = reduce(lambda w, kv: w.when(F.col("view") == kv[0], kv[1]), synthetic.items(), F.when(F.lit(False), ""))
    resolved = F.when(prefix.isNotNull(), F.col("pack").startswith(prefix)).otherwise(F.col("found").isNotNull())
    run, gate, layer = _text("compile_run_id"), _text("gate_status"), _text("brand_layer")
    rules = [
        ("S1", "run_mismatch", (run != "") & (run != run_id)),
        ("S1", "empty_source", F.col("pack") == ""),
        ("S1", "orphan_source", (F.col("pack") != "") & ~resolved),
        ("S2", "empty_gate", gate == ""),
        ("S2", "not_reviewed", (gate != "") & (gate != "active") & ~_text("review_status").isin(*REVIEWED)),
        ("S3", "bad_layer", ~layer.rlike(LAYER)),
        ("S3", "base_overlay", (F.col("view") == overlay_view) & (layer == BASE_LAYER)),
        ("S4", "bad_granularity", ~_text("granularity_layer").isin(*GRANULARITY)),
    ]
    broken = F.array_compact(F.array(*(F.when(F.coalesce(bad, F.lit(True)), F.struct(F.lit(g).alias("gate"), F.lit(e).alias("error"))) for g, e, bad in rules)))
    return rows.select("view", "pk", F.inline(broken))


#: The ids that tie a row to its compile run.
RUN_IDS = ("source_manifest_hash", "view_schema_version", "compile_run_id")


def lineage_gate(rows: DataFrame, packs: DataFrame, expected: Mapping[str, str] | None, synthetic: Mapping[str, str], views: Sequence[str], plural: str = "source_pack_ids") -> DataFrame:
    """S1 in full, (view, pk, error), of `rows` (view, pk, source_pack_id, RUN_IDS and `plural`).

    Each filled id of RUN_IDS equals the recomputed one in `expected`; the source is filled and names
    a row of `packs` (pack_id), or, in views of `synthetic`, begins with their prefix; `plural` is
    null, or a JSON list of filled ids that all name packs. Without expected ids, or with a view of
    `views` that has no row, the gate fails for that alone: it cannot vouch for what it cannot
    compare. Such errors have no pk. Views that are not in `synthetic` are resolved.
    """
    spark = rows.sparkSession
    whole = "view string, pk string, error string"
    if expected is None or any(not expected.get(c) for c in RUN_IDS):
        return spark.createDataFrame([(None, None, "expected_ids_missing")], whole)
    there = packs.select(F.trim("pack_id").alias("_pack")).distinct().withColumn("_found", F.lit(True))
    prefix = reduce(lambda w, kv: w.when(F.col("view") == kv[0], kv[1]), synthetic.items(), F.when(F.lit(False), ""))
    source = _text("source_pack_id")
    own = rows.withColumn("_pack", source).join(there, "_pack", "left")
    listed = F.try_parse_json(plural)
    is_list = F.coalesce(F.schema_of_variant(listed).startswith("ARRAY"), F.lit(False))
    unread = (_text(plural) != "") & ~is_list
    rules = [
        *((f"{c}_mismatch", (_text(c) != "") & (_text(c) != expected[c])) for c in RUN_IDS),
        ("empty_source", source == ""),
        ("orphan_source", (source != "") & prefix.isNull() & F.col("_found").isNull()),
        ("wrong_prefix", (source != "") & prefix.isNotNull() & ~source.startswith(prefix)),
        ("malformed_plural", unread),
    ]
    bad = own.select("view", F.col("pk").cast("string").alias("pk"), F.explode(F.array_compact(F.array(*(F.when(F.coalesce(r, F.lit(True)), e) for e, r in rules)))).alias("error"))
    each = rows.where(is_list).select("view", F.col("pk").cast("string").alias("pk"), F.explode(F.try_variant_get(listed, "$", "array<variant>")).alias("v"))
    each = each.select("view", "pk", F.trim(F.coalesce(F.try_variant_get("v", "$", "string"), F.lit(""))).alias("_pack")).join(there, "_pack", "left")
    refs = each.where("_pack = '' OR _found IS NULL").select("view", "pk", F.when(F.col("_pack") == "", "empty_plural").otherwise("orphan_plural").alias("error"))
    named = spark.createDataFrame([(v,) for v in views], "view string")
    empty = named.join(rows.select("view").distinct(), "view", "left_anti").select("view", F.lit(None).cast("string").alias("pk"), F.lit("empty_view").alias("error"))
    return bad.unionByName(refs).unionByName(empty)


def part_gate(rows: DataFrame, pk: str, parts: Column, files: DataFrame, path: str) -> DataFrame:
    """S5, (pk, part): parts of a source cell that no file of the inventory is; a row without parts
    is one with a null part."""
    each = rows.select(pk, F.explode_outer(F.when(F.size(parts) > 0, parts)).alias("part"))
    there = files.select(F.col(path).alias("part"), F.lit(True).alias("found")).distinct()
    return each.join(there, "part", "left").where("part IS NULL OR found IS NULL").select(pk, "part")


def set_gate(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """S7, (value, missing_in): filled values that only one side has."""
    side = lambda df, name: df.select(F.trim(column).alias("value")).where("value <> ''").distinct().withColumn(name, F.lit(True))
    both = side(left, "l").join(side(right, "r"), "value", "full_outer")
    return both.where("l IS NULL OR r IS NULL").select("value", F.when(F.col("l").isNull(), "left").otherwise("right").alias("missing_in"))


def verdicts(counts: DataFrame, broken: DataFrame, gates: Sequence[str], views: Sequence[str]) -> DataFrame:
    """(gate, n_rows, n_bad, verdict): a gate fails on a violation, and if a view has no row.

    `counts` is (view, n), `broken` (gate, n).
    """
    spark = counts.sparkSession
    named = spark.createDataFrame([(v,) for v in views], "view string").join(counts, "view", "left")
    total = named.agg(F.sum(F.coalesce("n", F.lit(0))).alias("n_rows"), F.count_if(F.coalesce("n", F.lit(0)) == 0).alias("n_empty"))
    out = spark.createDataFrame([(g,) for g in gates], "gate string").join(broken, "gate", "left").join(F.broadcast(total))
    n_bad = F.coalesce("n", F.lit(0))
    return out.select("gate", "n_rows", n_bad.alias("n_bad"), F.when((n_bad == 0) & (F.col("n_empty") == 0), "pass").otherwise("fail").alias("verdict"))


def chunk_violations(chunks: DataFrame, dimension: int, filled: Sequence[str]) -> DataFrame:
    """(chunk_id, errors) of chunks that cannot be loaded: a repeated or empty id, an embedding of
    another length or with nulls, an inactive gate, an empty payload field."""
    n = chunks.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("times"))
    rows = chunks.join(n, "chunk_id", "left")
    rules = {"duplicate": F.col("times") > 1, "dimension": ~F.coalesce((F.size("embedding") == dimension) & ~F.exists("embedding", lambda x: x.isNull()), F.lit(False)), "gate": _text("gate_status") != "active", **{f"empty_{c}": _text(c) == "" for c in ["chunk_id", *filled]}}
    errors = F.array_compact(F.array(*(F.when(F.coalesce(bad, F.lit(True)), F.lit(name)) for name, bad in sorted(rules.items()))))
    return rows.select("chunk_id", errors.alias("errors")).where(F.size("errors") > 0)


def requirement_violations(matrix: DataFrame) -> DataFrame:
    """(content_type, field_key, errors) of requirement rules that contradict themselves."""
    level, action = _text("required_level"), _text("fallback_action")
    rules = {
        "empty_key": (_text("content_type") == "") | (_text("field_key") == ""),
        "level": ~level.isin("hard", "soft", "none"),
        "hard_without_reason": (level == "hard") & (_text("block_reason") == ""),
        "hard_must_block": (level == "hard") & (action != "block_brand_output"),
        "soft_must_not_block": (level == "soft") & (action == "block_brand_output"),
    }
    errors = F.array_compact(F.array(*(F.when(bad, F.lit(name)) for name, bad in sorted(rules.items()))))
    return matrix.select("content_type", "field_key", errors.alias("errors")).where(F.size("errors") > 0)


def alias_violations(aliases: DataFrame) -> DataFrame:
    """(alias, n_ids): trimmed, lower-cased aliases that stand for several ids (alias, id)."""
    return aliases.select(F.lower(F.trim("alias")).alias("alias"), "id").where("alias <> ''").groupBy("alias").agg(F.count_distinct("id").alias("n_ids")).where("n_ids > 1")


#: What a replay can end with, in the order of its checks.
CODES = {"ok": 0, "no_log": 2, "bad_enum": 3, "governance_drift": 4, "tenant_drift": 5, "unresolved_id": 6, "foreign_layer": 7, "hash_drift": 8, "field_drift": 9}


def replay_codes(asked: DataFrame, log: DataFrame, views: DataFrame, statuses: Sequence[str], run_id: str) -> DataFrame:
    """(request_id, code) of each asked request: the first of the checks that fails, 0 if none.

    `log` is (request_id, status, compile_run_id, layer, allowed_layers array, ids array, bundle,
    bundle_hash, bundle_request_id); `views` (id, layer, compile_run_id). All requests are
    replayed by two joins, whatever their number.
    """
    ids = log.select("request_id", F.explode_outer("ids").alias("id"), "allowed_layers")
    seen = views.select("id", F.col("layer").alias("view_layer"), F.col("compile_run_id").alias("view_run"))
    met = ids.join(seen, "id", "left")
    lost = (F.col("id").isNotNull()) & ((F.col("view_layer").isNull()) | (F.col("view_run") != run_id))
    foreign = F.col("view_layer").isNotNull() & ~F.array_contains("allowed_layers", F.col("view_layer"))
    found = met.groupBy("request_id").agg(F.bool_or(F.coalesce(lost, F.lit(False))).alias("lost"), F.bool_or(F.coalesce(foreign, F.lit(False))).alias("foreign"))
    rows = asked.select("request_id").join(log.withColumn("logged", F.lit(True)), "request_id", "left").join(found, "request_id", "left")
    wrong = lambda ok: ~F.coalesce(ok, F.lit(False))
    code = (
        F.when(F.col("logged").isNull(), CODES["no_log"])
        .when(wrong(F.col("status").isin(*statuses)), CODES["bad_enum"])
        .when(wrong(F.col("compile_run_id") == run_id), CODES["governance_drift"])
        .when(wrong(F.array_contains("allowed_layers", F.col("layer"))), CODES["tenant_drift"])
        .when(F.col("lost"), CODES["unresolved_id"])
        .when(F.col("foreign"), CODES["foreign_layer"])
        .when(wrong(F.col("bundle_hash") == F.concat(F.lit("sha256:"), F.sha2("bundle", 256))), CODES["hash_drift"])
        .when(wrong(F.col("bundle_request_id") == F.col("request_id")), CODES["field_drift"])
        .otherwise(CODES["ok"])
    )
    return rows.select("request_id", code.alias("code"))


def replay_rate(codes: DataFrame) -> DataFrame:
    """(n, n_ok, rate, all_pass): no request gives a rate of 0 and still passes."""
    n, ok = F.count(F.lit(1)), F.count_if(F.col("code") == 0)
    return codes.agg(n.alias("n"), ok.alias("n_ok"), F.when(n == 0, 0.0).otherwise(F.round(ok / n, 4)).alias("rate"), (n == ok).alias("all_pass"))
