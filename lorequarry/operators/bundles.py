"""Context bundles of sixteen fields, their log rows of twenty-nine, and their replay."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import canonical_json, canonical_text, sha256_id
from .gates import CODES, GRANULARITY, LAYER
from .schema import Compiler

#: A bundle's fields.
FIELDS = [
    "request_id", "tenant_id", "resolved_brand_layer", "allowed_layers", "content_type", "recipe", "business_brief", "domain_packs", "play_cards", "runtime_assets", "brand_overlays", "evidence",
    "missing_fields", "fallback_status", "generation_constraints", "governance",
]
#: The parts that hold rows, with the log's column of their ids.
PARTS = {"domain_packs": "retrieved_pack_ids", "play_cards": "retrieved_play_card_ids", "runtime_assets": "retrieved_asset_ids", "brand_overlays": "retrieved_overlay_ids"}
#: A log row's fields.
LOG_FIELDS = [
    "request_id", "tenant_id", "resolved_brand_layer", "allowed_layers", "user_query_hash", "classified_intent", "content_type", "selected_recipe_id", "retrieved_pack_ids", "retrieved_play_card_ids",
    "retrieved_asset_ids", "retrieved_overlay_ids", "retrieved_evidence_ids", "fallback_status", "missing_fields", "blocked_reason", "context_bundle_hash", "final_output_hash", "compile_run_id",
    "source_manifest_hash", "view_schema_version", "embedding_model", "embedding_model_version", "rerank_model", "rerank_model_version", "llm_assist_model", "model_policy_version", "created_at",
    "context_bundle_json",
]
#: The states of a bundle, and the words for what is unused or absent.
STATES = ["brand_full_applied", "brand_partial_fallback", "domain_only", "blocked_missing_required_brand_fields", "blocked_missing_business_brief"]
DISABLED, NONE = "disabled", "none"
_TEXT, _TEXTS = {"type": "string", "minLength": 1}, {"type": "array", "items": {"type": "string"}}
_ROWS = {"type": "array", "items": {"type": "object"}}
_LAYER = {"type": "string", "pattern": LAYER}
SCHEMA = {
    "type": "object",
    "required": FIELDS,
    "not": {"required": ["user_query"]},
    "properties": {
        "request_id": _TEXT, "tenant_id": _TEXT, "resolved_brand_layer": _LAYER, "allowed_layers": {"type": "array", "items": _LAYER, "minItems": 1}, "content_type": _TEXT, "recipe": {"type": "object"},
        "business_brief": {"type": "object"}, **dict.fromkeys(PARTS, _ROWS), "missing_fields": _TEXTS, "fallback_status": {"enum": STATES}, "generation_constraints": _TEXTS,
        "evidence": {"type": "array", "items": {"type": "object", "required": ["evidence_id"], "properties": {"evidence_id": _TEXT, "brand_layer": {"type": ["string", "null"]}}}},
        "governance": {
            "type": "object", "required": ["gate_policy", "granularity_layers", "traceability_required", "compile_run_id", "source_manifest_hash", "view_schema_version"],
            "properties": {"traceability_required": {"type": "boolean"}, "granularity_layers": {"type": "array", "items": {"enum": list(GRANULARITY)}}, **dict.fromkeys(("gate_policy", "compile_run_id", "source_manifest_hash", "view_schema_version"), _TEXT)},
        },
    },
}


def assemble(requests: DataFrame, items: DataFrame) -> DataFrame:
    """FIELDS of each request, from `requests` (all of them but the parts and the evidence) and
    `items` (request_id, part, ord, item): rows of the parts, and `vector` rows for evidence alone.

    An item is a map of texts. Items stand in the order of `ord`; evidence is what they name in
    `evidence_id`, parts first, each once as first seen, that of vector rows with its layer. A
    request's items are collected into its row, as many as its policy lets through.
    """
    # one list and one sort a request; maps have no order, their entries have, and stay sorted by key
    listed = F.sort_array(F.collect_list(F.struct("ord", "part", F.sort_array(F.map_entries("item")).alias("item"))))
    of = lambda part: F.transform(F.filter("_items", lambda x: x["part"] == part), lambda x: F.map_from_entries(x["item"]))
    grouped = items.groupBy("request_id").agg(listed.alias("_items")).select("request_id", *(of(p).alias(p) for p in [*PARTS, "vector"]))
    empty = F.array().cast("array<map<string,string>>")
    rows = requests.join(grouped, "request_id", "left").withColumns({p: F.coalesce(F.col(p), empty) for p in [*PARTS, "vector"]})
    named = lambda x, layer: F.struct(F.try_element_at(x, F.lit("evidence_id")).alias("e"), layer.alias("layer"))
    layered = lambda x: F.struct(F.try_element_at(x, F.lit("brand_layer")).alias("v"))
    own = F.transform(F.concat("domain_packs", "play_cards", "runtime_assets"), lambda x: named(x, F.lit(None).cast("struct<v:string>")))
    seen = F.transform("vector", lambda x: named(x, layered(x)))
    rows = rows.withColumn("_all", F.filter(F.concat(own, seen), lambda x: x["e"] != ""))
    # most requests name nothing twice
    first = F.when(F.size(F.array_distinct("_all.e")) == F.size("_all"), F.col("_all")).otherwise(F.filter("_all", lambda x, i: F.array_position(F.col("_all.e"), x["e"]) == i + 1))
    id_ = F.lit("evidence_id")
    evidence = F.transform(first, lambda x: F.when(x["layer"].isNull(), F.create_map(id_, x["e"])).otherwise(F.create_map(F.lit("brand_layer"), x["layer"]["v"], id_, x["e"])))
    return rows.withColumn("evidence", evidence).select(FIELDS)


def with_json(bundles: DataFrame) -> DataFrame:
    """`bundles` with context_bundle_json (canonical), context_bundle_hash and errors (of SCHEMA)."""
    json = canonical_json(bundles, FIELDS)
    out = bundles.withColumn("context_bundle_json", json).withColumn("context_bundle_hash", sha256_id(F.col("context_bundle_json")))
    return out.withColumn("errors", Compiler({}).row_errors(SCHEMA, bundles.select(FIELDS).schema))


def _listed(texts: Column) -> Column:
    return F.to_json(F.coalesce(texts, F.array().cast("array<string>")))


def log_rows(bundles: DataFrame, extra: Mapping[str, Column], models: Mapping[str, str], created_at: Column, id_: str = "id") -> DataFrame:
    """LOG_FIELDS and `log_errors` of bundles (as `with_json` gives them).

    `extra` has user_query_hash, classified_intent, selected_recipe_id, and may have blocked_reason
    (else `none`) and final_output_hash (else `disabled`); `models` the model columns, each
    `disabled` where it is absent or empty. Items are named by their key `id_`. A field that is
    empty all the same is an error: what is off must say so.
    """
    either = lambda c, word: F.coalesce(F.nullif(c, F.lit("")), F.lit(word))
    ids = {log: _listed(F.filter(F.transform(F.col(part), lambda x: F.try_element_at(x, F.lit(id_))), lambda x: x.isNotNull())) for part, log in PARTS.items()}
    cells = {
        **{c: F.col(c) for c in ("request_id", "tenant_id", "resolved_brand_layer", "content_type", "fallback_status", "context_bundle_hash", "context_bundle_json")},
        **ids,
        "retrieved_evidence_ids": _listed(F.transform("evidence", lambda x: F.element_at(x, "evidence_id"))),
        "allowed_layers": _listed(F.col("allowed_layers")), "missing_fields": _listed(F.col("missing_fields")), "created_at": created_at,
        **{c: F.col(f"governance.{c}") for c in ("compile_run_id", "source_manifest_hash", "view_schema_version")},
        **{c: either(F.lit(models.get(c)).cast("string"), DISABLED) for c in LOG_FIELDS if "model" in c},
        "blocked_reason": either(extra.get("blocked_reason", F.lit(None).cast("string")), NONE), "final_output_hash": either(extra.get("final_output_hash", F.lit(None).cast("string")), DISABLED),
        **{c: extra[c] for c in ("user_query_hash", "classified_intent", "selected_recipe_id")},
    }
    out = bundles.select(*(cells[c].cast("string").alias(c) for c in LOG_FIELDS), "errors")
    empty = F.array_except(F.array(*(F.when(F.coalesce(F.col(c), F.lit("")) == "", F.lit(f"{c}: empty")) for c in LOG_FIELDS)), F.array(F.lit(None).cast("string")))
    return out.withColumn("log_errors", F.concat("errors", empty)).drop("errors")


def replay(asked: DataFrame, log: DataFrame, views: DataFrame, tenants: DataFrame, ids: Mapping[str, str]) -> DataFrame:
    """(request_id, code, consistency_hash) of each asked request: the first check that fails, 0 if none.

    `log` has LOG_FIELDS; `views` (view, id, brand_layer, and the three governance ids); `tenants`
    (tenant_id, brand_layer, allowed_layers). `ids` maps log columns of ids to views. In order: the
    log has the request; its state is known; its governance ids are those of all view rows; its
    layers are its tenant's; every id is in its view, of its run, in an allowed layer; the stored
    bundle can be read, fits SCHEMA, and hashes anew to the logged hash; and its fields are the log's.
    All requests are replayed by a handful of joins.
    """
    governed = ["compile_run_id", "source_manifest_hash", "view_schema_version"]
    now = views.agg(*(F.when(F.count_distinct(c) == 1, F.min(c)).alias(f"_{c}") for c in governed))
    listed = lambda c: F.coalesce(F.from_json(c, "array<string>"), F.array().cast("array<string>"))
    of = lambda c, view: F.transform(listed(c), lambda x: F.struct(F.lit(view).alias("view"), x.alias("id")))
    named = F.flatten(F.array(*(of(c, v) for c, v in ids.items())))
    each = log.select("request_id", "allowed_layers", "compile_run_id", F.inline(named))
    met = each.join(views.select("view", "id", F.col("brand_layer").alias("_layer"), F.col("compile_run_id").alias("_run")), ["view", "id"], "left")
    lost = F.col("_layer").isNull() | ~F.col("_run").eqNullSafe(F.col("compile_run_id"))
    foreign = ~F.array_contains(listed("allowed_layers"), F.col("_layer"))
    # an order-free digest of what the ids lead to, so that no request's rows are collected
    seen = F.sum(F.xxhash64("view", "id", "_layer", "_run").cast("decimal(38,0)")).cast("string")
    found = met.groupBy("request_id").agg(F.bool_or(lost).alias("_lost"), F.bool_or(F.coalesce(foreign, F.lit(False))).alias("_foreign"), seen.alias("_seen"))
    scope = tenants.select("tenant_id", F.col("brand_layer").alias("_tenant"), F.array_sort("allowed_layers").alias("_allowed"))
    rows = asked.select("request_id").join(log.withColumn("_logged", F.lit(True)), "request_id", "left").join(found, "request_id", "left").join(scope, "tenant_id", "left")
    rows = rows.join(F.broadcast(now))  # one row
    bundle = F.col("context_bundle_json")
    read = canonical_text(bundle)
    same = ("request_id", "tenant_id", "resolved_brand_layer", "content_type", "fallback_status")
    cells = F.from_json(bundle, T.StructType([T.StructField(c, T.StringType()) for c in same]))
    wrong = lambda ok: ~F.coalesce(ok, F.lit(False))
    both = lambda pairs: F.forall(F.array(*(a.eqNullSafe(b) for a, b in pairs)), lambda x: x)
    code = (
        F.when(F.col("_logged").isNull(), CODES["no_log"])
        .when(wrong(F.col("fallback_status").isin(STATES)), CODES["bad_enum"])
        .when(wrong(both([(F.col(c), F.col(f"_{c}")) for c in governed])), CODES["governance_drift"])
        .when(wrong((F.col("_tenant") == F.col("resolved_brand_layer")) & (F.array_sort(listed("allowed_layers")) == F.col("_allowed"))), CODES["tenant_drift"])
        .when(F.col("_lost"), CODES["unresolved_id"])
        .when(F.col("_foreign"), CODES["foreign_layer"])
        .when(wrong((F.size(Compiler({}).json_errors(SCHEMA, bundle)) == 0) & (sha256_id(read) == F.col("context_bundle_hash"))), CODES["hash_drift"])
        .when(wrong(cells.eqNullSafe(F.struct(*(F.col(c) for c in same)))), CODES["field_drift"])
        .otherwise(CODES["ok"])
    )
    signed = F.to_json(F.struct(*sorted(c for c in LOG_FIELDS if c not in ("created_at", "context_bundle_json")), F.coalesce("_seen", F.lit("0")).alias("seen")), {"ignoreNullFields": "false"})
    return rows.select("request_id", code.alias("code"), F.when(code == 0, sha256_id(signed)).alias("consistency_hash"))
