"""The schemas of twelve tables, seven views and five control tables, and their preflight."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import schema
from .catalog import query


def _object(required: str, **properties) -> dict:
    return {"type": "object", "properties": properties, "required": required.split()}


WHOLE, NUMBER, TEXT = {"type": "integer"}, {"type": "number"}, {"type": "string"}
SCHEMAS = {
    "$defs": {
        "key": {"type": "integer", "minimum": 0},
        "name": {"type": "string", "minLength": 3},
        # views
        "customer": _object("c_custkey c_name", c_custkey={"$ref": "#/$defs/key"}, c_name={"type": "string", "pattern": "^Customer#[0-9]{9}$"}, c_acctbal={"type": "number", "minimum": 0}, c_mktsegment={"enum": ["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY"]}),
        "supplier": _object("s_suppkey", s_suppkey={"$ref": "#/$defs/key"}, s_name={"$ref": "#/$defs/name"}, s_acctbal={"type": "number", "exclusiveMinimum": 100}),
        "part": _object("p_partkey p_name", p_partkey={"$ref": "#/$defs/key"}, p_name={"$ref": "#/$defs/name"}, p_brand={"type": "string", "pattern": "^Brand#[1-4]", "maxLength": 8}, p_type={"type": "string", "maxLength": 7}, p_size={"type": "integer", "maximum": 40}),
        "orders": {**_object("o_orderkey", o_orderkey={"$ref": "#/$defs/key"}, o_orderstatus={"enum": ["F", "O"]}, o_totalprice=NUMBER), "if": {"properties": {"o_orderstatus": {"const": "F"}}}, "then": {"properties": {"o_totalprice": {"maximum": 400000}}}},
        "lineitem": _object("l_orderkey l_linenumber", l_orderkey={"$ref": "#/$defs/key"}, l_linenumber=WHOLE, l_quantity={"type": "integer", "minimum": 2}, l_discount={"type": "number", "exclusiveMaximum": 0.1}, l_returnflag={"enum": ["A", "N", "R"]}),
        "events": _object("event_id", event_id={"$ref": "#/$defs/key"}, event_type={"not": {"const": "error"}}, props={"type": "object", "required": ["k"], "properties": {"k": {"type": "integer", "maximum": 90}}}),
        "documents": _object("doc_id text lang", doc_id={"$ref": "#/$defs/key"}, text={"type": "string", "minLength": 200}, lang={"enum": ["en", "fr", "es"]}),
        # control tables
        "nation": _object("n_nationkey", n_nationkey={"$ref": "#/$defs/key"}, n_regionkey={"type": "integer", "maximum": 3}),
        "region": _object("r_regionkey r_name", r_regionkey={"$ref": "#/$defs/key"}, r_name={"$ref": "#/$defs/name"}),
        "labels": _object("doc_id quality", quality={"enum": [0, 1]}, toxic={"const": 0}),
        "benchmark": _object("item_id text", text={"type": "string", "minLength": 160}),
        "pages": _object("page_id url", url={"type": "string", "pattern": "/(en|fr|de)/"}, html={"type": "string", "pattern": "^<!DOCTYPE"}),
    }
}
#: The key columns of each table.
KEYS = {"customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey", "orders": "o_orderkey", "lineitem": "l_orderkey l_linenumber", "events": "event_id", "documents": "doc_id", "nation": "n_nationkey", "region": "r_regionkey", "labels": "doc_id", "benchmark": "item_id", "pages": "page_id"}
#: The same rules as conditions that break them.
BROKEN = {
    "customer": {"c_name: pattern": "NOT regexp_matches(c_name, '^Customer#[0-9]{9}$')", "c_acctbal: minimum": "c_acctbal < 0", "c_mktsegment: enum": "c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'MACHINERY')"},
    "supplier": {"s_acctbal: exclusiveMinimum": "s_acctbal <= 100"},
    "part": {"p_brand: pattern": "NOT regexp_matches(p_brand, '^Brand#[1-4]')", "p_type: maxLength": "length(p_type) > 7", "p_size: maximum": "p_size > 40"},
    "orders": {"o_orderstatus: enum": "o_orderstatus NOT IN ('F', 'O')", "o_totalprice: maximum": "o_orderstatus = 'F' AND o_totalprice > 400000"},
    "lineitem": {"l_quantity: type": "l_quantity % 1 <> 0", "l_quantity: minimum": "l_quantity < 2", "l_discount: exclusiveMaximum": "l_discount >= 0.1::DOUBLE"},
    "events": {"event_type: not": "event_type = 'error'", "props: type": "json_type(props) <> 'OBJECT'", "props/k: required": "json_extract(props, '$.k') IS NULL", "props/k: maximum": "(props->>'$.k')::BIGINT > 90"},
    "documents": {"text: minLength": "length(text) < 200", "text: required": "text IS NULL", "lang: required": "lang IS NULL", "lang: enum": "lang NOT IN ('en', 'fr', 'es')"},
    "nation": {"n_regionkey: maximum": "n_regionkey > 3"},
    "region": {"r_name: minLength": "length(r_name) < 3"},
    "labels": {"quality: enum": "quality NOT IN (0, 1)", "quality: required": "quality IS NULL", "toxic: const": "toxic <> 0"},
    "benchmark": {"text: minLength": "length(text) < 160"},
    "pages": {"url: pattern": "NOT regexp_matches(url, '/(en|fr|de)/')", "html: pattern": "NOT regexp_matches(html, '^<!DOCTYPE')"},
}


def _sql(table: str) -> str:
    keys = KEYS[table].split()
    bad = " UNION ALL ".join(f"SELECT {', '.join(f'{k} AS k{i}' for i, k in enumerate(keys))}, '{error}' AS error FROM {table} WHERE {rule}" for error, rule in BROKEN[table].items())
    order = ", ".join(f"k{i}" for i in range(len(keys)))
    label = " || ',' || ".join(f"k{i}" for i in range(len(keys)))
    return f"""
SELECT '{table}' AS name, CASE WHEN n > 0 THEN 'fail' ELSE 'pass' END AS status, (SELECT count(*) FROM {table}) AS checked_rows, n AS n_violations, coalesce(listed, '') AS first, n > 50 AS truncated
FROM (SELECT count(*) AS n FROM ({bad})), (SELECT string_agg({label} || ' ' || error, chr(10) ORDER BY {order}, error) AS listed FROM (SELECT * FROM ({bad}) ORDER BY {order}, error LIMIT 50))"""


@query(" UNION ALL ".join(_sql(table) for table in KEYS))
def preflight(spark, t):
    """Every row of twelve tables against its schema: verdict, counts and the first fifty errors."""
    out = schema.preflight([(name, t(name), SCHEMAS, name, keys.split()) for name, keys in KEYS.items()])
    return out.withColumn("first", F.array_join("first", "\n"))
