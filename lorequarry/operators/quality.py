"""Row rules, typed cells, gates and replay of logged results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def violations(df: DataFrame, keys: Sequence[str], rules: Mapping[str, Column]) -> DataFrame:
    """(keys, errors) of rows that break a rule, names sorted; a rule that gives null is broken."""
    broken = F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in sorted(rules.items()))))
    return df.select(*keys, broken.alias("errors")).where(F.size("errors") > 0)


def coerce(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Text cells as typed columns: `c` null where it is empty or bad, and then `c_bad` keeps a bad text."""
    out = {}
    for name, kind in types.items():
        text = F.nullif(F.trim(F.col(name)), F.lit(""))
        out[name] = text.try_cast(kind)
        out[f"{name}_bad"] = F.when(text.try_cast(kind).isNull(), text)
    return df.withColumns(out)


def gate_report(gates: Sequence[tuple[str, DataFrame, Column]]) -> DataFrame:
    """(gate, n_rows, n_bad, verdict) of (name, table, condition); an empty table fails."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(~F.coalesce(ok, F.lit(False))).alias("n_bad")).select(F.lit(name).alias("gate"), "n_rows", "n_bad") for name, df, ok in gates]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumn("verdict", F.when((F.col("n_rows") > 0) & (F.col("n_bad") == 0), "pass").otherwise("fail"))


def replay(log: DataFrame, view: DataFrame, log_id: str, count: str, digest: str, value: str) -> DataFrame:
    """(log_id, status) for each log row: no_rows, count_drift, hash_drift or replayed.

    `view` (log_id, value) holds what the log row drew on. Its digest is an order-free sum of
    64-bit row hashes, so it is combined before the shuffle and no group is collected.
    """
    drawn = view.groupBy(log_id).agg(F.count(F.lit(1)).alias("_n"), digest_of(value).alias("_d"))
    status = F.when(F.col("_n").isNull(), "no_rows").when(F.col("_n") != F.col(count), "count_drift").when(~F.col("_d").eqNullSafe(F.col(digest)), "hash_drift").otherwise("replayed")
    return log.select(log_id, count, digest).join(drawn, log_id, "left").select(log_id, status.alias("status"))


def digest_of(value: str) -> Column:
    """Order-free digest of a group's texts: the sum of the first 15 hex digits of their sha256."""
    h = F.conv(F.substring(F.sha2(F.coalesce(F.col(value).cast("string"), F.lit("")), 256), 1, 15), 16, 10)
    return F.sum(h.cast("decimal(20,0)")).cast("string")
