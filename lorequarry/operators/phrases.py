"""Phrases found in texts that no key leads to."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lineage import cut

#: UTF-8 bytes of the phrases that are searched for at a time; an automaton takes some 40 times that.
SHARD_BYTES = 8 << 20


def find(docs: DataFrame, id_: str, text: str, phrases: DataFrame, key: str, phrase: str, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(`id_`, `key`, at): each phrase that a text holds, with the place, from 0, where it first does.

    One Aho-Corasick automaton finds all phrases in one pass over a text, so there is no product of
    texts and phrases, no shuffle of texts, and nested or overlapping phrases are all met. Phrases
    of more than `shard_bytes` in all are searched for shard by shard: the driver holds one shard, a
    worker its automaton, and each shard costs a pass over the texts. Null or empty phrases, null keys and null
    texts meet nothing; a phrase under several keys gives a row each, repeated rows of one key one;
    repeated rows of `docs` are searched each. `at` counts code points.
    """
    spark = docs.sparkSession
    phrases = phrases.select(F.col(key).alias("_key"), F.col(phrase).alias("_phrase")).where("_phrase <> '' AND _key IS NOT NULL").distinct()
    grouped = phrases.groupBy("_phrase").agg(F.collect_list("_key").alias("_keys"))
    total = phrases.agg(F.sum(F.octet_length("_phrase") + 16)).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    grouped = grouped.withColumn("_shard", F.pmod(F.xxhash64("_phrase"), F.lit(shards)))
    grouped = cut(grouped) if shards > 1 else grouped
    schema = docs.select(id_).schema.add(key, phrases.schema["_key"].dataType).add("at", "long")

    def found(shard: int) -> DataFrame:
        listed = grouped.where(F.col("_shard") == shard).select("_phrase", "_keys").toArrow()
        kind = listed.schema.field("_keys").type.value_type
        held = spark.sparkContext.broadcast((listed["_phrase"].to_pylist(), listed["_keys"].to_pylist()))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words, keys = held.value
            automaton = ahocorasick.Automaton()
            for i, w in enumerate(words):
                automaton.add_word(w, (i, len(w)))
            automaton.make_automaton()
            for batch in batches:
                rows, hits, places = [], [], []
                for row, t in enumerate(batch.column(text).to_pylist() if words else ()):
                    first: dict[int, int] = {}
                    for end, (i, n) in automaton.iter(t or ""):
                        first.setdefault(i, end - n + 1)
                    for i, at in first.items():
                        hits += keys[i]
                        rows += [row] * len(keys[i])
                        places += [at] * len(keys[i])
                yield pa.RecordBatch.from_arrays([batch.column(id_).take(pa.array(rows, pa.int64())), pa.array(hits, kind), pa.array(places, pa.int64())], [id_, key, "at"])

        return docs.select(id_, text).mapInArrow(run, schema)

    if shards == 1:
        return found(0)
    return reduce(DataFrame.unionAll, [cut(found(k)) for k in range(shards)])
