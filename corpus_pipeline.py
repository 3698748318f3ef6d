"""The training-data pipeline: documents to packed sequences, in five stages.

Each stage reads what its predecessor wrote and kept. All but the last return the columns of
`documents`.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorequarry.llm import decontam, langid, linededup, minhash, packing
from lorequarry.llm.queries import word_bpe
from lorequarry.llm.shared import checkpoint_folder, cut, remove, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A document whose best language has a lower posterior is rejected, as is one without letters.
LEAST_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject texts without letters or without a clear language.

    Null and empty texts go. Repeated rows are judged each; an empty table stays empty.
    """
    model = langid.train(docs)
    kept = langid.predict(docs.select(COLUMNS), model)
    return kept.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select(COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines that an earlier document holds; a text that loses all of them goes.

    Null texts are one empty line and stay, empty. A null doc_id loses no line. Rows that repeat
    a doc_id are one document and keep each other's lines.
    """
    out = linededup.dedup_lines(docs.select(COLUMNS))
    out = out.where("NOT (n_dropped > 0 AND n_dropped = n_lines)")
    return out.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", F.char_length("kept_text").cast("long").alias("n_chars"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate group (five-word shingles, 0.8): the least doc_id.

    Wordless texts and null ids are in no group and stay. Of rows that repeat both doc_id and
    text one stays; rows of one doc_id with different texts are kept or dropped together.
    """
    judged = minhash.near_duplicates(docs, words=5, percent=80)
    gone = cut(judged.where("NOT kept").select("doc_id").distinct())
    gone = F.broadcast(gone) if gone.count() <= minhash.BROADCAST_IDS else gone
    kept = docs.join(gone, "doc_id", "left_anti").select(COLUMNS)
    twice = cut(docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id"))
    if twice.isEmpty():
        return kept
    return kept.join(twice, "doc_id", "left_anti").unionByName(kept.join(twice, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item.

    Null and wordless texts stay; an empty benchmark drops nothing. Repeated rows are judged each.
    """
    return decontam.without_leaks(docs.select(COLUMNS), table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of 4096 tokens.

    Null and empty texts have the end id alone; texts of more than 4096 ids are cut there.
    Repeated rows are packed each; an empty table gives no sequence.
    """
    return packing.pack(packing.token_pieces(docs, word_bpe()))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: Classifying, near-duplicate search by hashes and packing have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`, each written to the shared folder and read by the next.

    A stage's files are deleted as soon as its successor's are there.
    """
    docs = table(spark, sf_dir, "documents").select(COLUMNS)
    folder, before = f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4().hex}", None
    try:
        for name, stage in STAGES[:-1]:
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
            docs = spark.read.parquet(f"{folder}/{name}")
            if before:
                remove(spark, f"{folder}/{before}")
            before = name
        return cut(STAGES[-1][1](spark, docs, sf_dir))
    finally:
        remove(spark, folder)
