"""The subpackage's entries for queries() and oracle_sql()."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontam, huffman, langid, linededup, minhash, packing, quality, repetition, runs, simhash, warc, whitening
from .shared import cut, remove, table


def _remainder(n: int, r: int) -> Column:
    """Whether crc32(doc_id as text) mod n is r; a null doc_id has no remainder: false."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % n == r, F.lit(False))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos,
         unnest(string_split(coalesce(text, ''), chr(10))) AS line
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
firsts AS (SELECT k, min(doc_id) AS first FROM keyed WHERE length(k) >= 10 GROUP BY k),
judged AS (SELECT keyed.*, coalesce(first < doc_id, false) AS gone FROM keyed LEFT JOIN firsts USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", _remainder(3, 1))
    model = langid.train(docs.where("NOT held_out"))
    return langid.predict(docs.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score")


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


OP10_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
           WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
           ELSE [array_to_string(w[i:i + 2], ' ') for i in range(1, len(w) - 1)] END) AS s
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
-- equal sets are one class
sets AS (SELECT doc_id, md5(string_agg(s, chr(10) ORDER BY s)) AS h FROM shingles GROUP BY doc_id),
classes AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY h) AS rep FROM sets),
of_reps AS (SELECT doc_id, s, n FROM shingles JOIN sizes USING (doc_id) JOIN classes USING (doc_id) WHERE doc_id = rep),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, x.n AS na, y.n AS nb, count(*) AS common
  FROM of_reps x JOIN of_reps y ON x.s = y.s AND x.doc_id < y.doc_id AND 100 * least(x.n, y.n) >= 85 * greatest(x.n, y.n)
  GROUP BY ALL),
links AS (SELECT a, b FROM pairs WHERE 100 * common >= 85 * (na + nb - common)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT DISTINCT a AS node, a AS seen FROM edges
  UNION
  SELECT r.node, e.b FROM reach r JOIN edges e ON e.a = r.seen),
components AS (SELECT node, min(seen) AS component FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component, rep, d.doc_id) AS component_id,
       coalesce(component, rep, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN classes USING (doc_id) LEFT JOIN components ON node = rep
"""


def word_bpe() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.token_pieces(table(spark, sf_dir, "documents"), word_bpe()))


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = huffman.fresh_folder(spark)
    try:
        huffman.write_ids(table(spark, sf_dir, "documents"), word_bpe(), folder)
        return cut(huffman.read_ids(spark, folder))
    finally:
        remove(spark, folder)


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.fingerprint_table(table(spark, sf_dir, "documents"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    held_out = _remainder(5, 0)
    model = quality.train(docs, labels.where(~held_out))
    out = quality.score(docs, model)
    return out.select("doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op3_chat_quotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.reply_ordered(table(spark, sf_dir, "conversations"))


OP3_SQL = r"""
WITH RECURSIVE msgs AS (
  SELECT row_number() OVER () AS id, * FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations)),
split AS (
  SELECT id, conv_id, turn, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos,
         unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM msgs),
fronts AS (SELECT *, regexp_extract(line, '^((?:[ 	]*>)*)', 1) AS front FROM split),
lines AS (
  SELECT id, conv_id, turn, pos, line, length(regexp_replace(front, '[^>]', '', 'g')) AS level,
         trim(substr(line, length(front) + 1), ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS bare FROM fronts),
begun AS (
  SELECT *, CASE WHEN bare = '' OR coalesce(lag(bare) OVER w, '') = '' OR lag(level) OVER w <> level THEN 1 ELSE 0 END AS b
  FROM lines WINDOW w AS (PARTITION BY id ORDER BY pos)),
runs AS (SELECT *, sum(b) OVER (PARTITION BY id ORDER BY pos) AS run FROM begun),
passages AS (
  SELECT id, conv_id, turn, min(level) AS level, string_agg(bare, chr(10) ORDER BY pos) AS p FROM runs GROUP BY id, conv_id, turn, run),
bodies AS (
  SELECT id, conv_id, turn, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT regexp_matches(line, '^[ 	]*>')), '') AS body
  FROM lines GROUP BY id, conv_id, turn),
normal AS (
  SELECT id, conv_id, turn, level, quoted, trim(regexp_replace(translate(p, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ 	

]+', ' ', 'g')) AS p
  FROM (SELECT *, level > 0 AS quoted FROM passages UNION ALL SELECT id, conv_id, turn, 0, body, false FROM bodies)),
units AS (SELECT * FROM normal WHERE p <> '' AND conv_id IS NOT NULL AND turn IS NOT NULL),
firsts AS (SELECT conv_id, p, min(turn) AS first FROM units WHERE NOT quoted GROUP BY conv_id, p),
quotes AS (SELECT u.id, u.conv_id, u.turn, u.level, CASE WHEN first < u.turn THEN first END AS first
           FROM units u LEFT JOIN firsts f ON u.conv_id = f.conv_id AND u.p = f.p WHERE quoted),
best AS (SELECT id, min(level) AS level FROM quotes WHERE first IS NOT NULL GROUP BY id),
replies AS (
  SELECT q.id, conv_id, turn, count(*) AS n_quotes, count(first) AS n_linked,
         max(first) FILTER (WHERE q.level = best.level) AS reply_to
  FROM quotes q LEFT JOIN best ON q.id = best.id GROUP BY q.id, conv_id, turn),
up AS (
  SELECT id, conv_id, turn AS at, turn AS root FROM msgs
  UNION ALL
  SELECT up.id, up.conv_id, r.turn, r.reply_to FROM up JOIN replies r ON r.conv_id = up.conv_id AND r.turn = up.root AND r.reply_to IS NOT NULL),
tops AS (SELECT id, min(root) AS root_turn FROM up GROUP BY id)
SELECT m.conv_id, m.turn, m.role,
       row_number() OVER (PARTITION BY m.conv_id ORDER BY root_turn, m.turn) - 1 AS position,
       r.reply_to, root_turn, coalesce(n_quotes, 0) AS n_quotes, coalesce(n_linked, 0) AS n_linked, body
FROM msgs m JOIN tops USING (id) JOIN bodies b USING (id)
LEFT JOIN replies r ON r.id = m.id
"""


def op8_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc.derivatives(warc.responses(table(spark, sf_dir, "pages")))
    return out.select("page_id", "record_type", "record_id", "refers_to", "target_uri", "source_block_digest", "block_digest", "content_length", F.sha2("record", 256).alias("record_sha256"))


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.coverage(table(spark, sf_dir, "documents"))


OP11_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w FROM d),
base AS (SELECT r, doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols FROM w),
lines AS (SELECT r, line, pos, row_number() OVER (PARTITION BY r, line ORDER BY pos) > 1 AS again FROM (
  SELECT r, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM w) WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
dup AS (SELECT r, count(*) AS n_dup_lines, sum(length(regexp_replace(line, '[\\x20\\x09-\\x0D]', '', 'g'))) AS dup_line_chars FROM lines WHERE again GROUP BY 1),
each AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM w),
grams AS (SELECT r, n, i, row_number() OVER (PARTITION BY r, n, g ORDER BY i) > 1 AS again, count(*) OVER (PARTITION BY r, n, g) > 1 AS twice FROM (
  SELECT r, n, unnest(range(1, len(w) - n + 2)) AS i, w[i:i + n - 1] AS g FROM w, (VALUES ({repetition.BASE}), {", ".join(f"({n})" for n in repetition.WINDOWS)}) v(n) WHERE len(w) >= n)),
hit AS (SELECT DISTINCT r, n, i + unnest(range(0, n)) AS i FROM grams WHERE CASE WHEN n = {repetition.BASE} THEN twice ELSE again END),
cover AS (SELECT r, count(*) FILTER (WHERE n = {repetition.BASE}) AS n_repeat_words, {", ".join(f"sum(length(word)) FILTER (WHERE n = {n}) AS g{n}" for n in repetition.WINDOWS)} FROM hit JOIN each USING (r, i) GROUP BY 1),
x AS (SELECT doc_id, n_words, word_chars, n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(dup_line_chars, 0)::BIGINT AS dup_line_chars,
  {", ".join(f"coalesce(g{n}, 0)::BIGINT AS dup_{n}gram_chars" for n in repetition.WINDOWS)} FROM base LEFT JOIN dup USING (r) LEFT JOIN cover USING (r))
SELECT *, n_words < {repetition.LEAST_WORDS} OR 100 * n_repeat_words > {repetition.MOST_REPEATED} * n_words AS base_failed,
  NOT base_failed AND 100 * dup_line_chars <= {repetition.LINE_CHARS} * word_chars {" ".join(f"AND 100 * dup_{n}gram_chars <= {most} * word_chars" for n, most in repetition.WINDOWS.items())} AS kept
FROM x
"""


def _edited(doc_id: Column, text: Column) -> Column:
    """op12's text: for one id in ten by its crc32, the words from a on repeat the p that stand there."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    w = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n, g = F.size(w).cast("long"), F.floor(h / 10)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    again = F.flatten(F.array_repeat(F.slice(w, a + 1, p), F.ceil((n - a) / p).cast("int")))
    return F.when((h % 10 == 0) & text.rlike(r"[^\x20\x09-\x0D]"), F.array_join(F.slice(F.concat(F.slice(w, F.lit(1), a), again), F.lit(1), n.cast("int")), " ")).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", _edited(F.col("doc_id"), F.col("text")).alias("text"))
    out = runs.periodic_runs(docs).withColumn("collapsed_sha256", F.sha2("collapsed", 256))
    return out.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {
    q.__name__: q
    for q in (
        op1_line_dedup,
        op2_language_id,
        op3_chat_quotations,
        op4_benchmark_decontamination,
        op5_document_fingerprints,
        op6_best_fit_packing,
        op7_token_output,
        op8_warc_derivatives,
        op9_quality_classifier,
        op10_minhash_near_dedup,
        op11_quality_rules,
        op12_periodic_runs,
        op13_embedding_whitening,
    )
}
ORACLES = {"op1_line_dedup": OP1_SQL, "op3_chat_quotations": OP3_SQL, "op10_minhash_near_dedup": OP10_SQL, "op11_quality_rules": OP11_SQL}
