"""Quotation linking: who answers whom in a conversation, from the quotes in its messages.

A line's quote level is the number of `>` in front of it. Neighbouring lines of one level
form a passage; blank lines part passages. Quoted passages are normalised, hashed and joined
to the unquoted passages and whole bodies of the conversation's messages; a passage's
original is the earliest message that holds it. A passage that is nowhere whole is joined by
its pieces (lines and sentences) to the pieces of unquoted passages: a piece's original is the
earliest message that holds it, the passage's the latest of these. A message answers the original of its
shallowest linked quote (of several, the latest). Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut

_SEP = "\x00"
_WHITE = " \t\x0b\x0c\r"
_KEY = ["conv_id", "turn", "m"]
#: Conversations with quotes that may be broadcast (8 bytes each); beyond it all are searched.
BROADCAST_CONVERSATIONS = 1_000_000


def _normal(text: Column) -> Column:
    folded = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.btrim(F.regexp_replace(folded, "[ \\t\\n\\x0B\\f\\r]+", " "))


def _hashes(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(71), text).alias("h2")]


def messages(conversations: DataFrame) -> DataFrame:
    """The distinct messages with `m`, which tells messages of one turn apart."""
    rows = conversations.select("conv_id", "turn", "role", "text").distinct()
    return rows.withColumn("m", F.xxhash64("role", "text"))


def passages(msgs: DataFrame) -> DataFrame:
    """(conv_id, turn, m, at, level, passage, raw): the passages that are not empty, normalised
    and with their lines as they stand; `at` tells a message's passages apart."""
    rows = msgs.select(*_KEY, F.split(F.translate(F.coalesce("text", F.lit("")), _SEP, " "), "\n").alias("lines"))
    front = lambda line: F.regexp_extract(line, "^[ \\t>]*>", 0)
    rows = rows.select(*_KEY, F.transform("lines", front).alias("fronts"), "lines")
    rows = rows.select(
        *_KEY,
        F.transform("fronts", lambda f: F.char_length(F.regexp_replace(f, "[^>]", ""))).alias("levels"),
        F.zip_with("lines", "fronts", lambda line, f: F.btrim(F.substr(line, F.char_length(f) + 1), F.lit(_WHITE))).alias("bare"),
    )
    # a separator and the level wherever a passage begins; `before` is the line above
    rows = rows.select(*_KEY, "levels", "bare", F.concat(F.array(F.lit(-1)), "levels").alias("before"), F.concat(F.array(F.lit("")), "bare").alias("above"))
    begins = F.zip_with(F.arrays_zip("levels", "bare"), F.arrays_zip("before", "above"), lambda a, b: F.when(a["levels"].isNull(), "").when((a["levels"] != b["before"]) | (a["bare"] == "") | (b["above"] == ""), F.concat(F.lit(_SEP), a["levels"].cast("string"), F.lit(":"), a["bare"])).otherwise(F.concat(F.lit("\n"), a["bare"])))
    rows = rows.select(*_KEY, F.posexplode(F.split(F.array_join(begins, ""), _SEP)).alias("at", "p"))
    raw = F.regexp_replace("p", "^[0-9]*:", "")
    rows = rows.select(*_KEY, "at", F.substring_index("p", ":", 1).try_cast("int").alias("level"), _normal(raw).alias("passage"), raw.alias("raw"))
    return rows.where("level IS NOT NULL AND passage <> ''")


def body(text: Column) -> Column:
    """The text without its quoted lines."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    return F.array_join(F.filter(lines, lambda line: ~line.rlike("^[ \\t]*>")), "\n")


def pieces(units: DataFrame, *keys: str) -> DataFrame:
    """(*keys, h1, h2): the hashes of each passage's lines, their sentences and its own."""
    sentences = lambda text: F.split(text, "(?<=[.!?]) ")
    lines = F.transform(F.split("raw", "\n"), _normal)
    rows = units.select(*keys, lines.alias("lines"), sentences(F.col("passage")).alias("own"))
    parts = F.array_distinct(F.concat("lines", F.flatten(F.transform("lines", sentences)), "own"))
    return rows.select(*keys, F.explode(parts).alias("piece")).where("piece <> ''").select(*keys, *_hashes(F.col("piece")))


def _firsts(original: DataFrame) -> DataFrame:
    return original.groupBy("conv_id", "h1", "h2").agg(F.min(F.struct("turn", "m")).alias("first"))


def links(msgs: DataFrame) -> DataFrame:
    """(conv_id, turn, m, reply_turn, reply_m, n_quotes, n_linked) of messages with quotes."""
    quoted = cut(passages(msgs.where(F.col("text").rlike("(?:^|\n)[ \t]*>"))).where("level > 0"))
    asked = quoted.select("conv_id").distinct()
    if asked.limit(BROADCAST_CONVERSATIONS + 1).count() <= BROADCAST_CONVERSATIONS:
        msgs = msgs.join(F.broadcast(asked), "conv_id", "left_semi")
    units = passages(msgs).where("level = 0")
    whole = msgs.select(*_KEY, _normal(body(F.col("text"))).alias("passage")).where("passage <> ''")
    first = _firsts(units.select(*_KEY, "passage").unionAll(whole).select(*_KEY, *_hashes(F.col("passage"))))
    before = F.when(F.col("first.turn") < F.col("turn"), F.col("first"))
    found = cut(quoted.select("*", *_hashes(F.col("passage"))).join(first, ["conv_id", "h1", "h2"], "left").withColumn("first", before).drop("h1", "h2"))
    # of what is nowhere whole, the latest original of a piece
    parts = pieces(found.where("first IS NULL"), *_KEY, "at").join(_firsts(pieces(units, *_KEY)), ["conv_id", "h1", "h2"]).where("first.turn < turn")
    late = parts.groupBy(*_KEY, "at").agg(F.min(F.struct((-F.col("first.turn")).alias("late"), F.col("first.m").alias("m"))).alias("part"))
    found = found.select(*_KEY, "at", "level", "first").join(late, [*_KEY, "at"], "left")
    found = found.withColumn("first", F.coalesce("first", F.when(F.col("part").isNotNull(), F.struct((-F.col("part.late")).alias("turn"), F.col("part.m").alias("m")))))
    # the shallowest level, then the latest original
    choice = F.min(F.when(F.col("first").isNotNull(), F.struct("level", (-F.col("first.turn")).alias("late"), F.col("first.m").alias("m"))))
    out = found.groupBy(*_KEY).agg(choice.alias("to"), F.count(F.lit(1)).alias("n_quotes"), F.count("first").alias("n_linked"))
    return out.select(*_KEY, (-F.col("to.late")).alias("reply_turn"), F.col("to.m").alias("reply_m"), "n_quotes", "n_linked")


def roots(replies: DataFrame) -> DataFrame:
    """(conv_id, turn, m, root_turn, root_m) of every message that answers another.

    Pointers are doubled until none moves: rounds grow with the logarithm of a thread's depth.
    """
    up = cut(replies.where("reply_turn IS NOT NULL").select(*_KEY, F.col("reply_turn").alias("root_turn"), F.col("reply_m").alias("root_m")))
    while True:
        above = up.select("conv_id", F.col("turn").alias("root_turn"), F.col("m").alias("root_m"), F.col("root_turn").alias("t"), F.col("root_m").alias("x"))
        moved = cut(up.join(above, ["conv_id", "root_turn", "root_m"], "left").select(*_KEY, F.coalesce("t", "root_turn").alias("root_turn"), F.coalesce("x", "root_m").alias("root_m"), F.col("t").isNotNull().alias("moved")))
        up = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return up


def reply_ordered(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, position, reply_to, root_turn, n_quotes, n_linked, body.

    One row per distinct message. Threads stand in the order of their first message, a
    thread's messages by turn; position counts from 0 in a conversation. reply_to is the turn
    answered or null. Null text has an empty body; null conv_id or turn: no links, and nulls
    stand together, first. Messages of one turn with different role or text are separate.
    Other columns are not read; an empty table gives an empty table.
    """
    msgs = messages(conversations)
    known = msgs.where("conv_id IS NOT NULL AND turn IS NOT NULL")
    found = cut(links(known))
    keys = msgs.select(*_KEY).join(found, _KEY, "left").join(roots(found), _KEY, "left")
    order = ["conv_id", "root_turn", "root_m", "turn", "m"]
    keys = keys.withColumns({"root_turn": F.coalesce("root_turn", "turn"), "root_m": F.coalesce("root_m", "m")})
    # ranks by range: a long conversation spans many ranges and never meets in one task
    keys = cut(keys.repartitionByRange(*order)).withColumn("range", F.spark_partition_id())
    keys = keys.withColumn("n", F.row_number().over(Window.partitionBy("range", "conv_id").orderBy(*order)))
    size = cut(keys.groupBy("range", "conv_id").agg(F.max("n").alias("size")))
    before = F.coalesce(F.sum("size").over(Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    at = size.select("range", F.col("conv_id").alias("c"), before.alias("before"))
    keys = keys.join(at, (keys["range"] == at["range"]) & keys["conv_id"].eqNullSafe(at["c"]))
    keys = keys.select("conv_id", "turn", "m", (F.col("n") - 1 + F.col("before")).alias("position"), "reply_turn", "root_turn", "n_quotes", "n_linked")
    k = keys.withColumnsRenamed({"conv_id": "k_conv", "turn": "k_turn", "m": "k_m"})
    both = msgs.join(k, msgs["conv_id"].eqNullSafe(k["k_conv"]) & msgs["turn"].eqNullSafe(k["k_turn"]) & (msgs["m"] == k["k_m"]))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return both.select("conv_id", "turn", "role", F.col("position").cast("long").alias("position"), F.col("reply_turn").alias("reply_to"), "root_turn", zero("n_quotes"), zero("n_linked"), body(F.col("text")).alias("body"))
