"""Reference checks, differences, nearest-before lookups and closures."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.text import casefold
from .lineage import cut


def orphans(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose reference is not null and names no parent."""
    keys = parent.select(F.col(key).alias("_key")).distinct()
    return child.where(F.col(column).isNotNull()).join(keys, F.col(column) == F.col("_key"), "left_anti")


def difference(left: DataFrame, right: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Keys with status only_left, only_right, mismatch or same; nulls compare as equal."""
    side = lambda df, tag: df.select(*keys, F.struct(*values).alias(tag))
    both = side(left, "_l").join(side(right, "_r"), list(keys), "full_outer")
    status = F.when(F.col("_r").isNull(), "only_left").when(F.col("_l").isNull(), "only_right").when(F.col("_l").eqNullSafe(F.col("_r")), "same").otherwise("mismatch")
    return both.select(*keys, status.alias("status"))


#: A key with fewer rows than this is never treated as hot.
HOT_ROWS = 50_000


def hot_keys(df: DataFrame, key: str) -> DataFrame | None:
    """(_k) the keys with more than two partitions' share of the rows, or None.

    There are at most half as many as shuffle partitions. Only `key` is read, and counts are
    combined before the shuffle.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = df.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("n"))
    seen = counts.agg(F.sum("n").alias("all"), F.max("n").alias("most")).first()
    least = max(HOT_ROWS, 2 * (seen["all"] or 0) // parts)
    if (seen["most"] or 0) <= least:
        return None
    return cut(counts.where(F.col("n") > least).select("_k"))


def in_order(df: DataFrame, key: str, by_key: Callable[[DataFrame], DataFrame], by_range: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """`by_key` on the rows of usual keys, one shuffle; `by_range` on those of hot keys, if any are."""
    hot = hot_keys(df, key)
    if hot is None:
        return by_key(df)
    same = F.col(key).eqNullSafe(F.col("_k"))
    return by_key(df.join(F.broadcast(hot), same, "left_anti")).unionByName(by_range(df.join(F.broadcast(hot), same, "left_semi")))


def ranges(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """`df` with `_range`: its part of the order by key and `order`; a key with many rows spans several."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut(df.repartitionByRange(parts, key, *order)).withColumn("_range", F.spark_partition_id())


def with_carry(ranged: DataFrame, key: str, own: Column, before: Callable[[Column, WindowSpec], Column]) -> DataFrame:
    """Adds `_carry`: `before` over the aggregate `own` of the key's earlier ranges (null: none).

    Only the keys that span ranges have one, at most as many rows as there are ranges and their keys.
    """
    split = ranged.select("_range", key).distinct().groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col(key).alias("_k"))
    owns = ranged.join(F.broadcast(split), F.col(key).eqNullSafe(F.col("_k")), "left_semi").groupBy("_range", key).agg(own.alias("_own"))
    w = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    at = cut(owns.select(F.col("_range").alias("_r"), F.col(key).alias("_k"), before(F.col("_own"), w).alias("_carry")))
    return ranged.join(F.broadcast(at), (F.col("_range") == F.col("_r")) & F.col(key).eqNullSafe(F.col("_k")), "left").drop("_r", "_k")


def latest_before(events: DataFrame, key: str, order: Sequence[str], is_mark, value: str, name: str) -> DataFrame:
    """Adds `name`: `value` of the key's last marked row at or before each row (floor lookup)."""
    marked = F.when(is_mark, F.col(value))
    last = lambda *by: F.last(marked, ignorenulls=True).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))

    def by_range(df: DataFrame) -> DataFrame:
        own = F.max_by(marked, F.when(marked.isNotNull(), F.struct(*order)))
        rows = with_carry(ranges(df, key, order), key, own, lambda c, w: F.last(c, ignorenulls=True).over(w))
        return rows.withColumn(name, F.coalesce(last("_range", key), "_carry")).drop("_range", "_carry")

    return in_order(events, key, lambda df: df.withColumn(name, last(key)), by_range)


def row_before(df: DataFrame, key: str, order: Sequence[str], value: str, name: str) -> DataFrame:
    """Adds `name`: `value` of the key's row before each row, null at the first."""

    def by_range(df: DataFrame) -> DataFrame:
        rows = with_carry(ranges(df, key, order), key, F.max_by(F.struct(value), F.struct(*order)), lambda c, w: F.last(c).over(w))
        w = Window.partitionBy("_range", key).orderBy(*order)
        return rows.withColumn(name, F.when(F.row_number().over(w) == 1, F.col("_carry")[value]).otherwise(F.lag(value).over(w))).drop("_range", "_carry")

    return in_order(df, key, lambda df: df.withColumn(name, F.lag(value).over(Window.partitionBy(key).orderBy(*order))), by_range)


def running_count(df: DataFrame, key: str, order: Sequence[str], condition: Column, name: str) -> DataFrame:
    """Adds `name`: how many of the key's rows up to each row meet the condition."""
    one = F.when(condition, 1).otherwise(0)
    so_far = lambda *by: F.sum(one).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))

    def by_range(df: DataFrame) -> DataFrame:
        rows = with_carry(ranges(df, key, order), key, F.sum(one), lambda c, w: F.sum(c).over(w))
        return rows.withColumn(name, so_far("_range", key) + F.coalesce("_carry", F.lit(0))).drop("_range", "_carry")

    return in_order(df, key, lambda df: df.withColumn(name, so_far(key)), by_range)


def place(df: DataFrame, key: str, order: Sequence[str], name: str) -> DataFrame:
    """Adds `name`: each row's place, from 1, in its key's order."""
    return running_count(df, key, order, F.lit(True), name)


def _parents(edges: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Distinct edges; (node, up) of the nodes with one parent; edges into those with several."""
    edges = cut(edges.select("parent", "child").where("parent IS NOT NULL AND child IS NOT NULL").distinct())
    n = edges.groupBy(F.col("child").alias("node")).agg(F.count(F.lit(1)).alias("n"), F.min("parent").alias("up"))
    several = n.where("n > 1").select(F.col("node").alias("child"))
    return edges, n.where("n = 1").select("node", "up"), edges.join(several, "child", "left_semi")


def climb(single: DataFrame, marked: DataFrame) -> tuple[DataFrame, int]:
    """Where the ways up from nodes with one parent end, in about log2(longest way) rounds.

    `single` (node, up) has a row for each such node; `marked` (node) is distinct. The result
    (node, top, steps, hit, open): `top` is the first node above that is not in `single`, `steps`
    edges up; `hit` says whether a marked node is among those passed, `top` included; `open` is
    true on a cycle or below one, where there is no top and all of the cycle is passed. Each round
    doubles the ways that are still open: a node takes over what its present top has found.
    """
    there = marked.select(F.col("node").alias("up"), F.lit(True).alias("_m"))
    more = single.select(F.col("node").alias("up"), F.lit(True).alias("_s"))
    at = single.join(there, "up", "left").join(more, "up", "left")
    at = cut(at.select("node", F.col("up").alias("top"), F.lit(1).cast("long").alias("steps"), F.col("_m").isNotNull().alias("hit"), F.col("_s").isNotNull().alias("open")))
    most, rounds = at.count().bit_length() + 1, 0
    while rounds < most and not at.where("open").isEmpty():
        next_ = at.select(F.col("node").alias("top"), F.col("top").alias("_t"), F.col("steps").alias("_n"), F.col("hit").alias("_h"), F.col("open").alias("_o"))
        moved = at.where("open").join(next_, "top").select("node", F.col("_t").alias("top"), (F.col("steps") + F.col("_n")).alias("steps"), (F.col("hit") | F.col("_h")).alias("hit"), F.col("_o").alias("open"))
        at, rounds = cut(at.where("NOT open").unionByName(moved)), rounds + 1
    return at, rounds


def below(edges: DataFrame, start: DataFrame) -> DataFrame:
    """(node) reachable from `start` (node) along `edges` (parent, child); cycles end too.

    Nodes with one parent are settled by `climb`, in rounds that grow with the logarithm of the
    depth: a forest needs nothing else. Nodes with several parents are then reached one after
    another along the graph that is left when the ways between them are drawn together, each
    round extending only what the last one reached; its rounds grow with that graph's depth.
    """
    edges, single, joins = _parents(edges)
    start = start.select("node").where("node IS NOT NULL").distinct()
    at, _ = climb(single, start)
    joins = cut(joins)
    if joins.isEmpty():
        return at.where("hit").select("node")
    ways = at.select(F.col("node").alias("parent"), "top", "hit")
    mark = start.select(F.col("node").alias("parent"), F.lit(True).alias("_m"))
    # a parent is marked, or has passed a mark, or hangs below a node that may be reached later
    up = joins.join(ways, "parent", "left").join(mark, "parent", "left")
    up = cut(up.select("child", F.coalesce("top", "parent").alias("above"), (F.coalesce("hit", F.lit(False)) | F.col("_m").isNotNull()).alias("hit")))
    frontier = cut(up.where("hit").select(F.col("child").alias("node")).distinct())
    reached, links = frontier, up.where("NOT hit").select("above", "child").distinct()
    while not frontier.isEmpty():
        step = links.join(frontier, F.col("above") == F.col("node")).select(F.col("child").alias("node")).distinct()
        frontier = cut(step.join(reached, "node", "left_anti"))
        reached = cut(reached.unionAll(frontier))
    late = at.where("NOT hit").join(reached.select(F.col("node").alias("top")), "top", "left_semi").select("node")
    return at.where("hit").select("node").unionAll(late).unionAll(reached)


def levels(edges: DataFrame) -> DataFrame:
    """(node, level): the longest way to each node of a graph (parent, child) from a node without
    parents. Nodes on a cycle, or below one, have no level and are left out.

    Nodes with one parent take their level from the end of their way up (`climb`), so a forest
    needs rounds that grow with the logarithm of its depth. Nodes with several parents are placed
    when all their parents' ends are, in rounds that grow with the depth of what is left then.
    """
    edges, single, joins = _parents(edges)
    at, _ = climb(single, single.select("node").where("false"))
    roots = edges.select(F.col("parent").alias("node")).join(edges.select(F.col("child").alias("node")), "node", "left_anti").distinct()
    placed = cut(roots.withColumn("level", F.lit(0).cast("long")))
    joins = cut(joins)
    if not joins.isEmpty():
        ways = at.select(F.col("node").alias("parent"), "top", "steps", "open")
        left = joins.join(ways, "parent", "left").select("child", F.coalesce("top", "parent").alias("above"), (F.coalesce("steps", F.lit(0)) + 1).alias("far"), F.coalesce("open", F.lit(False)).alias("open"))
        # of several ways from one end to one node only the longest counts; an open one is never met
        left = cut(left.groupBy("child", "above", "open").agg(F.max("far").alias("far")))
        frontier, best = placed, None
        while not frontier.isEmpty():
            ends = frontier.withColumnRenamed("node", "above")
            met = left.where("NOT open").join(ends, "above").groupBy("child").agg(F.max(F.col("level") + F.col("far")).alias("level"))
            best = cut(met if best is None else best.unionByName(met).groupBy("child").agg(F.max("level").alias("level")))
            gone = ends.select("above", F.lit(False).alias("open"))
            left = cut(left.join(gone, ["above", "open"], "left_anti"))
            frontier = cut(best.join(left.select("child").distinct(), "child", "left_anti").withColumnRenamed("child", "node"))
            best = best.join(frontier.select(F.col("node").alias("child")), "child", "left_anti")
            placed = cut(placed.unionByName(frontier))
    tops = placed.select(F.col("node").alias("top"), F.col("level").alias("_level"))
    on_way = at.where("NOT open").join(tops, "top").select("node", (F.col("_level") + F.col("steps")).alias("level"))
    return placed.unionByName(on_way).withColumn("level", F.col("level").cast("int"))


def append_new(old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """`old` and the first of each key of `new` that `old` lacks (existing rows win)."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    fresh = new.join(old.select(*keys), list(keys), "left_anti").withColumn("_rank", rank).where("_rank = 1").drop("_rank")
    return old.unionByName(fresh.select(old.columns))


def orphan_refs(df: DataFrame, id_: str, refs: str, parent: DataFrame, key: str) -> DataFrame:
    """Distinct (id, ref) of array elements that name no parent; nothing is judged while `parent` is empty."""
    each = df.select(id_, F.explode(refs).alias("ref")).where("ref IS NOT NULL").distinct()
    if parent.isEmpty():
        return each.where("false")
    return orphans(each, "ref", parent, key)


def alias_index(df: DataFrame, alias: str, id_: str, ordinal: str, last: bool = False) -> DataFrame:
    """(alias, id): trimmed, case-folded aliases, each with its first or last id by the ordinal."""
    pick = F.max_by if last else F.min_by
    return df.where(F.trim(alias) != "").groupBy(casefold(F.trim(alias)).alias("alias")).agg(pick(id_, ordinal).alias("id"))


def _stacked(rows: DataFrame, key: str, pos: str, level: str, name: str, carry: dict) -> DataFrame:
    """`rows`, each partition of which is sorted by key and falling position, with `name`.

    A stack holds the positions that may still end a row's scope. Levels rise towards its top: a
    row takes off those of its own level or deeper, which are farther from all rows before it. It
    begins with `carry`: (range, key) to such a stack of (level, position) from the later ranges.
    """
    schema = rows.drop("_range").schema.add(name, rows.schema[pos].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, stack, tied = object(), [], []  # tied: rows of the position last seen, not yet on the stack
        for batch in batches:
            at = batch.column("_range").to_pylist() if "_range" in batch.schema.names else [None] * batch.num_rows
            ends = []
            for r, k, p, n in zip(at, *(batch.column(c).to_pylist() for c in (key, pos, level))):
                if k != own:
                    own, stack, tied = k, list(carry.get((r, k), ())), []
                if k is None or p is None or n is None:
                    ends.append(None)
                    continue
                if tied and tied[-1][1] != p:
                    for m, q in tied:
                        while stack and stack[-1][0] >= m:
                            stack.pop()
                        stack.append((m, q))
                    tied = []
                # the nearest later position of a level no deeper: levels rise towards the top
                lo, hi = 0, len(stack)
                while lo < hi:
                    mid = (lo + hi) // 2
                    lo, hi = (mid + 1, hi) if stack[mid][0] <= n else (lo, mid)
                ends.append(stack[lo - 1][1] if lo else None)
                tied.append((n, p))
            out = pa.array(ends, batch.schema.field(pos).type)
            yield batch.select([c for c in batch.schema.names if c != "_range"]).append_column(name, out)

    return rows.mapInArrow(run, schema)


def scope_end(df: DataFrame, key: str, pos: str, level: str, name: str) -> DataFrame:
    """Adds `name`: where the next row of the key's with a level no deeper starts, null at the end.

    Levels are whole numbers, any number of them. Rows are sorted once, by key and falling
    position, and pass a stack: time is linear in them. A hot key is cut into ranges; each then
    begins with the first position of every level in the later ones, which is one row for each
    level and range of a hot key. A row without key, position or level ends none and has no end.
    """

    def by_key(rows: DataFrame) -> DataFrame:
        sorted_ = rows.repartition(key).sortWithinPartitions(key, F.desc(pos))
        return _stacked(sorted_, key, pos, level, name, {})

    def by_range(rows: DataFrame) -> DataFrame:
        rows = ranges(rows, key, [pos])
        firsts: dict = {}
        for r in rows.where(F.col(level).isNotNull() & F.col(pos).isNotNull()).groupBy("_range", key, level).agg(F.min(pos).alias("_at")).collect():
            firsts.setdefault(r[key], []).append((r["_range"], r[level], r["_at"]))
        carry = {}
        for k, all_ in firsts.items():
            for own in {r for r, *_ in all_}:
                nearest: dict = {}
                for r, n, at in all_:
                    if r > own:
                        nearest[n] = min(at, nearest.get(n, at))
                stack: list = []
                for at, n in sorted(((at, n) for n, at in nearest.items()), key=lambda x: (-x[0], x[1])):
                    while stack and stack[-1][0] >= n:
                        stack.pop()
                    stack.append((n, at))
                carry[own, k] = stack
        return _stacked(rows.sortWithinPartitions(key, F.desc(pos)), key, pos, level, name, carry)

    return in_order(df, key, by_key, by_range)
