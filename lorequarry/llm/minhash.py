"""Near-duplicate classes by MinHash: universal hash minima, banding, verification, components.

Documents with equal shingle sets are one class and enter the search once. Each class has
SIGNATURE minima of universal hashes. The first `rows * bands` make its bands; classes that
share a band meet in a bucket. The last four bits of all minima are its signature. Every
member is first compared with its buckets' pivots (the member that meets most others), and the
links found are contracted to components; so a bucket of mutual near copies costs about one
comparison for each member. Where a pivot's members are then in several components, all pairs
of different components are compared in blocks of BLOCK members, inside tasks: first by their
signatures alone, then, for the members that have a partner left, on their texts. Only links
that join two components become rows; no pair that shares a band and could do so is left out.
A pair is verified by its signatures (five standard errors below the threshold) and confirmed
on the full sets, taken from the texts again. What belongs to a key (a set's class, a bucket's
pivot, a pivot's signature) meets the key's rows spread by a salt, so no key fills one task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .components import components
from .shared import cut, lean, row_chunks, small_batches, text_bytes

_U = np.uint64
#: Candidate ids that may be broadcast (16 bytes each); beyond it the join is a shuffle.
BROADCAST_IDS = 1_000_000
#: Minima of a signature; members of a block of pairs.
SIGNATURE, BLOCK = 320, 1024


def _hashers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and offsets of n universal multiply-add hashes modulo 2^64."""
    rng = np.random.default_rng(97)
    return rng.integers(0, 1 << 63, n, dtype=np.uint64) * _U(2) + _U(1), rng.integers(0, 1 << 63, n, dtype=np.uint64)


def _minima(values: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """The upper 32 bits of each row's n minima; rows must not be empty."""
    a, b = _hashers(n)
    out = np.empty((len(at) - 1, n), "<u4")
    work = np.empty_like(values)
    for j in range(n):
        np.multiply(values, a[j], out=work)
        np.add(work, b[j], out=work)
        out[:, j] = np.minimum.reduceat(work, at[:-1]) >> _U(32)
    return out


def _band_keys(minima: np.ndarray, rows: int, bands: int) -> np.ndarray:
    sig = minima[:, : rows * bands].reshape(len(minima), bands, rows).astype(_U)
    key = np.broadcast_to(np.arange(bands, dtype=_U) + _U(1), sig.shape[:2])
    for j in range(rows):
        key = K.mix(key * _U(0x9FB21C651E98DF25) + sig[:, :, j])
    return key


def _signature(minima: np.ndarray) -> np.ndarray:
    """The last four bits of each minimum, as bit planes: four longs for every 64 minima."""
    bits = np.stack([np.packbits((minima >> p) & 1, axis=1).reshape(len(minima), -1, 8) for p in range(4)], 2)
    return bits.reshape(len(minima), -1).view("<i8")


def _features(words: int, rows: int, bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for lo, hi in row_chunks(offsets, 1 << 19):
                o = offsets[lo : hi + 1]
                values, at = K.shingle_sets(data[o[0] : o[-1]], o - o[0], words)
                size = np.diff(at)
                full = np.flatnonzero(size > 0)
                keys, sig = np.empty(hi - lo, object), np.empty(hi - lo, object)
                if len(full):
                    minima = _minima(values, np.append(at[full], at[-1]), max(SIGNATURE, rows * bands))
                    keys[full] = [r.tobytes() for r in _band_keys(minima, rows, bands)]
                    sig[full] = list(_signature(minima[:, :SIGNATURE]))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(lo, hi - lo),
                        pa.array(size, pa.int64()),
                        pa.array(K.sum_rows(K.mix(values), at).view(np.int64)),
                        pa.array(K.sum_rows(K.mix(values ^ _U(0x5851F42D4C957F2D)), at).view(np.int64)),
                        pa.array(keys, pa.binary()),
                        pa.array(sig, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "n_shingles", "set_a", "set_b", "keys", "sig"],
                )

    return run


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            key = np.frombuffer(b"".join(batch.column("keys").to_pylist()), "<i8")
            ids = np.repeat(np.asarray(batch.column("doc_id")), len(key) // batch.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(ids, pa.int64())], ["key", "rep"])


def _agreement(a: str, b: str):
    """How many minima of two signatures have equal last bits."""
    total = F.lit(0)
    for w in range(0, SIGNATURE // 16, 4):
        apart = None
        for p in range(w, w + 4):
            x = F.get(F.col(a), F.lit(p)).bitwiseXOR(F.get(F.col(b), F.lit(p)))
            apart = x if apart is None else apart.bitwiseOR(x)
        total = total + F.bit_count(F.bitwise_not(apart))
    return total


def _confirm(words: int, percent: int):
    """Keep the pairs with 100 * intersection >= percent * union on the full sets."""

    def sets(column):
        data, offsets = text_bytes(column)
        return K.shingle_sets(data, offsets, words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                (va, ta), (vb, tb) = sets(part.column("text_a")), sets(part.column("text_b"))
                keep = []
                for i in range(part.num_rows):
                    x, y = va[ta[i] : ta[i + 1]], vb[tb[i] : tb[i + 1]]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * both >= percent * (len(x) + len(y) - both))
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _partners(table, percent: int, least: float, smallest: np.ndarray, largest: np.ndarray):
    """(x, rows y) of a block that lie in other components and may be linked, by signature."""
    n = table.num_rows
    rep, comp, side = (table.column(c).to_numpy() for c in ("rep", "component", "side"))
    sig = np.array(table.column("sig").to_pylist(), np.int64).reshape(n, -1)
    several = np.asarray(table.column("several"))
    for x in np.flatnonzero(side == 0):
        # the other side, or the same side of one block with itself
        y = np.flatnonzero((comp != comp[x]) & ((side == 1) | ((side == 2) & (rep > rep[x]))))
        y = y[(100 * largest[y] >= percent * smallest[x]) & (100 * largest[x] >= percent * smallest[y])]
        if not len(y):
            continue
        differ = (sig[y] ^ sig[x]).reshape(len(y), -1, 4)
        apart = differ[:, :, 0] | differ[:, :, 1] | differ[:, :, 2] | differ[:, :, 3]
        close = SIGNATURE - np.bitwise_count(apart).sum(axis=1, dtype=np.int64) >= least
        y = y[close | several[y] | several[x]]
        if len(y):
            yield x, y


def _block_candidates(percent: int, least: float):
    """The members of a block that have a partner by signature and size."""

    def run(table):
        found = np.zeros(table.num_rows, bool)
        for x, y in _partners(table, percent, least, table.column("least").to_numpy(), table.column("most").to_numpy()):
            found[x] = found[y] = True
        return table.select(["a", "left", "right", "side", "rep"]).filter(pa.array(found))

    return run


def _block_links(words: int, percent: int, least: float):
    """Links that join different components of a block; those of components joined are left out."""

    def run(table):
        rep, comp = (table.column(c).to_numpy() for c in ("rep", "component"))
        values, at = K.shingle_sets(*text_bytes(table.column("text")), words)
        size = np.diff(at)
        up: dict[int, int] = {}

        def top(c: int) -> int:
            while c in up:
                c = up[c]
            return c

        out: list[tuple[int, int]] = []
        for x, partners in _partners(table, percent, least, size, size):
            own = values[at[x] : at[x + 1]]
            for z in partners:
                one, two = top(int(comp[x])), top(int(comp[z]))
                if one == two:
                    continue
                both = len(np.intersect1d(own, values[at[z] : at[z + 1]], assume_unique=True))
                if 100 * both >= percent * (size[x] + size[z] - both):
                    out.append((min(rep[x], rep[z]), max(rep[x], rep[z])))
                    up[max(one, two)] = min(one, two)
        a, b = zip(*out) if out else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _salted(rows: DataFrame, *by: str) -> DataFrame:
    """Add a salt, as many as the session has shuffle partitions, taken from the columns `by`."""
    return rows.withColumn("salt", F.pmod(F.xxhash64(*by), F.lit(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))))


def _ways(rows: DataFrame, what: DataFrame, *keys: str) -> DataFrame:
    """`what`, one row a key, for every salt that the key has among the salted rows."""
    return rows.select(*keys, "salt").distinct().join(what, [*keys])


def _in_blocks(met: DataFrame, comps: DataFrame, about: DataFrame, texts: DataFrame, candidates, run) -> DataFrame:
    """The links between components among each pivot's members, found block by block.

    `met` is (a, rep): a pivot and the members of its buckets. The members outside the pivot's
    own component are dealt to blocks; each block meets itself, the later ones, and the blocks
    of the pivot's component, whose rows are not compared with each other. `candidates` sees the
    blocks without texts; only the members it finds come to `run`, with their texts.
    """
    comp = comps.withColumnRenamed("node", "rep")
    rows = met.select("a", "rep").unionAll(met.select("a", F.col("a").alias("rep"))).distinct()
    rows = rows.join(comp, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    rows = cut(_salted(rows, "rep"))
    per = rows.groupBy("a", "component").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("a") == F.col("rep")).alias("own"))
    split = per.groupBy("a").agg(F.max(F.when(F.col("own"), F.col("component"))).alias("main"), F.sum(F.when(F.col("own"), F.col("n"))).alias("within"), F.sum("n").alias("n")).where("n > within")
    split = split.select("a", "main", F.ceil((F.col("n") - F.col("within")) / BLOCK).cast("int").alias("outer"), F.ceil(F.col("within") / BLOCK).cast("int").alias("inner"))
    rows = rows.join(_ways(rows, split, "a"), ["a", "salt"])
    h = F.xxhash64("rep")
    i = F.pmod(h, F.col("outer")).cast("int")
    j = F.pmod(h, F.col("inner")).cast("int")
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    at = lambda left, right, side: F.struct(left.alias("left"), right.alias("right"), side.alias("side"))
    # a block: (left, right); right counts outer blocks from 0 and the main component's below 0
    outer = F.concat(
        F.transform(upto(F.col("outer")), lambda k: at(F.least(i, k), F.greatest(i, k), F.when(i <= k, 0).otherwise(1))),
        F.array(at(i, i, F.lit(2))),
        F.transform(upto(F.col("inner")), lambda k: at(i, -1 - k, F.lit(0))),
    )
    inner = F.transform(upto(F.col("outer")), lambda k: at(k, -1 - j, F.lit(1)))
    dealt = rows.select("a", "rep", "component", F.explode(F.when(F.col("component") != F.col("main"), outer).otherwise(inner)).alias("at"))
    dealt = cut(dealt.select("a", "rep", "component", "at.*"))
    sigs = about.select("rep", "least", "most", "sig", "several")
    members = cut(dealt.join(sigs, "rep").groupBy("a", "left", "right").applyInArrow(candidates, "a long, left int, right int, side int, rep long"))
    dealt = dealt.join(members, ["a", "left", "right", "side", "rep"], "left_semi")
    ids = members.select(F.col("rep").alias("id")).distinct()
    own = _only(texts, "id", ids, members.count()).withColumnRenamed("id", "rep").join(sigs, "rep")
    return dealt.join(own, "rep").groupBy("a", "left", "right").applyInArrow(run, "a long, b long")


def _only(df: DataFrame, column: str, ids: DataFrame, n: int) -> DataFrame:
    """Rows whose id is among `ids`: a broadcast where they are few, else a shuffle."""
    ids = ids.withColumnRenamed("id", column)
    return df.join(F.broadcast(ids) if n <= BROADCAST_IDS else ids, column, "left_semi")


def _with_both(pairs: DataFrame, what: DataFrame, value: str, n: int) -> DataFrame:
    """Add value_a and value_b of a salted pair's two ids; `what` is (id, value)."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    few = _only(what, "id", ids, 2 * n)
    one = few.select(F.col("id").alias("a"), F.col(value).alias(f"{value}_a"))
    two = few.select(F.col("id").alias("b"), F.col(value).alias(f"{value}_b"))
    return pairs.join(_ways(pairs, one, "a"), ["a", "salt"]).join(_ways(pairs, two, "b"), ["b", "salt"])


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, rows: int = 5, bands: int = 30) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of `docs` (doc_id, text, ...).

    Linked are documents with 100 * intersection >= percent * union of their sets of
    `words`-word shingles. Null, empty and wordless texts have no shingles and no links. A
    null doc_id links with nothing, has a null component_id and is kept. Rows that repeat a
    doc_id are one node and each returned. A document is kept if it is its component's least
    id. Columns other than doc_id and text are not read. An empty table gives an empty one.
    The chance that a pair at the threshold t shares no band is (1 - t^rows)^bands: 2e-8 at
    0.85, 7e-6 at 0.8 with the defaults.
    """
    t = percent / 100
    docs = small_batches(docs).select("doc_id", "text")
    feats = cut(docs.mapInArrow(lean(_features(words, rows, bands)), "doc_id long, n_shingles long, set_a long, set_b long, keys binary, sig array<long>"))
    real = _salted(feats.where("n_shingles > 0 AND doc_id IS NOT NULL"), "doc_id")
    a_set = ["set_a", "set_b", "n_shingles"]
    # written: a join that sees the filter of `real` would get a runtime Bloom filter for each key,
    # 1 MB apiece from each task, merged in one task and sent through the driver
    sets = cut(real.select("doc_id", *a_set, "salt"))
    classes = cut(sets.groupBy(a_set).agg(F.min("doc_id").alias("rep")))
    ones = classes.select(F.col("rep").alias("doc_id"))
    # a doc_id with two texts is one node: its sets share bands through that id
    reps = real.join(ones, "doc_id", "left_semi")

    banded = _salted(reps.select("doc_id", "keys").mapInArrow(lean(_banded), "key long, rep long"), "rep")
    parts = banded.groupBy("key", "salt").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi"), F.count(F.lit(1)).alias("weight"))
    shared = parts.groupBy("key").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("weight").alias("weight")).where("lo < hi")
    shared = parts.select("key", "salt").join(shared.select("key", "weight"), "key")
    members = cut(banded.join(shared, ["key", "salt"]).distinct())  # only buckets of two classes or more
    # the class that meets most others is likeliest the one that the others were copied from
    weights = members.groupBy("rep").agg(F.sum("weight").alias("weight"))
    about = reps.select(F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), "sig").join(weights, "rep")
    about = cut(about.groupBy("rep").agg(F.max("weight").alias("weight"), F.min("n").alias("least"), F.max("n").alias("most"), F.first("sig").alias("sig"), (F.min("sig") != F.max("sig")).alias("several")))
    weighed = members.select("key", "rep").join(about.select("rep", "weight"), "rep")
    pivot = weighed.groupBy("key").agg(F.max(F.struct("weight", (-F.col("rep")).alias("late"))).alias("p")).select("key", (-F.col("p.late")).alias("a"))

    texts = docs.withColumnRenamed("doc_id", "id")
    equal = t + (1 - t) / 16  # what agrees of two signatures, by chance in the last bits too
    least = SIGNATURE * equal - 5 * math.sqrt(SIGNATURE * equal * (1 - equal))
    right = about.drop("weight")
    left = right.select(F.col("rep").alias("a"), F.col("least").alias("a_least"), F.col("most").alias("a_most"), F.col("sig").alias("a_sig"), F.col("several").alias("a_several"))
    # sets whose sizes differ too much cannot reach the threshold
    alike = (100 * F.col("most") >= percent * F.col("a_least")) & (100 * F.col("a_most") >= percent * F.col("least")) & (F.col("several") | F.col("a_several") | (_agreement("sig", "a_sig") >= least))

    def ordered(found: DataFrame) -> DataFrame:
        return _salted(found.select(F.least("a", "rep").alias("a"), F.greatest("a", "rep").alias("b")).distinct(), "a", "b")

    def verified(pairs: DataFrame) -> DataFrame:
        return _with_both(pairs, texts, "text", pairs.count()).select("a", "b", "text_a", "text_b").mapInArrow(lean(_confirm(words, percent)), "a long, b long")

    met = cut(members.join(_ways(members, pivot, "key"), ["key", "salt"]).where("a <> rep").select("a", "rep", "salt").distinct())
    pairs = cut(ordered(met.join(_ways(met, left, "a"), ["a", "salt"]).join(right, "rep").where(alike)))
    comps = cut(components(verified(pairs)))
    more = cut(_in_blocks(met, comps, about, texts, _block_candidates(percent, least), _block_links(words, percent, least)))
    if not more.isEmpty():
        comps = cut(components(comps.select(F.col("node").alias("a"), F.col("component").alias("b")).unionAll(more)))

    # an id with several texts ties its classes together
    twice = sets.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")
    if not twice.isEmpty():
        tied = sets.join(twice, "doc_id", "left_semi").join(classes, a_set).where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
        comps = cut(components(comps.select(F.col("node").alias("a"), F.col("component").alias("b")).unionAll(tied)))
    named = classes.join(comps.withColumnRenamed("node", "rep"), "rep", "left").select(*a_set, F.coalesce("component", "rep").alias("component_id"))
    placed = sets.join(_ways(sets, named, *a_set), [*a_set, "salt"]).select("doc_id", "component_id")
    placed = placed.groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    out = feats.select("doc_id", "n_shingles").join(placed, "doc_id", "left")
    out = out.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
