"""Near duplicates by b-bit MinHash.

1. Each text becomes its set of word shingles (64-bit hashes), `PERMS` minima of it, of which the low
   `BITS` bits are packed into a signature, and `BANDS` band keys of `ROWS` minima each.
2. Texts with equal sets (a 128-bit digest of the set and its size) are one node, so copies are never
   expanded into pairs.
3. In each band bucket all nodes are paired with the bucket's pivot. A pair whose packed signatures,
   corrected for chance agreement of b bits, are out of reach of the threshold is left out; the others
   are confirmed on full sets.
4. In buckets whose nodes are then still in several components, every node outside the largest one is
   compared with all others of the bucket by signature alone, tile by tile of at most `TILE` nodes a side.
   A tile gives back a forest that spans the pairs in reach of the threshold, not the pairs. The forests
   make clusters of texts that may be linked, and in a cluster every text outside its largest component is
   compared with all others on full sets, block against block of about `MASS` shingles; a pair of blocks
   gives back only links that join two components. So what the pivots joined is never compared again,
   and neither the rows of a bucket or cluster nor their pairs ever meet in one task. There is no cap on
   buckets, partners or candidates.
5. Components of the confirmed links; copies take the component of their node.

With 48 bands of 6 rows a pair of similarity 0.8 shares no band with probability 5e-7, one of similarity 0.3
(a common block of text) does with probability 0.03, so buckets hold little else than near duplicates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import components
from .shared import new_dir, store
from .wordscan import SPACED, mixed, run_at, runs, scan, texts_of

PERMS, BITS, BANDS, ROWS = 288, 4, 48, 6
#: Five standard deviations of the estimate from `PERMS` four-bit minima at similarity 0.8.
MARGIN = 0.1225
#: Nodes of a tile's side, and rows of a task's tiles, on average.
TILE, TASK = 1024, 8192
#: Shingles of a block, and of a task's blocks, on average.
MASS, LOAD = 1 << 20, 1 << 22
#: Bits of the filter by which tasks pass over texts whose sets aren't wanted, at most (16 MB); a fuller
#: filter lets more texts through and changes no result.
FILTER_BITS = 1 << 27
_rng = np.random.default_rng(8171)
_MULTIPLIERS = _rng.integers(0, 2**31, PERMS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_OFFSETS = _rng.integers(0, 2**32, PERMS, dtype=np.uint32)
_BAND = _rng.integers(0, 2**63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

SIGNED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_shingles", T.LongType()),
        T.StructField("d1", T.LongType()),
        T.StructField("d2", T.LongType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
        T.StructField("sig", T.ArrayType(T.LongType())),
    ]
)
SETS = T.StructType([T.StructField("node", T.LongType()), T.StructField("shingles", T.ArrayType(T.LongType()))])


def shingle_sets(texts: list[bytes], k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per chunk: index of its first text, sorted distinct shingle hashes of all its texts, bounds of each text's."""
    for w in scan(texts, SPACED):
        own = w.owners()
        at = run_at(w, k)
        of, h = own[at], runs(w.hashes, k)[at]
        counts = np.diff(w.offsets)
        short = np.flatnonzero((counts > 0) & (counts < k))
        if len(short):
            extra = [runs(w.hashes[w.offsets[i] : w.offsets[i + 1]], int(counts[i])) for i in short]
            of, h = np.concatenate([of, short]), np.concatenate([h, *extra])
        order = np.lexsort((h, of))
        of, h = of[order], h[order]
        keep = np.ones(len(h), bool)
        keep[1:] = (h[1:] != h[:-1]) | (of[1:] != of[:-1])
        of, h = of[keep], h[keep]
        yield w.lo, h, np.searchsorted(of, np.arange(w.n_texts + 1))


def _minima(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """PERMS minima of each non-empty set; sets start at `at`."""
    low = (h >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(at), PERMS), np.uint32)
    for j in range(PERMS):
        x = low * _MULTIPLIERS[j] + _OFFSETS[j]
        x ^= x >> np.uint32(15)
        out[:, j] = np.minimum.reduceat(x, at)
    return out


def _digests(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A digest of each set, 0 of an empty one."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(h))])
    return total[bounds[1:]] - total[bounds[:-1]]


def _sign(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for lo, h, bounds in shingle_sets(texts_of(batch.column(1)), k):
                n = np.diff(bounds)
                full = np.flatnonzero(n)
                d = np.stack([_digests(h, bounds), _digests(h ^ np.uint64(0x5851F42D4C957F2D), bounds)])
                bands, sig = np.zeros((len(full), BANDS), np.uint64), np.zeros((len(full), PERMS * BITS // 64), np.uint64)
                if len(full):
                    at = bounds[:-1][full]
                    m = _minima(h, at)
                    for b in range(BANDS):
                        rows = m[:, b * ROWS : (b + 1) * ROWS].astype(np.uint64)
                        bands[:, b] = mixed((rows * _BAND[b]).sum(1, dtype=np.uint64) + np.uint64(b))
                    bits = (m & np.uint32((1 << BITS) - 1)).astype(np.uint64).reshape(len(full), -1, 64 // BITS)
                    shifts = np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS)
                    sig = np.bitwise_or.reduce(bits << shifts, axis=2)
                size = np.zeros(len(n), np.int64)
                size[full] = 1
                ends = np.concatenate([[0], np.cumsum(size)])
                lists = lambda x, per: pa.ListArray.from_arrays(pa.array(ends * per, pa.int32()), pa.array(x.reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, len(n)).cast(pa.int64()), pa.array(n.astype(np.int64)), pa.array(d[0].view(np.int64)), pa.array(d[1].view(np.int64)), lists(bands, BANDS), lists(sig, sig.shape[1])],
                    names=[f.name for f in SIGNED],
                )

    return run


def _sets(k: int, value):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(value.value, np.uint8)
        for batch in batches:
            slot = batch.column(2).to_numpy()
            batch = batch.filter(pa.array((bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 > 0))
            for _, h, bounds in shingle_sets(texts_of(batch.column(1)), k):
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(h.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(_digests(h, bounds).view(np.int64)), lists], names=["node", "shingles"])

    return run


def _bit_filter(ids: DataFrame) -> tuple[Broadcast, Column]:
    """Broadcast bits of which those of all ids (doc_id) are set, and the bit of a row's doc_id."""
    m = min(FILTER_BITS, max(1 << 16, 1 << (16 * ids.count()).bit_length()))
    slot = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(m))
    bits = np.zeros(m // 8, np.uint8)
    # One row of 4 KB for each 32768 bits: a few thousand rows at most, in one job.
    parts = ids.select(slot.alias("s")).groupBy(F.shiftright("s", 15).alias("w")).agg(F.bitmap_construct_agg(F.col("s") % (1 << 15)).alias("v"))
    for r in parts.collect():
        bits[r["w"] << 12 : (r["w"] + 1) << 12] = np.frombuffer(r["v"], np.uint8)
    return ids.sparkSession.sparkContext.broadcast(bits.tobytes()), slot


def _wanted_sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """node, shingles of wanted (node, doc_id), without shuffling texts: a bit filter of bounded size passes over
    the other texts where they are read, and a join drops the few that slip through it."""
    value, slot = _bit_filter(wanted.select("doc_id"))
    found = docs.where("doc_id IS NOT NULL").select("doc_id", "text", slot.alias("s")).mapInArrow(_sets(k, value), SETS)
    return found.join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"])


def estimate(a: Column, b: Column) -> Column:
    """Similarity from packed signatures: the share of equal b-bit groups, less the agreement by chance."""
    words = PERMS * BITS // 64
    ones = F.lit(int("1" * 16, 16))
    differ = F.lit(0)
    for i in range(words):
        x = a.getItem(i).bitwiseXOR(b.getItem(i))
        y = x
        for s in range(1, BITS):
            y = y.bitwiseOR(F.shiftrightunsigned(x, s))
        differ = differ + F.bit_count(y.bitwiseAND(ones))
    chance = 2.0**-BITS
    return (1 - differ / F.lit(float(PERMS)) - chance) / (1 - chance)


def _confirm(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of pairs (a, b) whose full sets reach the threshold."""
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("sig").alias(f"s{x}"), F.col("n_shingles").alias(f"n{x}"))
    near = pairs.join(side("b"), "b").join(side("a"), "a")
    near = near.where((F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent) & (estimate(F.col("sa"), F.col("sb")) >= percent / 100 - MARGIN))
    near = near.select("a", "b", "na", "nb").join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("xb")), "b")
    joined = near.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("xa")), "a")
    shared = joined.select("a", "b", "na", "nb", F.size(F.array_intersect("xa", "xb")).alias("both"))
    return shared.where(F.col("both") * 100 >= (F.col("na") + F.col("nb") - F.col("both")) * percent).select("a", "b")


_ONES = np.uint64(int("1" * 16, 16))


def _split(table: pa.Table, *keys: str) -> Iterator[np.ndarray]:
    """Rows of each group of equal keys."""
    cols = np.stack([table.column(k).to_numpy() for k in keys])
    order = np.lexsort(cols[::-1])
    cuts = np.flatnonzero((cols[:, order[1:]] != cols[:, order[:-1]]).any(0)) + 1
    return iter(np.split(order, cuts)) if len(order) else iter(())


def _tiles(percent: int):
    """Edges that span the pairs of nodes, of different components and of different sides of a tile, whose signatures reach the threshold."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        node, comp, size, first = (table.column(x).to_numpy() for x in ("node", "c", "n_shingles", "first"))
        sigs = np.stack(table.column("sig").to_numpy()).view(np.uint64)
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for rows in _split(table, "key", "i", "j"):
            left, right = rows[first[rows]], rows[~first[rows]]
            _, label = np.unique(node[np.append(left, right)], return_inverse=True)
            mine, theirs = label[: len(left)].copy(), label[len(left) :].copy()
            n, c, other = size[right], comp[right], sigs[right]
            for k, x in enumerate(left):
                may = np.flatnonzero((c != comp[x]) & (theirs != mine[k]) & (np.minimum(n, size[x]) * 100 >= np.maximum(n, size[x]) * percent))
                y = other[may] ^ sigs[x]
                y |= y >> np.uint64(2)
                y |= y >> np.uint64(1)
                differ = np.bitwise_count(y & _ONES).sum(1)
                near = may[1 - differ / PERMS - 2.0**-BITS >= (percent / 100 - MARGIN) * (1 - 2.0**-BITS)]
                if len(near):
                    joined, at = np.unique(theirs[near], return_index=True)
                    a.append(np.full(len(at), node[x]))
                    b.append(node[right[near[at]]])
                    theirs[np.isin(theirs, joined)] = mine[k]
                    mine[np.isin(mine, joined)] = mine[k]
        return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)})

    return run


def _blocks(percent: int):
    """Links of the first block's texts with those of the second, on full sets, only such as join two components."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        node, comp, first = (table.column(x).to_numpy() for x in ("node", "c", "first"))
        lists = table.column("shingles").chunk(0)
        at, h = np.asarray(lists.offsets), lists.values.to_numpy()
        n = np.diff(at)
        a, b = [], []
        for rows in _split(table, "cluster", "i", "j"):
            second = rows[~first[rows]]
            own = np.repeat(np.arange(len(second)), n[second])
            posted = np.concatenate([h[:0], *(h[at[i] : at[i + 1]] for i in second)])
            order = np.argsort(posted, kind="stable")
            posted, own = posted[order], own[order]
            parent = {int(c): int(c) for c in comp[rows]}

            def top(c: int, parent: dict[int, int] = parent) -> int:
                while parent[c] != c:
                    parent[c] = c = parent[parent[c]]
                return c

            for i in rows[first[rows]]:
                mine = h[at[i] : at[i + 1]]
                lo, hi = np.searchsorted(posted, mine, "left"), np.searchsorted(posted, mine, "right")
                size = hi - lo
                where = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(size.sum())
                both = np.bincount(own[where], minlength=len(second))
                for j in second[100 * both >= percent * (n[i] + n[second] - both)]:
                    x, y = top(int(comp[i])), top(int(comp[j]))
                    if x != y:
                        parent[max(x, y)] = min(x, y)
                        a.append(int(node[i]))
                        b.append(int(node[j]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _pair_up(nodes: DataFrame, group: str, cols: list[str], size: Column, room: int) -> DataFrame:
    """Rows of nodes (group, node, c) as first and second sides of pairs (i, j) of blocks of about `room` size: outside of each group's largest component, and all."""
    sizes = nodes.groupBy(group, "c").agg(F.count("*").alias("m"), F.sum(size).alias("s"))
    sizes = sizes.groupBy(group).agg(F.sum("m").alias("n"), F.sum("s").alias("all"), F.max(F.struct("m", "c", "s")).alias("x")).where("x.m < n")
    blocks = sizes.select(group, F.col("x.c").alias("main"), F.ceil((F.col("all") - F.col("x.s")) / room).alias("nu"), F.ceil(F.col("all") / room).alias("nv"))
    at = nodes.join(blocks, group)
    block = lambda n: F.pmod(F.xxhash64("node"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = at.where("c <> main").select(group, *cols, F.lit(True).alias("first"), block("nu").alias("i"), every("nv").alias("j"))
    return left.unionByName(at.select(group, *cols, F.lit(False).alias("first"), block("nv").alias("j"), every("nu").alias("i")))


def _rest(members: DataFrame, links: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int, folder: str) -> DataFrame:
    """Links that the pivots didn't show, between nodes that share buckets."""
    comp = store(components(links, folder, "first"), folder, "first").withColumnRenamed("id", "node")
    of = members.join(comp, "node", "left").select("key", "node", F.coalesce("component_id", "node").alias("c"))
    sig = nodes.select("node", "n_shingles", "sig")
    tiles = store(_pair_up(of, "key", ["node", "c"], F.lit(1), TILE).join(sig, "node"), folder, "tiles", "lz4")
    task = F.pmod(F.xxhash64("key", "i", "j"), F.lit(max(1, -(-tiles.count() // TASK))))
    forest = store(tiles.groupBy(task.alias("task")).applyInArrow(_tiles(percent), "a long, b long").distinct(), folder, "forest")
    clusters = components(forest, folder, "clusters").withColumnRenamed("id", "node").withColumnRenamed("component_id", "cluster")
    inside = clusters.join(comp, "node", "left").join(nodes.select("node", "n_shingles"), "node").select("cluster", "node", F.coalesce("component_id", "node").alias("c"), "n_shingles")
    blocks = store(_pair_up(inside, "cluster", ["node", "c", "n_shingles"], F.col("n_shingles"), MASS), folder, "blocks")
    mass = blocks.agg(F.coalesce(F.sum("n_shingles"), F.lit(0)).alias("n")).first()["n"]
    task = F.pmod(F.xxhash64("cluster", "i", "j"), F.lit(-(-mass // LOAD) + 1))
    return blocks.join(sets, "node").groupBy(task.alias("task")).applyInArrow(_blocks(percent), "a long, b long")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of docs (doc_id, text).

    Null and empty texts have no shingles and are linked with nothing. Rows that repeat a doc_id are one document,
    linked by each of its texts; a null doc_id stays alone with a null component and is kept. Other columns are
    ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    folder = new_dir(spark, "neardup")
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    signed = store(docs.mapInArrow(_sign(k), SIGNED), folder, "signed")
    with_set = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    copies = store(with_set.groupBy("d1", "d2", "n_shingles").agg(F.min("doc_id").alias("rep")), folder, "copies")
    reps = with_set.join(copies.select("d1", F.col("rep").alias("doc_id")).distinct(), ["d1", "doc_id"], "left_semi").dropDuplicates(["d1"])
    reps = store(reps.withColumnRenamed("d1", "node"), folder, "nodes")
    banded = reps.select("node", F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("pivot")).where("n > 1")
    members = store(banded.join(shared.drop("n"), "key"), folder, "members")
    wanted = reps.select("node", "doc_id").join(members.select("node").distinct(), "node", "left_semi")
    sets = store(_wanted_sets(docs, wanted, k), folder, "sets", "lz4")
    pairs = members.select(F.col("pivot").alias("a"), F.col("node").alias("b")).where("a < b").distinct()
    links = store(_confirm(pairs, reps, sets, percent), folder, "links")
    links = links.union(_rest(members, links, reps, sets, percent, folder))
    # One document may have several texts under its id: they are linked, too.
    twice = with_set.groupBy("doc_id").agg(F.min("d1").alias("a"), F.max("d1").alias("b")).where("a < b").drop("b")
    links = links.union(with_set.join(twice, "doc_id").select("a", F.col("d1").alias("b")))
    comp = components(links, folder, "last")
    named = copies.join(comp.withColumnRenamed("id", "d1"), "d1", "left").withColumn("c", F.coalesce("component_id", "d1")).drop("component_id")
    of = named.join(named.groupBy("c").agg(F.min("rep").alias("component_id")), "c").select("d1", "d2", "n_shingles", "component_id")
    out = signed.select("doc_id", "n_shingles", "d1", "d2").join(of, ["d1", "d2", "n_shingles"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _by_bit(value, wanted: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(value.value, np.uint8)
        for batch in batches:
            last = batch.num_columns - 1
            slot = batch.column(last).to_numpy()
            there = (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 > 0
            yield batch.filter(pa.array(there == wanted)).select(range(last))

    return run


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs, all columns, that are the first of their group of near duplicates.

    Rows that repeat a doc_id count as one document, of which the row whose text sorts first stays; rows without a
    doc_id stay. Texts aren't shuffled, but for those that a bit filter takes for dropped or repeated ones; a join
    then says which of these stay.
    """
    found = near_duplicates(docs, k, percent).where("doc_id IS NOT NULL")
    ids = found.groupBy("doc_id").agg(F.min("kept").alias("kept"), F.count("*").alias("n")).where("NOT kept OR n > 1")
    ids = store(ids.select("doc_id", "kept"), new_dir(docs.sparkSession, "dropped"), "ids")
    value, slot = _bit_filter(ids)
    mark = "slot"
    while mark in docs.columns:
        mark += "_"
    marked = docs.select("*", F.when(F.col("doc_id").isNotNull(), slot).alias(mark))
    named = marked.where(F.col(mark).isNotNull())
    sure = named.mapInArrow(_by_bit(value, False), docs.schema)
    maybe = named.mapInArrow(_by_bit(value, True), docs.schema).join(ids.where("NOT kept").select("doc_id"), "doc_id", "left_anti").select(*docs.columns)
    row = F.min_by(F.struct(*docs.columns), F.coalesce("text", F.lit(""))).alias("row")
    maybe = maybe.groupBy("doc_id").agg(row).select("row.*")
    return sure.union(maybe).union(marked.where(F.col(mark).isNull()).select(*docs.columns))
