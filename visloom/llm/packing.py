"""Packing documents into sequences by cutting-stock column generation.

A document's ids are cut at every `SIZE`; only what is left over needs packing. Lengths are counted in
`GRAIN`-token units, so the histogram has at most SIZE / GRAIN classes however many documents there are,
and only it reaches the driver. There a linear program over patterns (which classes fill one sequence)
is solved by column generation: a knapsack dynamic program prices the patterns with the program's dual
values until none improves it. Patterns are rounded down; the fewer than SIZE / GRAIN sequences' worth of
pieces that then lack a place are put first-fit, longest first. Pieces are ranked within their class by
partial counts of each task, and rank decides pattern, sequence and slot, so no class meets in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .bpe import encoder, in_chunks
from .shared import new_dir, store
from .wordscan import texts_of

SIZE, GRAIN = 4096, 16
UNITS = SIZE // GRAIN
PIECES = "part int, pos long, doc_id long, start long, length int, doc_tokens long, class int, local long, ids binary"
_SCHEMA = pa.schema([("part", pa.int32()), ("pos", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int32()), ("doc_tokens", pa.int64()), ("class", pa.int32()), ("local", pa.int64()), ("ids", pa.binary())])


def best_pattern(sizes: np.ndarray, worth: np.ndarray, room: int = UNITS) -> tuple[float, np.ndarray]:
    """The most valuable multiset of sizes within the room (unbounded knapsack)."""
    value, choice = np.zeros(room + 1), np.full(room + 1, -1)
    for w in range(1, room + 1):
        value[w] = value[w - 1]
        fits = int(np.searchsorted(sizes, w, "right"))
        if fits:
            gain = worth[:fits] + value[w - sizes[:fits]]
            k = int(gain.argmax())
            if gain[k] > value[w]:
                value[w], choice[w] = gain[k], k
    counts, w = np.zeros(len(sizes)), room
    while w > 0:
        if choice[w] < 0:
            w -= 1
        else:
            counts[choice[w]] += 1
            w -= sizes[choice[w]]
    return float(value[room]), counts


def inverted(a: np.ndarray) -> np.ndarray:
    """The inverse by Gauss-Jordan steps of row operations.

    Matrix products and `numpy.linalg` may use a library of threads, which in a driver don't outlive the start of its
    JVM: a call then never returns. So everything here is element-wise.
    """
    n = len(a)
    both = np.concatenate([a.astype(float), np.eye(n)], axis=1)
    for k in range(n):
        top = k + int(np.abs(both[k:, k]).argmax())
        if top != k:
            both[[k, top]] = both[[top, k]]
        both[k] /= both[k, k]
        by = both[:, k].copy()
        by[k] = 0.0
        some = np.flatnonzero(by)
        both[some] -= by[some, None] * both[k]
    return both[:, n:]


def cutting_stock(sizes: np.ndarray, demand: np.ndarray, room: int = UNITS, rounds: int = 4000) -> list[tuple[np.ndarray, float]]:
    """(pattern, how often) of the linear program: least sequences that hold the demand of each size.

    Revised simplex with generated columns; every basis on the way holds the demand, so stopping after
    `rounds` would cost room, never pieces.
    """
    m = len(sizes)
    basis = np.diag(np.floor(room / sizes))
    cost = np.ones(m)
    inverse, age = np.diag(1 / np.diag(basis)), 0
    for _ in range(rounds):
        level, dual = (inverse * demand).sum(axis=1), (cost[:, None] * inverse).sum(axis=0)
        low = int(dual.argmin())
        if dual[low] < -1e-9:
            column, c = -np.eye(m)[low], 0.0
        else:
            worth, column = best_pattern(sizes, dual, room)
            c = 1.0
            if worth <= 1 + 1e-9:
                if not age:
                    break
                inverse, age = inverted(basis), 0  # rounding in the updates may feign the end
                continue
        step = (inverse * column).sum(axis=1)
        ratio = np.where(step > 1e-9, np.maximum(level, 0) / np.where(step > 1e-9, step, 1), np.inf)
        least = ratio.min()
        if not np.isfinite(least):
            break
        # Of equal ratios the largest step keeps the basis far from singular.
        out = int(np.where(ratio <= least + 1e-9, step, -np.inf).argmax())
        basis[:, out], cost[out] = column, c
        if age == 49:
            inverse, age = inverted(basis), 0
        else:
            row = inverse[out] / step[out]
            inverse = inverse - step[:, None] * row
            inverse[out] = row
            age += 1
    level = (inverted(basis) * demand).sum(axis=1)
    return [(basis[:, i].copy(), float(level[i])) for i in range(m) if cost[i] and level[i] > 1e-9]


def plan(histogram: dict[int, int], room: int = UNITS) -> list[tuple[dict[int, int], int]]:
    """(pieces of each class in a sequence, number of such sequences) that place every piece."""
    left = {c: n for c, n in histogram.items() if n > 0}
    out: list[tuple[dict[int, int], int]] = []
    if full := left.pop(room, 0):
        out.append(({room: 1}, full))
    if left:
        sizes = np.array(sorted(left))
        for pattern, often in cutting_stock(sizes, np.array([left[c] for c in sizes], float), room):
            held = {int(c): int(round(a)) for c, a in zip(sizes, pattern, strict=True) if a > 0.5}
            if (times := int(np.floor(often + 1e-6))) > 0:
                out.append((held, times))
                for c, a in held.items():
                    left[c] -= a * times
    free: list[list] = []
    for c in sorted(left, reverse=True):
        for _ in range(max(0, left[c])):
            place = next((s for s in free if s[0] >= c), None)
            if place is None:
                free.append(place := [room, {}])
            place[0] -= c
            place[1][c] = place[1].get(c, 0) + 1
    return out + [(held, 1) for _, held in free]


def _cut(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, pos = TaskContext.get().partitionId(), 0
        ranks = np.zeros(UNITS + 1, np.int64)
        for batch in batches:
            docs, texts = batch.column(0).to_pylist(), texts_of(batch.column(1))
            for lo, some in in_chunks(texts):
                rows: list[tuple] = []
                for i, found in enumerate(encoder(path).encode(some)):
                    ids = np.append(found, found.dtype.type(end_id)).astype("<u4")
                    for a in range(0, len(ids), SIZE):
                        piece = ids[a : a + SIZE]
                        c = -(-len(piece) // GRAIN)
                        rows.append((part, pos, docs[lo + i], a, len(piece), len(ids), c, int(ranks[c]), piece.tobytes()))
                        ranks[c] += 1
                        pos += 1
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)

    return run


@dataclass
class Packed:
    """`pieces` with their ids, as written, and `placements` of them; (part, pos) names a piece in both."""

    pieces: DataFrame
    placements: DataFrame

    def sequences(self, pad_id: int = 0) -> DataFrame:
        """sequence_id, ids: whole sequences, padded to SIZE unless their length is a power of two."""
        rows = self.placements.join(self.pieces.select("part", "pos", "ids"), ["part", "pos"])
        joined = rows.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"), F.sum("length").alias("n"))
        ids = F.aggregate("p", F.lit(b""), lambda acc, x: F.concat(acc, x["ids"]))
        pad = F.when(F.bit_count("n") == 1, F.lit(b"")).otherwise(F.unhex(F.repeat(F.lit(int(pad_id).to_bytes(4, "little").hex()), (SIZE - F.col("n")).cast("int"))))
        return joined.select("sequence_id", F.concat(ids, pad).alias("ids"))


def pack(docs: DataFrame, tokenizer: str, end_id: int) -> Packed:
    """Pack docs (doc_id, text): every id of every whole text, and its end id, lies in exactly one piece.

    Null and empty texts are the end id alone. Rows that repeat a doc_id are packed each; null ids stay
    null. An empty table gives no pieces. Other columns are ignored.
    """
    spark = docs.sparkSession
    folder = new_dir(spark, "packing")
    pieces = store(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_cut(tokenizer, end_id), PIECES), folder, "pieces")
    counts = store(pieces.groupBy("part", "class").agg(F.count("*").alias("n")), folder, "counts")
    histogram = {r["class"]: r["n"] for r in counts.groupBy("class").agg(F.sum("n").alias("n")).collect()}
    slots, used, first = [], dict.fromkeys(histogram, 0), 0
    for held, times in plan(histogram):
        for c, each in held.items():
            slots.append((c, used[c], used[c] + each * times, each, first))
            used[c] += each * times
        first += times
    slot = spark.createDataFrame(slots, "class int, lo long, hi long, each int, first long")
    before = counts.select("part", "class", (F.sum("n").over(W.partitionBy("class").orderBy("part")) - F.col("n")).alias("before"))
    ranked = pieces.drop("ids").join(before, ["part", "class"]).withColumn("rank", F.col("before") + F.col("local"))
    # Slots are at most UNITS patterns of at most UNITS classes.
    placed = ranked.join(F.broadcast(slot), "class").where("rank >= lo AND rank < hi")
    placed = placed.withColumn("sequence_id", F.expr("first + (rank - lo) div each"))
    order = W.partitionBy("sequence_id").orderBy(F.desc("class"), "rank")
    placed = placed.withColumn("offset", F.sum("length").over(order) - F.col("length"))
    return Packed(pieces, placed.select("part", "pos", "doc_id", "start", F.col("length").cast("long").alias("length"), "doc_tokens", "sequence_id", "offset"))
