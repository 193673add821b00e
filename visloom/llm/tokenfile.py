"""Token ids in directly addressable codes.

A block of ids is split into levels. Level 0 holds the lowest `widths[0]` bits of every id; ids with
higher bits go on in level 1, and so on. Each level but the last has a bitmap of which entries go on, and
a directory with the number of set bits before every `STEP`th entry, so that the place of an id in the next
level, and with it any id, is found without decoding what stands before it. Widths are chosen for the
block's own ids by dynamic programming over the number of bits stored.

The file is a Parquet table of blocks in the shared folder, in ascending doc_id order, written and
committed by Spark; a lost executor only repeats its own blocks. Nothing but the number of tokens of
each range of documents meets in one task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .bpe import encoder, in_chunks
from .shared import new_dir, store
from .wordscan import texts_of

STEP = 512
#: Ids of a block, up to one document more.
BLOCK = 1 << 18
_POP = np.array([bin(i).count("1") for i in range(256)], np.uint8)

BLOCKS = "part int, first_token long, n_docs int, n_tokens long, doc_ids binary, ends binary, widths array<int>, sizes array<long>, chunks array<binary>, bitmaps array<binary>, ranks array<binary>"


def widths_for(ids: np.ndarray) -> list[int]:
    """Level widths with the fewest stored bits: an entry costs its chunk and, but for the last level, a bit."""
    top = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    upto = np.append(0, np.cumsum(np.bincount(ids, minlength=1 << top)))
    beyond = [len(ids)] + [len(ids) - int(upto[1 << k]) for k in range(1, top)]
    best: list[tuple[int, list[int]]] = [(0, [])] * (top + 1)
    for a in range(top - 1, -1, -1):
        best[a] = min((beyond[a] * (b - a + (b < top)) + best[b][0], [b - a, *best[b][1]]) for b in range(a + 1, top + 1))
    return best[0][1]


class Dac:
    """Ids of a block in levels."""

    def __init__(self, widths: list[int], sizes: list[int], chunks: list[bytes], bitmaps: list[bytes], ranks: list[bytes]) -> None:
        self.widths, self.sizes = list(widths), list(sizes)
        self.chunks = [np.frombuffer(x, np.uint8) for x in chunks]
        self.bitmaps = [np.frombuffer(x, np.uint8) for x in bitmaps]
        self.ranks = [np.frombuffer(x, np.uint32) for x in ranks]

    @classmethod
    def encode(cls, ids: np.ndarray) -> Dac:
        widths, rest = widths_for(ids), ids.astype(np.uint32)
        sizes, chunks, bitmaps, ranks = [], [], [], []
        for i, w in enumerate(widths):
            sizes.append(len(rest))
            bits = np.unpackbits(rest.astype("<u4").view(np.uint8).reshape(-1, 4)[:, : (w + 7) // 8], axis=1, bitorder="little")[:, :w]
            chunks.append(np.packbits(bits.reshape(-1), bitorder="little").tobytes())
            if i < len(widths) - 1:
                rest = rest >> np.uint32(w)
                on = rest > 0
                bitmaps.append(np.packbits(on, bitorder="little").tobytes())
                sums = np.concatenate([[0], np.cumsum(on)])[:-1][::STEP] if len(on) else np.zeros(0)
                ranks.append(sums.astype(np.uint32).tobytes())
                rest = rest[on]
        return cls(widths, sizes, chunks, bitmaps, ranks)

    def parts(self) -> tuple[list[int], list[int], list[bytes], list[bytes], list[bytes]]:
        return self.widths, self.sizes, *([x.tobytes() for x in y] for y in (self.chunks, self.bitmaps, self.ranks))

    def _rank(self, level: int, at: np.ndarray) -> np.ndarray:
        """Set bits before each place."""
        bits, block = self.bitmaps[level], at // STEP
        out = self.ranks[level][block].astype(np.int64)
        for b in range(STEP // 8):
            byte = block * (STEP // 8) + b
            whole, last = byte < at // 8, (byte == at // 8) & (at % 8 > 0)
            value = bits[np.minimum(byte, len(bits) - 1)]
            out += np.where(whole, _POP[value], 0)
            out += np.where(last, _POP[value & ((1 << (at % 8)) - 1).astype(np.uint8)], 0)
        return out

    def _chunk(self, level: int, at: np.ndarray) -> np.ndarray:
        w, data = self.widths[level], self.chunks[level]
        value = np.zeros(len(at), np.uint32)
        for k in range(w):
            bit = at * w + k
            value |= ((data[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1).astype(np.uint32) << np.uint32(k)
        return value

    def access(self, at: np.ndarray) -> np.ndarray:
        """The ids at any places, each by as many look-ups as it has levels."""
        at, where, shift = np.asarray(at, np.int64), np.arange(len(at)), 0
        out = np.zeros(len(at), np.uint32)
        for level, w in enumerate(self.widths):
            out[where] |= self._chunk(level, at) << np.uint32(shift)
            if level == len(self.widths) - 1:
                break
            on = (self.bitmaps[level][at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
            at, where, shift = self._rank(level, at[on]), where[on], shift + w
        return out

    def run(self, a: int, b: int) -> np.ndarray:
        """The ids a..b: the start in each level comes from its directory, nothing before it is decoded."""
        n = b - a
        out, where, shift = np.zeros(n, np.uint32), np.arange(n), 0
        for level, w in enumerate(self.widths):
            n = len(where)
            lo = a * w
            bits = np.unpackbits(self.chunks[level][lo >> 3 : (lo + n * w + 7) >> 3], bitorder="little")[lo & 7 : (lo & 7) + n * w].reshape(n, w)
            wide = np.zeros((n, 4), np.uint8)
            packed = np.packbits(bits, axis=1, bitorder="little")
            wide[:, : packed.shape[1]] = packed
            out[where] |= wide.reshape(-1).view("<u4") << np.uint32(shift)
            if level == len(self.widths) - 1 or not n:
                break
            on = np.unpackbits(self.bitmaps[level][a >> 3 : (a + n + 7) >> 3], bitorder="little")[a & 7 : (a & 7) + n] > 0
            a, where, shift = int(self._rank(level, np.array([a]))[0]), where[on], shift + w
        return out


def _write(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        docs: list[int | None] = []
        held: list[np.ndarray] = []
        size = 0

        def block() -> pa.RecordBatch:
            ids = np.concatenate(held).astype(np.uint32)
            dac = Dac.encode(ids)
            known = pa.array(docs, pa.int64())
            raw = known.fill_null(-(2**63)).to_numpy(zero_copy_only=False).astype("<i8").tobytes()
            row = [part, before, len(docs), len(ids), raw, np.cumsum([len(h) for h in held]).astype("<i8").tobytes(), *dac.parts()]
            return pa.RecordBatch.from_pylist([dict(zip(_BLOCK_SCHEMA.names, row, strict=True))], schema=_BLOCK_SCHEMA)

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), texts_of(batch.column(1))
            for lo, some in in_chunks(texts):
                for i, found in enumerate(encoder(path).encode(some)):
                    docs.append(ids[lo + i])
                    held.append(np.append(found, found.dtype.type(end_id)))
                    size += len(held[-1])
                    if size >= BLOCK:
                        yield block()
                        before, docs, held, size = before + size, [], [], 0
        if docs:
            yield block()

    return run


_BLOCK_SCHEMA = pa.schema(
    [("part", pa.int32()), ("first_token", pa.int64()), ("n_docs", pa.int32()), ("n_tokens", pa.int64()), ("doc_ids", pa.binary()), ("ends", pa.binary()), ("widths", pa.list_(pa.int32())), ("sizes", pa.list_(pa.int64()))]
    + [(x, pa.list_(pa.binary())) for x in ("chunks", "bitmaps", "ranks")]
)


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """Blocks one at a time: they are large."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Encode docs (doc_id, text) and write the blocks; returns them as read from the file.

    Every text is encoded whole and gets `end_id`; null and empty texts are that id alone. Documents
    stand in ascending doc_id order, a null id first, rows of one id by their texts. An empty table
    gives a file without blocks.
    """
    spread = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return store(spread.mapInArrow(_write(tokenizer, end_id), BLOCKS), new_dir(docs.sparkSession, "tokens"), "blocks")


def _first_tokens(blocks: DataFrame) -> DataFrame:
    """The number of ids before each range of documents; one row a range."""
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    return parts.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before"))


def read_documents(blocks: DataFrame, with_ids: bool = True) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32 and, if asked for, ids, from the file."""
    schema = "part int, doc_id long, at long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                dac = Dac(*(row[x] for x in ("widths", "sizes", "chunks", "bitmaps", "ranks")))
                ends = np.frombuffer(row["ends"], "<i8")
                docs = np.frombuffer(row["doc_ids"], "<i8")
                starts = np.append(0, ends[:-1])
                ids = dac.run(0, int(ends[-1])).astype("<u4")
                crc = [zlib.crc32(ids[a:b].data) for a, b in zip(starts, ends, strict=True)]
                known = pa.array(docs, mask=docs == -(2**63))
                out = [pa.array(np.full(len(docs), row["part"], np.int32)), known, pa.array(starts + row["first_token"]), pa.array(ends - starts), pa.array(crc, pa.int64())]
                if with_ids:
                    out.append(pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(out, names=[f.split()[0] for f in schema.split(", ")])

    found = blocks.mapInArrow(run, schema).join(_first_tokens(blocks), "part")
    return found.select("doc_id", (F.col("at") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))


def tokens_at(spark: SparkSession, blocks: DataFrame, positions: DataFrame) -> DataFrame:
    """position, token: random access by place in the whole file, for positions (position long).

    Each position finds its block by an equi-join over stretches of `BLOCK` ids, of which a block touches a few, and its
    id by look-ups in that block; positions outside the file give no row, repeated positions repeated rows.
    """
    placed = blocks.join(_first_tokens(blocks), "part").withColumn("lo", F.col("first_token") + F.col("before"))
    last = F.col("lo") + F.col("n_tokens") - 1
    touched = placed.select("lo", "n_tokens", F.explode(F.sequence(F.floor(F.col("lo") / BLOCK), F.floor(last / BLOCK))).alias("stretch"))
    near = positions.select("position", F.floor(F.col("position") / BLOCK).alias("stretch")).join(touched, "stretch").where((F.col("position") >= F.col("lo")) & (F.col("position") <= last))
    asked = near.groupBy("lo", F.floor(F.rand(7) * 64).alias("salt")).agg(F.collect_list("position").alias("positions"))
    both = asked.join(placed, "lo").select("lo", "positions", "widths", "sizes", "chunks", "bitmaps", "ranks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                dac = Dac(*(row[x] for x in ("widths", "sizes", "chunks", "bitmaps", "ranks")))
                at = np.array(row["positions"], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(dac.access(at - row["lo"]).astype(np.int64))], names=["position", "token"])

    return both.mapInArrow(run, "position long, token long")
