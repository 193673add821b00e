"""Fill-in-the-middle texts, cut through a learned rank index.

A text is dealt into tokens, and a cut stands behind a number of them. The index says at which code point that is:
straight pieces are fitted to the offsets of all boundaries by rank, each as long as one slope keeps every boundary
within `ERROR` code points, and the small residuals that are left are stored, one byte each. A cut's offset is
predicted by the piece that its rank lies in and set right by its residual, so it is exact. Which texts are cut, where,
and how their parts are put together follows from digests of their ids, so runs repeat themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .wordscan import SPACED, texts_of

#: Marks of the three parts.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Bound of a prediction's error: residuals, rounding included, fit into a signed byte.
ERROR = 120
#: Boundaries that are looked at together while a piece grows.
STEP = 1 << 12


def boundaries(text: bytes) -> np.ndarray:
    """Offsets, in code points, of the bounds of `[white space]*[other]+` or closing white space, from 0 to the end."""
    data = np.frombuffer(text, np.uint8)
    if not len(data):
        return np.zeros(1, np.int64)
    other = SPACED[data]
    ends = np.flatnonzero(other[:-1] & ~other[1:]) + 1
    ends = np.append(ends, len(data))  # of the last token, or of the white space behind it
    if text.isascii():
        return np.append(0, ends)
    starts = np.append(0, ends[:-1])
    points = np.add.reduceat((data & 0xC0) != 0x80, starts, dtype=np.int64)
    return np.append(0, np.cumsum(points))


@dataclass
class RankIndex:
    """Offsets of ranks 0, 1, ... as pieces (first rank, offset there, slope) and residuals."""

    rank: np.ndarray
    offset: np.ndarray
    slope: np.ndarray
    residual: np.ndarray

    @classmethod
    def fit(cls, offsets: np.ndarray, error: int = ERROR) -> RankIndex:
        """Greedy pieces: from a boundary on, the slopes that keep every further one within the error narrow until none is left."""
        n, at = len(offsets), 0
        ranks, slopes = [], []
        while at < n:
            low, high, end = 0.0, np.inf, at + 1
            while end < n:
                some = offsets[end : end + STEP] - offsets[at]
                away = np.arange(end - at, end - at + len(some))
                lows = np.maximum.accumulate(np.maximum((some - error) / away, low))
                highs = np.minimum.accumulate(np.minimum((some + error) / away, high))
                broken = np.flatnonzero(lows > highs)
                many = int(broken[0]) if len(broken) else len(some)
                if many:
                    low, high = lows[many - 1], highs[many - 1]
                end += many
                if len(broken):
                    break
            ranks.append(at)
            slopes.append((low + high) / 2 if np.isfinite(high) else 0.0)
            at = end
        rank, slope = np.array(ranks, np.int64), np.array(slopes)
        index = cls(rank, offsets[rank], slope, np.zeros(0, np.int8))
        index.residual = (offsets - index.predict(np.arange(n))).astype(np.int8)
        return index

    def predict(self, ranks: np.ndarray) -> np.ndarray:
        piece = np.searchsorted(self.rank, ranks, "right") - 1
        return self.offset[piece] + np.floor(self.slope[piece] * (ranks - self.rank[piece]) + 0.5).astype(np.int64)

    def find(self, ranks: np.ndarray) -> np.ndarray:
        """Exact offsets."""
        return self.predict(ranks) + self.residual[ranks]


_INDEX = "rank array<long>, offset array<long>, slope array<double>, residual binary"
_LISTS = pa.struct([("rank", pa.list_(pa.int64())), ("offset", pa.list_(pa.int64())), ("slope", pa.list_(pa.float64())), ("residual", pa.binary())])


def rank_index(docs: DataFrame) -> DataFrame:
    """doc_id, n, rank, offset, slope, residual: each row's index, to be kept beside the texts; null texts are empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [RankIndex.fit(boundaries(t)) for t in texts_of(batch.column(1))]
            rows = [{"rank": x.rank, "offset": x.offset, "slope": x.slope, "residual": x.residual.tobytes()} for x in found]
            held = pa.array(rows, _LISTS)
            n = pa.array([len(x.residual) - 1 for x in found], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), n, *held.flatten()], names=["doc_id", "n", *_LISTS.names])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, f"doc_id long, n long, {_INDEX}")


def offset_at(rank: Column) -> Column:
    """The exact code-point offset of a rank, of a row of `rank_index`; null beyond the row's ranks."""
    piece = F.size(F.filter("rank", lambda r: r <= rank)) - 1
    ahead = F.floor(F.get("slope", piece) * (rank - F.get("rank", piece)) + 0.5)
    octet = F.conv(F.hex(F.substring("residual", rank.cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.when((rank >= 0) & (rank <= F.col("n")), F.get("offset", piece) + ahead + octet - F.when(octet > 127, 256).otherwise(0))


CUTS = "struct<n: long, first: long, second: long>"


def _cuts(text: pa.Array, one: pa.Array, two: pa.Array) -> pa.Array:
    """The number of tokens of each text, and the offsets of its cuts by its rank index."""
    h = np.stack([one.to_numpy(zero_copy_only=False), two.to_numpy(zero_copy_only=False)])
    out = np.zeros((3, len(text)), np.int64)
    for i, t in enumerate(texts_of(text)):
        index = RankIndex.fit(boundaries(t))
        n = len(index.residual) - 1
        out[0, i], out[1:, i] = n, index.find(np.sort(h[:, i] % (n + 1)))
    return pa.StructArray.from_arrays([pa.array(x) for x in out], names=["n", "first", "second"])


def fill_in_middle(docs: DataFrame, seed: int = 42, cut_percent: int = 50, suffix_first_percent: int = 80) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output of each row of docs (doc_id, text).

    Four numbers of 32 bits from the digest of `seed:doc_id` say where the cuts are, whether the text is cut at all
    (cut_percent of a hundred are) and whether the suffix comes first (`spm`, else `psm`). A text that is empty or
    null, or holds one of the marks, stays plain; plain texts have no prefix_chars and middle_chars. A null id is the
    empty text in the digest. Repeated rows come out alike; other columns are ignored; an empty table gives none.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *h)
    rows = rows.withColumn("c", F.arrow_udf(_cuts, CUTS)("text", "h1", "h2"))
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.col("text").contains(mark)
    form = F.when((F.col("text") == "") | marked | (F.col("h3") % 100 >= cut_percent), "plain").when(F.col("h4") % 100 < suffix_first_percent, "spm").otherwise("psm")
    first, second = F.col("c.first").cast("int"), F.col("c.second").cast("int")
    rows = rows.select("doc_id", "text", F.col("c.n").alias("n"), form.alias("form"), first.alias("first"), second.alias("second"))
    prefix, middle, suffix = (F.substring("text", F.lit(1), F.col("first")), F.substring("text", F.col("first") + 1, F.col("second") - F.col("first")), F.substring("text", F.col("second") + 1, F.length("text")))
    psm = F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle)
    spm = F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle)
    output = F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm).otherwise(F.col("text"))
    cut = F.col("form") != "plain"
    return rows.select("doc_id", "n", "form", F.when(cut, F.col("first")).cast("long").alias("prefix_chars"), F.when(cut, F.col("second") - F.col("first")).cast("long").alias("middle_chars"), output.alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The text that an output of a form was made of."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    psm = F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2)))
    spm = F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
