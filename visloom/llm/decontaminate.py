"""Benchmark decontamination by a broadcast set of normalised n-grams.

The benchmark's windows (`WINDOW` consecutive words; an item of fewer words is one window) become a sorted
array of hashes with the words behind them. Tasks hash every run of words of their documents, look the
hashes up, and compare the words of each hit with the item's. The set is built by tasks and broadcast in
parts of about `PART` windows at most, and a worker holds one part at a time, so what driver and tasks hold is
bounded however large the benchmark is. Documents are read once, and nothing of them is shuffled.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import new_dir, store
from .wordscan import CHUNK, PLAIN, Words, run_at, runs, scan, texts_of

WINDOW = 10
#: Windows of one broadcast: with its words about 200 bytes each.
PART = 1 << 18
HITS = "doc_id long, n_words long, spans array<struct<a:long,b:long>>, items array<string>, unnamed boolean"
_SPAN = pa.struct([("a", pa.int64()), ("b", pa.int64())])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of benchmark items: item_id, hash, number of words, the words joined by blanks."""
    for batch in batches:
        ids = batch.column(0).to_pylist()
        out: list[tuple] = []
        for w in scan(texts_of(batch.column(1)), PLAIN):
            for i in range(w.n_texts):
                a, b = int(w.offsets[i]), int(w.offsets[i + 1])
                k = min(WINDOW, b - a)
                if k:
                    words = [w.word(j) for j in range(a, b)]
                    for j, h in enumerate(runs(w.hashes[a:b], k).view(np.int64)):
                        out.append((ids[w.lo + i], int(h), k, b" ".join(words[j : j + k])))
        cols = zip(*out, strict=True) if out else ([], [], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, (pa.string(), pa.int64(), pa.int32(), pa.binary()), strict=True)], names=["item_id", "hash", "k", "words"])


class _Set:
    """Windows by number of words: sorted hashes, and for each the words and their items."""

    def __init__(self, rows: list[tuple[int, int, bytes, list[str | None]]]) -> None:
        self.by: dict[int, tuple[np.ndarray, np.ndarray, list[tuple[bytes, list[str | None]]]]] = {}
        for k in {r[1] for r in rows}:
            some = sorted((r for r in rows if r[1] == k), key=lambda r: np.int64(r[0]).view(np.uint64))
            h = np.array([r[0] for r in some], np.int64).view(np.uint64)
            seen = np.zeros(1 << 20, bool)
            seen[h >> np.uint64(44)] = True
            self.by[k] = h, seen, [(r[2], r[3]) for r in some]


def _hits_in(known: _Set, w: Words) -> tuple[list[list[tuple[int, int]]], list[set[str | None]]]:
    """For each text of a chunk: word ranges of verified windows, in order of window length, and the items (None: such without an id)."""
    spans: list[list[tuple[int, int]]] = [[] for _ in range(w.n_texts)]
    items: list[set[str | None]] = [set() for _ in range(w.n_texts)]
    for k, (h, seen, what) in known.by.items():
        at = run_at(w, k)
        mine = runs(w.hashes, k)[at]
        maybe = np.flatnonzero(seen[mine >> np.uint64(44)])
        lo = np.searchsorted(h, mine[maybe], "left")
        hit = (lo < len(h)) & (h[np.minimum(lo, len(h) - 1)] == mine[maybe])
        places, lo = at[maybe[hit]], lo[hit]
        own = np.searchsorted(w.offsets, places, "right") - 1
        for p, i, t in zip(places.tolist(), lo.tolist(), own.tolist(), strict=True):
            words, first = b" ".join(w.word(j) for j in range(p, p + k)), h[i]
            while i < len(h) and h[i] == first:
                if what[i][0] == words:
                    items[t].update(what[i][1])
                    a = p - int(w.offsets[t])
                    if spans[t] and spans[t][-1][1] >= a >= spans[t][-1][0]:
                        spans[t][-1] = (spans[t][-1][0], max(a + k, spans[t][-1][1]))
                    else:
                        spans[t].append((a, a + k))
                    break
                i += 1
    return spans, items


def _hits(parts: list[Broadcast], texts: list[bytes]) -> Iterator[tuple[Words, list[list[tuple[int, int]]], list[set[str | None]]]]:
    """Per chunk of texts: its words, and for each text the merged word ranges and the items of all parts.

    Chunks are as large as the number of parts, each of which is loaded for each chunk where there are several.
    """
    for w in scan(texts, PLAIN, chunk=CHUNK * max(1, min(len(parts), 16))):
        spans: list[list[tuple[int, int]]] = [[] for _ in range(w.n_texts)]
        items: list[set[str | None]] = [set() for _ in range(w.n_texts)]
        for part in parts:
            for i, (some, named) in enumerate(zip(*_hits_in(part.value, w), strict=True)):
                spans[i] += some
                items[i] |= named
            if len(parts) > 1:  # it is read anew from the worker's disk for the next chunk
                part.__dict__.pop("_value", None)
        yield w, list(map(_union, spans)), items


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


WINDOWS = "item_id string, hash long, k int, words binary"


def _build(table: pa.Table) -> pa.Table:
    rows = [(r["hash"], r["k"], r["words"], r["items"] + [None] * r["unnamed"]) for r in table.select(["hash", "k", "words", "items", "unnamed"]).to_pylist()]
    return pa.table({"part": [pickle.dumps(_Set(rows))]})


def benchmark_parts(benchmark: DataFrame) -> list[Broadcast]:
    """The windows of benchmark (item_id, text), items without an id among them, in broadcasts of at most about PART windows.

    Windows that several items hold are kept once, with the items' ids as text. An empty benchmark has no parts.
    """
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("string"), "text")
    grams = items.mapInArrow(_windows, WINDOWS).groupBy("hash", "k", "words").agg(F.sort_array(F.collect_set("item_id")).alias("items"), F.bool_or(F.isnull("item_id")).alias("unnamed"))
    folder = new_dir(spark, "benchmark")
    grams = store(grams, folder, "windows")
    n = max(1, -(-grams.count() // PART))
    sets = store(grams.groupBy(F.pmod("hash", F.lit(n)).alias("i")).applyInArrow(_build, "part binary"), folder, "sets")
    return [spark.sparkContext.broadcast(pickle.loads(r["part"])) for r in sets.toLocalIterator()]


def benchmark_hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, spans (merged word ranges a..b that occur in the benchmark), items (sorted item ids, as text), unnamed.

    One row per row of docs (doc_id, text). Null and empty texts have no words; items without words are never
    found; those with a null id are found as others, and unnamed says so in place of an id in items; an empty
    benchmark finds nothing. Other columns are ignored.
    """
    parts = benchmark_parts(benchmark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w, spans, items in _hits(parts, texts_of(batch.column(1))):
                cols = [pa.array(np.diff(w.offsets)), pa.array([[{"a": a, "b": b} for a, b in s] for s in spans], pa.list_(_SPAN)), pa.array([sorted(s - {None}) for s in items], pa.list_(pa.string())), pa.array([None in s for s in items])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(w.lo, w.n_texts), *cols], names=["doc_id", "n_words", "spans", "items", "unnamed"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, HITS)


def n_hit() -> F.Column:
    return F.aggregate("spans", F.lit(0).cast("long"), lambda acc, x: acc + x["b"] - x["a"])


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, all columns, that hold no benchmark window: one pass, nothing is shuffled.

    Null and empty texts hold none; repeated rows go or stay alike; an empty benchmark keeps every row.
    """
    parts, text = benchmark_parts(benchmark), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = np.zeros(batch.num_rows, bool)
            for w, spans, _ in _hits(parts, texts_of(batch.column(text))):
                clean[w.lo : w.lo + w.n_texts] = [not s for s in spans]
            yield batch.filter(pa.array(clean))

    return docs.mapInArrow(run, docs.schema)


def without_spans(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, all columns, with every span of benchmark words cut out of the text, as written, to one blank.

    Null texts stay null, texts without a span as they are, also repeated ones.
    """
    parts, names = benchmark_parts(benchmark), docs.columns
    text = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text).to_pylist()
            for w, spans, _ in _hits(parts, texts_of(batch.column(text))):
                for i, some in enumerate(spans):
                    if some:
                        raw, first = texts[w.lo + i].encode(), w.offsets[i]
                        at, kept = 0, []
                        for a, b in some:
                            kept.append(raw[at : w.starts[first + a] - w.text_at[i]])
                            at = int(w.ends[first + b - 1] - w.text_at[i])
                        texts[w.lo + i] = b" ".join([*kept, raw[at:]]).decode()
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if j == text else batch.column(j) for j in range(batch.num_columns)], names=names)

    return docs.mapInArrow(run, docs.schema)
