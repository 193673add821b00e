"""Quality rules: gradient-boosted trees over document statistics.

Statistics are counted over whole texts in numpy. The trees are fitted on the driver from at most
`SAMPLE` labelled documents (those of smallest hash of doc_id; a documented bound), with monotonic
constraints on chosen statistics, and flattened into node arrays of some kilobytes, with which each task
scores its documents level by level, all documents and trees at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .wordscan import SPACED, Words, mixed, polynomials, run_at, runs, scan, texts_of

#: Labelled rows that the trees are fitted on, at most.
SAMPLE = 20_000
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Statistics the trees see, and how the verdict may depend on each: -1 means more is never better.
FEATURES = {"log_words": 0, "mean_word": 0, "symbol_ratio": -1, "dup_line_ratio": -1, "repeat_ratio": -1, "distinct_ratio": 1, "top_word_ratio": -1, "mean_line": 0, "short_line_ratio": 0, "end_mark_ratio": 0, "digit_ratio": 0, "upper_ratio": 0}


def _sums(mask: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return total[np.append(at[1:], len(mask))] - total[at]


def _repeats(own: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether each (owner, hash) occurs twice or more."""
    order = np.lexsort((h, own))
    o, x = own[order], h[order]
    same = (o[1:] == o[:-1]) & (x[1:] == x[:-1])
    many = np.zeros(len(h), bool)
    many[order[1:]] |= same
    many[order[:-1]] |= same
    return many


def statistics(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Counts (texts x COUNTS) and FEATURES (texts x features) of a chunk scanned without lower-casing."""
    n, raw, own = w.n_texts, w.data, w.owners()
    inside = np.zeros(len(raw) + 1, np.int8)
    inside[w.starts] += 1
    inside[w.ends] -= 1
    inside = np.cumsum(inside[:-1]).astype(bool)
    points = (raw & 0xC0) != 0x80
    counts = np.zeros((n, len(COUNTS)), np.int64)
    counts[:, 0] = np.diff(w.offsets)
    counts[:, 1] = _sums(inside & points, w.text_at)
    counts[:, 2] = _sums(SYMBOLS[raw], w.text_at)

    # Lines: between \n; the end of a text also ends its last line.
    breaks = raw == 10
    breaks[np.append(w.text_at[1:], len(raw)) - 1] = True
    ends = np.flatnonzero(breaks)
    starts = np.append(0, ends[:-1] + 1)
    line_of = np.searchsorted(starts, w.starts, "right") - 1
    has_word = np.zeros(len(starts), bool)
    has_word[line_of] = True
    text_of_line = np.searchsorted(w.text_at, starts, "right") - 1
    h = _line_hashes(raw, starts, ends)
    real = np.flatnonzero(has_word)
    order = np.lexsort((real, h[real], text_of_line[real]))
    o, x = text_of_line[real][order], h[real][order]
    again = np.concatenate([[False], (o[1:] == o[:-1]) & (x[1:] == x[:-1])]) if len(real) else np.zeros(0, bool)
    counts[:, 3] = np.bincount(o[again], minlength=n)

    at = run_at(w, 5)
    many = _repeats(own[at], runs(w.hashes, 5)[at])
    cover = np.zeros(len(own) + 6, np.int64)
    np.add.at(cover, at[many], 1)
    np.add.at(cover, at[many] + 5, -1)
    covered = np.cumsum(cover)[: len(own)] > 0
    counts[:, 4] = np.bincount(own[covered], minlength=n)

    words = np.maximum(counts[:, 0], 1).astype(float)
    lines = np.maximum(np.bincount(text_of_line[has_word], minlength=n), 1).astype(float)
    size = np.maximum(_sums(points, w.text_at), 1).astype(float)
    order = np.lexsort((w.hashes, own))
    o, x = own[order], w.hashes[order]
    first = np.ones(len(o), bool)
    first[1:] = (o[1:] != o[:-1]) | (x[1:] != x[:-1])
    at = np.flatnonzero(first)
    top = np.zeros(n)
    np.maximum.at(top, o[at], np.diff(np.append(at, len(o))))
    last = raw[np.maximum(w.ends - 1, 0)]
    line_words = np.bincount(line_of, minlength=len(starts))
    features = np.stack(
        [
            np.log1p(counts[:, 0]), counts[:, 1] / words, counts[:, 2] / size, counts[:, 3] / lines, counts[:, 4] / words, np.bincount(o[at], minlength=n) / words, top / words, words / lines,
            np.bincount(text_of_line[has_word & (line_words < 4)], minlength=n) / lines, np.bincount(own[(last == 46) | (last == 33) | (last == 63)], minlength=n) / words,
            _sums((raw >= 48) & (raw <= 57), w.text_at) / size, _sums((raw >= 65) & (raw <= 90), w.text_at) / size,
        ],
        axis=1,
    )
    return counts, features


def _line_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mixed(polynomials(raw, starts, ends) + (ends - starts).astype(np.uint64))


@dataclass
class Trees:
    """Complete binary trees as node arrays (trees x nodes): a document goes right where its value exceeds the cut."""

    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log odds of good quality of each row."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        depth = (self.leaf.shape[1]).bit_length() - 1
        for f, c, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, f[node]] > c[node])
            total += leaf[node - len(f)]
        return total


def fit(x: np.ndarray, y: np.ndarray, monotone: list[int], rounds: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 64, ridge: float = 1.0, least: float = 1.0) -> Trees:
    """Boosted trees of the logistic loss by histograms; monotone[j] = 1 or -1 forbids a falling or rising dependence.

    A split that breaks a constraint is not taken, and the mean of its two leaves bounds what lies below
    each side, so constraints hold for whole trees and so for their sum.
    """
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    code = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], axis=1)
    p = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    base = float(np.log(p / (1 - p)))
    total = np.full(len(x), base)
    inner, n_leaves = (1 << depth) - 1, 1 << depth
    feature, cut, leaf = np.zeros((rounds, inner), np.int64), np.full((rounds, inner), np.inf), np.zeros((rounds, n_leaves))
    for t in range(rounds):
        q = 1 / (1 + np.exp(-total))
        g, h = q - y, q * (1 - q)
        node = np.zeros(len(x), np.int64)
        bounds = {0: (-np.inf, np.inf)}
        for k in range(inner):
            rows = np.flatnonzero(node == k)
            lo, hi = bounds[k]
            best = (1e-6, -1, 0)
            if len(rows) > 1:
                gs, hs = g[rows].sum(), h[rows].sum()
                for j, c in enumerate(cuts):
                    if not len(c):
                        continue
                    gl = np.cumsum(np.bincount(code[rows, j], g[rows], len(c) + 1))[:-1]
                    hl = np.cumsum(np.bincount(code[rows, j], h[rows], len(c) + 1))[:-1]
                    left = np.clip(-gl / (hl + ridge), lo, hi)
                    right = np.clip(-(gs - gl) / (hs - hl + ridge), lo, hi)
                    gain = -(gl * left + 0.5 * (hl + ridge) * left**2) - ((gs - gl) * right + 0.5 * (hs - hl + ridge) * right**2)
                    gain -= 0.5 * gs**2 / (hs + ridge)
                    gain[(hl < least) | (hs - hl < least) | (monotone[j] * (right - left) < 0)] = -1
                    i = int(gain.argmax())
                    if gain[i] > best[0]:
                        best = float(gain[i]), j, i
            _, j, i = best
            low, high = bounds[k], bounds[k]
            if j >= 0:
                feature[t, k], cut[t, k] = j, cuts[j][i]
                right = code[rows, j] > i
                node[rows] = 2 * k + 1 + right
                if monotone[j]:
                    side = [float(np.clip(-g[r].sum() / (h[r].sum() + ridge), lo, hi)) for r in (rows[~right], rows[right])]
                    mid = sum(side) / 2
                    low, high = ((lo, mid), (mid, hi)) if monotone[j] > 0 else ((mid, hi), (lo, mid))
            else:
                node[rows] = 2 * k + 1
            bounds[2 * k + 1], bounds[2 * k + 2] = low, high
        for k in range(n_leaves):
            rows = node == inner + k
            lo, hi = bounds[inner + k]
            value = float(np.clip(-g[rows].sum() / (h[rows].sum() + ridge), lo, hi)) if rows.any() else 0.0
            leaf[t, k] = rate * value
        total += leaf[t, node - inner]
    return Trees(feature, cut, leaf, base)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for w in scan(texts_of(batch.column(2)), SPACED, lower=False):
            _, x = statistics(w)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(w.lo, w.n_texts), batch.column(1).slice(w.lo, w.n_texts), pa.FixedSizeListArray.from_arrays(pa.array(x.reshape(-1)), x.shape[1]).cast(pa.list_(pa.float64()))], names=["doc_id", "quality", "x"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    """Fit the trees on the documents with a label in labels (doc_id, quality), at most `sample` of them.

    Labels of null or repeated ids, or null quality, are left out. An id that several rows of docs have gives one
    row. Without both kinds of label the trees say good of every document.
    """
    known = labels.select(F.col("doc_id").cast("long"), "quality").where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.count("*").alias("n")).where("n = 1")
    some = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).select("doc_id", "quality")
    rows = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(some), "doc_id").select("doc_id", "quality", "text").mapInArrow(_count, "doc_id long, quality int, x array<double>")
    # One row an id, however often documents repeat it.
    rows = rows.groupBy("doc_id").agg(F.min(F.struct("quality", "x")).alias("r")).select("r.*").collect()
    y = np.array([r["quality"] > 0 for r in rows], float)
    if not 0 < y.sum() < len(y):
        none = np.zeros((1, 1))
        return Trees(none.astype(np.int64), none + np.inf, np.zeros((1, 2)), 1.0)
    x = np.array([r["x"] for r in rows])
    order = np.lexsort((*x.T, y))
    return fit(x[order], y[order], list(FEATURES.values()))


RESULT = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, quality double, kept boolean"


def _judge(value):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees: Trees = value.value
        for batch in batches:
            for w in scan(texts_of(batch.column(1)), SPACED, lower=False):
                c, x = statistics(w)
                failed = (c[:, 0] < 10) | (100 * c[:, 4] > 20 * c[:, 0])
                odds = trees.score(x)
                cols = [batch.column(0).slice(w.lo, w.n_texts), *(pa.array(c[:, j]) for j in range(5)), pa.array(failed), pa.array(1 / (1 + np.exp(-odds))), pa.array(~failed & (odds > 0))]
                yield pa.RecordBatch.from_arrays(cols, names=[f.split()[0] for f in RESULT.split(", ")])

    return run


def judge(docs: DataFrame, trees: Trees) -> DataFrame:
    """Counts, quality (0 to 1) and verdict of each row of docs (doc_id, text).

    Null and empty texts have no words and fail. Repeated rows are judged alike, null ids kept as they are.
    """
    value = docs.sparkSession.sparkContext.broadcast(trees)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_judge(value), RESULT)


def good_documents(docs: DataFrame, trees: Trees) -> DataFrame:
    """The rows of docs, all columns, that pass.

    Null and empty texts fail; repeated rows are judged alike; ids are not looked at.
    """
    value, names = docs.sparkSession.sparkContext.broadcast(trees), docs.columns
    text = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for w in scan(texts_of(batch.column(text)), SPACED, lower=False):
                c, x = statistics(w)
                keep[w.lo : w.lo + w.n_texts] = (c[:, 0] >= 10) & (100 * c[:, 4] <= 20 * c[:, 0]) & (value.value.score(x) > 0)
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
