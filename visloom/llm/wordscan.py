"""Words of many texts at once, in numpy: positions and 64-bit hashes.

Every text of a chunk is laid into one byte array; a table says which bytes belong to words, so
one pass finds all words, and prefix sums of `byte code * P**position` give each word's polynomial
hash without a loop over words. Chunks hold whole texts and about `CHUNK` bytes, which bounds the
memory of a task; only a single longer text makes a longer chunk. Hashing goes block by block, so beside
a text itself only its words' bounds and hashes are held.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
_U = np.uint64
_SEEDS = np.random.default_rng(20240229)
_CODES = _SEEDS.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
#: Multipliers of the places in a run of words.
PLACES = _SEEDS.integers(1, 2**63, 64, dtype=np.uint64) * _U(2) + _U(1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words that white space ends: not 0x20, not 0x09-0x0D.
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes of words of digits, lower-case letters and everything beyond ASCII.
PLAIN = np.zeros(256, bool)
PLAIN[0x30:0x3A] = PLAIN[0x61:0x7B] = PLAIN[0x80:] = True


#: Bytes of a block: powers are kept for so many places only, however long a text is.
BLOCK = 1 << 16
_UP, _DOWN = np.full(BLOCK + 1, _BASE, np.uint64), np.full(BLOCK + 1, _INVERSE, np.uint64)
_UP[0] = _DOWN[0] = 1
_UP, _DOWN = np.cumprod(_UP), np.cumprod(_DOWN)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> _U(31))
    x *= _U(0x7FB5D329728EA185)
    x ^= x >> _U(27)
    x *= _U(0x81DADEF4BC2DD44D)
    return x ^ (x >> _U(33))


@dataclass
class Words:
    """Words of texts lo..hi of a batch."""

    lo: int
    data: np.ndarray  # bytes as scanned (lower-cased if asked for)
    text_at: np.ndarray  # where each text starts in data
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray  # words of text i: offsets[i]..offsets[i + 1]
    hashes: np.ndarray
    marks: np.ndarray  # the mark taken off each word's end, 0 where none was

    @property
    def n_texts(self) -> int:
        return len(self.offsets) - 1

    def owners(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(self.n_texts), np.diff(self.offsets))

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """Texts as UTF-8; null becomes empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def scan(texts: list[bytes], words: np.ndarray, lower: bool = True, chunk: int = CHUNK, marks: bytes = b"") -> Iterator[Words]:
    """All words of whole texts, chunk by chunk; a mark of `marks` right behind a letter a-z is taken off a word's end."""
    lo = 0
    while lo < len(texts):
        hi, size = lo, 0
        while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= chunk):
            size += len(texts[hi]) + 1
            hi += 1
        yield _scan(lo, texts[lo:hi], words, lower, marks)
        lo = hi


def _scan(lo: int, texts: list[bytes], words: np.ndarray, lower: bool, marks: bytes) -> Words:
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    if lower:
        data = LOWER[data]
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    text_at = np.cumsum(lengths) - lengths
    inside = words[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[0::2], edge[1::2]  # the closing space ends the last word
    off = np.zeros(len(ends), np.uint8)
    if marks and len(ends):
        last, before = data[ends - 1], data[np.maximum(ends - 2, 0)]
        found = np.isin(last, np.frombuffer(marks, np.uint8)) & (ends - starts > 1) & (before >= 97) & (before <= 122)
        off, ends = np.where(found, last, 0).astype(np.uint8), ends - found
    hashes = mixed(polynomials(data, starts, ends))
    offsets = np.searchsorted(starts, np.append(text_at, len(data)))
    return Words(lo, data, text_at, starts, ends, offsets, hashes, off)


def polynomials(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each word, or other range of bytes in order, the sum of its bytes' codes times the base to the power of their places in it."""
    out = np.zeros(len(starts), np.uint64)
    at = np.arange(0, len(data), BLOCK)
    first, last = np.searchsorted(ends, at, "right"), np.searchsorted(starts, at + BLOCK, "left")
    for begin, i, j in zip(at.tolist(), first.tolist(), last.tolist(), strict=True):
        if i == j:
            continue
        part = data[begin : begin + BLOCK]
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_CODES[part] * _UP[: len(part)])])
        a, b = np.maximum(starts[i:j] - begin, 0), np.minimum(ends[i:j] - begin, len(part))
        sums = (total[b] - total[a]) * _DOWN[a]
        if starts[i] < begin:  # the word that the block before began
            sums[:1] *= _U(pow(_BASE, int(begin - starts[i]), 1 << 64))
        out[i:j] += sums
    return out


def runs(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words, also of those that pass a text's end."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n] * PLACES[0]
    for j in range(1, k):
        out += hashes[j : j + n] * PLACES[j]
    return mixed(out + _U(k))


def run_at(w: Words, k: int) -> np.ndarray:
    """Places of the runs of k words that lie in one text."""
    own = w.owners()
    return np.flatnonzero(own[: len(own) - k + 1] == own[k - 1 :]) if len(own) >= k else np.zeros(0, np.int64)
