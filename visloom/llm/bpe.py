"""Token ids of whole texts by a public tokenizer, through the tokenizers library.

The vocabulary used drops white space, lower-cases, and its pre-tokenizer never joins a word with what
stands behind white space, or a letter with a punctuation mark. So a text's ids are those of its parts
between ASCII white space, one after the other, and a part that ends in a letter and one full stop or
comma has the ids of the two. Each worker keeps the ids of parts it has met, by the parts' 64-bit hashes and in
flat arrays (two generations of about `KEEP` parts and `KEEP_IDS` ids, which bounds its memory, some 30 MB), and hands
only new words to the library: plain Latin words straight to its BPE model, in the byte letters that the tokenizer's byte-level step would make, all else through the
full tokenizer. The ids equal those of the whole text; tests compare both.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator

import numpy as np
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from .wordscan import SPACED, scan

KEEP, KEEP_IDS = 500_000, 4_000_000
#: Letters up to here have one-letter lower cases and no special composition.
LATIN = "\u024f"


class Kept:
    """Ids of parts: sorted hashes, and where each part's ids lie in one flat array."""

    def __init__(self, dtype: np.dtype) -> None:
        self.hashes, self.at, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.ids = np.zeros(0, dtype)

    @property
    def full(self) -> bool:
        return len(self.hashes) > KEEP or len(self.ids) > KEEP_IDS

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash, -1 where it isn't kept."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        place = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[place] == hashes, place, -1)

    def add(self, hashes: np.ndarray, size: np.ndarray, ids: np.ndarray) -> None:
        """Keep parts of sorted hashes, none of which is kept, by the sizes of their runs of ids."""
        place = np.searchsorted(self.hashes, hashes)
        self.at = np.insert(self.at, place, len(self.ids) + np.cumsum(size) - size)
        self.size = np.insert(self.size, place, size)
        self.hashes, self.ids = np.insert(self.hashes, place, hashes), np.concatenate([self.ids, ids])


def runs_of(at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Places of all members of runs, one run after the other."""
    ends = np.cumsum(size)
    return np.repeat(at - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


class Encoder:
    """Ids as little-endian unsigned 32-bit integers, or 16-bit where the vocabulary allows it.

    A tokenizer that joins words over white space, keeps case or reads letters otherwise is refused: it would give
    whole texts other ids than their parts.
    """
    def __init__(self, path: str) -> None:
        # A task has one core; a pool of threads a worker costs time and memory.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.known, self.before = Kept(self.dtype), Kept(self.dtype)
        letters = ByteLevel.alphabet()
        kept = [b for b in range(256) if chr(b) in letters]
        rest = (b for b in range(256) if chr(b) not in letters)
        self.letters = {b: chr(256 + i) for i, b in enumerate(rest)} | {b: chr(b) for b in kept}
        self.marks = {m: self._call([m.decode()])[0] for m in (b".", b",")}
        probe = "Ab cd, EF. Gh\n\tij  12 k.l na\u00efve \u00dcnder, x. \u0160kola don't 3.5% the-end ("
        if self.encode([probe.encode()])[0].tolist() != self.tokenizer.encode(probe, add_special_tokens=False).ids:
            raise ValueError(f"the parts of a text don't have its ids by {path}")

    def _call(self, words: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch(words, add_special_tokens=False)
        return [np.array(e.ids, self.dtype).tobytes() for e in found]

    def _word(self, word: bytes) -> bytes | None:
        """Ids of a plain Latin word, else None."""
        text = word.decode("utf-8", "replace")
        if not text.isascii():
            text = text.lower()
            if not text.isalpha() or max(text) > LATIN:
                return None
            text = text.encode().decode("latin-1").translate(self.letters)
        elif not text.isalpha():
            return None
        return array(self.dtype.char, [t.id for t in self.tokenizer.model.tokenize(text)]).tobytes()

    def _learn(self, parts: list[bytes]) -> list[bytes]:
        """Ids of distinct parts."""
        cores: dict[bytes, tuple[bytes, bytes]] = {}
        for p in parts:
            mark = self.marks.get(p[-1:])
            if mark and len(p) > 1 and (97 <= p[-2] <= 122 or p[:-1].decode("utf-8", "replace")[-1].isalpha()):
                cores[p] = p[:-1], mark
        found = {w: self._word(w) for w in {cores[p][0] if p in cores else p for p in parts}}
        new = [w for w, ids in found.items() if ids is None]
        for i in range(0, len(new), 1024):
            some = new[i : i + 1024]
            found.update(zip(some, self._call([w.decode("utf-8", "replace") for w in some]), strict=True))
        return [found[cores[p][0]] + cores[p][1] if p in cores else found[p] for p in parts]

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each text. Parts are found, told apart and looked up in numpy; only new ones are taken out."""
        out: list[np.ndarray] = []
        for w in scan(texts, SPACED, chunk=2 << 20, marks=b".,"):
            hashes, first, back = np.unique(w.hashes, return_index=True, return_inverse=True)
            if self.known.full:
                self.before, self.known = self.known, Kept(self.dtype)
            lost = np.flatnonzero(self.known.find(hashes) < 0)
            if len(lost):
                place = self.before.find(hashes[lost])
                old, new = lost[place >= 0], lost[place < 0]
                place = place[place >= 0]
                size = self.before.size[place]
                self.known.add(hashes[old], size, self.before.ids[runs_of(self.before.at[place], size)])
                learnt = self._learn([w.data[a:b].tobytes() for a, b in zip(w.starts[first[new]].tolist(), w.ends[first[new]].tolist(), strict=True)])
                size = np.fromiter(map(len, learnt), np.int32, len(learnt)) // self.dtype.itemsize
                self.known.add(hashes[new], size, np.frombuffer(b"".join(learnt), self.dtype))
            place = self.known.find(hashes)
            ids = np.concatenate([self.known.ids, np.frombuffer(b"".join(self.marks.values()), self.dtype)])
            size, at = self.known.size[place], self.known.at[place][back]
            # Words and the marks behind them, as runs of ids: where each is found, and where it goes.
            marked = w.marks > 0
            place = np.arange(len(back)) + np.cumsum(marked) - marked
            runs = np.zeros(len(back) + int(marked.sum()), np.int64)
            source = runs.copy()
            runs[place], source[place] = size[back], at
            runs[place[marked] + 1] = 1
            source[place[marked] + 1] = len(ids) - 2 + (w.marks[marked] == 44)
            ends = np.cumsum(runs)
            every = ids[runs_of(source, runs)]
            cut = np.append(0, ends)[np.append(place, len(runs))[w.offsets]]
            out += [every[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder a worker process and vocabulary file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def in_chunks(texts: list[bytes], limit: int = 2 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """(first, texts) of about `limit` bytes; whole texts only."""
    lo = 0
    while lo < len(texts):
        hi, size = lo, 0
        while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= limit):
            size += len(texts[hi])
            hi += 1
        yield lo, texts[lo:hi]
        lo = hi
