"""What a worker holds, and that it knows the same with less."""

import tracemalloc

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from visloom.llm import bpe, ngram_lm

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def test_known_parts_take_little_memory():
    """Ids of 200000 parts as objects took some 30 MB a worker, twice over."""
    e = bpe.Encoder(TOKENIZER)
    words = np.random.default_rng(4).integers(97, 123, (200_000, 7)).astype(np.uint8)
    text = b" ".join(x.tobytes() for x in words)
    tracemalloc.start()
    e.encode([text])
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 12e6


def test_parts_are_forgotten_and_learnt_again(monkeypatch):
    monkeypatch.setattr(bpe, "KEEP", 40)
    e, whole = bpe.Encoder(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    r = np.random.default_rng(9)
    pool = [f"wo{i}rd" if i % 3 else f"été{'aeiou'[i % 5]}é{i % 2 * '.'}" for i in range(120)] + ["é.", "l'été,", "x.", "(a.b),"]
    for _ in range(40):
        texts = [" ".join(r.choice(pool, 12)) for _ in range(3)] + [""]
        for mine, text in zip(e.encode([t.encode() for t in texts]), texts, strict=True):
            assert mine.tolist() == whole.encode(text, add_special_tokens=False).ids
        assert len(e.known.hashes) <= 40 + 36 and (np.diff(e.known.hashes.astype(object)) > 0).all()


def test_filter_is_probed_in_blocks():
    """All keys at once held some 70 bytes of each, and streamed them through memory at each probe."""
    keys = np.arange(1, 600_001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    counts = np.arange(600_000) % 9 + 1
    field = ngram_lm.build_filter(keys[::2], counts[::2], ngram_lm.PAIRS)
    base, bits = np.zeros(len(keys), np.uint64), np.full(len(keys), len(field) * 8, np.uint64)
    bits[5::10] = 0
    tracemalloc.start()
    found = ngram_lm.find_level(field, base, bits, keys)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak - found.nbytes < 5e6
    right = np.where(np.arange(600_000) % 2 == 0, ngram_lm.level_of(counts, ngram_lm.PAIRS), 0)
    assert (found >= np.where(bits > 0, right, 0)).all() and not found[bits == 0].any()
    assert (found > right).mean() < 0.01
    some = np.random.default_rng(2).choice(600_000, 3000, replace=False)
    assert np.array_equal(found[some], [ngram_lm.find_level(field, base[k : k + 1], bits[k : k + 1], keys[k : k + 1])[0] for k in some])
