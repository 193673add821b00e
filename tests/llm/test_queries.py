"""Registered queries of the training-data operators: against their SQL, or against brute force on the smallest tables."""

import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from compare import assert_same, duck
from test_operators import brute_force_labels
from visloom.llm import ngram_lm
from visloom.llm import queries as q
from visloom.llm.licenses import PHRASES
from visloom.llm.ngram_lm import M, PAIRS, STEPS, WORDS, level_of, read_as, reserve
from visloom.llm.shared import new_dir
from visloom.llm.wordscan import SPACED, scan

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def docs(sf):
    return dict(duckdb.connect().execute(f"SELECT doc_id, text FROM '{sf}/documents.parquet' ORDER BY doc_id").fetchall())


@pytest.fixture(scope="module")
def ids(docs):
    t = Tokenizer.from_file(q.TOKENIZER)
    return {k: np.array(e.ids, "<u4") for k, e in zip(docs, t.encode_batch([x or "" for x in docs.values()], add_special_tokens=False), strict=True)}


@pytest.mark.parametrize("name", sorted(q.SQL))
def test_matches_sql(spark, sf, name):
    assert_same(q.QUERIES[name](spark, sf), duck(sf), q.SQL[name])


def test_token_file(spark, sf, ids):
    got = {r["doc_id"]: r for r in q.op2_token_file(spark, sf).collect()}
    start = 0
    for k, x in ids.items():
        x = np.append(x, np.uint32(1)).astype("<u4")
        assert (got[k]["start"], got[k]["n_tokens"], got[k]["ids_crc32"]) == (start, len(x), zlib.crc32(x.tobytes()))
        start += len(x)


def test_packing(spark, sf, ids):
    rows = q.op7_packing(spark, sf).collect()
    want = {k: np.append(x, np.uint32(2)).astype("<u4") for k, x in ids.items()}
    covered, sequences = Counter(), {}
    for r in rows:
        part = want[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert (len(part), zlib.crc32(part.tobytes()), len(want[r["doc_id"]])) == (r["length"], r["ids_crc32"], r["doc_tokens"])
        covered[r["doc_id"]] += r["length"]
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert covered == {k: len(x) for k, x in want.items()}
    pad = total = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
        total += at
        pad += 0 if at & (at - 1) == 0 else 4096 - at
    assert pad < 0.08 * total + 4096


def test_lm_scores(spark, sf, docs):
    words, pairs, texts = Counter(), Counter(), {}
    for k, x in docs.items():
        texts[k] = [*(x or "").encode().lower().split(), None]
        if zlib.crc32(str(k).encode()) % 7 != 2:
            words.update(texts[k])
            pairs.update(zip([0, *texts[k]], texts[k], strict=False))
    n, v = sum(words.values()), len(words)
    score = base = tokens = wrong = asked = 0
    read = spark.read.parquet(f"{sf}/documents.parquet").where("crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 7 <> 2")
    model = ngram_lm.train(read, new_dir(spark, "tight"))

    def levels(kind, keys):
        """What the filter says of each key, its false positives included: one probe a key."""
        out = np.zeros(len(keys), np.int64)
        for held, value in model.slices:
            if held == kind:
                ngram_lm._look(value.value, kind, model.bits, keys, out)
        return out.tolist()

    for r in q.op3_lm_scores(spark, sf).collect():
        t = texts[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2, len(t), sum(words[x] > 0 for x in t), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((words[x] + 1) / (n + v + 1)) for x in t), rel=1e-9)
        if r["held_out"]:
            score, base, tokens = score + r["score"], base + r["base_score"], tokens + len(t)
        (scanned,) = scan([(docs[r["doc_id"]] or "").encode()], SPACED)
        token, before, _ = ngram_lm.events(scanned)
        own, both = levels(WORDS, ngram_lm._cut(token)), levels(PAIRS, ngram_lm._cut(ngram_lm.pair(before, token)))
        exact = 0.0
        for i, (a, x) in enumerate(zip([0, *t], t, strict=False)):
            true = [level_of(words[x], WORDS) if words[x] else 0, level_of(pairs[a, x], PAIRS) if pairs[a, x] else 0]
            assert own[i] >= true[0] and both[i] >= true[1]
            wrong, asked = wrong + (own[i] > true[0]) + (both[i] > true[1]), asked + 2
            level = own[i - 1]  # of the token before; before the first stands the end
            context = STEPS[WORDS][level] - 1 if level else 0
            p = (read_as(own[i], WORDS) + 1) / (n + v + 1)
            exact += math.log10((min(read_as(both[i], PAIRS), context) + M * p) / (context + M + reserve(context, v)))
        assert r["score"] == pytest.approx(exact, rel=1e-9)
    assert score > base + 0.05 * tokens
    assert wrong < 0.005 * asked


def test_quality_counts(spark, sf, docs):
    labels = dict(duckdb.connect().execute(f"SELECT doc_id, quality FROM '{sf}/labels.parquet'").fetchall())
    right = judged = 0
    for r in q.op5_quality_rules(spark, sf).collect():
        x = docs[r["doc_id"]] or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", x)
        seen, dup = set(), 0
        for line in x.split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                dup += line in seen
                seen.add(line)
        runs = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        many, cover = Counter(runs), set()
        for i, k in enumerate(runs):
            if many[k] > 1:
                cover.update(range(i, i + 5))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", x)), dup, len(cover))
        assert r["base_failed"] == (len(w) < 10 or 100 * len(cover) > 20 * len(w))
        assert not (r["kept"] and r["base_failed"])
        if r["doc_id"] in labels and not r["base_failed"]:
            judged += 1
            right += r["kept"] == (labels[r["doc_id"]] == 1)
    assert right > 0.93 * judged


def test_license_base(spark, sf, docs):
    for r in q.op6_license_scan(spark, sf).collect():
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (docs[r["doc_id"]] or "").translate(LOWER))
        at = [(k, label) for phrase, label in PHRASES.items() for k in range(len(w)) if w[k : k + len(phrase.split())] == phrase.split()]
        places = sorted(k for k, _ in at)
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(w), len(at), places[0] if at else None, places[-1] if at else None)
        assert r["base_labels"] == ",".join(sorted({x for _, x in at}))
        labels, cover = brute_force_labels(docs[r["doc_id"]])
        assert r["labels"] == ",".join(sorted({x for _, x in at} | labels))
        assert r["score"] == (1.0 if at else pytest.approx(cover))


def test_token_counts(spark, sf, ids):
    import base64

    import public_tokenizers
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(q.BYTES, "rb"))}
    own = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    con = duckdb.connect()
    bad = {k for (k,) in con.execute(f"SELECT doc_id FROM '{sf}/labels.parquet' WHERE quality = 0").fetchall()}
    want = {}
    for k, source, lang, text in con.execute(f"SELECT doc_id, source, lang, text FROM '{sf}/documents.parquet'").fetchall():
        if k not in bad:
            key = (source, lang, "byte_bpe_50k" if source == "src0" else "word_bpe_49k")
            n, tokens = want.get(key, (0, 0))
            want[key] = n + 1, tokens + (len(own.encode_ordinary(text or "")) if source == "src0" else len(ids[k]))
    assert {(r["source"], r["lang"], r["tokenizer"]): (r["n_docs"], r["n_tokens"]) for r in q.op9_token_counts(spark, sf).collect()} == want


def test_html(spark, sf):
    import html as h

    pages = dict(duckdb.connect().execute(f"SELECT page_id, html FROM '{sf}/pages.parquet'").fetchall())
    for r in q.op10_html_text(spark, sf).collect():
        m = re.search(r"<article>(.*?)(</article>|$)", pages[r["page_id"]] or "", re.S)
        parts = [" ".join(h.unescape(re.sub(r"<[^>]*>?", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)>", m[1] if m else "")]
        assert r["text"] == "\n".join(x for x in parts if x)
        assert r["n_chars"] == len(r["text"])


def test_pipeline_stages_agree_with_brute_force(spark, sf, docs, ids):
    """Each stage on its own input: what it keeps, and that columns stay."""
    read = spark.read.parquet(f"{sf}/documents.parquet")
    good = corpus_pipeline.good(spark, read, sf).cache()
    verdict = {r["doc_id"]: r["kept"] for r in q.op5_quality_rules(spark, sf).collect()}
    assert sorted(r["doc_id"] for r in good.collect()) == sorted(k for k, kept in verdict.items() if kept)
    assert good.columns == read.columns
    one = corpus_pipeline.distinct(spark, good, sf).cache()
    left = {r["doc_id"] for r in good.collect()}
    sets = {k: _shingles(docs[k], 5) for k in left}
    assert sorted(r["doc_id"] for r in one.collect()) == sorted(k for k, c in _components(sets, 80).items() if k == c)
    clean = corpus_pipeline.untested(spark, one, sf).cache()
    bad = {r["doc_id"] for r in q.op8_decontamination(spark, sf).where("contaminated").collect()}
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted({r["doc_id"] for r in one.collect()} - bad)
    assert clean.columns == read.columns
    rows = sorted((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in corpus_pipeline.packed(spark, clean, sf).collect())
    covered = Counter()
    for k, start, length, crc in rows:
        part = np.append(ids[k], np.uint32(2)).astype("<u4")[start : start + length]
        assert (len(part), zlib.crc32(part.tobytes())) == (length, crc)
        covered[k] += length
    assert covered == {r["doc_id"]: len(ids[r["doc_id"]]) + 1 for r in clean.collect()}
    whole = corpus_pipeline.run(spark, sf)
    assert Counter({r["doc_id"]: r["n"] for r in whole.groupBy("doc_id").agg({"length": "sum"}).toDF("doc_id", "n").collect()}) == covered


def _shingles(text, k):
    w = (text or "").encode().lower().split()
    return frozenset([tuple(w)] if 0 < len(w) < k else [tuple(w[i : i + k]) for i in range(len(w) - k + 1)])


def _components(sets, percent):
    parent = {k: k for k in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return {k: top(k) for k in keys}


def test_decontamination_finds_items_without_an_id(spark, tmp_path, monkeypatch):
    """As the SQL does: their windows hit words, and count as one item that has no id."""
    bench = [(1, "one two three"), (None, "four five six"), (None, "one two three"), (None, "seven eight")]
    rows = [(1, "x One two three four five six y"), (2, "seven EIGHT"), (3, "nothing of it"), (4, "one two three seven eight")]
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    read = spark.createDataFrame(rows, "doc_id long, text string")
    read.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    for name in ("benchmark", "documents"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    for part in (corpus_pipeline.decontaminate.PART, 1):
        monkeypatch.setattr(corpus_pipeline.decontaminate, "PART", part)
        assert_same(q.op8_decontamination(spark, str(tmp_path)), con, q.SQL["op8_decontamination"])
        assert [r["doc_id"] for r in corpus_pipeline.untested(spark, read, str(tmp_path)).collect()] == [3]
