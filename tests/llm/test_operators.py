"""Operators on small made tables: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from visloom.llm import chat, decontaminate, htmltext, licenses, neardup, ngram_lm, packing, quality, tokenfile
from visloom.llm.bpe import encoder
from visloom.llm.queries import TOKENIZER
from visloom.llm.rollup import Rollup, count_tokens, deletes, inserts, revisions
from visloom.llm.shared import new_dir
from visloom.llm.wordscan import PLAIN, SPACED, scan

DOCS = "doc_id long, text string, row string, kept int, spans string"
LONG = "word " * 60_000
#: Null, empty and blank texts, a very long one, repeated rows, a null id, odd characters; other columns clash.
ODD = [(1, None), (2, ""), (3, " \t\n"), (4, LONG), (5, "Tie tie tie."), (5, "Tie tie tie."), (None, "no id at all here"), (6, "naïve ÉCOLE ﬁ é \x1c x 😀 don't <|endoftext|> 3.5, ok."), (7, "a")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "r", 1, "s") for i, t in ODD], DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_words():
    (w,) = scan(["A b  c".encode(), b"", "é1-x".encode()], PLAIN)
    assert [w.word(i) for i in range(len(w.starts))] == [b"a", b"b", b"c", "é1".encode(), b"x"]
    assert w.offsets.tolist() == [0, 3, 3, 5]
    (s,) = scan([b"ab, ab. ab 4."], SPACED, marks=b".,")
    assert s.hashes[0] == s.hashes[1] == s.hashes[2]
    assert [s.word(i) for i in range(4)] == [b"ab", b"ab", b"ab", b"4."]


def test_words_of_a_text_of_many_blocks_in_bounded_memory():
    import tracemalloc

    text = b"ab cde " * 7_000_000 + b"x" * 200_000 + b" ab"
    tracemalloc.start()
    (w,) = scan([text], SPACED)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(w.hashes) == 14_000_002 and len(np.unique(w.hashes)) == 3 and w.hashes[0] == w.hashes[-1]
    (one,) = scan([b"x" * 200_000], SPACED)
    assert one.hashes[0] == w.hashes[-2]
    assert peak < 16 * len(text)


def test_encoder_equals_the_whole_text():
    from tokenizers import Tokenizer

    texts = [t or "" for _, t in ODD] + ["Σίσυφος, ΣΑΣ. l'été... (a.b),, x,.", "ſtraße Ǆ İstanbul, 漢字. ½."]
    whole = Tokenizer.from_file(TOKENIZER).encode_batch(texts, add_special_tokens=False)
    for mine, ref in zip(encoder(TOKENIZER).encode([t.encode() for t in texts]), whole, strict=True):
        assert mine.tolist() == ref.ids


def test_encoder_refuses_a_tokenizer_of_another_kind():
    import public_tokenizers

    with pytest.raises(ValueError, match="parts of a text"):
        encoder(public_tokenizers.path("byte_bpe_50k.json"))


def test_chat(spark):
    rows = [(1, 0, "user", "hi"), (2, 0, "user", "hi"), (2, 1, "assistant", "yo"), (3, 0, "user", "hi"), (3, 1, "assistant", "yo"), (4, 0, "user", "hi"), (4, 1, "assistant", "no"), (5, 0, None, None), (5, 0, None, None), (6, 0, "user", ""), (None, 0, "user", "lost"), (7, 0, "user", None)]
    df = spark.createDataFrame([(*r, 9) for r in rows], "conv_id long, turn long, role string, text string, place int")
    got = {r["conv_id"]: r for r in chat.format_chats(df).collect()}
    assert sorted(got) == [2, 4, 5, 6, 7]
    assert got[2]["chat"] == "<|turn|>user\nhi<|end|>\n<|turn|>assistant\nyo<|end|>\n"
    assert got[5]["n_turns"] == 2
    assert chat.format_chats(df.limit(0)).count() == 0


def test_dac_gives_every_id():
    rng = np.random.default_rng(3)
    for ids in (np.zeros(0, np.uint32), np.zeros(9, np.uint32), rng.zipf(1.3, 5000).clip(0, 49407).astype(np.uint32), rng.integers(0, 2**20, 3000).astype(np.uint32)):
        dac = tokenfile.Dac.encode(ids)
        again = tokenfile.Dac(*dac.parts())
        assert np.array_equal(again.run(0, len(ids)), ids)
        if len(ids):
            at = rng.integers(0, len(ids), 500)
            assert np.array_equal(again.access(at), ids[at])
            for a, b in ((len(ids) // 3, len(ids) // 2), (len(ids) - 1, len(ids)), (5, 5)):
                assert np.array_equal(again.run(a, b), ids[a:b])


def test_token_file_of_odd_rows(spark, odd, none):
    rows = tokenfile.read_documents(tokenfile.write_tokens(odd, TOKENIZER, 1)).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == [None, 1, 2, 3, 4, 5, 5, 6, 7]
    assert [r["start"] for r in rows] == np.cumsum([0] + [r["n_tokens"] for r in rows])[:-1].tolist()
    assert rows[1]["ids"] == rows[2]["ids"] == [1]
    blocks = tokenfile.write_tokens(odd, TOKENIZER, 1)
    every = [t for r in rows for t in r["ids"]]
    asked = spark.createDataFrame([(0,), (5,), (5,), (len(every) - 1,), (len(every),)], "position long")
    got = tokenfile.tokens_at(spark, blocks, asked).collect()
    assert sorted((r["position"], r["token"]) for r in got) == sorted([(0, every[0]), (5, every[5]), (5, every[5]), (len(every) - 1, every[-1])])
    assert tokenfile.read_documents(tokenfile.write_tokens(none, TOKENIZER, 1)).count() == 0


def test_lm_of_odd_rows(odd, none):
    rows = {(r["doc_id"], r["n_tokens"]): r for r in ngram_lm.score_documents(odd).collect()}
    assert rows[1, 1]["n_tokens"] == rows[2, 1]["n_tokens"] == 1
    assert rows[4, 60_001]["score"] > rows[4, 60_001]["base_score"] - 60_001
    assert ngram_lm.score_documents(none).count() == 0


def test_lm_by_slices_and_by_shards_scores_alike(spark, sf, odd, monkeypatch):
    key = lambda d: sorted((r["doc_id"] or 0, r["n_tokens"], r["n_known"], r["base_score"], r["score"]) for r in ngram_lm.score_documents(d).collect())
    for docs in (odd, spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"), odd.limit(0)):
        whole = key(docs)
        with monkeypatch.context() as m:
            m.setattr(ngram_lm, "SLICE", 64)
            assert key(docs) == whole
        with monkeypatch.context() as m:
            m.setattr(ngram_lm, "HELD", -1)
            assert key(docs) == whole


def _ask(field, keys):
    return ngram_lm.find_level(field, np.zeros(len(keys), np.uint64), np.full(len(keys), len(field) * 8, np.uint64), keys)


@pytest.mark.parametrize("kind", [ngram_lm.PAIRS, ngram_lm.WORDS])
def test_filter_has_no_false_negative(kind):
    keys = np.arange(1, 20_000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    counts = np.arange(1, 20_000) % 70 + 1
    field = ngram_lm.build_filter(keys, counts, kind)
    levels, right = _ask(field, keys), ngram_lm.level_of(counts, kind)
    assert (levels >= right).all()
    assert (levels > right).mean() < 0.01
    assert (_ask(field, keys + np.uint64(1)) > 0).mean() < 0.001
    assert (ngram_lm.read_as(right, kind) <= counts).all() and (counts < ngram_lm.read_as(right + 1, kind)).all()


def test_probabilities_after_any_context_add_up_to_one_at_most(sf):
    """Over the whole vocabulary and the unknown word, with all false positives; a context is any word, or a text's start."""
    import duckdb

    texts = [(t or "").encode() for (t,) in duckdb.connect().execute(f"SELECT text FROM '{sf}/documents.parquet' ORDER BY doc_id LIMIT 50").fetchall()]
    token, before = (np.concatenate(x) for x in zip(*(ngram_lm.events(w)[:2] for w in scan(texts, SPACED)), strict=True))
    words, counts = ngram_lm._tally(ngram_lm._cut(token))
    pairs, many = ngram_lm._tally(ngram_lm._cut(ngram_lm.pair(before, token)))
    n, v = len(token), len(words)
    word = _ask(ngram_lm.build_filter(words, counts, ngram_lm.WORDS), words)
    field = ngram_lm.build_filter(pairs, many, ngram_lm.PAIRS)
    whole = np.unique(token)
    assert (ngram_lm._cut(whole) == words).all()
    end = np.searchsorted(words, ngram_lm._cut(np.array([ngram_lm._END])))[0]
    contexts, levels = np.append(whole, ngram_lm._START), np.append(word, word[end])
    for i in range(0, len(contexts), 32):
        some = contexts[i : i + 32]
        level = _ask(field, ngram_lm._cut(ngram_lm.pair(np.repeat(some, v), np.tile(whole, len(some))))).reshape(-1, v)
        for found, c in zip(level, levels[i : i + 32], strict=True):
            assert ngram_lm.conditional(np.append(found, 0), np.full(v + 1, c), np.append(word, 0), n, v).sum() <= 1


def test_neardup_of_odd_rows(spark, odd, none):
    rows = {(r["doc_id"], r["n_shingles"]): r for r in neardup.near_duplicates(odd, 4, 80).collect()}
    assert rows[1, 0]["kept"] and rows[2, 0]["kept"] and rows[3, 0]["kept"]
    assert rows[4, 1]["component_id"] == 4
    assert rows[None, 2]["kept"] and rows[None, 2]["component_id"] is None
    assert neardup.near_duplicates(none).count() == 0
    out = neardup.one_of_each(odd, 5, 80)
    assert out.columns == odd.columns
    assert sorted(r["doc_id"] or 0 for r in out.collect()) == [0, 1, 2, 3, 4, 5, 6, 7]
    clash = odd.withColumnsRenamed({"row": "slot", "kept": "n", "spans": "node"})
    assert neardup.one_of_each(clash, 5, 80).columns == clash.columns
    assert neardup.one_of_each(none).count() == 0


def test_neardup_links_a_star_whose_hub_comes_last(spark):
    """Copies that only resemble a hub, not one another, and a group of many rows."""
    rng = np.random.default_rng(5)
    hub = [f"h{i}" for i in range(100)]
    rows = []
    for k in range(40):
        w = list(hub)
        for i in rng.choice(24, 3, replace=False) * 4:
            w[i] = f"x{k}-{i}"
        rows.append((k, " ".join(w)))
    rows += [(1000, " ".join(hub)), *((2000 + i, " ".join(hub)) for i in range(30))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {i: {tuple(t.split()[j : j + 4]) for j in range(97)} for i, t in rows}
    parent = {i: i for i in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(df, 4, 80).collect()}
    assert got == {i: top(i) for i in sets}


def test_neardup_of_ids_with_several_texts(spark):
    """A document is linked by each of its texts."""
    words = lambda tag: " ".join(f"{tag}{i}" for i in range(40))
    df = spark.createDataFrame([(1, words("a")), (2, words("a")), (2, words("b")), (3, words("b")), (4, words("c"))], "doc_id long, text string")
    assert {(r["doc_id"], r["component_id"]) for r in neardup.near_duplicates(df).collect()} == {(1, 1), (2, 1), (3, 1), (4, 4)}
    assert sorted(r["doc_id"] for r in neardup.one_of_each(df).collect()) == [1, 4]


@pytest.mark.parametrize("n", [250, 1000])
def test_neardup_of_a_common_block_compares_little(spark, n, monkeypatch):
    """Texts that share a block (similarity 0.3) and no link: what tiles hold grows with the texts, not with their pairs."""
    rng = np.random.default_rng(n)
    block = " ".join(f"b{i}" for i in range(46))
    df = spark.createDataFrame([(i, block + " " + " ".join(map(str, rng.integers(0, 10**9, 54)))) for i in range(n)], "doc_id long, text string")
    held = []
    run = neardup.store
    monkeypatch.setattr(neardup, "store", lambda d, folder, name, *x: held.append((name, out := run(d, folder, name, *x))) or out)
    rows = neardup.near_duplicates(df).collect()
    assert all(r["kept"] for r in rows) and len(rows) == n
    tables = dict(held)
    assert tables["tiles"].count() <= 3 * n
    assert tables["forest"].count() == tables["blocks"].count() == 0


def test_neardup_in_small_tiles_and_blocks(spark, monkeypatch):
    """Links between texts of different blocks are found, whatever the blocks' size."""
    for name, value in (("TILE", 8), ("TASK", 20), ("MASS", 300), ("LOAD", 900)):
        monkeypatch.setattr(neardup, name, value)
    test_neardup_links_a_star_whose_hub_comes_last(spark)


def test_quality_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(4, 0), (6, 1), (5, 1), (None, 1), (7, None)], "doc_id long, quality int")
    trees = quality.train(odd, labels)
    rows = quality.judge(odd, trees).collect()
    assert len(rows) == len(ODD)
    assert all(not r["kept"] for r in rows if r["n_words"] < 10)
    assert quality.good_documents(odd, trees).columns == odd.columns
    assert quality.judge(none, quality.train(none, labels)).count() == 0


def test_quality_of_documents_it_was_not_fitted_on(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    trees = quality.train(docs, labels.where("doc_id % 2 = 0"))
    other = quality.judge(docs, trees).join(labels.where("doc_id % 2 = 1").select("doc_id", F.col("quality").alias("label")), "doc_id").where("NOT base_failed").collect()
    assert len(other) > 20
    assert np.mean([r["kept"] == (r["label"] == 1) for r in other]) > 0.85


def test_quality_of_repeated_ids_is_bounded(spark):
    docs = spark.range(3000).selectExpr("id % 2 AS doc_id", "concat(repeat('some words ', 20), id) AS text")
    labels = spark.createDataFrame([(0, 0), (1, 1)], "doc_id long, quality int")
    seen = []
    fit = quality.fit
    quality.fit = lambda x, *a: seen.append(len(x)) or fit(x, *a)
    try:
        quality.train(docs, labels)
    finally:
        quality.fit = fit
    assert seen == [2]


def test_trees_keep_their_constraints():
    rng = np.random.default_rng(0)
    x = rng.uniform(0, 1, (4000, 3))
    y = (x[:, 0] + 0.1 * np.sin(20 * x[:, 0]) + 0.1 * rng.normal(size=4000) > 0.5).astype(float)
    trees = quality.fit(x, y, [1, 0, 0], rounds=30)
    grid = np.tile(x[:50], (200, 1, 1)).copy()
    grid[:, :, 0] = np.linspace(0, 1, 200)[:, None]
    scores = trees.score(grid.reshape(-1, 3)).reshape(200, 50)
    assert (np.diff(scores, axis=0) >= -1e-9).all()
    assert ((trees.score(x) > 0) == (y > 0)).mean() > 0.85


def test_licenses_of_odd_rows(spark, odd, none):
    rows = licenses.scan_licenses(odd).collect()
    assert len(rows) == len(ODD) and all(r["labels"] == "" for r in rows)
    text = "Intro. " + licenses.TEMPLATES["mit"].split("\n\n")[1].replace("any person", "any one natural person") + " Also the Apache License; under the GNU General Public License."
    (r,) = licenses.scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert (r["base_labels"], r["labels"], r["n_base"]) == ("apache,gpl", "apache,gpl,mit", 2)
    assert licenses.scan_licenses(none).count() == 0


def _parts():
    from visloom.llm.licenses import SHORTEST, TEMPLATES

    for label, body in TEMPLATES.items():
        for part in body.split("\n\n"):
            w = _plain(part)
            if len(w) >= SHORTEST:
                yield label, w


def _plain(text):
    import re

    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


def brute_force_labels(text):
    """Labels and best cover of a text, match by match."""
    from visloom.llm.licenses import COVER, DRIFT, K

    w, found, best = _plain(text), set(), 0.0
    at = {}
    for p in range(len(w) - K + 1):
        at.setdefault(tuple(w[p : p + K]), []).append(p)
    for label, body in _parts():
        runs = len(body) - K + 1
        matches = sorted((p - t, p, t) for t in range(runs) for p in at.get(tuple(body[t : t + K]), []))
        spans, last = [], None
        for d, p, t in matches:
            if last is None or d - last > DRIFT:
                spans.append([])
            spans[-1].append((p, t))
            last = d
        for span in spans:
            n = most = 0
            lp = lt = -1
            for p, t in sorted(span):
                if n and p == lp:
                    continue
                n = n + 1 if n and t > lt and abs((p - lp) - (t - lt)) <= DRIFT else 1
                lp, lt = p, t
                most = max(most, n)
            if most / runs >= COVER:
                found.add(label)
                best = max(best, most / runs)
    return found, best


def test_licenses_are_found_by_order_and_gaps(spark):
    """Whole texts, edited ones, shuffled words of one, its sentences far apart: as a count match by match says."""
    rng = np.random.default_rng(2)
    texts = []
    for label, body in licenses.TEMPLATES.items():
        w = body.split()
        texts += [body, " ".join(x for x in w if rng.random() > 0.08), "x " * 700 + body + " y" * 900 + body]
        texts += [" ".join(rng.permutation(w)), " ".join(y for i in range(0, len(w), 3) for y in (*w[i : i + 3], "and", "some", "other", "words", "here", "too")), " ".join(w[: len(w) // 2]), label]
    rows = {r["doc_id"]: r for r in licenses.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, text in enumerate(texts):
        labels, cover = brute_force_labels(text)
        base = set(rows[i]["base_labels"].split(",")) - {""}
        assert set(rows[i]["labels"].split(",")) - {""} == labels | base
        assert rows[i]["score"] == (1.0 if base else pytest.approx(cover))
    for i, label in enumerate(licenses.TEMPLATES):
        assert label in rows[7 * i]["labels"].split(",") and label in rows[7 * i + 2]["labels"].split(",")
        assert rows[7 * i + 3]["spans"] is None
    assert {s["label"] for s in rows[2]["spans"]} == {"mit"} and len(rows[2]["spans"]) >= 8
    (r,) = licenses.scan_licenses(spark.createDataFrame([(1, "all rights reserved by me")], "doc_id long, text string")).collect()
    assert r["labels"] == "" and r["score"] == 0.0


def test_packing_of_odd_rows(spark, odd, none):
    packed = packing.pack(odd, TOKENIZER, 2)
    assert packed.placements.agg(F.sum("length")).first()[0] == sum(len(x) + 1 for x in encoder(TOKENIZER).encode([(t or "").encode() for _, t in ODD]))
    for r in packed.sequences().collect():
        n = len(r["ids"]) // 4
        assert n == 4096 or n & (n - 1) == 0
    assert packing.pack(none, TOKENIZER, 2).placements.count() == 0


def test_plan_places_all_and_wastes_little():
    rng = np.random.default_rng(1)
    sizes, counts = np.unique(rng.integers(1, 257, 20_000), return_counts=True)
    plan = packing.plan(dict(zip(sizes.tolist(), counts.tolist(), strict=True)))
    for c, n in zip(sizes.tolist(), counts.tolist(), strict=True):
        assert sum(held.get(c, 0) * times for held, times in plan) >= n
    assert all(sum(c * a for c, a in held.items()) <= 256 for held, _ in plan)
    assert sum(times for _, times in plan) <= 1.02 * (sizes * counts).sum() / 256 + 260


BENCH = [(1, "one two three four five six seven eight nine ten eleven"), (2, "short item"), (3, ""), (4, None), (None, "never found words here at all in any of the texts")]


def bench(spark):
    return spark.createDataFrame(BENCH, "item_id long, text string")


def test_decontamination(spark, odd, none):
    rows = [(1, "x One two-three four five, six seven eight nine ten ELEVEN y"), (2, "a short item b"), (3, "one two three"), (4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in decontaminate.benchmark_hits(df, bench(spark)).collect()}
    assert [(s["a"], s["b"]) for s in got[1]["spans"]] == [(1, 12)] and got[1]["items"] == ["1"]
    assert [(s["a"], s["b"]) for s in got[2]["spans"]] == [(1, 3)] and not got[3]["spans"] and got[4]["n_words"] == 0
    assert sorted(r["doc_id"] for r in decontaminate.clean_documents(df, bench(spark)).collect()) == [3, 4]
    cut = {r["doc_id"]: r["text"] for r in decontaminate.without_spans(df, bench(spark)).collect()}
    assert cut == {1: "x   y", 2: "a   b", 3: "one two three", 4: None}
    assert decontaminate.benchmark_hits(odd, bench(spark)).count() == len(ODD)
    assert decontaminate.benchmark_hits(none, bench(spark)).count() == 0
    assert decontaminate.clean_documents(odd, bench(spark).limit(0)).count() == len(ODD)
    assert decontaminate.benchmark_hits(odd, bench(spark).limit(0)).where("size(spans) = 0").count() == len(ODD)
    assert [(r["doc_id"], r["text"], r["spans"]) for r in decontaminate.without_spans(odd, bench(spark)).collect()] == [(i, t, "s") for i, t in ODD]
    named = spark.createDataFrame([("x1", "Short item"), ("x0", "an item")], "item_id string, text string")
    assert [r["items"] for r in decontaminate.benchmark_hits(df, named).orderBy("doc_id").collect()] == [[], ["x1"], [], []]


def test_decontamination_in_parts_gives_the_same(spark, monkeypatch):
    df = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven short item"), (1, "short item short item"), (2, "clean")], "doc_id long, text string")
    key = lambda d: sorted((r["doc_id"], r["n_words"], [(s["a"], s["b"]) for s in r["spans"]], r["items"]) for r in d.collect())
    whole = key(decontaminate.benchmark_hits(df, bench(spark)))
    monkeypatch.setattr(decontaminate, "PART", 1)
    assert key(decontaminate.benchmark_hits(df, bench(spark))) == whole
    assert [r["doc_id"] for r in decontaminate.clean_documents(df, bench(spark)).collect()] == [2]


def test_rollup(spark):
    new = lambda rows: spark.createDataFrame(rows, "source string, lang string, tokenizer string, n_tokens long")
    state = lambda r: sorted((x["source"] or "", x["tokenizer"], x["n_docs"], x["n_tokens"]) for x in r.totals().collect())
    r = Rollup(spark, new_dir(spark, "rollup"))
    assert state(r) == [] and r.compact() is None
    first = new([("a", "en", "v1", 10), ("a", "en", "v1", 5), (None, None, "v1", None)])
    assert r.commit("1", inserts(first)) and not r.commit("1", inserts(first))
    assert r.commit("2", deletes(new([("a", "en", "v1", 5)])))
    moved = spark.createDataFrame([("a", "en", "v1", 10, "v2", 7)], "source string, lang string, old_tokenizer string, old_n_tokens long, new_tokenizer string, new_n_tokens long")
    assert r.commit("3", revisions(moved))
    assert r.commit("4", inserts(first.limit(0)))
    want = [("", "v1", 1, 0), ("a", "v2", 1, 7)]
    assert state(r) == want
    # An attempt that broke off: its files are there, its end is not.
    broken = Rollup(spark, r.folder)
    broken._write("5", inserts(first))
    fs, path = r._in(f"{r.folder}/batch=5/_SUCCESS")
    fs.delete(path, False)
    assert state(r) == want and not r.committed("5")
    assert r.commit("5", inserts(new([("b", "de", "v1", 3)])))
    want = [*want, ("b", "v1", 1, 3)]
    assert state(r) == want
    # A compaction that broke off leaves all as it was; one that ends changes no total, and folded batches stay committed.
    spark.createDataFrame([("1",)], "id string").write.parquet(f"{r.folder}/folded=cbroken")
    assert state(r) == want
    one = r.compact()
    assert r.batches() == [one] and state(r) == want
    assert not r.commit("1", inserts(first)) and r.commit("6", inserts(new([("b", "de", "v1", 4)])))
    again = r.compact()
    assert r.batches() == [again] and not r.commit("3", revisions(moved)) and not r.commit("6", inserts(first))
    assert state(r) == [*want[:2], ("b", "v1", 2, 7)]


def test_token_counts(spark, odd, none):
    import base64

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer
    from visloom.llm.queries import BYTES

    rows = count_tokens(odd, TOKENIZER).collect()
    whole = Tokenizer.from_file(TOKENIZER).encode_batch([t or "" for _, t in ODD], add_special_tokens=False)
    assert [r["n_tokens"] for r in rows] == [len(x.ids) for x in whole]
    assert rows[0]["row"] == "r" and rows[0]["spans"] == "s"
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(BYTES, "rb"))}
    own = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert [r["n"] for r in count_tokens(odd, BYTES, "n").collect()] == [len(own.encode_ordinary(t or "")) for _, t in ODD]
    assert count_tokens(none, TOKENIZER).count() == 0


PAGE = """<html><head><title>t</title><script>if (a < b) "<p>no</p>"</script></head><body><header>Top</header><nav><a href="/">Home</a></nav>
<div class="post"><h1>Title &amp; more</h1><p>First  para<br>goes <b>o</b>n.<p>Second &lt;one&gt; {n}.<div class="ad">Buy</div><form>Name</form></div>
<aside>Side</aside><section class="comments"><p>Me too</p></section><footer>&copy; us</footer></body></html>"""


def test_html_without_article(spark):
    rows = [(i, f"http://Host.example/{i}", PAGE.replace("{n}", f"number {i} of the pages with words enough")) for i in range(4)]
    rows += [(9, "http://host.example/9", None), (10, None, ""), (11, None, "just text &amp; <b>bold"), (12, "http://host.example/x", "<article><p>Cut <b>here&am")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, host string")
    got = {r["page_id"]: r["text"] for r in htmltext.extract(df).collect()}
    assert got[2] == "Title & more\nFirst para goes on.\nSecond <one> number 2 of the pages with words enough."
    assert (got[9], got[10], got[11], got[12]) == ("", "", "just text & bold", "Cut here&am")
    assert {r["host"] for r in htmltext.infer_wrappers(htmltext.read_pages(df)).collect()} == {"host.example"}
    assert htmltext.extract(df.limit(0)).count() == 0


def test_wrapper_has_optional_and_repeated_parts(spark):
    pages = ["<body><ul><li>x</li><li>y</li></ul><p>one</p><i>Same</i></body>", "<body><h2>new</h2><ul><li>z</li></ul><p>two</p></body>", "<body><h2>old</h2><ul><li>z</li></ul><p>two</p></body>"]
    df = spark.createDataFrame([(i, "http://h.example/", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    (w,) = htmltext.infer_wrappers(htmltext.read_pages(df)).collect()
    assert w["wrapper"] == "(body(#h2(#)?ul(li(#)+)p(#)))"
    (again,) = htmltext.infer_wrappers(htmltext.read_pages(df.orderBy(F.desc("page_id")).repartition(3))).collect()
    assert again == w


def test_html_constants_of_the_template_are_none(spark):
    """No article and no telling class: only what pages have in common tells furniture from text."""
    page = "<body><div><b>The Daily Shop</b></div><section><ul><li>Home</li><li>Wares</li></ul></section><div><h1>Head {i}</h1><p>Story {i} in some words</p><p>more</p></div><div><table><tr><td>Imprint of the shop</td></tr></table></div></body>"
    got = texts(spark, [page.replace("{i}", str(i)) for i in range(4)])
    assert got == [[f"Head {i}", f"Story {i} in some words", "more"] for i in range(4)]
    alone = htmltext.main_text(*htmltext.read(page), None, set(), set())
    assert "The Daily Shop" in alone and "Imprint of the shop" in alone
    article = "<body><article><h1>Same</h1><div class='tell'>Tell your friends</div><p>Story {i} in some words, so that it is long enough</p></article></body>"
    same = "<body><article><h1>A long heading of page {i} that tells most of it</h1><p>Same text.</p></article></body>"
    assert texts(spark, [same.replace("{i}", str(i)) for i in range(3)]) == [[f"A long heading of page {i} that tells most of it", "Same text."] for i in range(3)]
    assert texts(spark, [article.replace("{i}", str(i)) for i in range(3)]) == [["Same", f"Story {i} in some words, so that it is long enough"] for i in range(3)]


def test_html_copies_of_one_page_stay_whole(spark):
    page = "<body><p>{i}</p><article><h1>Title</h1><p>The whole story in words, told again and again</p></article></body>"
    assert texts(spark, [page.replace("{i}", str(i)) for i in range(5)]) == [[str(i), "Title", "The whole story in words, told again and again"] for i in range(5)]


def test_html_marks_do_not_hold_where_nothing_else_is(spark):
    page = "<body><div class='sidebar'><p>Text {i} of the page</p></div></body>"
    assert texts(spark, [page.replace("{i}", str(i)) for i in range(3)]) == [[f"Text {i} of the page"] for i in range(3)]
    assert texts(spark, [page]) == [["Text {i} of the page"]]


def test_html_of_odd_shapes(spark):
    deep = "<div>" * 3000 + "<p>Deep {i}</p>" + "</div>" * 3000
    long = "<p>" + "words of a long text {i} " * 20_000 + "</p>"
    got = texts(spark, [f"<body>{x}</body>".replace("{i}", str(i)) for x in (deep, long) for i in range(2)])
    assert got[:2] == [["Deep 0"], ["Deep 1"]]
    assert [len(x[0]) for x in got[2:]] == [23 * 20_000 - 1] * 2


def texts(spark, pages):
    df = spark.createDataFrame([(i, "http://host.example/", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    return [r["text"].split("\n") for r in htmltext.extract(df).orderBy("page_id").collect()]


def test_html_region_holds_title_and_lead(spark):
    """No article: the region is around all slots, however small their share; also if texts differ only at their ends."""
    same = "the same words on every page " * 20
    page = "<body><div class='top'>Shop</div><div class='page'><h1>Title {i}</h1><div class='lead'>Lead {i} of the page</div><div class='body'>" + same + "{i}</div></div><nav>Menu {i}</nav></body>"
    got = texts(spark, [page.replace("{i}", str(i)) for i in range(3)])
    assert got == [[f"Title {i}", f"Lead {i} of the page", f"{same}{i}"] for i in range(3)]


def test_html_repeated_and_single_pages_are_whole(spark):
    page = "<body><div class='head'><h1>Title</h1></div><div class='body'><p>One</p><p>Two</p></div></body>"
    assert texts(spark, [page]) == [["Title", "One", "Two"]]
    assert texts(spark, [page, page]) == [["Title", "One", "Two"]] * 2


def test_html_takes_every_article_and_main(spark):
    both = "<body><p>Top {i}</p><article class='lead'><p>Lead</p></article><article class='story'><p>Story {i}</p></article></body>"
    got = texts(spark, [both.replace("{i}", str(i)) for i in range(3)] + ["<body><article class='sport'>Sport</article></body>"])
    assert got == [[f"Top {i}", "Lead", f"Story {i}"] for i in range(3)] + [["Sport"]]
    main = "<body><p>Top {i}</p><main><h1>Head {i}</h1><article class='a{i}x'>Story</article></main></body>"
    assert texts(spark, [main.replace("{i}", str(i)) for i in range(3)]) == [[f"Head {i}", "Story"] for i in range(3)]
    cards = "<body><div class='story'><h1>Head {i}</h1>Long story {i}</div><section><article class='card'>Card</article></section></body>"
    assert texts(spark, [cards.replace("{i}", str(i)) for i in range(3)]) == [[f"Head {i}", f"Long story {i}", "Card"] for i in range(3)]


def test_html_marks_are_whole_words(spark):
    """Modifiers of a layout, headings and sections named like marks, and headers inside an article are main text."""
    text = "<h2 id='related-work'>Related</h2><p>One {i}</p><h2 id='search'>Search</h2><section id='notice-period'>Period</section>"
    shapes = [
        "<body class='no-sidebar'><article><header class='entry-header header'><h1>Head {i}</h1></header>" + text + "</article></body>",
        "<body class='sidebar'><main class='content with-sidebar widget'><h1>Head {i}</h1>" + text + "</main></body>",
        "<body><article class='has-comments related'><h1>Head {i}</h1>" + text + "</article></body>",
        "<body><div class='post no-ads'><header class='header'><h1>Head {i}</h1></header><div>" + text + "</div></div></body>",
    ]
    dropped = "<div class='comment-list'>no</div><div id='site_footer'>no</div><ul class='related-posts'><li>no</ul><div class='cookie-banner'>no</div><div class='ad-slot'>no</div>"
    for shape in shapes:
        for page in (shape, shape.replace("</h2><p>", "</h2>" + dropped + "<p>")):
            got = texts(spark, [page.replace("{i}", str(i)) for i in range(2)])
            assert got == [[f"Head {i}", "Related", f"One {i}", "Search", "Period"] for i in range(2)]
