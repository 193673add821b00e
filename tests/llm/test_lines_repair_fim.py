"""Shared lines, conversation repair and fill-in-the-middle: brute force, odd rows, hot lines, long texts."""

import hashlib
import heapq
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from visloom.llm import fim, linededup, packing, repair

BLANKS = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_plan_of_256_classes_ends_while_a_session_is_up(spark):
    """Threaded linear algebra in a driver stood still here."""
    spark.range(1).collect()
    rng = np.random.default_rng(0)
    histogram = {c: int(n) for c, n in zip(range(1, 257), rng.integers(20, 80, 256), strict=True)}
    began = time.time()
    plan = packing.plan(histogram)
    assert time.time() - began < 60
    held = Counter()
    for pattern, often in plan:
        assert sum(c * n for c, n in pattern.items()) <= 256
        held.update({c: n * often for c, n in pattern.items()})
    assert all(held[c] >= n for c, n in histogram.items())
    least = -(-sum(c * n for c, n in histogram.items()) // 256)
    assert sum(often for _, often in plan) <= 1.06 * least + 2


def test_inverse():
    a = np.random.default_rng(1).normal(size=(40, 40))
    assert np.allclose(packing.inverted(a) @ a, np.eye(40))


# Lines.


def brute_lines(rows, min_chars, min_docs):
    """(doc_id, text, n_lines, n_dropped) of each row."""
    key = lambda line: line.strip(BLANKS).translate(LOWER)
    count, last = Counter(), {}
    for i, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= min_chars:
                count[k] += 1
                if k not in last or last[k] is None or (i is not None and i > last[k]):
                    last[k] = i
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if count[key(x)] < min_docs or last[key(x)] == i]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def same_lines(spark, rows, min_chars=6, min_docs=3, **more):
    df = spark.createDataFrame([(i, t, "kept", 5) for i, t in rows], "doc_id long, text string, t1 string, n_lines int").repartition(3)
    got = linededup.drop_shared_lines(df, min_chars, min_docs, **more)
    assert got.columns == ["doc_id", "text", "t1", "n_lines", "n_dropped"] and {r["t1"] for r in got.collect()} <= {"kept"}
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted([(r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in got.collect()], key=key) == sorted(brute_lines(rows, min_chars, min_docs), key=key)


def test_lines_of_odd_rows(spark):
    shared, other = "A shared line É", "another LINE ſ"
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, f"{shared}\nown\n\t{shared.lower().replace('é', 'É')} \r\n"), (5, f"x\n{shared}"), (5, f"x\n{shared}"), (9, shared), (None, f"{shared}\nlost line"), (None, "lost line"), (None, "lost line\n"), (7, other), (6, f"{other}\x1c"), (8, other.lower()), (10, "short"), (11, "short"), (12, "short"), (-3, f"{other}\n{other}\nend")]
    same_lines(spark, rows)
    same_lines(spark, rows, min_docs=2, batches=1)
    same_lines(spark, [])
    same_lines(spark, [(None, "only nulls hold it"), (None, "only nulls hold it")], min_docs=2)


def test_lines_of_many_documents_and_a_hot_line(spark):
    r = random.Random(5)
    pool = [f"line number {i} of the pool" for i in range(60)]
    rows = [(i * 7 % 401, "\n".join(["the line that everyone has"] * (i % 3 > 0) + r.choices(pool, k=r.randrange(6)) + [f"own {i}"])) for i in range(400)]
    rows.append((1000, "\n".join(f"long line {i % 5000}" for i in range(20_000)) + "\nthe line that everyone has"))
    rows.append((1001, "\n".join(f"long line {i}" for i in range(5000))))
    rows.append((900, rows[-2][1]))
    same_lines(spark, rows)


def test_runs_are_levelled_and_batches_added_once(spark, tmp_path):
    runs = linededup.LineRuns(spark, f"file://{tmp_path}/runs", fanout=3)
    seen, want = set(), {}
    for batch in range(10):
        keys = {(k * k % 89, k % 5) for k in range(batch * 7, batch * 7 + 30)}
        df = spark.createDataFrame([(a, b, batch) for a, b in keys], "h1 long, h2 long, doc_id long")
        for _ in range(2):
            runs.add(batch, df)
        want |= dict.fromkeys(keys - seen, batch)
        seen |= keys
    assert {(r["h1"], r["h2"]): r["doc_id"] for r in runs.rows().collect()} == want and runs.rows().count() == len(want)
    assert runs.live() == [(0, 8), (9, 9)]
    again = linededup.LineRuns(spark, runs.folder, 3)
    (tmp_path / "runs" / "run-000009-000011").mkdir()  # a merge that broke off
    assert again.live() == runs.live() and again.rows().count() == len(want)
    for run in (tmp_path / "runs").glob("run-*/part-*.parquet"):
        own = [(r["h1"], r["h2"]) for r in spark.read.parquet(str(run)).collect()]
        assert own == sorted(own)


# Conversations.


def cheapest(rows):
    """(cost, audit, emitted roles) by Dijkstra over (row, state), least by cost and then as text."""
    steps = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, q, out = heapq.heappop(heap)
        if i == len(rows) and q in ("", "a"):
            return cost, audit, out
        if (i, q) in done:
            continue
        done.add((i, q))
        grown = "a" if q == "u" else "u"
        name = {"u": "user", "a": "assistant"}[grown]
        heapq.heappush(heap, (cost + 2, audit + "I", i, grown, (*out, f"{name}:")))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, q, out))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                if not role:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, q, (*out, f":{text}")))
                elif (q, role[0]) in steps:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, role[0], (*out, f"{role}:{text}")))
                heapq.heappush(heap, (cost + 2 + more, audit + "R", i + 1, grown, (*out, f"{name}:{text}")))
    raise AssertionError


def shape_of(rows):
    return "".join("-" if f in ("blank", "duplicate") else (lambda c: c.upper() if f else c)("e" if not role else role[0] if role[0] in "sua" else "x") for role, _, f in rows)


def test_search_is_cheapest_and_least():
    r = random.Random(8)
    for n in [0, 1, 1, 1, *[r.randrange(2, 9) for _ in range(400)], 30, 30]:
        rows = [(r.choice(["system", "user", "assistant", "user", "assistant", "tool", ""]), f"t{k}", r.choice([None, None, None, "truncated", "blank", "duplicate"])) for k in range(n)]
        audit, cost, emitted = repair.search(shape_of(rows))
        want = cheapest(rows)
        assert (cost, audit) == want[:2], shape_of(rows)
        assert len(emitted) == len(want[2])
        assert repair.estimates(shape_of(rows))[0] <= cost


def test_search_of_a_long_conversation():
    r = random.Random(3)
    shape = "".join(r.choice("uUaA-uaua") if r.random() < 0.1 else "ua"[i % 2] for i in range(3000))
    began = time.time()
    audit, cost, emitted = repair.search(shape)
    assert time.time() - began < 60 and len(audit) - audit.count("I") == len(shape)
    assert cost == sum({"D": 3, "I": 2, "K": 0, "R": 2}[e] for e in audit) + sum(shape[k].isupper() for k, e in enumerate(audit.replace("I", "")) if e != "D")


def brute_repair(conversations):
    """The whole contract of op12, row by row."""
    by = defaultdict(list)
    for c, turn, role, text in conversations:
        by[c].append((turn, role, text))
    import zlib

    out = {}
    for c, own in by.items():
        rows = []
        for turn, role, text in own:
            k = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            role, text = " " if role is None else role, " " if text is None else text
            text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
            rows += [(turn, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
        rows.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode()))
        seen, judged, counts = set(), [], Counter()
        for _, role, text in rows:
            bare = text.rstrip(BLANKS)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            judged.append((role, text, fault))
            counts[fault] += 1
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:], strict=False))
        cost, audit, lines = cheapest(judged)
        out[c] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def test_repair_of_odd_conversations(spark):
    r = random.Random(12)
    some = [(c, t, r.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None]), r.choice(["Hi.", "hi", "", " \t", "Ok!", "Ok! ", None, "a?b", "ſ.\x1c", "x" * 3000])) for c in range(60) for t in r.choices([0, 1, 2, 3, 5, 9, None], k=r.randrange(1, 9))]
    some += [(None, 1, "user", "lost."), (None, None, None, None), (70, 4, "user", "a."), (70, 4, "user", "a."), (2**40, -5, "assistant", "z!")]
    df = spark.createDataFrame([(*x, "row", 1) for x in some], "conv_id long, turn long, role string, text string, rows string, audit int").repartition(5)
    got = repair.counted(repair.repair(repair.damaged(df))).withColumn("h", F.sha2(F.array_join("repaired", "\n"), 256))
    fields = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "h")
    assert {x["conv_id"]: tuple(x[f] for f in fields) for x in got.collect()} == brute_repair(some)
    assert repair.counted(repair.repair(repair.damaged(df.limit(0)))).count() == 0
    plain = {x["conv_id"]: x for x in repair.counted(repair.repair(repair.whole(df))).collect()}
    assert plain[2**40]["audit"] == "IK" and plain[2**40]["repaired"] == ["user:", "assistant:z!"]


# Fill in the middle.

TOKENS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
ODD = ["", " ", "a", " a", "a ", "  ab \n c\t", "é 😀x\x1cy  ", "\x85a b", "<P> x y", "a <S", "one two three four", "word " * 70_000, "x" * 100_000 + " y", ("é" * 300 + " ") * 500, " " * 5000 + "a"]


@pytest.mark.parametrize("text", ODD)
def test_rank_index_gives_every_boundary(text):
    tokens = TOKENS.findall(text)
    want = np.append(0, np.cumsum([len(t) for t in tokens])) if tokens else np.zeros(1, int)
    found = fim.boundaries(text.encode())
    assert found.tolist() == want.tolist()
    for error in (120, 3, 0):
        index = fim.RankIndex.fit(found, error)
        ranks = np.arange(len(found))
        assert np.array_equal(index.find(ranks), want)
        assert np.abs(want - index.predict(ranks)).max() <= error + 1
        assert index.residual.dtype == np.int8


def test_rank_index_is_small_where_tokens_are_regular():
    index = fim.RankIndex.fit(fim.boundaries(b"word " * 70_000))
    assert len(index.rank) <= 2
    rng = np.random.default_rng(7)
    offsets = np.append(0, np.cumsum(rng.integers(2, 12, 300_000)))
    index = fim.RankIndex.fit(offsets)
    assert len(index.rank) < 2000 and np.array_equal(index.find(np.arange(len(offsets))), offsets)


def brute_fim(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    t = TOKENS.findall(text)
    a, b = sorted((h1 % (len(t) + 1), h2 % (len(t) + 1)))
    p, m, s = "".join(t[:a]), "".join(t[a:b]), "".join(t[b:])
    form = "plain" if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50 else "spm" if h4 % 100 < 80 else "psm"
    out = {"plain": text, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
    return len(t), form, *((None, None) if form == "plain" else (len(p), len(m))), out


def test_fill_in_middle_of_odd_rows(spark):
    rows = [(k, t) for k in range(60) for t in (ODD[k % len(ODD)], f"x < y <S z{k} <M>"[: 8 + k % 12])] + [(None, "no id here"), (None, None), (3, None), (-7, "a b c"), (-7, "a b c")]
    df = spark.createDataFrame([(i, t, 1, "f") for i, t in rows], "doc_id long, text string, n int, form string").repartition(4)
    got = fim.fill_in_middle(df).withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    key = lambda x: (str(x[0]), x[-1], x)
    found = [(r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in got]
    assert sorted(found, key=str) == sorted([(i, *brute_fim(i, t)) for i, t in rows], key=str)
    assert Counter(r["back"] for r in got) == Counter(t or "" for _, t in rows)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    assert fim.fill_in_middle(df.limit(0)).count() == 0


def test_stored_index_answers_by_expressions(spark):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(99, None)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, rank int")
    index = fim.rank_index(df)
    asked = index.withColumn("r", F.explode(F.array(F.lit(0), F.lit(1), F.col("n") - 1, F.floor(F.col("n") / 2), F.col("n"), F.col("n") + 1))).select("doc_id", "r", fim.offset_at(F.col("r")).alias("at"))
    want = {k: fim.boundaries((t or "").encode()) for k, t in rows}
    for x in asked.collect():
        own = want[x["doc_id"]]
        assert x["at"] == (int(own[x["r"]]) if 0 <= x["r"] < len(own) else None)
