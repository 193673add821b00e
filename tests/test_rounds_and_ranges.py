"""Peaks by rounds, ranges by dyadic cells, lags by transform, clips, splits and weights: against brute force."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from visloom.operators import cubes, flagging, imaging, integrate, vistable


def test_suppression_equals_the_greedy_walk(spark):
    r = random.Random(6)
    rows = [(k, i, float(r.randrange(12))) for k in (1, 2, None) for i in sorted(r.sample(range(-300, 900), 300))]
    rows += [(3, i, float(i)) for i in range(0, 60, 3)] + [(4, 5, 1.0), (4, 5, 2.0), (4, 9, 1.5), (4, None, 9.0), (5, 1, None), (6, 2, 7.0), (6, 2, 7.0)]
    df = spark.createDataFrame(rows, "key int, i long, v double").repartition(6)
    want, of = set(), defaultdict(set)
    for k, i, v in rows:
        if i is not None and v is not None:
            of[k].add((i, v))
    for k, own in of.items():
        kept = []
        for i, v in sorted(own, key=lambda x: (-x[1], x[0])):
            if all(abs(i - j) > 4 for j, _ in kept):
                kept.append((i, v))
        want |= {(k, i, v) for i, v in kept}
    got = [tuple(x) for x in imaging.suppress(df, ["key"], "i", "v", 4).collect()]
    assert set(got) == want and len(got) == len(want)
    assert imaging.suppress(df.limit(0), ["key"], "i", "v", 4).count() == 0


def test_dyadic_cells(spark):
    r = random.Random(1)
    pairs = [(a, a + r.choice([0, 1, 6, 365, 100_000])) for a in (r.randrange(-5000, 5000) for _ in range(60))] + [(4, 3)]
    for x in spark.createDataFrame(pairs, "a long, b long").select("a", "b", integrate.dyadic_cells(F.col("a"), F.col("b")).alias("c")).collect():
        cells = sorted((c["at"] << c["level"], (c["at"] + 1) << c["level"]) for c in x["c"])
        n = x["b"] - x["a"] + 1
        assert sum(b - a for a, b in cells) == n and all(a[1] == b[0] for a, b in zip(cells, cells[1:], strict=False))
        if n:
            assert cells[0][0] == x["a"] and len(cells) <= 2 * max(1, math.log2(n) + 1)


@pytest.mark.parametrize("ranges", [512, 3])
def test_flag_ranges_short_and_of_years(spark, monkeypatch, ranges):
    """With few ranges a task, cells that hold many are split."""
    monkeypatch.setattr(integrate, "RANGES", ranges)
    r = random.Random(3)
    day = lambda k: f"20{10 + k // 336:02d}-{k % 336 // 28 + 1:02d}-{k % 28 + 1:02d} {r.randrange(24):02d}:00:00"
    vis = [(r.randrange(2), *sorted(r.sample(range(6), 2)), r.randrange(2), r.randrange(8), day(r.randrange(2000))) for _ in range(600)] + [(None, 1, 2, 0, 3, day(5)), (1, 1, 2, 0, 3, None)]
    flags = []
    for k in range(60):
        t0 = r.randrange(2000)
        ends = sorted([day(t0), day(min(1999, t0 + r.choice([0, 0, 3, 20, 900])))])
        flags.append((r.choice([None, 0, 1]), r.choice([None] + list(range(6)) * 3), r.choice([None, *range(6)]), r.choice([None, 0, 1]), *ends, c := r.randrange(8), c + r.randrange(3)))
    flags += flags[:5]
    v = spark.createDataFrame(vis + vis[:9], "source int, ant1 int, ant2 int, band int, chan int, obs string").withColumn("obs_ts", F.col("obs").cast("timestamp"))
    f = spark.createDataFrame(flags, "source int, ant_a int, ant_b int, band int, t0 string, t1 string, c0 int, c1 int").withColumns({c: F.col(c).cast("timestamp") for c in ("t0", "t1")})

    def hit(s, a, b, band, chan, t):
        for fs, fa, fb, fband, t0, t1, c0, c1 in flags:
            pair = fa is None or (fa == a and fb in (None, b)) or (fa == b and fb in (None, a))
            if t is not None and pair and fs in (None, s) and fband in (None, band) and t0 <= t <= t1 and c0 <= chan <= c1:
                return True
        return False

    want = sorted((x for x in vis + vis[:9] if hit(*x)), key=str)
    assert 10 < len(want) < 500
    got = integrate.flagged_by_ranges(v, f)
    assert got.columns == v.columns
    assert sorted((tuple(x)[:6] for x in got.collect()), key=str) == want
    assert integrate.flagged_by_ranges(v, f.limit(0)).count() == integrate.flagged_by_ranges(v.limit(0), f).count() == 0


def test_all_lags_agree_with_pairs(spark):
    rng = np.random.default_rng(3)
    there = rng.random((7, 9)) < 0.8
    image = rng.normal(500, 3, (7, 9))
    rows = [(1, x, y, float(image[y, x]) if (x, y) != (4, 4) else None) for y, x in zip(*np.nonzero(there), strict=True) for x, y in [(int(x), int(y))]] + [(2, 0, 0, 1.0)]
    there[4, 4] = False
    got = {(r["dx"], r["dy"]): (r["s"], r["n"]) for r in cubes.structure_all_lags(spark.createDataFrame(rows, "image_key int, x int, y int, value double"), 9).collect()}
    want = defaultdict(list)
    at = list(zip(*np.nonzero(there), strict=True))
    for y0, x0 in at:
        for y1, x1 in at:
            if y1 > y0 or (y1 == y0 and x1 > x0):
                want[int(x1 - x0), int(y1 - y0)].append((image[y1, x1] - image[y0, x0]) ** 2)
    assert got.keys() == want.keys()
    assert all(got[k][1] == len(v) and got[k][0] == pytest.approx(np.mean(v), abs=1e-8) for k, v in want.items())


def test_all_lags_of_a_large_image_are_one_task(spark):
    n = 256
    p = spark.range(n * n).select(F.lit(1).alias("image_key"), (F.col("id") % n).cast("int").alias("x"), F.floor(F.col("id") / n).cast("int").alias("y"), (F.col("id") % n).cast("double").alias("value"))
    s = cubes.structure_all_lags(p, n)
    assert s.count() == n * (2 * n - 1) - n
    assert s.where(F.abs(F.col("s") - F.col("dx") ** 2) > 1e-4).count() == 0


def test_clip_after_an_average_and_bins_of_scatter(spark):
    rows = [(1, c, v, 0.0) for c, v in enumerate([10.0, -10.0, 30.0, 30.0, 5.0, 5.0])]
    v = spark.createDataFrame(rows, "frame_id int, chan int, re double, im double")
    assert [r["chan"] for r in flagging.clip_averaged(v, ["frame_id"], 2, 1.0, 20.0).where("flag").orderBy("chan").collect()] == [0, 1, 2, 3]
    t = v.withColumn("obs_ts", F.timestamp_seconds(F.col("chan") * 10))
    w = {r["chan"]: (r["weight"], r["flag"]) for r in vistable.weights_from_scatter(t, ["frame_id"], 2, seconds=20, rms=True).collect()}
    assert w == {0: (0.02, False), 1: (0.02, False), 2: (pytest.approx(2 / 900), False), 3: (pytest.approx(2 / 900), False), 4: (0.08, False), 5: (0.08, False)}
    h = {r["bin"]: (r["n"], r["cumulative"], r["log_n"]) for r in cubes.plane_histogram(v.select(F.lit(1).alias("image_key"), F.col("re").alias("value")), 2, 0.0, 20.0).collect()}
    assert h == {-1: (1, 1, 0.0), 0: (2, 3, pytest.approx(math.log10(2))), 1: (1, 4, 0.0), 2: (2, 6, pytest.approx(math.log10(2)))}
