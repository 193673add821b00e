"""Time cubes over several blocks, exposure and scans against sweeps in plain Python, odd rows."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from visloom.operators import metadata as md
from visloom.operators import timecube


def test_cube_of_several_blocks(spark):
    r = random.Random(2)
    pairs = [(a, b) for a in range(16) for b in range(a + 1, 16)]
    times = sorted(r.sample(range(-4000, 90_000), 600))
    rows = [(*p, t, float(r.randrange(100))) for p in pairs for t in r.sample(times, 40)] + [(0, 1, times[3], 7.0), (0, 1, times[3], 8.0), (0, 1, times[5], None), (2, 3, None, 4.0)]
    df = spark.createDataFrame(rows, "ant1 int, ant2 int, t long, v double")
    cube = timecube.TimeCube(df, "t", "v", default=-9.0, width=1000)
    want = defaultdict(list)
    for a, b, t, v in rows:
        if v is not None and t is not None:
            want[a, b, t].append(v)
    seen = sorted({t for _, _, t, _ in rows if t is not None})
    assert [x["t"] for x in cube.times.orderBy("ti").collect()] == seen and cube.pairs.count() == len(pairs)
    assert cube.blocks.count() == -(-len(pairs) // 64) * -(-len(seen) // 256)
    got = {(x["ant1"], x["ant2"], x["t"]): (x["value"], x["known"]) for x in cube.cells().collect()}
    assert len(got) == len(pairs) * len(seen)
    assert all(v == ((np.mean(want[k]), True) if k in want else (-9.0, False)) for k, v in got.items())
    mean = defaultdict(list)
    for (a, b, _), v in want.items():
        mean[a, b].append(np.mean(v))
    for x in cube.time_average().collect():
        assert x["n"] == len(mean[x["ant1"], x["ant2"]]) and x["mean"] == pytest.approx(np.mean(mean[x["ant1"], x["ant2"]]))


def test_cube_of_nothing(spark):
    none = spark.createDataFrame([], "ant1 int, ant2 int, t long, v double")
    cube = timecube.TimeCube(none, "t", "v")
    assert cube.blocks.count() == cube.cells().count() == cube.time_average().count() == 0
    empty = spark.createDataFrame([(1, 2, 5, None)], none.schema)
    assert [tuple(x) for x in timecube.TimeCube(empty, "t", "v", default=3.0).cells().collect()] == [(1, 2, 5, 3.0, False)]


def test_exposure_and_scans(spark):
    r = random.Random(9)
    rows = [(r.choice([1, 1, 1, 2, None]), s := r.randrange(0, 3000), s + r.choice([0, 1, 5, 30, 700 if r.random() < 0.02 else 3])) for _ in range(500)] + [(1, None, 5), (1, 5, None), (2, 9, 3), (3, 10, 10)]
    df = spark.createDataFrame(rows, "key int, a long, b long")
    of = defaultdict(list)
    for k, a, b in rows:
        if a is not None and b is not None and b >= a:
            of[k].append((a, b))
    got = {x["key"]: (x["covered"], x["total"], x["first"], x["n"]) for x in md.exposure(df, ["key"], "a", "b", 100).collect()}
    want = {}
    for k, own in of.items():
        covered = set()
        for a, b in own:
            covered.update(range(a, b))
        want[k] = (len(covered), sum(b - a for a, b in own), min(own)[1] - min(own)[0], len(own))
    assert got == want
    numbered = md.scans(df, ["key"], "a", "b", 4, 100)
    assert numbered.columns == ["key", "a", "b", "scan"]
    found = sorted(((x["key"] is None, x["key"] or 0, x["a"], x["b"], x["scan"]) for x in numbered.collect()))
    expect = []
    for k, own in of.items():
        scan, end = 0, None
        for a, b in sorted(own):
            scan += end is None or a > end + 4
            end = b if end is None else max(end, b)
            expect.append((k is None, k or 0, a, b, scan))
    assert found == sorted(expect) and max(x[4] for x in expect) > 20
    listed = md.scan_list(numbered, ["key"], "a", "b", "a")
    assert listed.agg(F.sum("rows")).first()[0] == len(expect)
    assert md.exposure(df.limit(0), ["key"], "a", "b", 100).count() == 0


def test_rows_windows_and_partners(spark):
    rows = [(1, 0, 1, 3, True, 0), (1, 0, 1, 4, False, 1), (1, 2, 2, 3, True, 0), (2, 0, 1, 3, True, 0), (2, 1, 1, 3, None, 5)]
    df = spark.createDataFrame(rows, "frame_id long, ant1 int, ant2 int, chan int, flag boolean, field int")
    assert tuple(md.row_counts(df, ["frame_id", "ant1", "ant2"], F.col("ant1") == F.col("ant2"), "flag").first()) == (4, 2, 2, 1)
    assert {x["ant1"]: x["partners"] for x in md.baseline_matrix(df).collect()} == {0: [1], 1: [0, 1], 2: [2]}
    w = {x["frame_id"]: (x["mean_hz"], x["channels"], x["fields"]) for x in md.spectral_windows(df, "frame_id", F.col("chan") * 10.0, "field").collect()}
    assert w == {1: (35.0, 2, [0, 1]), 2: (30.0, 1, [0, 5])}
    n = df.withColumn("scan", F.col("frame_id") * 2)
    assert [(x["field"], [(y["ant1"], y["scans"]) for y in x["scans"]]) for x in md.scans_by_field(n, "field", ["ant1"]).orderBy("field").collect()] == [(0, [(0, [2, 4]), (2, [2])]), (1, [(0, [2])]), (5, [(1, [4])])]
