"""The crop that takes turns, against a brute force of the same definition."""

import numpy as np
import pandas as pd

from visloom.operators.flagging import SIGMA, Direction, crop_until_stable


def brute_force(df, directions, value):
    """Flags by least squares on pieces of each group, turn by turn; also the number of turns."""
    flag, quiet, turn = np.zeros(len(df), bool), 0, 0
    while quiet < len(directions):
        d = directions[turn % len(directions)]
        new = np.zeros(len(df), bool)
        for at in df.groupby(list(d.keys)).indices.values():
            x, y, good = df[d.along].to_numpy(float)[at], df[value].to_numpy(float)[at], ~flag[at]
            lo, hi = x.min(), x.max()
            piece = np.minimum(((x - lo) * d.pieces / (hi - lo)).astype(int), d.pieces - 1) if hi > lo else np.zeros(len(x), int)
            rest = np.full(len(x), np.nan)
            for p in np.unique(piece):
                own, fit = piece == p, (piece == p) & good & np.isfinite(y)
                if fit.any():
                    mid, half = (x[fit].max() + x[fit].min()) / 2, (x[fit].max() - x[fit].min()) / 2 or 1.0
                    powers = np.vander((x - mid) / half, d.order + 1, increasing=True)
                    rest[own] = np.abs(y[own] - powers[own] @ np.linalg.lstsq(powers[fit], y[fit], rcond=None)[0])
            known = rest[good & np.isfinite(rest)]
            if len(known):
                new[at] = rest > d.cutoff * SIGMA * np.median(known) + 1e-6
        new &= ~flag
        flag |= new
        quiet, turn = 0 if new.any() else quiet + 1, turn + 1
    return flag, turn


def test_turns_until_nothing_is_flagged(spark):
    rng = np.random.default_rng(4)
    t, c, b = (g.reshape(-1) for g in np.meshgrid(np.arange(40), np.arange(24), np.arange(2), indexing="ij"))
    y = np.sin(c / 5) * 4 + t * 0.05 + rng.normal(size=len(t))
    y += np.where((t == 7) | (c == 19), 400.0, 0) + np.where(rng.random(len(t)) < 0.04, 30, 0) + np.where((t > 30) & (c == 3), 9, 0)
    y[5] = np.nan
    df = pd.DataFrame({"b": b, "t": t, "c": c, "y": y})
    turns = [Direction(("b", "t"), "c", 3.5, 2, 2), Direction(("b", "c"), "t", 4.0)]
    want, n = brute_force(df, turns, "y")
    rows = spark.createDataFrame([(int(a), int(b), int(c), None if np.isnan(y) else float(y)) for a, b, c, y in df.itertuples(index=False)], "b int, t int, c int, y double")
    got = crop_until_stable(rows, turns, "y").toPandas().set_index(["b", "t", "c"])["flag"]
    assert n > 3 and 100 < want.sum() < 1000
    assert got.loc[list(zip(b, t, c, strict=True))].tolist() == want.tolist()


def test_flags_stay_and_odd_groups_are_left_alone(spark):
    rows = [(1, 0, 5.0, True), (1, 1, 5.0, True), (2, 0, None, None), (3, 0, 1.0, False), (4, 0, 1.0, None), (4, 1, 1.0, False), (4, 2, 50.0, False), (4, 3, 1.0, False), (4, 4, 1.0, False)]
    df = spark.createDataFrame(rows, "b int, t int, y double, flag boolean")
    got = {(r["b"], r["t"]): r["flag"] for r in crop_until_stable(df, [Direction(("b",), "t", 2.0, 0)], "y").collect()}
    assert {k for k, v in got.items() if v} == {(1, 0), (1, 1), (4, 2)} and len(got) == len(rows)
    assert crop_until_stable(df.limit(0), [Direction(("b",), "t", 3.0)], "y").count() == 0
