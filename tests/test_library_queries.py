"""Every registered query of the library against its SQL on the smallest tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from compare import assert_same, duck
from visloom import registry

QUERIES, SQL = registry.all_queries(), registry.all_sql()


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf, con, name):
    assert_same(QUERIES[name](spark, sf), con, SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_suppressed_peaks(spark, sf, con):
    """Of peaks within six places only the highest stays, from the top down."""
    series = {}
    for k, i, v in con.execute(SQL["w06_peaks"]).fetchall():
        series.setdefault(k, []).append((i, v))
    want = set()
    for k, found in series.items():
        kept = []
        for i, v in sorted(found, key=lambda x: (-x[1], x[0])):
            if all(abs(i - j) > 6 for j, _ in kept):
                kept.append((i, v))
        want |= {(k, i, v) for i, v in kept}
    assert {(r["image_key"], r["i"], r["value"]) for r in QUERIES["w06_peaks_suppressed"](spark, sf).collect()} == want


def test_polynomial_crop(spark, sf, con):
    from visloom.plans import fixtures as fx

    rows = con.execute(fx.with_views("SELECT ant1, chan, re FROM visu", "visu")).fetchnumpy()
    want = {}
    for ant in np.unique(rows["ant1"]):
        chan, re = (rows[c][rows["ant1"] == ant].astype(float) for c in ("chan", "re"))
        lo, hi = chan.min(), chan.max()
        piece = np.minimum(np.floor((chan - lo) * 3 / (hi - lo)), 2) if hi > lo else chan * 0
        rest = np.zeros(len(re))
        for p in np.unique(piece):
            x, y = chan[piece == p], re[piece == p]
            a = np.vander(x - x.mean(), 3)
            rest[piece == p] = y - a @ np.linalg.lstsq(a, y, rcond=None)[0]
        want[ant] = int((np.abs(rest) > 1.5 * rest.std()).sum()), len(re)
    assert {r["ant1"]: (r["flagged"], r["n"]) for r in QUERIES["d06_crop_polynomial"](spark, sf).collect()} == want


def test_images(spark, sf):
    """The stream's images are the dirty images; beams peak in their middle; components are those of a plain CLEAN loop."""
    from visloom.operators import imaging as im
    from visloom.plans import tools

    uv = tools._uv(spark, sf).toPandas()
    live = {r["image_key"]: r for r in QUERIES["t08_live_images"](spark, sf).collect()}
    beams = {r["image_key"]: r for r in im.extrema(QUERIES["i03_clean_beam"](spark, sf)).collect()}
    parts = {}
    for r in QUERIES["i04_hogbom_components"](spark, sf).orderBy("image_key", "k").collect():
        parts.setdefault(r["image_key"], []).append((r["y"], r["x"], r["flux"]))
    assert set(live) == set(beams) == set(parts) == set(uv["image_key"])
    for key, s in uv.groupby("image_key"):
        size, cell = 256, tools.SPEED / (key * 25e6 + 4e8) / 9000
        image, beam = im.dirty_image(*(s[c].to_numpy() for c in ("u", "v", "re", "im")), size, cell)
        assert live[key]["high"] == pytest.approx(image.max(), rel=1e-4) and live[key]["low"] == pytest.approx(image.min(), rel=1e-4)
        assert image[live[key]["y"], live[key]["x"]] == pytest.approx(image.max(), rel=1e-4)
        assert (beams[key]["x"], beams[key]["y"], beams[key]["high"]) == (128, 128, pytest.approx(1.0))
        rest, flux = image.copy(), {}
        for _ in range(200):
            y, x = np.unravel_index(np.abs(rest).argmax(), rest.shape)
            f = 0.1 * rest[y, x]
            flux[y, x] = flux.get((y, x), 0.0) + f
            padded = np.zeros_like(rest)
            ys, xs = np.arange(size) - y + 128, np.arange(size) - x + 128
            inside = np.ix_((ys >= 0) & (ys < size), (xs >= 0) & (xs < size))
            padded[inside] = beam[np.ix_(ys[(ys >= 0) & (ys < size)], xs[(xs >= 0) & (xs < size)])]
            rest -= f * padded
        assert len(parts[key]) == len(flux)
        assert [f for _, _, f in parts[key]] == pytest.approx(sorted(flux.values(), key=lambda f: -abs(f)), abs=2e-3)
        assert all(f == pytest.approx(flux[y, x], abs=2e-3) for y, x, f in parts[key])


def test_levels_of_each_image(spark, sf):
    for r in QUERIES["a14_clusters"](spark, sf).groupBy("image_key").agg(F.sum("share").alias("share"), F.min("deviation").alias("least"), F.count("*").alias("n")).collect():
        assert r["share"] == pytest.approx(1.0, abs=1e-3) and r["least"] > 0 and r["n"] == 3


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_all_names_are_callable():
    assert set(entry.oracle_sql()) <= set(entry.queries())
