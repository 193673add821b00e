"""Images in blocks: equal to those of one task, whatever their size, and what a task holds."""

import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from visloom.operators import blockimages as bi
from visloom.operators import imaging as im


@pytest.fixture(scope="module")
def samples():
    rng = np.random.default_rng(11)
    out = []
    for key, size in ((1, 100), (2, 256), (3, 1024)):
        cell, m = 1e-4 * 256 / size, 150
        u, v = (rng.normal(0, 0.15 / cell, m) for _ in range(2))
        u[:8] *= 0.001  # near the mirror's edge
        out.append(pd.DataFrame({"image_key": key, "u": u, "v": v, "re": rng.normal(size=m), "im": rng.normal(size=m), "size": size, "cell": cell}))
    return pd.concat(out)


@pytest.mark.parametrize("uniform", [False, True])
def test_blocks_make_the_image_of_one_task(spark, samples, uniform):
    blocks = bi.image_blocks(spark.createDataFrame(samples), uniform).cache()
    ends = {(r["image_key"], r["plane"]): r for r in bi.block_extrema(blocks).collect()}
    for key, own in samples.groupby("image_key"):
        size = int(own["size"].iloc[0])
        both = im.dirty_image(*(own[c].to_numpy() for c in ("u", "v", "re", "im")), size, float(own["cell"].iloc[0]), uniform)
        for plane, want in enumerate(both):
            rows = blocks.where((F.col("image_key") == key) & (F.col("plane") == plane)).orderBy("y0").collect()
            got = np.concatenate([np.array(r["data"]) for r in rows]).reshape(size, size)
            assert np.abs(got - want).max() < 2e-6
            high, low = ends[key, plane]["high"], ends[key, plane]["low"]
            assert (high, low) == (got.max(), got.min())
            assert got[ends[key, plane]["y"], ends[key, plane]["x"]] == high
    small = bi.block_pixels(blocks.where("image_key = 1 AND plane = 0"))
    assert small.count() == 100 * 100 and small.where("x = 7 AND y = 99").count() == 1


def test_an_image_without_samples_is_none(spark, samples):
    assert bi.image_blocks(spark.createDataFrame(samples).limit(0)).count() == 0


def test_a_task_of_the_largest_image_holds_a_block():
    size, rng = 5120, np.random.default_rng(2)
    cells = pa.table({"iu": np.repeat(np.arange(64), 500).astype(np.int32), "iv": np.tile(rng.choice(2 * size, 500, replace=False), 64).astype(np.int32), "re": rng.normal(size=32_000), "im": rng.normal(size=32_000), "beam": np.ones(32_000)})
    tracemalloc.start()
    pieces = bi._columns(pa.int32())((pa.scalar(1), pa.scalar(size), pa.scalar(0)), cells)
    columns = tracemalloc.get_traced_memory()[1]
    one = pieces.filter(pa.compute.equal(pieces.column("plane"), 0)).slice(0, 1).column("piece")[0].as_py()
    tracemalloc.reset_peak()
    line = bi._lines((1, size, 0, 0), pd.DataFrame({"columns": range(size // 64), "piece": [one] * (size // 64)}))
    lines = tracemalloc.get_traced_memory()[1]
    assert len(line["data"][0]) == 64 * size
    # The whole plane has 10240 x 10240 complex values: 1.7 GB.
    assert columns < 60e6 and lines < 60e6
