"""Image cubes as pixel tables (image_key, x, y, value) with planes named by image_key or label."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .imaging import spread


def collapse(pixels: DataFrame, keep: list[str]) -> DataFrame:
    """max, mean, median, min, rms, stdev, sum and variance over all axes but those kept."""
    v = F.col("value")
    return pixels.groupBy(*keep).agg(F.max(v).alias("max"), F.avg(v).alias("mean"), F.median(v).alias("median"), F.min(v).alias("min"), F.sqrt(F.avg(v * v)).alias("rms"), F.stddev_samp(v).alias("stdev"), F.sum(v).alias("sum"), F.var_samp(v).alias("variance"))


def spectral_moments(cube: DataFrame, axis: str) -> DataFrame:
    """Moments of each pixel's spectrum: mean, integral, weighted coordinate and its spread, extrema and their places, mean absolute deviation."""
    v, c = F.col("value"), F.col(axis)
    m = cube.groupBy("x", "y").agg(F.avg(v).alias("mean"), F.sum(v).alias("integrated"), (F.sum(v * c) / F.sum(v)).alias("coordinate"), F.sum(v * c * c).alias("_s2"), F.median(v).alias("median"), F.stddev_samp(v).alias("std"), F.sqrt(F.avg(v * v)).alias("rms"), F.max(F.struct(v.alias("v"), (-c).alias("c"))).alias("_top"), F.min(F.struct(v.alias("v"), c.alias("c"))).alias("_low"))
    spread = F.sqrt(F.abs(F.col("_s2") / F.col("integrated") - F.col("coordinate") ** 2))
    off = cube.join(m.select("x", "y", "mean"), ["x", "y"]).groupBy("x", "y").agg(F.avg(F.abs(v - F.col("mean"))).alias("absdev"))
    m = m.join(off, ["x", "y"])
    return m.select("x", "y", "absdev", "mean", "integrated", "coordinate", spread.alias("dispersion"), "median", "std", "rms", F.col("_top.v").alias("max"), (-F.col("_top.c")).alias("max_at"), F.col("_low.v").alias("min"), F.col("_low.c").alias("min_at"))


def boxcar(pixels: DataFrame, axis: str, others: list[str], width: int) -> DataFrame:
    w = W.partitionBy(*others).orderBy(axis).rowsBetween(-(width // 2), width - 1 - width // 2)
    return pixels.withColumn("value", F.avg("value").over(w))


def hanning_axis(pixels: DataFrame, axis: str, others: list[str]) -> DataFrame:
    """1/4, 1/2, 1/4 along an axis; the ends keep their values."""
    w = W.partitionBy(*others).orderBy(axis)
    a, b = F.lag("value").over(w), F.lead("value").over(w)
    return pixels.withColumn("value", F.when(a.isNotNull() & b.isNotNull(), a / 4 + F.col("value") / 2 + b / 4).otherwise(F.col("value")))


def rebin(pixels: DataFrame, fx: int, fy: int) -> DataFrame:
    x, y = F.floor(F.col("x") / fx).cast("int").alias("x"), F.floor(F.col("y") / fy).cast("int").alias("y")
    return pixels.groupBy("image_key", x, y).agg(F.avg("value").alias("value"))


def plane_histogram(pixels: DataFrame, bins: int, low: float, high: float) -> DataFrame:
    """image_key, bin, n, cumulative, log_n (base 10): counts of equal bins of [low, high); bin -1 counts what lies below, bin `bins` what lies above, null values are left out."""
    b = F.least(F.greatest(F.floor((F.col("value") - low) * bins / (high - low)), F.lit(-1)), F.lit(bins)).cast("int").alias("bin")
    n = pixels.where(F.col("value").isNotNull()).groupBy("image_key", b).agg(F.count("*").alias("n"))
    return n.withColumn("cumulative", F.sum("n").over(W.partitionBy("image_key").orderBy("bin"))).withColumn("log_n", F.log10("n"))


def structure_function(pixels: DataFrame, max_lag: int) -> DataFrame:
    """image_key, dx, dy, s: mean squared difference of pixels a lag apart, for lags up to a limit.

    Each pixel is shifted by every lag and met by one equi-join, so rows grow with the lags, not with pairs.
    """
    lags = F.explode(F.array(*(F.struct(F.lit(i).alias("dx"), F.lit(j).alias("dy")) for i in range(max_lag + 1) for j in range(max_lag + 1) if i or j)))
    shifted = pixels.select("image_key", "x", "y", "value", lags.alias("lag")).select("image_key", (F.col("x") + F.col("lag.dx")).alias("x"), (F.col("y") + F.col("lag.dy")).alias("y"), F.col("value").alias("v0"), "lag.dx", "lag.dy")
    return shifted.join(pixels, ["image_key", "x", "y"]).groupBy("image_key", "dx", "dy").agg(F.avg((F.col("value") - F.col("v0")) ** 2).alias("s"), F.count("*").alias("n"))


def structure_all_lags(pixels: DataFrame, size: int) -> DataFrame:
    """image_key, dx, dy, s, n: mean squared difference of pixels a lag apart, and their number, for all lags of images of up to size x size.

    dy is 0 or more, and of dy 0 only dx of 1 or more, since a lag and its opposite say the same. The sums of squared
    differences come from transforms of values, squares and of what is there, padded to twice the size: the sum over
    pairs of a^2 + b^2 - 2ab. Values are freed of their mean first, which changes no difference. One image is one
    task; a pixel that is absent or null counts nowhere.
    """
    kind = dict(pixels.dtypes)["image_key"]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf[np.isfinite(pdf["value"])]
        n = 2 * size
        there, value = np.zeros((size, size)), np.zeros((size, size))
        y, x = pdf["y"].to_numpy(), pdf["x"].to_numpy()
        there[y, x] = 1.0
        value[y, x] = pdf["value"].to_numpy() - (pdf["value"].mean() if len(pdf) else 0.0)
        f = {name: np.fft.rfft2(a, (n, n)) for name, a in (("one", there), ("v", value), ("q", value**2))}
        back = lambda a: np.fft.irfft2(a, (n, n))
        pairs = np.rint(back(f["one"].conj() * f["one"])).astype(np.int64)
        sums = back(f["q"].conj() * f["one"] + f["one"].conj() * f["q"] - 2 * f["v"].conj() * f["v"])
        dy, dx = np.meshgrid(np.arange(size), np.arange(-size + 1, size), indexing="ij")
        use = ((dy > 0) | (dx > 0)) & (pairs[dy, dx] > 0)
        dy, dx = dy[use], dx[use]
        count = pairs[dy, dx]
        return pd.DataFrame({"image_key": [pdf["image_key"].iloc[0] if len(pdf) else None] * len(dx), "dx": dx.astype(np.int32), "dy": dy.astype(np.int32), "s": np.maximum(sums[dy, dx], 0.0) / count, "n": count})

    return spread(pixels, "image_key").groupBy("image_key").applyInPandas(run, f"image_key {kind}, dx int, dy int, s double, n long")


def find_sources(pixels: DataFrame, cutoff: float, most: int) -> DataFrame:
    """image_key, k, x, y, value: the highest local maxima (none of eight neighbours is higher) above a share of the peak."""
    near = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1) if i or j)))
    spread = pixels.select("image_key", "value", "x", "y", near.alias("o")).select("image_key", (F.col("x") + F.col("o.i")).alias("x"), (F.col("y") + F.col("o.j")).alias("y"), F.col("value").alias("near"))
    around = spread.groupBy("image_key", "x", "y").agg(F.max("near").alias("near"))
    peak = pixels.groupBy("image_key").agg(F.max("value").alias("peak"))
    tops = pixels.join(around, ["image_key", "x", "y"]).join(peak, "image_key").where((F.col("value") >= F.col("near")) & (F.col("value") >= cutoff * F.col("peak")))
    k = F.row_number().over(W.partitionBy("image_key").orderBy(F.desc("value"), "y", "x"))
    return tops.withColumn("k", k).where(F.col("k") <= most).select("image_key", "k", "x", "y", "value")
