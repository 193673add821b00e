"""Images: gridding, histograms, geometry and models as pixel tables, and whole-image helpers in numpy.

A pixel table has a row for each (image_key, x, y, value). Work that needs a whole image at once, such as a
transform or CLEAN, gets one image a group, which is how images are spread over executors.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from visloom.scratch import store

HALF_WIDTH = 3

# Rational approximation of the spheroidal function of width 6 and exponent 1 (Schwab 1984), numerators
# and denominators by rising powers of eta ** 2 - limit ** 2, for eta below 0.75 and above it.
LIMIT = 0.75
NUMERATORS = ((8.203343e-2, -3.644705e-1, 6.278660e-1, -5.335581e-1, 2.312756e-1), (4.028559e-3, -3.697768e-2, 1.021332e-1, -1.201436e-1, 6.412774e-2))
DENOMINATORS = ((1.0, 8.212018e-1, 2.078043e-1), (1.0, 9.599102e-1, 2.918724e-1))
#: Points of the kernel's table, and its places for 0, 1 and 2 whole cells.
TABLE, PLACES = 24, (12, 16, 21)


def spheroid(eta: np.ndarray | float) -> np.ndarray:
    """The spheroidal function at places -1..1 of its width."""
    eta = np.abs(np.asarray(eta, float))
    value = lambda k, limit: np.polynomial.polynomial.polyval(eta**2 - limit**2, NUMERATORS[k]) / np.polynomial.polynomial.polyval(eta**2 - limit**2, DENOMINATORS[k])
    return np.where(eta <= LIMIT, value(0, LIMIT), value(1, 1.0))


def _kernel() -> tuple[float, ...]:
    x = 2 * np.array(PLACES) / (TABLE - 1) - 1
    return tuple(float(w) for w in (1 - x**2) * spheroid(x))


#: Weights of grid cells 0, 1 and 2 whole cells away.
KERNEL = _kernel()


def kernel_weight(cells: Column) -> Column:
    """Tapering weight of a grid cell so many whole cells away."""
    return F.get(F.array(*map(F.lit, KERNEL)), cells)


def grid(vis: DataFrame, cell: float | Column) -> DataFrame:
    """Weighted sums by (image_key, iu, iv) of samples (image_key, u, v, re, im); cell, the step of u and v, may be said by columns of theirs.

    Samples are turned to the half plane u >= 0. Each touches the cells that are less than three whole cells
    away on both axes; samples near u = 0 also touch those of the opposite half, mirrored.
    """
    back = F.col("u") < 0
    s = vis.select("image_key", (F.abs("u") / cell).alias("gu"), (F.when(back, -F.col("v")).otherwise(F.col("v")) / cell).alias("gv"), "re", F.when(back, -F.col("im")).otherwise(F.col("im")).alias("im"))
    mirrored = s.where(F.col("gu") < HALF_WIDTH).select("image_key", (-F.col("gu")).alias("gu"), (-F.col("gv")).alias("gv"), "re", (-F.col("im")).alias("im"))
    both = s.union(mirrored)
    reach = lambda c: F.explode(F.sequence(F.floor(F.col(c)) - HALF_WIDTH, F.floor(F.col(c)) + HALF_WIDTH + 1))
    cells = both.select("*", reach("gu").alias("iu")).where("iu >= 0").select("*", reach("gv").alias("iv"))
    du, dv = F.abs(F.col("iu") - F.col("gu")).cast("int"), F.abs(F.col("iv") - F.col("gv")).cast("int")
    near = cells.where((du < HALF_WIDTH) & (dv < HALF_WIDTH)).withColumn("w", kernel_weight(du) * kernel_weight(dv))
    return near.groupBy("image_key", "iu", "iv").agg(F.sum(F.col("w") * F.col("re")).alias("re"), F.sum(F.col("w") * F.col("im")).alias("im"), F.sum("w").alias("beam"), F.count("*").alias("n"))


def weigh(gridded: DataFrame, uniform: bool) -> DataFrame:
    """Natural weights leave sums, uniform ones divide by the number of samples of the cell."""
    by = F.col("n") if uniform else F.lit(1)
    return gridded.select("image_key", "iu", "iv", (F.col("re") / by).alias("re"), (F.col("im") / by).alias("im"), (F.col("beam") / by).alias("beam"))


def direct_map(vis: DataFrame, pixels: list[tuple[int, int, float, float]]) -> DataFrame:
    """Brightness at each of a short list of directions (x, y, l, m), by the sum over samples (exact).

    The list is part of the question, and of the plan: every sample counts for every direction.
    """
    phi = 2 * F.pi() * (F.col("u") * F.col("l") + F.col("v") * F.col("m"))
    at = F.array(*(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.lit(float(l)).alias("l"), F.lit(float(m)).alias("m")) for x, y, l, m in pixels))
    both = vis.select("*", F.inline(at))
    return both.groupBy("image_key", "x", "y").agg(F.avg(F.col("re") * F.cos(phi) + F.col("im") * F.sin(phi)).alias("value"))


def histogram(pixels: DataFrame, bins: int) -> DataFrame:
    """image_key, bin, n: counts of equal steps between the outward-rounded extrema."""
    span = pixels.groupBy("image_key").agg(F.floor(F.min("value")).alias("lo"), F.ceil(F.max("value")).alias("hi"))
    b = F.when(F.col("hi") > F.col("lo"), F.floor((F.col("value") - F.col("lo")) * (bins - 1) / (F.col("hi") - F.col("lo")))).otherwise(0)
    return pixels.join(span, "image_key").groupBy("image_key", b.cast("int").alias("bin")).agg(F.count("*").alias("n"))


def extrema(pixels: DataFrame) -> DataFrame:
    """Largest and smallest value of each image and the place of the largest (of ties the first by y, x)."""
    top = F.max(F.struct("value", (-F.col("y")).alias("my"), (-F.col("x")).alias("mx"))).alias("top")
    m = pixels.groupBy("image_key").agg(top, F.min("value").alias("low"))
    return m.select("image_key", F.col("top.value").alias("high"), "low", (-F.col("top.mx")).alias("x"), (-F.col("top.my")).alias("y"))


def centroid(pixels: DataFrame) -> DataFrame:
    v = F.sum("value")
    return pixels.groupBy("image_key").agg((F.sum(F.col("x") * F.col("value")) / v).alias("cx"), (F.sum(F.col("y") * F.col("value")) / v).alias("cy"))


def moments(pixels: DataFrame) -> DataFrame:
    """Height (median), amplitude, centre and widths of each image, as a Gaussian's start values."""
    t = F.sum("value")
    c = pixels.groupBy("image_key").agg(F.median("value").alias("height"), F.max("value").alias("top"), (F.sum(F.col("x") * F.col("value")) / t).alias("cx"), (F.sum(F.col("y") * F.col("value")) / t).alias("cy"))
    spread = lambda a, m: F.sqrt(F.sum(F.abs((F.col(a) - F.col(m)) ** 2 * F.col("value"))) / F.abs(F.sum("value")))
    return pixels.join(c, "image_key").groupBy("image_key", "height", (F.col("top") - F.col("height")).alias("amplitude"), "cx", "cy").agg(spread("x", "cx").alias("wx"), spread("y", "cy").alias("wy"))


def spectrum_moments(series: DataFrame, keys: list[str], x: str, value: str) -> DataFrame:
    """height (median), amplitude, centre and width of the peak of each group's series over a regular axis.

    The peak is the one, upwards or downwards, whose side of the mean is the narrower, downwards where both are as wide;
    its width is half of the area beyond the height, over the amplitude (infinite, or NaN without an area, where that is
    0). Both sides' widths are compared by sums of places, without a quotient or root, which are exact for whole places;
    so equal ones are equal, whatever the order of rows.
    """
    v, p = F.col(value), F.col(x)
    s = series.groupBy(*keys).agg(
        F.median(v).alias("height"), F.avg(v).alias("_mean"), F.min(v).alias("_low"), F.max(v).alias("_high"), F.sum(v).alias("_sum"), F.count("*").alias("_n"), F.when(F.count("*") > 1, (F.max(p) - F.min(p)) / (F.count("*") - 1)).otherwise(F.lit(float("nan"))).alias("_dx"), F.min(p).alias("_from"),
        (-F.max(F.struct(v.alias("v"), (-p).alias("x")))["x"]).alias("_at_high"), F.min(F.struct(v.alias("v"), p.alias("x")))["x"].alias("_at_low"),
    )
    j = series.join(s, keys)
    up, down = v > F.col("height"), v < F.col("height")
    place = (p - F.col("_from")).cast("double")
    sides = {"h": v > F.col("_mean"), "l": v < F.col("_mean")}
    t = j.groupBy(*keys, "height", "_low", "_high", "_sum", "_n", "_dx", "_at_high", "_at_low").agg(
        F.sum(F.when(up, v).otherwise(0.0)).alias("_above"), F.sum(F.when(down, v).otherwise(0.0)).alias("_below"),
        *(F.sum(F.when(side, x).otherwise(0.0)).alias(f"_{n}{k}") for k, side in sides.items() for n, x in (("n", F.lit(1.0)), ("s", place), ("q", place * place))),
    )
    # n^2 times the variance of a side's places, times n^2 of the other side
    wide = lambda k, other: (F.col(f"_n{k}") * F.col(f"_q{k}") - F.col(f"_s{k}") ** 2) * F.col(f"_n{other}") ** 2
    area = lambda rest: (F.col("_sum") - F.col("height") * F.col("_n") - F.col(rest)) * F.col("_dx")
    is_up = wide("h", "l") < wide("l", "h")
    amplitude = F.when(is_up, F.col("_high") - F.col("height")).otherwise(F.col("_low") - F.col("height"))
    beyond = F.when(is_up, area("_below")).otherwise(area("_above"))
    width = 0.5 * F.abs(F.when(amplitude != 0, beyond / amplitude).when((beyond == 0) | F.isnan(beyond), F.lit(float("nan"))).otherwise(F.lit(float("inf"))))
    return t.select(*keys, "height", amplitude.alias("amplitude"), F.when(is_up, F.col("_at_high")).otherwise(F.col("_at_low")).alias("centre"), width.alias("width"))


def stretch(pixels: DataFrame, low: float) -> DataFrame:
    """Values cut at a low percentile and scaled to 0..1 by image."""
    p = pixels.groupBy("image_key").agg(F.percentile("value", low).alias("lo"), F.max("value").alias("hi"))
    v = (F.greatest("value", "lo") - F.col("lo")) / F.when(F.col("hi") > F.col("lo"), F.col("hi") - F.col("lo")).otherwise(1)
    return pixels.join(p, "image_key").select("image_key", "x", "y", v.alias("value"))


def forward_mean(series: DataFrame, keys: list[str], order: str, value: str, radius: int) -> DataFrame:
    """Whole mean of the next `radius` values; 0 where fewer are left."""
    w = W.partitionBy(*keys).orderBy(order).rowsBetween(0, radius - 1)
    mean = F.when(F.count(value).over(w) == radius, F.floor(F.avg(value).over(w))).otherwise(0)
    return series.withColumn(value, mean)


def peaks(series: DataFrame, keys: list[str], order: str, value: str, threshold: float) -> DataFrame:
    """Rows where the series turns from rising to falling above a share of its range."""
    w = W.partitionBy(*keys).orderBy(order)
    span = series.groupBy(*keys).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    turned = series.withColumn("_up", F.col(value) - F.lag(value).over(w)).withColumn("_down", F.lead(value).over(w) - F.col(value))
    top = (F.col("_up") > 0) & (F.col("_down") < 0) & (F.col(value) > threshold * (F.col("_hi") - F.col("_lo")) + F.col("_lo"))
    return turned.join(span, keys).where(top).select(*keys, order, value)


def suppress(found: DataFrame, keys: list[str], order: str, value: str, distance: float) -> DataFrame:
    """Of peaks closer than a distance, or as far apart, only the highest stays, taken greedily from the top of each series; of equals the first.

    In rounds: a peak that no undecided one within the distance outranks stays, and its neighbours go; that is what the
    greedy walk does, for many places of a series at once. Peaks meet their neighbours by cells of the distance's
    width, so a series may be of any length. Rounds are as many as the longest chain of peaks each of which the next
    one outranks. A peak without a value is none, and rows that repeat one count as one.
    """
    width = max(float(distance), 1e-9)
    cell = F.floor(F.col(order) / width)
    rank = lambda side: (F.col(f"{side}.{value}"), -F.col(f"{side}.{order}"))
    same = lambda: [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    # State 0 is undecided, 1 stays; those that go are left out.
    state = store(found.where(F.col(value).isNotNull() & F.col(order).isNotNull()).select(*keys, order, value).distinct().withColumn("_state", F.lit(0)), "peaks")
    while state.where("_state = 0").limit(1).count():
        here = state.withColumn("_cell", cell)
        around = here.select("*", F.explode(F.array(F.col("_cell") - 1, F.col("_cell"), F.col("_cell") + 1)).alias("_at")).drop("_cell")
        near = F.abs(F.col(f"a.{order}") - F.col(f"b.{order}")) <= distance
        met = here.where("_state = 0").alias("a").join(around.alias("b"), [*same(), F.col("a._cell") == F.col("b._at"), near, (F.col(f"a.{order}") != F.col(f"b.{order}")) | (F.col(f"a.{value}") != F.col(f"b.{value}"))], "left")
        above = (F.col("b._state") == 0) & ((rank("b")[0] > rank("a")[0]) | ((rank("b")[0] == rank("a")[0]) & (rank("b")[1] > rank("a")[1])))
        flags = met.groupBy(*(F.col(f"a.{k}").alias(k) for k in [*keys, order, value])).agg(F.coalesce(F.bool_or(F.col("b._state") == 1), F.lit(False)).alias("_gone"), F.coalesce(F.bool_or(above), F.lit(False)).alias("_below"))
        kept = flags.where("NOT _gone").select(*keys, order, value, F.when(F.col("_below"), 0).otherwise(1).alias("_state"))
        state = store(state.where("_state = 1").unionByName(kept), "peaks")
    rows = [F.col(f"f.{k}").eqNullSafe(F.col(f"s.{k}")) for k in [*keys, order, value]]
    return found.dropDuplicates([*keys, order, value]).alias("f").join(state.alias("s"), rows, "left_semi")


def rescale(series: DataFrame, keys: list[str], value: str, low: float, high: float) -> DataFrame:
    """Values of each group mapped onto [low, high]; a constant group becomes low."""
    span = series.groupBy(*keys).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    v = F.when(F.col("_hi") > F.col("_lo"), low + (F.col(value) - F.col("_lo")) * (high - low) / (F.col("_hi") - F.col("_lo"))).otherwise(low)
    return series.join(span, keys).withColumn(value, v).drop("_lo", "_hi")


def rotate_image(pixels: DataFrame, degrees: float, size: int) -> DataFrame:
    """Each pixel takes the value at its place turned back about the centre, whole coordinates floored; 0 outside."""
    c, s, m = float(np.cos(np.radians(degrees))), float(np.sin(np.radians(degrees))), size / 2
    x, y = F.col("x") - m, F.col("y") - m
    to = pixels.select("image_key", "x", "y", F.floor(c * x - s * y + m).cast("int").alias("sx"), F.floor(s * x + c * y + m).cast("int").alias("sy"))
    source = pixels.select("image_key", F.col("x").alias("sx"), F.col("y").alias("sy"), "value")
    return to.join(source, ["image_key", "sx", "sy"], "left").select("image_key", "x", "y", F.coalesce("value", F.lit(0.0)).alias("value"))


def shift_image(pixels: DataFrame, dx: int, dy: int, size: int) -> DataFrame:
    """Cyclic shift; half the size on both axes swaps quadrants."""
    return pixels.select("image_key", F.pmod(F.col("x") + dx, F.lit(size)).alias("x"), F.pmod(F.col("y") + dy, F.lit(size)).alias("y"), "value")


def disk_mask(x: Column, y: Column, centre: float, radius: float) -> Column:
    return (x - centre) ** 2 + (y - centre) ** 2 <= radius**2


def add_inside(pixels: DataFrame, centre: float, radius: float, amount: float) -> DataFrame:
    inside = disk_mask(F.col("x"), F.col("y"), centre, radius)
    return pixels.withColumn("value", F.when(inside, F.col("value") + amount).otherwise(F.col("value")))


def radial_model(pixels: DataFrame, profile: DataFrame, centre: float, radius: float) -> DataFrame:
    """Brightness of a disk from a radial profile (i, brightness), between whose points it is interpolated; profile is a fixed small table."""
    r = F.sqrt((F.col("x") - centre) ** 2 + (F.col("y") - centre) ** 2) / radius * 100
    at = pixels.select("image_key", "x", "y", r.alias("r"), F.floor(r).cast("int").alias("i"))
    two = profile.select("i", F.col("brightness").alias("b0"), F.lead("brightness").over(W.orderBy("i")).alias("b1"))
    v = F.col("b0") + (F.coalesce("b1", F.lit(0.0)) - F.col("b0")) * (F.col("r") - F.col("i"))
    return at.join(F.broadcast(two), "i", "left").select("image_key", "x", "y", F.coalesce(v, F.lit(0.0)).alias("value"))


def box_smooth(pixels: DataFrame, width: int, divisor: float) -> DataFrame:
    """Moving sums along rows, then along columns, each divided."""
    half = width // 2
    rows = W.partitionBy("image_key", "y").orderBy("x").rowsBetween(-half, half)
    cols = W.partitionBy("image_key", "x").orderBy("y").rowsBetween(-half, half)
    once = pixels.withColumn("value", F.sum("value").over(rows) / divisor)
    return once.withColumn("value", F.sum("value").over(cols) / divisor)


def hybrid(first: DataFrame, second: DataFrame, centre: float, radius: float, disk_share: float = 0.15) -> DataFrame:
    """Mean of two CLEAN images of one sky, raised to 0 where they go below, each scaled to the first one's peak, upon a disk.

    Inside 1.2 radii the disk of a share of that peak is added within the radius; what lies beyond the radius and is
    fainter than nine tenths of the disk is taken for noise, and what lies beyond 1.2 radii is left out.
    """

    def raised(p: DataFrame, name: str) -> DataFrame:
        span = p.groupBy("image_key").agg(F.least(F.min("value"), F.lit(0.0)).alias("_lo"), F.max("value").alias("_hi"))
        up = p.join(span, "image_key").withColumn("_hi", F.col("_hi") - F.col("_lo"))
        unit = (F.col("value") - F.col("_lo")) / F.when(F.col("_hi") > 0, F.col("_hi")).otherwise(1.0)
        return up.select("image_key", "x", "y", unit.alias(name), F.col("_hi").alias(f"_peak_{name}"))

    both = raised(first, "a").join(raised(second, "b").drop("_peak_b"), ["image_key", "x", "y"])
    far = (F.col("x") - centre) ** 2 + (F.col("y") - centre) ** 2
    back = F.col("_peak_a") * disk_share
    mean = (F.col("a") + F.col("b")) / 2 * F.col("_peak_a") + F.when(far <= radius**2, back).otherwise(0.0)
    trimmed = F.when((far > radius**2) & (mean < 0.9 * back), 0.0).otherwise(mean)
    return both.select("image_key", "x", "y", F.when(far > 1.44 * radius**2, 0.0).otherwise(trimmed).alias("value"))


# Whole images, one a group.


def dirty_image(u: np.ndarray, v: np.ndarray, re: np.ndarray, im: np.ndarray, size: int, cell: float, uniform: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Dirty image and beam (size x size, beam peak 1) of samples in wavelengths; cell is the pixel in radians.

    Samples are gridded as `grid` does it, onto the Fourier plane of a map twice as wide, with natural or uniform
    weights; the half plane and its mirror are transformed, the middle is kept and freed of the kernel's taper.
    """
    n = 2 * size
    du = 1.0 / (n * cell)
    back = np.where(u < 0, -1.0, 1.0)
    gu, gv, value = np.abs(u) / du, back * v / du, re + 1j * back * im
    edge = gu < HALF_WIDTH
    gu, gv, value = np.append(gu, -gu[edge]), np.append(gv, -gv[edge]), np.append(value, value[edge].conj())
    data, beam, hits = np.zeros((size + 1, n), complex), np.zeros((size + 1, n)), np.zeros((size + 1, n))
    reach = np.arange(-HALF_WIDTH, HALF_WIDTH + 2)
    iu, iv = np.floor(gu).astype(int)[:, None] + reach, np.floor(gv).astype(int)[:, None] + reach
    weight = lambda cells: np.append(KERNEL, 0.0)[np.minimum(cells.astype(int), HALF_WIDTH)]
    wu, wv = weight(np.abs(iu - gu[:, None])), weight(np.abs(iv - gv[:, None]))
    wu = np.where((iu >= 0) & (iu < n // 2), wu, 0.0)
    wv = np.where(np.abs(iv) < n // 2, wv, 0.0)
    w = wv[:, :, None] * wu[:, None, :]
    use = w > 0
    where = (np.broadcast_to(iu[:, None, :], w.shape)[use], np.broadcast_to((iv % n)[:, :, None], w.shape)[use])
    np.add.at(data, where, (w * value[:, None, None])[use])
    np.add.at(beam, where, w[use])
    np.add.at(hits, where, 1.0)
    if uniform:
        data, beam = data / np.maximum(hits, 1), beam / np.maximum(hits, 1)
    taper = spheroid(np.arange(-(size // 2), size - size // 2) / size)
    to_image = lambda half: along_u(along_v(half, size).T, size) / (taper[:, None] * taper)
    image, beam = to_image(data), to_image(beam)
    peak = beam.max() if len(value) else 1.0
    return image / peak, beam / peak


def along_v(half: np.ndarray, size: int) -> np.ndarray:
    """Columns (u, v) transformed along v; the middle `size` places, from -size // 2 on, of twice as many."""
    return np.fft.fft(half, axis=1)[:, np.arange(-(size // 2), size - size // 2)]


def along_u(lines: np.ndarray, size: int) -> np.ndarray:
    """Lines (y, u), u from 0 to `size` or less, transformed along u; what lies at -u is their mirror, so values are real."""
    n = 2 * size
    return np.fft.irfft(lines.conj(), n, axis=1)[:, np.arange(-(size // 2), size - size // 2)] * n


def fit_beam(beam: np.ndarray, window: int = 10, steps: int = 30) -> np.ndarray:
    """Gaussian of peak 1 fitted to the middle of a beam by Gauss-Newton steps on its logarithm's quadratic form."""
    n = len(beam)
    c = n // 2
    lo, hi = max(0, c - window), min(n, c + window + 1)
    y, x = np.mgrid[lo:hi, lo:hi] - c
    z = beam[lo:hi, lo:hi]
    use = z > 0.35
    a = np.stack([x[use] ** 2, 2 * x[use] * y[use], y[use] ** 2], axis=1).astype(float)
    p = np.linalg.lstsq(a, -np.log(z[use]), rcond=None)[0] if use.sum() >= 3 else np.array([1.0, 0.0, 1.0])
    for _ in range(steps):
        g = np.exp(-(a @ p))
        move = np.linalg.lstsq(-a * g[:, None], z[use] - g, rcond=None)[0]
        p = p + move
        if np.abs(move).max() < 1e-9:
            break
    y, x = np.mgrid[0:n, 0:n] - c
    return np.exp(-np.clip(p[0] * x**2 + 2 * p[1] * x * y + p[2] * y**2, 0, 700))


#: Lines of an image that are subtracted and searched together, small enough for a processor's cache.
STRIP = 64


def hogbom(image: np.ndarray, beam: np.ndarray, gain: float = 0.1, threshold: float = 0.0, steps: int = 200) -> tuple[np.ndarray, list[tuple[int, int, float]]]:
    """Residual and components (y, x, flux): the beam at the highest point is taken off again and again.

    The beam comes off strip by strip, and each strip's extrema are taken while it is at hand.
    """
    rest, parts, n = np.ascontiguousarray(image, float).copy(), [], len(image)
    by, bx = np.unravel_index(int(beam.argmax()), beam.shape)
    strips = [(a, min(n, a + STRIP)) for a in range(0, n, STRIP)]
    room, flat = np.empty((STRIP, n)), rest.reshape(-1)
    high = [int(rest[a:b].argmax()) + a * n for a, b in strips]
    low = [int(rest[a:b].argmin()) + a * n for a, b in strips]
    for _ in range(steps):
        top, bottom = high[int(flat[high].argmax())], low[int(flat[low].argmin())]
        y, x = divmod(top if flat[top] >= -flat[bottom] else bottom, n)
        flux = float(gain * rest[y, x])
        if abs(rest[y, x]) <= threshold:
            break
        parts.append((y, x, flux))
        y0, y1, x0, x1 = max(0, y - by), min(n, y - by + n), max(0, x - bx), min(n, x - bx + n)
        for k, (a, b) in enumerate(strips):
            a0, b0 = max(a, y0), min(b, y1)
            if a0 < b0:
                rest[a0:b0, x0:x1] -= np.multiply(beam[a0 - y + by : b0 - y + by, x0 - x + bx : x1 - x + bx], flux, out=room[: b0 - a0, : x1 - x0])
                high[k], low[k] = int(rest[a:b].argmax()) + a * n, int(rest[a:b].argmin()) + a * n
    return rest, parts


def restore(rest: np.ndarray, parts: list[tuple[int, int, float]], clean_beam: np.ndarray) -> np.ndarray:
    """Residual plus the clean beam at every component."""
    flux = np.zeros_like(rest)
    for y, x, f in parts:
        flux[y, x] += f
    return rest + convolve(flux, clean_beam)


def convolve(image: np.ndarray, beam: np.ndarray) -> np.ndarray:
    """Image convolved with a beam centred in its middle."""
    n, c = len(image), len(beam) // 2
    m = 2 * n
    out = np.fft.irfft2(np.fft.rfft2(image, (m, m)) * np.fft.rfft2(beam, (m, m)), (m, m))
    return out[c : c + n, c : c + n]


def steer(image: np.ndarray, beam: np.ndarray, gain: float = 0.3, cut: float = 0.8, steps: int = 100, stop: float = 0.02) -> tuple[np.ndarray, np.ndarray]:
    """Residual and model for extended sources: all points above a falling contour become model at once."""
    rest, model = image.copy(), np.zeros_like(image)
    top = max(float(image.max()), 1e-12)
    for _ in range(steps):
        peak = float(rest.max())
        if peak <= stop * top:
            break
        contour = np.where(rest >= cut * peak, rest, 0.0)
        seen = convolve(contour, beam)
        scale = gain * peak / max(float(seen.max()), 1e-12)
        model += scale * contour
        rest = rest - scale * seen
    return rest, model


def disk_offset(image: np.ndarray, radius: float) -> tuple[int, int]:
    """How far (x, y) a disk of a radius lies off the middle: where disk and image agree best."""
    n = len(image)
    y, x = np.mgrid[0:n, 0:n] - n // 2
    disk = (x**2 + y**2 <= radius**2).astype(float)
    agree = np.fft.fftshift(np.fft.ifft2(np.fft.fft2(image) * np.conj(np.fft.fft2(np.fft.ifftshift(disk)))).real)
    # The disk model is centred, so agreement at lag 0 means the image's disk lies at the array's origin.
    row, col = np.unravel_index(int(np.fft.ifftshift(agree).argmax()), agree.shape)
    return int(col) - n // 2, int(row) - n // 2


def levels(bins: np.ndarray, counts: np.ndarray, parts: int = 3, rounds: int = 200) -> np.ndarray:
    """Means, deviations and shares (parts x 3, by rising mean) of a mixture of Gaussians over a histogram, seeded by k-means."""
    w, x = counts / counts.sum(), bins.astype(float)
    apart = (x[:, None] - x) ** 2
    seeds = [int(np.searchsorted(np.cumsum(w), 0.5))]
    while len(seeds) < parts:  # each next seed is the value that lowers the spread about the nearest seed most
        near = apart[seeds].min(0)
        seeds.append(int((np.maximum(near - apart, 0) @ w).argmax()))
    mean = x[seeds]
    for _ in range(rounds):
        near = np.abs(x[:, None] - mean).argmin(1)
        new = np.array([np.average(x[near == k], weights=w[near == k]) if (near == k).any() else mean[k] for k in range(parts)])
        if np.allclose(new, mean):
            break
        mean = new
    share = np.maximum(np.array([w[near == k].sum() for k in range(parts)]), 1e-9)
    least = 0.25 * max(float(np.diff(np.unique(x)).min(initial=1.0)), 1e-9) ** 2
    var = np.maximum([np.average((x[near == k] - mean[k]) ** 2, weights=w[near == k]) if (near == k).any() else 1.0 for k in range(parts)], least)
    for _ in range(rounds):
        log = np.log(share) - 0.5 * np.log(var) - 0.5 * (x[:, None] - mean) ** 2 / var
        own = np.exp(log - log.max(1, keepdims=True))
        own = own / own.sum(1, keepdims=True) * w[:, None]
        share = np.maximum(own.sum(0), 1e-12)
        new = (own * x[:, None]).sum(0) / share
        var = np.maximum((own * (x[:, None] - new) ** 2).sum(0) / share, least)
        done, mean = np.allclose(new, mean, atol=1e-9), new
        if done:
            break
    order = np.argsort(mean, kind="stable")
    return np.stack([mean, np.sqrt(var), share / share.sum()], 1)[order]


def sky_levels(pixels: DataFrame, bins: int, parts: int) -> DataFrame:
    """image_key, k, level, deviation, share: levels of each image's values, darkest first, by a mixture over its histogram.

    An image's histogram has at most `bins` rows, whatever the image's size.
    """
    span = pixels.groupBy("image_key").agg(F.floor(F.min("value")).alias("lo"), F.ceil(F.max("value")).alias("hi"))
    kind = dict(pixels.dtypes)["image_key"]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        lo, hi = float(pdf["lo"].iloc[0]), float(pdf["hi"].iloc[0])
        found = levels(pdf["bin"].to_numpy(), pdf["n"].to_numpy(float), min(parts, len(pdf)))
        step = (hi - lo) / (bins - 1)
        return pd.DataFrame({"image_key": [pdf["image_key"].iloc[0]] * len(found), "k": np.arange(len(found)), "level": lo + found[:, 0] * step, "deviation": found[:, 1] * step, "share": found[:, 2]})

    return histogram(pixels, bins).join(span, "image_key").groupBy("image_key").applyInPandas(run, f"image_key {kind}, k int, level double, deviation double, share double")


def refine_peaks(series: np.ndarray, at: list[int], width: int = 10) -> list[float]:
    """Centres of peaks from a parabola through the logarithm of what lies around each."""
    out = []
    for i in at:
        x = np.arange(max(0, i - width), min(len(series), i + width + 1))
        y = series[x]
        use = y > 0.5 * series[i]
        if use.sum() < 3:
            out.append(float(i))
            continue
        a, b, _ = np.polyfit(x[use] - i, np.log(y[use]), 2)
        out.append(float(i - b / (2 * a)) if a < 0 else float(i))
    return out


def per_image(samples: DataFrame, make: Callable[[pd.DataFrame], np.ndarray]) -> DataFrame:
    """image_key, n, data: `make` turns the samples of one image into an array, one image a task."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        image = make(pdf)
        return pd.DataFrame({"image_key": [pdf["image_key"].iloc[0]], "n": [image.shape[-1]], "data": [image.astype(np.float32).reshape(-1)]})

    kind = dict(samples.dtypes)["image_key"]
    return spread(samples, "image_key").groupBy("image_key").applyInPandas(run, f"image_key {kind}, n int, data array<float>")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """df dealt by keys to a number of tasks that stays: what an image is made of is small, what is done with it is not, so partitions mustn't be joined by their bytes."""
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 4 * df.sparkSession.sparkContext.defaultParallelism)
    return df.repartition(n, *keys)


def as_pixels(images: DataFrame) -> DataFrame:
    p = images.select("image_key", "n", F.posexplode("data").alias("i", "value"))
    return p.select("image_key", (F.col("i") % F.col("n")).alias("x"), F.floor(F.col("i") / F.col("n")).cast("int").alias("y"), F.col("value").cast("double").alias("value"))
