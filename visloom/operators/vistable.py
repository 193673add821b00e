"""Tools over visibility tables: selection, averaging, conversion, statistics, fitting, reshaping."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def select_rows(vis: DataFrame, *conditions: Column) -> DataFrame:
    """Rows that all of the conditions hold for, added one after the other."""
    return reduce(lambda v, c: v.where(c), conditions, vis)


def average_channels(vis: DataFrame, keys: list[str], start: int, width: int, step: int, count: int) -> DataFrame:
    """Means of `width` channels every `step` from `start`, as channels 0 .. count - 1."""
    out = F.floor((F.col("chan") - start) / step)
    inside = (F.col("chan") >= start) & (out < count) & ((F.col("chan") - start) % step < width)
    return vis.where(inside).groupBy(*keys, out.cast("int").alias("out_chan")).agg(F.avg("re").alias("re"), F.avg("im").alias("im"))


def stokes(vis: DataFrame, keys: list[str], linear: bool = False) -> DataFrame:
    """Stokes columns of circular correlations (pol 0 LL, 1 RR; with linear also 2 RL, 3 LR) of equal keys.

    I and V are half the sum and half of RR less LL; with linear, Q is half the sum of RL and LR, and U half of RL less
    LR turned back by a quarter. Keys that lack one of the correlations are left out.
    """
    pols = (("l", 0), ("r", 1)) + ((("p", 2), ("m", 3)) if linear else ())
    s = vis.groupBy(*keys).agg(*(F.avg(F.when(F.col("pol") == p, F.col(x))).alias(f"{n}_{x}") for n, p in pols for x in ("re", "im")))
    s = s.where(" AND ".join(f"{n}_re IS NOT NULL" for n, _ in pols))
    half = lambda a, b, sign, name: ((F.col(a) + sign * F.col(b)) / 2).alias(name)
    out = [half(f"r_{x}", f"l_{x}", 1, f"i_{x}") for x in ("re", "im")] + [half(f"r_{x}", f"l_{x}", -1, f"v_{x}") for x in ("re", "im")]
    if linear:
        out += [half(f"p_{x}", f"m_{x}", 1, f"q_{x}") for x in ("re", "im")] + [half("p_im", "m_im", -1, "u_re"), half("m_re", "p_re", -1, "u_im")]
    return s.select(*keys, *out)


def circular(vis: DataFrame, keys: list[str]) -> DataFrame:
    """The way back: keys, pol, re, im of the four circular correlations of rows with i, q, u, v as _re and _im."""
    c = F.col
    rows = [(0, c("i_re") - c("v_re"), c("i_im") - c("v_im")), (1, c("i_re") + c("v_re"), c("i_im") + c("v_im")), (2, c("q_re") - c("u_im"), c("q_im") + c("u_re")), (3, c("q_re") + c("u_im"), c("q_im") - c("u_re"))]
    return vis.select(*keys, F.explode(F.array(*(F.struct(F.lit(p).alias("pol"), re.alias("re"), im.alias("im")) for p, re, im in rows))).alias("x")).select(*keys, "x.*")


def quantiles(rows: DataFrame, keys: list[str], value: str, shares: dict[str, float], bins: int = 1000) -> DataFrame:
    """keys and a column a name of shares: exact quantiles, interpolated between neighbours, of each group's values; null ones are left out.

    Equal values are counted together, and each group's range is cut into bins. Running counts of the bins tell where
    a quantile's two neighbours lie; only values of these bins are ranked, bin by bin. So a group of any number of
    rows is a few counts, and no task holds all of its values.
    """
    counts = rows.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_n"))
    span = counts.groupBy(*keys).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.sum("_n").alias("_all"))
    place = F.when(F.col("_hi") > F.col("_lo"), F.least(F.floor((F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * bins), F.lit(bins - 1))).otherwise(0)
    binned = counts.join(span, keys).withColumn("_bin", place)
    sums = binned.groupBy(*keys, "_bin", "_all").agg(F.sum("_n").alias("_here"))
    before = F.sum("_here").over(W.partitionBy(*keys).orderBy("_bin")) - F.col("_here")
    # For each quantile the ranks (from 0) of the values below and above it.
    wanted = F.explode(F.array(*(F.struct(F.lit(n).alias("name"), (F.floor((F.col("_all") - 1) * p) + up).alias("rank"), F.lit(up).alias("up")) for n, p in shares.items() for up in (0, 1))))
    sought = sums.withColumn("_before", before).select("*", wanted.alias("w")).where("w.rank >= _before AND w.rank < _before + _here").select(*keys, "_bin", "_before", "w.*")
    found = binned.select(*keys, "_bin", "_v", "_n").join(sought.select(*keys, "_bin", "_before").distinct(), [*keys, "_bin"])
    upto = F.sum("_n").over(W.partitionBy(*keys, "_bin").orderBy("_v")) + F.col("_before")
    ranked = found.withColumn("_to", upto).withColumn("_from", F.col("_to") - F.col("_n"))
    at = ranked.drop("_before").join(sought.drop("_before"), [*keys, "_bin"]).where("rank >= _from AND rank < _to")
    side = lambda n, up: F.max(F.when((F.col("name") == n) & (F.col("up") == up), F.col("_v")))
    picked = at.groupBy(*keys).agg(*(side(n, up).alias(f"{n}_{up}") for n in shares for up in (0, 1)))
    part = lambda p: (F.col("_all") - 1) * p - F.floor((F.col("_all") - 1) * p)
    between = [(F.col(f"{n}_0") + F.coalesce((F.col(f"{n}_1") - F.col(f"{n}_0")) * part(p), F.lit(0.0))).alias(n) for n, p in shares.items()]
    return picked.join(span.select(*keys, "_all"), keys).select(*keys, *between)


def statistics(vis: DataFrame, keys: list[str], value: str, where: Column | None = None, flag: str | None = None) -> DataFrame:
    """Count, extrema, sum, mean, deviation, rms and quartiles of a value by keys; of the rows that `where` selects, without those that `flag` flags."""
    if where is not None:
        vis = vis.where(where)
    if flag is not None:
        vis = vis.where(~F.coalesce(F.col(flag), F.lit(False)))
    v = F.col(value)
    plain = vis.groupBy(*keys).agg(
        F.count(v).alias("n"), F.min(v).alias("low"), F.max(v).alias("high"), F.sum(v).alias("total"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.var_samp(v).alias("var"), F.sqrt(F.avg(v * v)).alias("rms"),
    )
    return plain.join(quantiles(vis, keys, value, {"median": 0.5, "q1": 0.25, "q3": 0.75}), keys, "left")


def split_time(vis: DataFrame, seconds: float, keys: list[str], weight: str, step: int = 0, combine: list[str] | None = None) -> DataFrame:
    """Weighted means of time bins; keys say what is never averaged over, such as scans.

    With a step, so many channels are averaged into one, `out_chan`. Of the keys named in `combine` all are averaged
    together, and of each the smallest stays beside the mean.
    """
    bin_ = F.floor(F.unix_micros(F.col("obs_ts").cast("timestamp")) / (seconds * 1e6)).alias("bin")
    w = F.col(weight)
    mean = lambda x: F.sum(F.col(x) * w) / F.sum(w)
    out = [F.floor(F.col("chan") / step).cast("int").alias("out_chan")] if step else []
    over = [F.min(c).alias(c) for c in combine or []]
    return vis.groupBy(bin_, *(k for k in keys if k not in (combine or [])), *out).agg(*over, mean("re").alias("re"), mean("im").alias("im"), F.sum(w).alias("weight"))


def weights_from_scatter(vis: DataFrame, keys: list[str], least: int, seconds: float | None = None, rms: bool = False) -> DataFrame:
    """weight: inverse variance of each group's real and imaginary parts; flag where too few samples or no scatter.

    With seconds, groups are cut into bins of time. With rms, the scatter is about 0 and not about the mean.
    """
    groups = keys
    if seconds:
        vis, groups = vis.withColumn("_bin", F.floor(F.unix_micros(F.col("obs_ts").cast("timestamp")) / (seconds * 1e6))), [*keys, "_bin"]
    scatter = (lambda c: F.avg(F.col(c) * F.col(c))) if rms else F.var_samp
    s = vis.groupBy(*groups).agg(((scatter("re") + scatter("im")) / 2).alias("_v"), F.count("*").alias("_n"))
    good = (F.col("_n") >= least) & (F.col("_v") > 0)
    return vis.join(s.select(*groups, F.when(good, 1 / F.col("_v")).alias("weight"), (~F.coalesce(good, F.lit(False))).alias("flag")), groups).drop("_bin")


def polynomials(rows: DataFrame, keys: list[str], x: str, values: list[str], order: int, use: Column | None = None) -> DataFrame:
    """keys, mid, half, fit_<value> of each group: least-squares polynomials of values over (x - mid) / half.

    Only sums of powers leave the groups, summed before the shuffle, so a group of any size is one row a task; numpy
    solves the small systems of many groups at once. `use` says which rows are fitted. With fewer different x than
    coefficients the system has many solutions, and the smallest is taken; a group without such rows has null fits.
    """
    use = F.lit(True) if use is None else use
    span = rows.groupBy(*keys).agg(((F.max(F.when(use, F.col(x))) + F.min(F.when(use, F.col(x)))) / 2).alias("mid"), ((F.max(F.when(use, F.col(x))) - F.min(F.when(use, F.col(x)))) / 2).alias("half"))
    span = span.withColumn("half", F.when(F.col("half") > 0, F.col("half")).otherwise(1.0))
    s = F.when(use, (F.col(x) - F.col("mid")) / F.col("half"))
    power = lambda k: F.pow(s, F.lit(k)) if k else F.when(use, 1.0)
    sums = [F.sum(power(k)).alias(f"s{k}") for k in range(2 * order + 1)] + [F.sum(power(k) * F.col(v)).alias(f"{v}_{k}") for v in values for k in range(order + 1)]
    found = rows.join(span, keys).groupBy(*keys, "mid", "half").agg(*sums)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            moments = pdf[[f"s{k}" for k in range(2 * order + 1)]].to_numpy(float)
            normal = np.stack([moments[:, i : i + order + 1] for i in range(order + 1)], axis=1)
            good = np.isfinite(normal).all((1, 2))
            out = pdf[[*keys, "mid", "half"]].copy()
            inverse = np.linalg.pinv(np.where(good[:, None, None], normal, 0.0), rcond=1e-12, hermitian=True)
            for v in values:
                right = pdf[[f"{v}_{k}" for k in range(order + 1)]].to_numpy(float)
                fit = (inverse @ np.where(good[:, None], right, 0.0)[:, :, None])[:, :, 0]
                out[f"fit_{v}"] = [f if g else None for f, g in zip(fit, good, strict=True)]
            yield out

    kinds = dict(found.dtypes)
    schema = ", ".join([*(f"{k} {kinds[k]}" for k in [*keys, "mid", "half"]), *(f"fit_{v} array<double>" for v in values)])
    return found.mapInPandas(solve, schema)


def fitted(x: str, value: str, order: int) -> Column:
    """Value of a polynomial of `polynomials` at x; 0 without one."""
    s = (F.col(x) - F.col("mid")) / F.col("half")
    out = F.get(F.col(f"fit_{value}"), F.lit(order))
    for k in range(order - 1, -1, -1):
        out = out * s + F.get(F.col(f"fit_{value}"), F.lit(k))
    return F.coalesce(out, F.lit(0.0))


def subtract_continuum(vis: DataFrame, keys: list[str], line_free: Column, order: int = 1) -> DataFrame:
    """re and im less the polynomial over channels fitted to the line-free ones of each group; order 0 is their mean."""
    joined = vis.join(polynomials(vis, keys, "chan", ["re", "im"], order, line_free), keys)
    less = lambda x: (F.col(x) - fitted("chan", x, order)).alias(x)
    return joined.select(*(c for c in vis.columns if c not in ("re", "im")), less("re"), less("im"))


def hanning(vis: DataFrame, keys: list[str]) -> DataFrame:
    """Channels smoothed by 1/4, 1/2, 1/4; flag at the edges and where a neighbour is absent or flagged."""
    w = W.partitionBy(*keys).orderBy("chan")
    near = lambda x, f: F.when(F.abs(f("chan").over(w) - F.col("chan")) == 1, f(x).over(w))
    smooth = lambda x: (near(x, F.lag) / 4 + F.col(x) / 2 + near(x, F.lead) / 4).alias(x)
    bad = F.col("flag") | F.coalesce(near("flag", F.lag), F.lit(True)) | F.coalesce(near("flag", F.lead), F.lit(True))
    return vis.select(*(c for c in vis.columns if c not in ("re", "im", "flag")), smooth("re"), smooth("im"), bad.alias("flag"))


def subtract_model(vis: DataFrame, model: DataFrame, keys: list[str], sign: int = -1) -> DataFrame:
    """Data less (or plus) the model of equal keys; a sample without a model stays as it is."""
    m = model.select(*keys, F.col("re").alias("_mr"), F.col("im").alias("_mi"))
    add = lambda x, y: (F.col(x) + sign * F.coalesce(F.col(y), F.lit(0.0))).alias(x)
    return vis.join(m, keys, "left").select(*(c for c in vis.columns if c not in ("re", "im")), add("re", "_mr"), add("im", "_mi"))


def concatenate(parts: list[tuple[DataFrame, float]], weight: str) -> DataFrame:
    """Tables one after the other, each with its weights scaled."""
    return reduce(lambda a, b: a.unionByName(b), [p.withColumn(weight, F.col(weight) * scale) for p, scale in parts])


def match_fields(fields: DataFrame, others: DataFrame, tolerance: float) -> DataFrame:
    """other_id, field_id: fields (id, x, y) that lie within a tolerance, by an equi-join over cells of that size."""
    cell = lambda c: F.floor(F.col(c) / tolerance)
    near = F.explode(F.array(*(F.struct((cell("x") + i).alias("cx"), (cell("y") + j).alias("cy")) for i in (-1, 0, 1) for j in (-1, 0, 1))))
    a = fields.select(F.col("id").alias("field_id"), F.col("x").alias("fx"), F.col("y").alias("fy"), cell("x").alias("cx"), cell("y").alias("cy"))
    b = others.select("id", "x", "y", near.alias("c")).select(F.col("id").alias("other_id"), "x", "y", "c.cx", "c.cy")
    d = F.sqrt((F.col("x") - F.col("fx")) ** 2 + (F.col("y") - F.col("fy")) ** 2)
    both = b.join(a, ["cx", "cy"]).where(d <= tolerance)
    return both.groupBy("other_id").agg(F.min("field_id").alias("field_id"))


def cube(vis: DataFrame, times: list[int], time: str, value: str, default: float = 0.0) -> DataFrame:
    """A row a baseline and a column a time, with a default where a baseline has no sample."""
    wide = vis.groupBy("ant1", "ant2").pivot(time, times).agg(F.avg(value))
    return wide.na.fill(default)
