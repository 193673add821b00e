"""Flags of visibilities: by antenna, value, time, neighbourhood, and their books."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from visloom.operators.vistable import fitted, polynomials, quantiles
from visloom.scratch import store


def drop_bad_antennas(vis: DataFrame, bad: DataFrame) -> DataFrame:
    """vis (ant1, ant2, ...) without baselines of a bad antenna (ant); an array has a hundred antennas at most."""
    out = vis
    for side in ("ant1", "ant2"):
        out = out.join(F.broadcast(bad.select(F.col("ant").alias(side)).distinct()), side, "left_anti")
    return out


def flag_range(value: Column, low: float, high: float, outside: bool = True, zeros: bool = False) -> Column:
    """Whether a value is to be flagged: outside (or inside) of [low, high], or zero."""
    inside = value.between(low, high)
    hit = ~inside if outside else inside
    return hit | (value == 0) if zeros else hit


def flag_where(flag: Column, selection: Column, apply: bool = True) -> Column:
    """The flag set, or with apply=False taken away, where the selection holds."""
    return F.when(selection, F.lit(apply)).otherwise(flag)


def quack(vis: DataFrame, seconds: float, keys: list[str], time: str) -> DataFrame:
    """flag: the first seconds of each scan (keys). One small row a scan is joined back, scans aren't windows."""
    first = vis.groupBy(*keys).agg(F.min(time).alias("_first"))
    hit = F.unix_micros(F.col(time).cast("timestamp")) < F.unix_micros(F.col("_first").cast("timestamp")) + int(seconds * 1e6)
    return vis.join(first, keys).withColumn("flag", hit).drop("_first")


def clip_averaged(vis: DataFrame, row: list[str], width: int, low: float, high: float) -> DataFrame:
    """flag: all channels of a run of `width` whose mean visibility has an amplitude outside of [low, high]; row names what a sample is besides its channel."""
    run = F.floor(F.col("chan") / width)
    mean = vis.groupBy(*row, run.alias("_run")).agg(F.avg("re").alias("_re"), F.avg("im").alias("_im"))
    amp = F.sqrt(F.col("_re") ** 2 + F.col("_im") ** 2)
    return vis.withColumn("_run", run).join(mean, [*row, "_run"]).withColumn("flag", ~amp.between(low, high)).drop("_run", "_re", "_im")


def flag_elevation(vis: DataFrame, altitude: Column, lower: float, upper: float) -> DataFrame:
    return vis.withColumn("flag", ~altitude.between(lower, upper))


def extend_groups(vis: DataFrame, keys: list[str], percent: float) -> DataFrame:
    """flag: also all of a group (keys) that is flagged by more than so many percent."""
    share = vis.groupBy(*keys).agg((F.avg(F.col("flag").cast("int")) * 100 > percent).alias("_full"))
    return vis.join(share, keys).withColumn("flag", F.col("flag") | F.col("_full")).drop("_full")


def grow(vis: DataFrame, keys: list[str], order: str) -> DataFrame:
    """flag: also the neighbours, along `order`, of what is flagged."""
    w = W.partitionBy(*keys).orderBy(order)
    near = [F.coalesce(f("flag").over(w), F.lit(False)) for f in (F.lag, F.lead)]
    return vis.withColumn("_near", reduce(lambda a, b: a | b, near)).withColumn("flag", F.col("flag") | F.col("_near")).drop("_near")


def across(vis: DataFrame, keys: list[str]) -> DataFrame:
    """flag: all of a group (keys) of which any is flagged, as for the polarizations of a sample."""
    any_flag = vis.groupBy(*keys).agg(F.bool_or("flag").alias("_any"))
    return vis.join(any_flag, keys).withColumn("flag", F.col("_any")).drop("_any")


def crop(vis: DataFrame, keys: list[str], along: str, value: str, cutoff: float, order: int = 1, pieces: int = 1) -> DataFrame:
    """flag: values further than cutoff deviations from the curve fitted to each group (keys) along an axis.

    The curve is a line, or polynomials of an order on so many pieces of equal length of the group's range.
    """
    span = vis.groupBy(*keys).agg(F.min(along).alias("_lo"), F.max(along).alias("_hi"))
    n = F.when(F.col("_hi") > F.col("_lo"), F.least(F.floor((F.col(along) - F.col("_lo")) * pieces / (F.col("_hi") - F.col("_lo"))), F.lit(pieces - 1))).otherwise(0)
    cut = vis.join(span, keys).withColumn("_piece", n).drop("_lo", "_hi")
    rest = cut.join(polynomials(cut, [*keys, "_piece"], along, [value], order), [*keys, "_piece"]).withColumn("_rest", F.col(value) - fitted(along, value, order))
    spread = rest.groupBy(*keys).agg(F.stddev_pop("_rest").alias("_s"))
    return rest.join(spread, keys).withColumn("flag", F.abs("_rest") > cutoff * F.col("_s")).select(*(c for c in vis.columns if c != "flag"), "flag")


@dataclass(frozen=True)
class Direction:
    """An axis along which values are fitted in groups of rows: polynomials of an order on so many pieces, and how many deviations a value may lie off."""

    keys: tuple[str, ...]
    along: str
    cutoff: float
    order: int = 1
    pieces: int = 1


#: Deviation of normally distributed values over the median of their distances.
SIGMA = 1.4826
#: Distances that are rounding.
TINY = 1e-6


def crop_once(vis: DataFrame, d: Direction, value: str) -> DataFrame:
    """flag: also what lies off the curve of its group; neither the curve nor the deviation sees flagged rows.

    The deviation is that of the median distance, so what is to be flagged doesn't widen it. A group without an
    unflagged row stays as it is.
    """
    keys, good = list(d.keys), ~F.col("flag")
    cut, pieces = vis, keys
    if d.pieces > 1:
        span = vis.groupBy(*keys).agg(F.min(d.along).alias("_lo"), F.max(d.along).alias("_hi"))
        n = F.when(F.col("_hi") > F.col("_lo"), F.least(F.floor((F.col(d.along) - F.col("_lo")) * d.pieces / (F.col("_hi") - F.col("_lo"))), F.lit(d.pieces - 1))).otherwise(0)
        cut, pieces = vis.join(span, keys).withColumn("_piece", n).drop("_lo", "_hi"), [*keys, "_piece"]
    rest = cut.join(polynomials(cut, pieces, d.along, [value], d.order, good), pieces)
    rest = rest.withColumn("_rest", F.when(F.col(f"fit_{value}").isNotNull(), F.abs(F.col(value) - fitted(d.along, value, d.order))))
    spread = quantiles(rest.where(good & F.col("_rest").isNotNull()), keys, "_rest", {"_s": 0.5})
    far = F.coalesce(F.col("_rest") > d.cutoff * SIGMA * F.col("_s") + TINY, F.lit(False))
    return rest.join(spread, keys, "left").withColumn("flag", F.col("flag") | far).select(*vis.columns)


def crop_until_stable(vis: DataFrame, directions: list[Direction], value: str) -> DataFrame:
    """vis with flag: directions take turns, each flagging by what the others have left, until none flags any more.

    Flags are only ever added, so this ends; each turn's flags are written to the shared folder, which ends lineage. A
    null flag is none, and vis without one begins with none. A null value is never flagged and never fitted.
    """
    now = vis.withColumn("flag", F.coalesce(F.col("flag"), F.lit(False)) if "flag" in vis.columns else F.lit(False))
    quiet, turn, before = 0, 0, -1
    while quiet < len(directions):
        now = store(crop_once(now, directions[turn % len(directions)], value), "crop")
        flagged = now.where("flag").count()
        if turn == 0:
            before = vis.where("flag").count() if "flag" in vis.columns else 0
        quiet = 0 if flagged > before else quiet + 1
        before, turn = flagged, turn + 1
    return now


def crop_sliding(vis: DataFrame, keys: list[str], along: str, value: str, cutoff: float, half: int) -> DataFrame:
    """flag: values further than cutoff deviations from the mean of the window of `half` neighbours to either side."""
    w = W.partitionBy(*keys).orderBy(along).rowsBetween(-half, half)
    return vis.withColumn("flag", F.coalesce(F.abs(F.col(value) - F.avg(value).over(w)) > cutoff * F.stddev_pop(value).over(w), F.lit(False)))


def summary(vis: DataFrame, sets: list[list[str]]) -> DataFrame:
    """Flagged and all rows by each of several sets of columns, null where a column is not of the set."""
    names = list(dict.fromkeys(c for s in sets for c in s))
    parts = vis.groupBy(*names).agg(F.count_if("flag").alias("flagged"), F.count("*").alias("total"))
    sums = [F.sum("flagged").alias("flagged"), F.sum("total").alias("total")]
    return parts.groupingSets([[F.col(c) for c in s] for s in sets], *(F.col(c) for c in names)).agg(*sums)


def restore(current: DataFrame, saved: DataFrame, keys: list[str], merge: str = "replace") -> DataFrame:
    """Flags of a saved version (keys, flag) put on the current ones: replace, and, or."""
    s = saved.select(*keys, F.col("flag").alias("_saved"))
    now, then = F.col("flag"), F.coalesce("_saved", F.lit(False))
    new = {"replace": F.coalesce("_saved", "flag"), "and": now & then, "or": now | then}[merge]
    return current.join(s, keys, "left").withColumn("flag", new).drop("_saved")
