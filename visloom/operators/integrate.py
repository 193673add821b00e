"""Integration in time, sampling, gaps and pairing of frames."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from visloom.functions.signal import rotate

CELL = ["sub_band", "pol", "bl", "chan"]


def integrate_frames(vis: DataFrame, cycle: int, cycles: int) -> DataFrame:
    """Mean of so many cycles of frames for each band, polarization, baseline and channel, and the time midpoint."""
    key = F.floor(F.col("frame_id") / (cycle * cycles)).alias("integration")
    mid = ((F.min("t_us") + F.max("t_us")) / 2).alias("t_mid")
    return vis.groupBy(key, *CELL).agg(F.avg("re").alias("re"), F.avg("im").alias("im"), mid, F.count("*").alias("n"))


def average_bins(vis: DataFrame, width_us: int) -> DataFrame:
    """Means of each time bin, of u and v too where vis has them, and the frames in it."""
    means = [F.avg(c).alias(c) for c in ("re", "im", "u", "v") if c in vis.columns]
    return vis.groupBy(F.floor(F.col("t_us") / width_us).alias("bin"), *CELL).agg(*means, F.count_distinct("frame_id").alias("n_frames"))


def shift_phases(vis: DataFrame, phi: Column) -> DataFrame:
    """vis with its values turned back by phi, as for a source off the centre."""
    re, im = rotate(F.col("re"), F.col("im"), phi)
    return vis.select(*(c for c in vis.columns if c not in ("re", "im")), re.alias("re"), im.alias("im"))


def sample_grid(frames: DataFrame, step_us: int) -> DataFrame:
    """The first frame of each band and polarization in each slot of a fixed grid."""
    slot = F.floor(F.col("t_us") / step_us).alias("slot")
    return frames.groupBy("sub_band", "pol", slot).agg(F.min_by("frame_id", "t_us").alias("frame_id"), F.min("t_us").alias("t_us"))


def sample_chain(frames: DataFrame, keys: list[str], step_us: int, width: int = 60_000_000) -> DataFrame:
    """keys, t_us of a chain: each pick is the first frame at least step_us after the pick before.

    A pick depends on all before it, but a chain that enters a time bucket does so at one of the frames of the bucket's
    first step or the next one. Each bucket is walked by itself from all of these, which gives where each of its possible chains leaves
    it; only these few rows a bucket are walked in order, and then each bucket is walked once more from its true entry.
    A bucket holds `width` microseconds, however long a key's frames go on.
    """
    f = frames.select(*keys, "t_us", F.floor(F.col("t_us") / width).alias("bucket"))
    key = [*keys, "bucket"]

    def walk(times: np.ndarray, due: int) -> list[int]:
        picked = []
        while (i := int(np.searchsorted(times, due))) < len(times):
            picked.append(int(times[i]))
            due = picked[-1] + step_us
        return picked

    def ways(pdf: pd.DataFrame) -> pd.DataFrame:
        times = np.unique(pdf["t_us"].to_numpy())
        entries = times[: int(np.searchsorted(times, int(pdf["bucket"].iloc[0]) * width + step_us)) + 1]
        return pd.DataFrame({**{k: pdf[k].iloc[0] for k in key}, "entry": entries, "leaves": [walk(times, int(t))[-1] for t in entries]})

    def thread(_: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        out, due = [], None
        for bucket, some in pdf.sort_values(["bucket", "entry"]).groupby("bucket"):
            entries = some["entry"].to_numpy()
            i = 0 if due is None else int(np.searchsorted(entries, due))
            if i == len(entries):  # the chain is past all that this bucket could be entered at
                continue
            out.append((*pdf[keys].iloc[0], bucket, int(entries[i])))
            due = int(some["leaves"].iloc[i]) + step_us
        return pd.DataFrame(out, columns=[*key, "entry"])

    kinds = dict(f.dtypes)
    schema = ", ".join(f"{k} {kinds[k]}" for k in key)
    entered = f.groupBy(*key).applyInPandas(ways, f"{schema}, entry long, leaves long").groupBy(*keys).applyInPandas(thread, f"{schema}, entry long")

    def follow(pdf: pd.DataFrame) -> pd.DataFrame:
        picked = walk(np.unique(pdf["t_us"].to_numpy()), int(pdf["entry"].iloc[0]))
        return pd.DataFrame({**{k: pdf[k].iloc[0] for k in keys}, "t_us": picked})

    schema = ", ".join(f"{k} {kinds[k]}" for k in [*keys, "t_us"])
    return f.join(entered, key).groupBy(*key).applyInPandas(follow, schema)


def mixture(vis: DataFrame, frames: DataFrame, interval_us: int, average_us: int) -> DataFrame:
    """Means of the first frames of each interval, of u and v too where vis has them; a frame counts for 3 ms of the time to average."""
    slot = F.floor(F.col("t_us") / interval_us)
    k = F.row_number().over(W.partitionBy("sub_band", "pol", slot).orderBy("t_us"))
    first = frames.select("frame_id", slot.alias("slot"), k.alias("k")).where(F.col("k") <= -(-average_us // 3000))
    means = [F.avg(c).alias(c) for c in ("re", "im", "u", "v") if c in vis.columns]
    return vis.join(first, "frame_id").groupBy("slot", *CELL).agg(*means)


def gaps(frames: DataFrame, step_us: int) -> DataFrame:
    """Frames whose forerunner is more than a step away, and how many steps lie between.

    Headers only, by array and minute; a minute's first frame is held against the last of the minute before,
    which one row a minute brings, so no day of frames is one window.
    """
    minute = F.floor(F.col("t_us") / 60_000_000)
    f = frames.select("sub_array", "frame_id", "t_us", minute.alias("minute"))
    ends = f.groupBy("sub_array", "minute").agg(F.max("t_us").alias("end"))
    carry = ends.select("sub_array", "minute", F.lag("end").over(W.partitionBy("sub_array").orderBy("minute")).alias("carry"))
    before = F.coalesce(F.lag("t_us").over(W.partitionBy("sub_array", "minute").orderBy("t_us")), "carry")
    dt = F.col("t_us") - before
    return f.join(carry, ["sub_array", "minute"]).withColumn("dt", dt).where(F.col("dt") > step_us).select("sub_array", "frame_id", "t_us", F.floor(F.col("dt") / step_us).alias("skipped"))


def fill_slots(frames: DataFrame, step_us: int) -> DataFrame:
    """A row for each slot between first and last frame; absent ones have value 0 and weight 0."""
    span = frames.agg(F.floor(F.min("t_us") / step_us).alias("lo"), F.floor(F.max("t_us") / step_us).alias("hi"))
    per = 60_000_000 // step_us
    minutes = span.select("lo", "hi", F.explode(F.sequence(F.floor(F.col("lo") / per), F.floor(F.col("hi") / per))).alias("minute"))
    slots = minutes.select("minute", F.explode(F.sequence(F.greatest("lo", F.col("minute") * per), F.least("hi", F.col("minute") * per + per - 1))).alias("slot"))
    have = frames.select(F.floor(F.col("t_us") / step_us).alias("slot"), "frame_id", "value")
    return slots.join(have, "slot", "left").select("minute", "slot", F.coalesce("value", F.lit(0.0)).alias("value"), F.col("frame_id").isNotNull().cast("long").alias("weight"))


def pair_polarizations(frames: DataFrame, step_us: int, jump_us: int) -> DataFrame:
    """source_id and error of each pair of slots: 1 left missing, 2 right missing, 3 a jump since the pair before, else 0."""
    source = (F.floor(F.floor(F.col("t_us") / step_us) / 2) + 1).alias("source_id")
    side = lambda p: F.max(F.when(F.col("pol") == p, F.col("t_us")))
    pairs = frames.groupBy(source).agg(side(0).alias("ll"), side(1).alias("rr"), F.min("t_us").alias("t"))
    minute = F.floor(F.col("source_id") * 2 * step_us / 60_000_000)
    p = pairs.withColumn("minute", minute)
    carry = p.groupBy("minute").agg(F.max("t").alias("end")).select("minute", F.lag("end").over(W.orderBy("minute")).alias("carry"))
    before = F.coalesce(F.lag("t").over(W.partitionBy("minute").orderBy("source_id")), "carry")
    jump = F.col("t") - before > jump_us
    error = F.when(F.col("ll").isNull(), 1).when(F.col("rr").isNull(), 2).when(jump, 3).otherwise(0)
    return p.join(carry, "minute").select("source_id", error.alias("error"))


def number_frames(frames: DataFrame, keys: list[str], order: str, width: int = 60_000_000) -> DataFrame:
    """n: the rank of a frame among those of its keys.

    Frames are ranked within buckets of the order's values; a running sum of one count a bucket comes on top, so
    no key is a window over all of its frames.
    """
    f = frames.withColumn("_bucket", F.floor(F.col(order) / width))
    counts = f.groupBy(*keys, "_bucket").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.partitionBy(*keys).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ranked = f.withColumn("n", F.row_number().over(W.partitionBy(*keys, "_bucket").orderBy(order)))
    joined = ranked.join(counts.select(*keys, "_bucket", before.alias("_before")), [*keys, "_bucket"])
    return joined.withColumn("n", F.col("n") + F.col("_before")).select(*frames.columns, "n")


def merge_chunks(chunks: list[DataFrame], order: str) -> DataFrame:
    """Several tasks' rows as one set, numbered anew within each minute."""
    both = reduce(lambda a, b: a.unionByName(b), chunks)
    return both.withColumn("n", F.row_number().over(W.partitionBy(F.floor(F.col(order) / 60_000_000)).orderBy(order)))


#: Levels of dyadic cells: 2 ** 40 units of time.
DEPTH = 40
#: Ranges of a bucket of time on average, where there are that many; samples of a bucket that meet in one task.
RANGES, SAMPLES = 4096, 1 << 19


def _shift(x: Column, k: Column) -> Column:
    return F.call_function("shiftright", x, k)


def dyadic_cells(first: Column, last: Column) -> Column:
    """The cells (level, at) that make up whole numbers first..last: of each level, 2 ** level wide, two at most."""

    def of(k: Column) -> Column:
        lo, hi = -_shift(-first, k), _shift(last + 1, k)
        cell = lambda at, use: F.when((lo < hi) & (use.bitwiseAND(1) == 1), F.named_struct(F.lit("level"), k, F.lit("at"), at))
        return F.array(cell(lo, lo), cell(hi - 1, hi))

    return F.filter(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(DEPTH)), of)), lambda c: c.isNotNull())


def _codes(held: list[np.ndarray], asked: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """One number for each different row of `held`, and for rows of `asked` the number of the equal one, -1 without any."""
    code, found = np.zeros(len(held[0]), np.int64), np.zeros(len(asked[0]), np.int64)
    for h, a in zip(held, asked, strict=True):
        values, own = np.unique(h, return_inverse=True)
        at = np.minimum(np.searchsorted(values, a), len(values) - 1)
        found = np.where((values[at] == a) & (found >= 0), found * len(values) + at, -1)
        both, code = np.unique(code * len(values) + own, return_inverse=True)
        at = np.minimum(np.searchsorted(both, found), len(both) - 1)
        found = np.where(both[at] == found, at, -1)
    return code, found


def _whole(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers of a column, 0 for null, and which aren't null."""
    return pc.fill_null(pc.cast(column, pa.int64()), 0).to_numpy(), pc.is_valid(column).to_numpy()


def _inside(columns: list[str]):
    """Rows of samples that lie in a range, of one bucket of time.

    Of the ranges that say the same of source, band and antennas, and of a cell of channels, the ends so far are kept
    beside the sorted beginnings; so one look-up for each such kind tells whether a sample is in any of them.
    """

    def run(samples: pa.Table, ranges: pa.Table) -> pa.Table:
        rows = samples.select(columns)
        if not len(samples) or not len(ranges):
            return rows.slice(0, 0)
        r = {c: _whole(ranges.column(c)) for c in ("source", "lo", "hi", "band")}
        t0, t1 = (ranges.column(c).to_numpy() for c in ("t0", "t1"))
        s = {c: _whole(samples.column(c)) for c in ("source", "ant1", "ant2", "band", "chan")}
        t = samples.column("_t").to_numpy()
        both = s["ant1"][1] & s["ant2"][1]
        lo, hi = np.minimum(s["ant1"][0], s["ant2"][0]), np.maximum(s["ant1"][0], s["ant2"][0])
        times = np.unique(np.concatenate([t0, t1]))
        n = 2 * len(times) + 1
        # Places of the ranges' ends are odd, so that samples between two ends have one of their own.
        begin, end = 2 * np.searchsorted(times, t0) + 1, 2 * np.searchsorted(times, t1) + 1
        at = np.searchsorted(times, t)
        now = 2 * at + (times[np.minimum(at, len(times) - 1)] == t)
        cells = ranges.column("cells").combine_chunks()
        row = pc.list_parent_indices(cells).to_numpy()
        level, cell = (pc.struct_field(pc.list_flatten(cells), c).to_numpy() for c in ("level", "at"))
        kind = level * 16 + r["source"][1][row] * 8 + r["band"][1][row] * 4 + r["lo"][1][row] * 2 + r["hi"][1][row]
        hit = np.zeros(len(samples), bool)
        for k in np.unique(kind).tolist():
            some = row[kind == k]
            sides = [(lo, both, hi)] if k & 1 else [(*s["ant1"], None), (*s["ant2"], None)] if k & 2 else [(None, s["chan"][1], None)]
            for one, valid, other in sides:
                ask = s["chan"][1] & valid & ~hit
                held, want = [cell[kind == k]], [s["chan"][0] >> (k >> 4)]
                for bit, c in ((8, "source"), (4, "band")):
                    if k & bit:
                        ask = ask & s[c][1]
                        held.append(r[c][0][some])
                        want.append(s[c][0])
                for c, value in (("lo", one), ("hi", other)):
                    if value is not None:
                        held.append(r[c][0][some])
                        want.append(value)
                asked = np.flatnonzero(ask)
                code, found = _codes(held, [w[asked] for w in want])
                asked, found = asked[found >= 0], found[found >= 0]
                order = np.argsort(code * n + begin[some])
                begins, ends = (code * n + begin[some])[order], np.maximum.accumulate((code * n + end[some])[order])
                where = found * n + now[asked]
                i = np.searchsorted(begins, where, "right") - 1
                hit[asked[(i >= 0) & (ends[np.maximum(i, 0)] >= where)]] = True
        return rows.filter(pa.array(hit))

    return run


def flagged_by_ranges(vis: DataFrame, flags: DataFrame) -> DataFrame:
    """Rows of vis (source, ant1, ant2, band, chan, obs_ts, whole numbers but for the time) inside any row of a flag table.

    flags (source, ant_a, ant_b, band, t0, t1, c0, c1): null in source, band or ant_b stands for any, and ant_b may be
    the baseline's other antenna on either side; null in ant_a flags all antennas.

    Time is cut into buckets that are as wide as a range is long on average or wider, so ranges are cut into three parts
    each on average at most, however long some are. Parts that say the same of all else are put together where
    they overlap. Samples meet the ranges of their bucket once, and aren't compared one by one (`_inside`); buckets of many
    samples are dealt over several tasks by their counts, with the ranges of the bucket for each.
    """
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    a, b = F.col("ant_a").cast("long"), F.when(F.col("ant_a").isNotNull(), F.col("ant_b").cast("long"))
    named = flags.select(F.col("source").cast("long").alias("source"), F.when(b.isNull(), a).otherwise(F.least(a, b)).alias("lo"), F.when(b.isNotNull(), F.greatest(a, b)).alias("hi"), F.col("band").cast("long").alias("band"), F.col("c0").cast("long").alias("c0"), F.col("c1").cast("long").alias("c1"), us("t0").alias("t0"), us("t1").alias("t1"))
    named = named.where("t0 <= t1 AND c0 <= c1")
    sums = named.agg(F.count("*").alias("n"), F.min("t0").alias("first"), F.max("t1").alias("last"), F.avg(F.col("t1") - F.col("t0")).alias("mean")).first()
    if not sums["n"]:
        return vis.limit(0)
    width = max(int(sums["mean"]), (sums["last"] - sums["first"]) * RANGES // sums["n"]) + 1
    bucket = lambda x: F.floor((x - sums["first"]) / width).cast("long")

    same = ["bucket", "source", "lo", "hi", "band", "c0", "c1"]
    parts = named.select("*", F.explode(F.sequence(bucket(F.col("t0")), bucket(F.col("t1")))).alias("bucket"))
    start = F.col("bucket") * width + sums["first"]
    parts = parts.select(*same, F.greatest("t0", start).alias("t0"), F.least("t1", start + (width - 1)).alias("t1")).groupBy(*same, "t0").agg(F.max("t1").alias("t1"))
    w = W.partitionBy(*same).orderBy("t0")
    parts = parts.withColumn("_new", F.coalesce(F.col("t0") > F.max("t1").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(True)).cast("long"))
    parts = parts.withColumn("_run", F.sum("_new").over(w)).groupBy(*same, "_run").agg(F.min("t0").alias("t0"), F.max("t1").alias("t1"))
    parts = parts.withColumn("cells", dyadic_cells(F.col("c0"), F.col("c1"))).drop("_run", "c0", "c1")

    samples = vis.withColumn("_t", us("obs_ts")).where(F.col("_t").between(sums["first"], sums["last"])).withColumn("_bucket", bucket(F.col("_t")))
    # Buckets of many samples are few, at most one for each `SAMPLES` rows.
    many = samples.groupBy("_bucket").agg(F.ceil(F.count("*") / SAMPLES).cast("int").alias("_parts")).where("_parts > 1")
    samples = samples.join(F.broadcast(many), "_bucket", "left").withColumn("_part", F.coalesce(F.pmod(F.xxhash64(*vis.columns), F.col("_parts")), F.lit(0)).cast("int"))
    parts = parts.join(F.broadcast(many), F.col("bucket") == F.col("_bucket"), "left").select("bucket", "source", "lo", "hi", "band", "cells", "t0", "t1", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts") - 1, F.lit(0)))).alias("part"))
    return samples.groupBy("_bucket", "_part").cogroup(parts.groupBy("bucket", "part")).applyInArrow(_inside(vis.columns), vis.schema)
