"""Interferometer x time cubes as dense blocks.

Both axes come from the data: the pairs of antennas and the times that occur, numbered in order. Numbers of times are
ranks within buckets of time plus what earlier buckets hold, so no task sorts all of them. A block of the cube is one
row: `PAIRS` x `TIMES` values, the default where a pair has no sample. Blocks without any sample are there, too.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from visloom.scratch import store

PAIRS, TIMES = 64, 256


def time_axis(vis: DataFrame, time: str, width: int) -> DataFrame:
    """<time>, ti: the distinct times (whole numbers, null left out), numbered from 0; width is that of a bucket."""
    times = vis.where(F.col(time).isNotNull()).select(F.col(time).cast("long").alias(time)).distinct().withColumn("_bucket", F.floor(F.col(time) / width))
    counts = times.groupBy("_bucket").agg(F.count("*").alias("_n"))
    before = counts.select("_bucket", (F.sum("_n").over(W.orderBy("_bucket")) - F.col("_n")).alias("_before"))
    rank = F.row_number().over(W.partitionBy("_bucket").orderBy(time)) - 1
    return times.withColumn("_rank", rank).join(before, "_bucket").select(time, (F.col("_rank") + F.col("_before")).alias("ti"))


def pair_axis(vis: DataFrame) -> DataFrame:
    """ant1, ant2, pi, ifr: the pairs that occur, in order, numbered from 0, and their number 1000 * ant1 + ant2 from 1; an array has some thousand pairs."""
    pairs = vis.select("ant1", "ant2").where("ant1 IS NOT NULL AND ant2 IS NOT NULL").distinct()
    return pairs.select("ant1", "ant2", (F.row_number().over(W.orderBy("ant1", "ant2")) - 1).alias("pi"), ((F.col("ant1") + 1) * 1000 + F.col("ant2") + 1).alias("ifr"))


def _fill(default: float):
    def run(table: pa.Table) -> pa.Table:
        pb, tb = (table.column(c)[0].as_py() for c in ("pb", "tb"))
        real = table.filter(pa.compute.is_valid(table.column("pi")))
        n_pairs, n_times = (min(size, int(table.column(c)[0].as_py()) - b * size) for c, b, size in (("np", pb, PAIRS), ("nt", tb, TIMES)))
        values, known = np.full((n_pairs, n_times), default), np.zeros((n_pairs, n_times), bool)
        at = real.column("pi").to_numpy() - pb * PAIRS, real.column("ti").to_numpy() - tb * TIMES
        values[at], known[at] = real.column("value").to_numpy(), True
        one = {"pb": pa.array([pb]), "tb": pa.array([tb]), "n_pairs": pa.array([n_pairs], pa.int32()), "n_times": pa.array([n_times], pa.int32()), "data": pa.array([values.reshape(-1)], pa.list_(pa.float64())), "known": pa.array([known.reshape(-1)], pa.list_(pa.bool_()))}
        return pa.table(one)

    return run


class TimeCube:
    """A cube of mean values by pair and time: `pairs` and `times` are its axes, `blocks` its rows of dense values (pairs by times) and of what is known."""

    def __init__(self, vis: DataFrame, time: str, value: str, default: float = 0.0, width: int = 60_000_000) -> None:
        """vis (ant1, ant2, <time>, <value>): samples of one pair and time are averaged, null values are none."""
        self.time = time
        self.times, self.pairs = store(time_axis(vis, time, width), "times"), store(pair_axis(vis), "pairs")
        cells = vis.where(F.col(value).isNotNull()).groupBy("ant1", "ant2", F.col(time).cast("long").alias(time)).agg(F.avg(value).cast("double").alias("value"))
        placed = cells.join(F.broadcast(self.pairs), ["ant1", "ant2"]).join(self.times, time)
        placed = placed.select(F.floor(F.col("pi") / PAIRS).alias("pb"), F.floor(F.col("ti") / TIMES).alias("tb"), F.col("pi").cast("long").alias("pi"), F.col("ti").cast("long").alias("ti"), "value")
        size = self.pairs.agg(F.count("*").alias("np")).crossJoin(self.times.agg(F.count("*").alias("nt")))
        block = lambda n, size: F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(n) - 1) / size)))
        every = size.where("np > 0 AND nt > 0").select("np", "nt", block("np", PAIRS).alias("pb")).select("np", "nt", "pb", block("nt", TIMES).alias("tb"))
        empty = every.select("pb", "tb", F.lit(None).cast("long").alias("pi"), F.lit(None).cast("long").alias("ti"), F.lit(None).cast("double").alias("value"))
        rows = placed.unionByName(empty).crossJoin(F.broadcast(size))
        self.blocks = rows.groupBy("pb", "tb").applyInArrow(_fill(default), "pb long, tb long, n_pairs int, n_times int, data array<double>, known array<boolean>")

    def cells(self) -> DataFrame:
        """ant1, ant2, <time>, value, known of every pair at every time."""
        b = self.blocks.select("pb", "tb", "n_times", "known", F.posexplode("data").alias("i", "value"))
        b = b.select((F.col("pb") * PAIRS + F.floor(F.col("i") / F.col("n_times"))).alias("pi"), (F.col("tb") * TIMES + F.col("i") % F.col("n_times")).alias("ti"), "value", F.get("known", F.col("i")).alias("known"))
        return b.join(F.broadcast(self.pairs), "pi").join(self.times, "ti").select("ant1", "ant2", self.time, "value", "known")

    def time_average(self) -> DataFrame:
        """ant1, ant2, n, mean over the times at which a pair has a value; summed block by block."""
        i = F.explode(F.sequence(F.lit(0), F.col("n_pairs") - 1)).alias("i")
        b = self.blocks.select("pb", "n_times", "data", "known", i)
        part = lambda c: F.slice(c, F.col("i") * F.col("n_times") + 1, F.col("n_times"))
        kept = F.zip_with(part("data"), part("known"), lambda v, k: F.when(k, v).otherwise(0.0))
        b = b.select((F.col("pb") * PAIRS + F.col("i")).alias("pi"), F.aggregate(kept, F.lit(0.0), lambda a, v: a + v).alias("s"), F.size(F.filter(part("known"), lambda k: k)).alias("n"))
        sums = b.groupBy("pi").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
        return sums.join(F.broadcast(self.pairs), "pi").select("ant1", "ant2", "n", (F.col("s") / F.when(F.col("n") > 0, F.col("n"))).alias("mean"))
