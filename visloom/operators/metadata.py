"""What a dataset holds: exposure, scans, rows, frequencies, by field and receiver.

Intervals of exposure may overlap. Whether one begins a scan, and how much of it is new, depends on the latest end
before it; ends are swept within buckets of time, and of earlier buckets one end comes in, so a hot receiver is spread
over its buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def swept(rows: DataFrame, keys: list[str], start: str, end: str, width: int) -> DataFrame:
    """rows and `_seen`, the latest end of intervals (whole numbers) that come before in order of start, null of a key's first.

    Rows without a start or end are left out, and so are those that end before they begin. Of equal starts the shorter
    comes first.
    """
    some = rows.where(F.col(start).isNotNull() & (F.col(end) >= F.col(start))).withColumn("_bucket", F.floor(F.col(start) / width))
    last = some.groupBy(*keys, "_bucket").agg(F.max(end).alias("_last"))
    carry = last.select(*keys, "_bucket", F.max("_last").over(W.partitionBy(*keys).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)).alias("_carry"))
    before = F.max(end).over(W.partitionBy(*keys, "_bucket").orderBy(start, end).rowsBetween(W.unboundedPreceding, -1))
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in [*keys, "_bucket"]]
    met = some.withColumn("_before", before).alias("a").join(carry.alias("b"), same)
    return met.select("a.*", "b._carry").withColumn("_seen", F.greatest("_before", "_carry")).drop("_before", "_carry")


def exposure(rows: DataFrame, keys: list[str], start: str, end: str, width: int) -> DataFrame:
    """keys, covered (length of the union of their intervals), total (sum of lengths), first (length of the interval that begins first), n."""
    s = swept(rows, keys, start, end, width)
    new = F.greatest(F.col(end) - F.greatest(F.col(start), F.coalesce("_seen", start)), F.lit(0))
    return s.groupBy(*keys).agg(F.sum(new).alias("covered"), F.sum(F.col(end) - F.col(start)).alias("total"), F.min_by(F.col(end) - F.col(start), F.struct(start, end)).alias("first"), F.count("*").alias("n"))


def scans(rows: DataFrame, keys: list[str], start: str, end: str, gap: int, width: int) -> DataFrame:
    """rows and scan: 1, 2, ... of each key; an interval that begins more than a gap after all before it have ended begins the next."""
    s = swept(rows, keys, start, end, width)
    begins = (F.col("_seen").isNull() | (F.col(start) > F.col("_seen") + gap)).cast("int")
    s = s.withColumn("_begins", begins)
    counts = s.groupBy(*keys, "_bucket").agg(F.sum("_begins").alias("_n"))
    before = counts.select(*keys, "_bucket", F.coalesce(F.sum("_n").over(W.partitionBy(*keys).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_scans"))
    # Of intervals alike the one that begins a scan comes first.
    here = F.sum("_begins").over(W.partitionBy(*keys, "_bucket").orderBy(start, end, F.desc("_begins")).rowsBetween(W.unboundedPreceding, 0))
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in [*keys, "_bucket"]]
    met = s.withColumn("_here", here).alias("a").join(before.alias("b"), same).select("a.*", "b._scans")
    return met.withColumn("scan", F.col("_here") + F.col("_scans")).select(*rows.columns, "scan")


def scan_list(numbered: DataFrame, keys: list[str], start: str, end: str, time: str) -> DataFrame:
    """keys, scan, first, last, rows, times (how many differ) of each scan."""
    return numbered.groupBy(*keys, "scan").agg(F.min(start).alias("first"), F.max(end).alias("last"), F.count("*").alias("rows"), F.count_distinct(time).alias("times"))


def scans_by_field(numbered: DataFrame, field: str, keys: list[str]) -> DataFrame:
    """field, scans: for each receiver (keys) that saw the field the sorted numbers of its scans there, nested."""
    of = numbered.groupBy(field, *keys).agg(F.array_sort(F.collect_set("scan")).alias("scans"))
    return of.groupBy(field).agg(F.array_sort(F.collect_list(F.struct(*keys, "scans"))).alias("scans"))


def times_by_scan(numbered: DataFrame, keys: list[str], time: str, window: str | None = None) -> DataFrame:
    """keys, scan, (window,) and each time that occurs in it, once."""
    return numbered.select(*keys, "scan", *([window] if window else []), time).distinct()


def row_counts(vis: DataFrame, row: list[str], auto: Column, flag: str) -> DataFrame:
    """rows, cross (without autocorrelations), good and cross_good (those not flagged in all of their samples) of a table of samples; `row` names a row."""
    rows = vis.groupBy(*row).agg(F.bool_and(auto).alias("auto"), F.bool_and(F.coalesce(flag, F.lit(False))).alias("bad"))
    return rows.agg(F.count("*").alias("rows"), F.count_if(~F.col("auto")).alias("cross"), F.count_if(~F.col("bad")).alias("good"), F.count_if(~F.col("auto") & ~F.col("bad")).alias("cross_good"))


def spectral_windows(vis: DataFrame, window: str, hz: Column, field: str) -> DataFrame:
    """window, mean_hz over its channels, channels, fields: those seen in it, sorted."""
    channels = vis.groupBy(window, hz.alias("_hz")).agg(F.collect_set(field).alias("_f"))
    return channels.groupBy(window).agg(F.avg("_hz").alias("mean_hz"), F.count("*").alias("channels"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("_f")))).alias("fields"))


def baseline_matrix(vis: DataFrame) -> DataFrame:
    """ant1, partners: the sorted antennas that an antenna has samples with, itself among them where it has autocorrelations."""
    both = vis.select("ant1", "ant2").union(vis.select(F.col("ant2"), F.col("ant1"))).distinct()
    return both.groupBy("ant1").agg(F.array_sort(F.collect_list("ant2")).alias("partners"))
