"""Dated parameters: look-ups of what was valid at a time, changes and removals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def numbers(cell: Column) -> Column:
    """A comma-separated cell as an array of numbers; what is no number is null."""
    return F.transform(F.split(cell, ","), lambda x: x.try_cast("double"))


def intervals(params: DataFrame, key: str) -> DataFrame:
    """params (key, ref_time, id, value) as [valid_from, valid_to); of equal times the highest id holds."""
    newest = params.groupBy(key, "ref_time").agg(F.max_by("value", "id").alias("value"))
    return newest.withColumn("valid_to", F.lead("ref_time").over(W.partitionBy(key).orderBy("ref_time"))).withColumnRenamed("ref_time", "valid_from")


def _buckets(probe: DataFrame, params: DataFrame, key: str, unit: str) -> tuple[DataFrame, DataFrame]:
    """Both sides with a time bucket, and the parameters with the row that each bucket carries in.

    A key with most of the rows is so spread over its buckets; the carry is one row a bucket.
    """
    p = params.groupBy(key, "ref_time").agg(F.max_by(F.struct("value", "id"), F.col("id")).alias("v")).withColumn("bucket", F.date_trunc(unit, "ref_time"))
    last = p.groupBy(key, "bucket").agg(F.max_by(F.struct("ref_time", "v"), F.col("ref_time")).alias("last"))
    seen = probe.select(key, F.date_trunc(unit, "t").alias("bucket")).distinct()
    both = seen.select(key, "bucket", F.lit(None).cast(last.schema["last"].dataType).alias("last")).union(last)
    carried = both.groupBy(key, "bucket").agg(F.first("last", ignorenulls=True).alias("last"))
    before = F.last("last", ignorenulls=True).over(W.partitionBy(key).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1))
    carry = carried.select(key, "bucket", before.alias("c")).where("c IS NOT NULL").select(key, "bucket", "c.ref_time", "c.v")
    return probe.withColumn("bucket", F.date_trunc(unit, "t")), p.select(key, "bucket", "ref_time", "v").union(carry)


def as_of(probe: DataFrame, params: DataFrame, key: str, unit: str = "month") -> DataFrame:
    """probe (key, t, ...) with the latest value whose ref_time is not after t; null before the first."""
    left, right = _buckets(probe, params, key, unit)
    cols = probe.columns
    a = left.select(key, "bucket", F.col("t").alias("at"), F.lit(1).alias("side"), F.struct(*cols).alias("row"), F.lit(None).cast(right.schema["v"].dataType).alias("v"))
    b = right.select(key, "bucket", F.col("ref_time").alias("at"), F.lit(0).alias("side"), F.lit(None).cast(a.schema["row"].dataType).alias("row"), "v")
    held = F.last("v", ignorenulls=True).over(W.partitionBy(key, "bucket").orderBy("at", "side"))
    return a.union(b).withColumn("v", held).where("side = 1").select(*(F.col(f"row.{c}").alias(c) for c in cols), F.col("v.value").alias("value"))


def bracket(probe: DataFrame, params: DataFrame, key: str, unit: str = "month") -> DataFrame:
    """probe with the value in force at t and the next one at or after t.

    Within time buckets, as in `as_of`; each bucket carries in the last row before it and the first one after it.
    """
    p = params.groupBy(key, "ref_time").agg(F.max_by("value", "id").alias("value")).withColumn("bucket", F.date_trunc(unit, "ref_time"))
    v = F.struct("ref_time", "value")
    ends = p.groupBy(key, "bucket").agg(F.max(v).alias("last"), F.min(v).alias("first"))
    seen = probe.select(key, F.date_trunc(unit, "t").alias("bucket")).distinct()
    ends = seen.join(ends, [key, "bucket"], "full")
    rows = W.partitionBy(key).orderBy("bucket")
    before = F.last("last", ignorenulls=True).over(rows.rowsBetween(W.unboundedPreceding, -1))
    after = F.first("first", ignorenulls=True).over(rows.rowsBetween(1, W.unboundedFollowing))
    carry = ends.withColumn("c", F.array(before, after)).select(key, "bucket", F.explode("c").alias("c")).where("c IS NOT NULL").select(key, "bucket", "c.ref_time", "c.value")
    cols = probe.columns
    a = probe.select(key, F.date_trunc(unit, "t").alias("bucket"), F.col("t").alias("at"), F.lit(1).alias("side"), F.struct(*cols).alias("row"), F.lit(None).cast(p.schema["value"].dataType).alias("value"))
    b = p.select(key, "bucket", "ref_time", "value").union(carry)
    b = b.select(key, "bucket", F.col("ref_time").alias("at"), F.lit(0).alias("side"), F.lit(None).cast(a.schema["row"].dataType).alias("row"), "value")
    order = W.partitionBy(key, "bucket").orderBy("at", "side")
    later = W.partitionBy(key, "bucket").orderBy("at", F.desc("side")).rowsBetween(W.currentRow, W.unboundedFollowing)
    both = a.union(b).withColumn("previous", F.last("value", ignorenulls=True).over(order)).withColumn("next", F.first("value", ignorenulls=True).over(later))
    return both.where("side = 1").select(*(F.col(f"row.{c}").alias(c) for c in cols), "previous", "next")


def upsert(params: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """params with the rows of changes in the place of those of equal keys."""
    both = params.withColumn("_age", F.lit(0)).unionByName(changes.withColumn("_age", F.lit(1)))
    rest = [c for c in params.columns if c not in keys]
    return both.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col("_age")).alias("v")).select(*keys, "v.*")


def remove(params: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    return params.join(gone.select(*keys).distinct(), keys, "left_anti")
