"""Exports as one commit: what a failing task leaves, and what readers see."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from visloom.sources.exports import read_export, write_export


def tables(spark, n, tag):
    return {"groups": spark.range(n).select("id", F.array("id", F.col("id") * 2).alias("data"), F.lit(tag).alias("tag")).repartition(3), "antenna": spark.createDataFrame([(1, tag), (2, None)], "nosta int, tag string"), "none": spark.createDataFrame([], "x int")}


def seen(spark, path):
    return {k: sorted(map(tuple, ((str(v) for v in r) for r in df.collect()))) for k, df in read_export(spark, path).items()}


def test_a_failing_task_leaves_the_old_export(spark, tmp_path):
    path = str(tmp_path / "out")
    assert read_export(spark, path) == {}
    write_export(tables(spark, 7, "one"), path)
    old = seen(spark, path)
    assert [len(old[k]) for k in ("groups", "antenna", "none")] == [7, 2, 0] and old["antenna"] == [("1", "one"), ("2", "None")]
    assert read_export(spark, path)["groups"].dtypes == [("id", "bigint"), ("data", "array<bigint>"), ("tag", "string")]
    files = sorted(p.name for p in tmp_path.rglob("*.parquet"))
    broken = tables(spark, 9, "two")
    broken["groups"] = broken["groups"].withColumn("tag", F.when(F.col("id") == 8, F.raise_error(F.lit("lost"))).otherwise(F.col("tag")))
    with pytest.raises(PySparkException):
        write_export(broken, path)
    assert seen(spark, path) == old and sorted(p.name for p in tmp_path.rglob("*.parquet")) == files
    write_export(tables(spark, 4, "three"), f"file://{path}")
    assert {r["tag"] for r in read_export(spark, path)["groups"].collect()} == {"three"} and read_export(spark, f"file://{path}")["groups"].count() == 4
