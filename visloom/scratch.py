"""Folders that the driver and every executor can reach, for products and checkpoints of queries."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []


def new_dir(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, or below a temporary one where that is unset and the master is local."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        if not _own:
            own = tempfile.mkdtemp(prefix="visloom-")
            atexit.register(shutil.rmtree, own, True)
            _own.append("file://" + own)
        base = _own[0]
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a table into a new folder and read it again: what is read twice is made once, and lineage ends there."""
    path = new_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
