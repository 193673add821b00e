"""Folders that the driver and every executor can reach."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []


#: Rows of one Arrow batch: texts are long, and a batch exists several times over on its way to Python and back.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> SparkSession:
    """Bound the rows of Arrow batches, and with them the memory of tasks on texts; results don't depend on it."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "10000")) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))
    return spark


def base_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; a temporary one where it is unset and the master is local."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
    if not _own:
        own = tempfile.mkdtemp(prefix="visloom-")
        atexit.register(shutil.rmtree, own, True)
        _own.append("file://" + own)
    return _own[0]


def new_dir(spark: SparkSession, name: str) -> str:
    """A folder of its own for one run of one operator, so that repeated runs never meet."""
    return f"{base_dir(spark)}/visloom-{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, folder: str, name: str, codec: str = "zstd") -> DataFrame:
    """Write a table into the shared folder and read it again: lineage ends there."""
    path = f"{folder}/{name}"
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
