"""Exports of several tables as one commit.

Spark writes the Parquet files of each table into a folder of this run; when all tables are there, the driver writes a
list of the files and renames it into place. Readers follow the newest list, so they see all tables of one export or all
of the one before, never groups without their antennas; files of an export that broke off are on no list.
"""

from __future__ import annotations

import json
import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

LIST = "export-"


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def write_export(tables: dict[str, DataFrame], path: str) -> None:
    """Write tables as one export; it takes the place of the one before when all of it is there. What breaks off is removed."""
    path, run = path.rstrip("/"), uuid.uuid4().hex
    store, top = _store(path)
    files = []
    try:
        for table, df in tables.items():
            df.write.option("compression", "zstd").parquet(f"{path}/{table}/{run}")
            found = store.get_file_info(fs.FileSelector(f"{top}/{table}/{run}"))
            files += [(table, f"{table}/{run}/{x.base_name}") for x in found if x.base_name.endswith(".parquet")]
        lists = [x.base_name for x in store.get_file_info(fs.FileSelector(top)) if x.base_name.startswith(LIST)]
        n = max((int(x[len(LIST) :].split(".")[0]) for x in lists), default=0) + 1
        unsure = f"{top}/_{run}"
        with store.open_output_stream(unsure) as out:
            out.write(json.dumps({"schemas": {t: df.schema.json() for t, df in tables.items()}, "files": files}).encode())
        store.move(unsure, f"{top}/{LIST}{n:09d}.json")
    except BaseException:
        for table in tables:
            if store.get_file_info(f"{top}/{table}/{run}").type == fs.FileType.Directory:
                store.delete_dir(f"{top}/{table}/{run}")
        raise


def read_export(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Tables of the newest export, empty ones too; without any export there are none."""
    store, top = _store(path)
    lists = sorted(x.path for x in store.get_file_info(fs.FileSelector(top, allow_not_found=True)) if x.base_name.startswith(LIST))
    if not lists:
        return {}
    with store.open_input_stream(lists[-1]) as f:
        held = json.loads(f.read())
    out = {}
    for table, kind in held["schemas"].items():
        schema = StructType.fromJson(json.loads(kind))
        files = [f"{path.rstrip('/')}/{name}" for t, name, *_ in held["files"] if t == table]
        out[table] = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    return out
