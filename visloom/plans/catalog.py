"""The registered queries of the library."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from visloom.plans import joins, products, scalars, tools  # noqa: F401


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.flagship(spark, sf_dir)
