"""Reading the driver tables (one parquet file per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
