"""Batch readers with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tideframe.schemas import INPUTS


def parquet_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the declared Parquet inputs."""
    return spark.read.schema(INPUTS[name]).parquet(f"{folder}/{name}.parquet")


def csv_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header line and a declared schema; a bad value is an error."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )
