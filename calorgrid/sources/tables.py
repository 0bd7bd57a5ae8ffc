"""Parquet tables of one directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def class_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the class dimension, a fixed table of 26 rows."""
    return sorted({r[0] for r in table(spark, folder, "class_dim").select("cls_name").where("cls_name is not null").collect()})
