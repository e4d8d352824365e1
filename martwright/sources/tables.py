"""Catalog tables by two- or three-part name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def full_name(spark: SparkSession, name: str) -> str:
    """``schema.table`` gets the session's current catalog in front."""
    parts = name.split(".")
    if len(parts) == 2:
        return f"{spark.catalog.currentCatalog()}.{name}"
    if len(parts) == 3:
        return name
    raise ValueError(f"invalid table name: {name}")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(full_name(spark, name))
