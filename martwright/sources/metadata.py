"""The metadata tables that drive the flow. They are small by nature."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def active_sources(ingestion_config: DataFrame) -> DataFrame:
    return ingestion_config.filter("active_flag")


def table_schema(required_schema: DataFrame, table_name: str) -> DataFrame:
    """Expected columns of a table, in order."""
    return required_schema.filter(F.col("table_name") == table_name).orderBy("column_order")


def column_mapping(mapping: DataFrame, table_name: str) -> DataFrame:
    """(source_column, target_column) lines of a table."""
    return mapping.filter(F.col("table_name") == table_name)


def active_rules(data_quality_rules: DataFrame, table_name: str) -> DataFrame:
    """Active rules of a table in a fixed order, since each sees the survivors of the last.

    Order: ``priority`` where the table has that column, then column and type.
    """
    rules = data_quality_rules.filter(F.col("table_name") == table_name).filter("active_flag")
    order = [c for c in ("priority", "column_name", "rule_type") if c in rules.columns]
    return rules.orderBy(*order)
