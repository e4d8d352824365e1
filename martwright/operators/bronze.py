"""Scanned files to bronze rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from martwright.functions.columns import standardize_columns
from martwright.functions.lineage import add_lineage, stringify


def to_bronze(
    scanned: DataFrame, run_id: str, source_system: str, source_file: str | Column | None = None
) -> DataFrame:
    """Standard names, text columns, lineage. Narrow: one projection over the scan.

    Lineage comes first, while the scan's ``_metadata`` can still be read.
    """
    return stringify(
        standardize_columns(add_lineage(scanned, run_id, source_system, source_file))
    )
