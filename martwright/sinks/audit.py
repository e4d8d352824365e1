"""Audit tables: run log, schema-validation log, rejected records."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import astuple, dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.functions.lineage import SOURCE_FILE, quoted
from martwright.operators.typing import FAILURE_COLUMNS
from martwright.sinks.tables import write_table

# Columns of the two logs.
RUN_LOG_SCHEMA = """
    run_id string, pipeline_name string, pipeline_stage string, source_name string,
    source_file_name string, archived_file_name string, source_table string,
    target_table string, start_time timestamp, end_time timestamp, status string,
    records_read long, records_written long, rejected_records long, error_message string
"""
SCHEMA_LOG_SCHEMA = """
    run_id string, table_name string, column_name string,
    expected_type string, actual_type string, validation_status string
"""
# Columns of the rejected-records table.
REJECTED_COLUMNS = (
    "rejection_id",
    "run_id",
    "pipeline_stage",
    "table_name",
    "source_name",
    "source_file_name",
    *FAILURE_COLUMNS,
    "raw_record",
    "rejected_timestamp",
)


@dataclass
class RunEntry:
    """One line of the run log. Counts start at zero so that a failure can always be logged."""

    run_id: str
    pipeline_name: str
    pipeline_stage: str
    source_name: str
    source_file_name: str = ""
    archived_file_name: str = ""
    source_table: str = ""
    target_table: str = ""
    start_time: datetime | None = None
    end_time: datetime | None = None
    status: str = "SUCCESS"
    records_read: int = 0
    records_written: int = 0
    rejected_records: int = 0
    error_message: str = ""


def run_log(spark: SparkSession, entries: Iterable[RunEntry]) -> DataFrame:
    return spark.createDataFrame([astuple(entry) for entry in entries], RUN_LOG_SCHEMA)


def log_runs(spark: SparkSession, entries: Iterable[RunEntry], table: str) -> None:
    """Append the entries of one stage in one write."""
    entries = list(entries)
    if entries:
        write_table(run_log(spark, entries).coalesce(1), table)


def log_schema_checks(spark: SparkSession, rows: list[tuple], table: str) -> None:
    if rows:
        write_table(spark.createDataFrame(rows, SCHEMA_LOG_SCHEMA).coalesce(1), table)


def rejected_records(
    rejected: DataFrame,
    run_id: str,
    stage: str,
    table_name: str,
    source_name: str,
    source_file_name: str | None = None,
) -> DataFrame:
    """Rejected rows in the shape of the central rejected-records table.

    Each row keeps the file it came from; ``source_file_name`` is for rows
    without lineage. NULL fields are absent from ``raw_record``. An id follows
    from what the reject says of which row, not from the run that finds it: a load
    that is validated again gives the same ids, and rows alike in all share one.
    """
    if SOURCE_FILE in rejected.columns:
        file_name = F.col(SOURCE_FILE)
    else:
        file_name = F.lit(source_file_name)
    expected = "expected_data_type" if "expected_data_type" in rejected.columns else "failed_rule"
    values = {
        "rejection_id": _content_id(stage, table_name, source_name, expected, rejected.columns),
        "run_id": F.lit(run_id),
        "pipeline_stage": F.lit(stage),
        "table_name": F.lit(table_name),
        "source_name": F.lit(source_name),
        "source_file_name": file_name,
        "expected_data_type": F.col(expected),
        "raw_record": F.to_json(F.struct(*[F.col(quoted(c)) for c in rejected.columns])),
        "rejected_timestamp": F.current_timestamp(),
    }
    return rejected.select(
        *[values.get(name, F.col(name)).alias(name) for name in REJECTED_COLUMNS]
    )


def _content_id(stage: str, table_name: str, source_name: str, expected: str, columns: list[str]) -> Column:
    """36 characters in the form of a UUID."""
    said = ("failed_column", expected, "actual_value", "rejection_reason")
    record = F.to_json(F.struct(*[F.col(quoted(c)) for c in columns]))
    content = F.to_json(F.array(F.lit(stage), F.lit(table_name), F.lit(source_name), *[F.col(c).cast("string") for c in said], record))
    digest = F.sha2(content, 256)
    parts = [F.substring(digest, start, length) for start, length in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat_ws("-", *parts)


def log_rejected(rejected: DataFrame | None, table: str, **details: str | None) -> None:
    """Append to the rejected-records table; an empty frame adds no rows."""
    if rejected is not None:
        write_table(rejected_records(rejected, **details), table)
