"""The lineage columns every bronze row carries."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Lineage column names of the bronze layer.
RUN_ID = "pipeline_run_id"
SOURCE_FILE = "source_file_name"
SOURCE_SYSTEM = "source_system"
INGESTED_AT = "ingestion_timestamp"
INGESTED_ON = "ingestion_date"
LINEAGE_COLUMNS = (RUN_ID, SOURCE_FILE, SOURCE_SYSTEM, INGESTED_AT, INGESTED_ON)

# A path of these characters alone is reported as listed, and names no partition folder.
_PLAIN_PATH = re.compile(r"[A-Za-z0-9_.:/-]+")


def business_columns(df: DataFrame) -> list[str]:
    return [name for name in df.columns if name not in LINEAGE_COLUMNS]


def add_lineage(
    df: DataFrame, run_id: str, source_system: str, source_file: str | Column | None = None
) -> DataFrame:
    """Append the lineage columns.

    ``source_file=None`` takes each row's own file name from the scan's
    ``_metadata``, so one scan may cover any number of files.
    """
    if source_file is None:
        source_file = scanned_file_name()
    elif isinstance(source_file, str):
        source_file = F.lit(source_file)
    return df.withColumns(
        {
            RUN_ID: F.lit(run_id),
            SOURCE_FILE: source_file,
            SOURCE_SYSTEM: F.lit(source_system),
            INGESTED_AT: F.current_timestamp(),
            INGESTED_ON: F.current_date(),
        }
    )


def file_name_of(path: Column) -> Column:
    """A path's base name, after its partition folders if it has any: ``dt=1/part-0.csv``.

    So files of one name in two partition folders stay apart. Only a path with
    such folders is searched, from its start, folder by folder.
    """
    foldered = F.regexp_extract(path, r"^(?:[^/]*/)*?((?:[^/=]+=[^/]*/)*[^/]+)$", 1)
    return F.when(F.contains(path, F.lit("=")), foldered).otherwise(F.substring_index(path, "/", -1))


def scanned_file_name(paths: Iterable[str] | None = None) -> Column:
    """Each row's file name as listed; the scan reports it percent-encoded.

    Where the ``paths`` scanned are known and all plain, it is the name that the
    scan holds once a file; else each row's path is searched.
    """
    if paths is not None and all(_PLAIN_PATH.fullmatch(path) for path in paths):
        return F.col("_metadata.file_name")
    path = F.col("_metadata.file_path")
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(path, F.lit("%")), file_name_of(decoded)).otherwise(file_name_of(path))


def stringify(df: DataFrame) -> DataFrame:
    """Business columns to text in one projection; nested ones as JSON."""

    def as_text(field: T.StructField) -> Column:
        column = F.col(quoted(field.name))
        if field.name in LINEAGE_COLUMNS or isinstance(field.dataType, T.StringType):
            return column
        if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            return F.to_json(column).alias(field.name)
        return column.cast("string").alias(field.name)

    return df.select(*[as_text(field) for field in df.schema.fields])


def quoted(name: str) -> str:
    """Column name as a SQL identifier."""
    return "`" + name.replace("`", "``") + "`"
