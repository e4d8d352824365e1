"""File scans."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.sources.listing import hadoop_glob, matching_files


# Of the reader options, names the text column for lines that do not fit their file's header.
RAW_LINE_OPTION = "columnNameOfCorruptRecord"
MALFORMED_LINE = "malformed_line"
# Never part of a JSON file: it makes the whole file one record.
NO_LINE_SEPARATOR = "\0" * 4


@dataclass(frozen=True)
class Format:
    source: str
    options: Mapping[str, str] = field(default_factory=dict)


FORMATS: dict[str, Format] = {
    # Headers differ between files more often than one hopes: fail, never misassign.
    "csv": Format("csv", {"header": "true", "inferSchema": "false", "enforceSchema": "false"}),
    # Source text is kept as written: 4999 stays 4999 next to 1199.98.
    "json": Format("json", {"multiLine": "true", "primitivesAsString": "true"}),
    "parquet": Format("parquet"),
    # Usable where this third-party data source is installed.
    "excel": Format("com.crealytics.spark.excel", {"header": "true", "inferSchema": "false"}),
}


def register_format(file_type: str, source: str, options: Mapping[str, str] | None = None) -> None:
    """Make another installed data source readable through ``scan``."""
    FORMATS[file_type.lower()] = Format(source, options or {})


def scan(
    spark: SparkSession,
    path: str | list[str],
    file_type: str,
    options: Mapping[str, str] | None = None,
    schema: str | None = None,
) -> DataFrame:
    """Read files of a registered type; ``options`` override the format's defaults.

    A known ``schema`` saves JSON its inference pass over the data. JSON over many
    lines is held a file at a time; files not in UTF-8 need the option ``encoding``. CSV with the
    option ``columnNameOfCorruptRecord`` has that column last: the whole line where
    its number of fields is not the header's (longer, shorter, a quote not closed),
    NULL on all other lines. Spark refuses to read that column alone.
    """
    known = FORMATS.get(file_type.lower())
    if known is None:
        raise ValueError(f"unsupported file type: {file_type}")
    settings = {**known.options, **(options or {})}
    raw_line = settings.get(RAW_LINE_OPTION)
    if raw_line and known.source == "csv":
        del settings[RAW_LINE_OPTION]
        plain = spark.read.format("csv").options(**settings)
        header = (plain.schema(schema) if schema else plain).load(path).schema
        if raw_line in header.names:
            raise ValueError(f"the files have a column {raw_line} of their own")
        schema = T.StructType([*header.fields, T.StructField(raw_line, T.StringType())])
        # A line is judged by all of its fields, whatever columns are read.
        settings |= {RAW_LINE_OPTION: raw_line, "mode": "PERMISSIVE", "columnPruning": "false"}
    given = {name.lower(): value for name, value in settings.items()}
    if known.source == "json" and given.get("multiline", "").lower() == "true" and not {"linesep", "encoding", "charset"} & set(given):
        # The multi-line reader goes back to the file for the source text of each single number;
        # a record read as a line is in memory.
        settings = {name: value for name, value in settings.items() if name.lower() != "multiline"}
        settings |= {"multiLine": "false", "lineSep": NO_LINE_SEPARATOR}
    reader = spark.read.format(known.source).options(**settings)
    return (reader.schema(schema) if schema else reader).load(path)


def scan_csv(spark: SparkSession, path: str | list[str], options: Mapping | None = None) -> DataFrame:
    return scan(spark, path, "csv", options)


def scan_json(spark: SparkSession, path: str | list[str], options: Mapping | None = None) -> DataFrame:
    return scan(spark, path, "json", options)


def scan_parquet(
    spark: SparkSession, path: str | list[str], options: Mapping | None = None
) -> DataFrame:
    return scan(spark, path, "parquet", options)


def scan_landing(
    spark: SparkSession,
    landing_path: str,
    file_pattern: str,
    file_type: str,
    files: DataFrame | None = None,
    options: Mapping[str, str] | None = None,
    schema: str | None = None,
) -> list[DataFrame]:
    """Scans over the matching files of a landing folder.

    ``files`` (path, ...) narrows them to part of the listing. The result is
    one scan, unless CSV files disagree on their header: then one per distinct
    header. Each keeps its ``_metadata``; union them by name after adding lineage.
    A known ``schema`` saves JSON its inference pass over the data.
    """
    options = dict(options or {})
    if files is not None or file_type.lower() == "csv":
        # Listed by path, files keep the columns that their partition folders name.
        options = {"basePath": landing_path} | options
    if file_type.lower() == "csv" and str(options.get("header", "true")).lower() == "true":
        listed = matching_files(spark, landing_path, file_pattern) if files is None else files
        headers = csv_headers(listed, options.get("sep", options.get("delimiter", ",")))
        layouts = [row.header for row in headers.groupBy("header").count().collect()]
        if len(layouts) > 1:
            groups = [_paths(headers.filter(F.col("header") == layout)) for layout in layouts]
            return [scan(spark, paths, "csv", options) for paths in groups]
    if files is not None:
        return [scan(spark, _paths(files), file_type, options, schema)]
    globbed = {"pathGlobFilter": hadoop_glob(file_pattern)} | options
    globbed.pop("basePath", None)
    return [scan(spark, landing_path, file_type, globbed, schema)]


def _paths(files: DataFrame) -> list[str]:
    return [row.path for row in files.select("path").collect()]


def csv_headers(files: DataFrame, separator: str = ",") -> DataFrame:
    """(path, header) of each listed CSV file; tasks read the first line only.

    The function shipped to the workers imports what it needs by itself, so
    this package need not be installed there.
    """

    def first_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import csv
        import io
        from urllib.parse import quote, unquote

        from pyarrow import fs

        for batch in batches:
            headers = []
            for path in batch["path"]:
                files, inner = fs.FileSystem.from_uri(quote(path, safe=":/@"))
                with files.open_input_stream(unquote(inner), compression="detect") as stream:
                    text = io.TextIOWrapper(stream, encoding="utf-8-sig", newline="")
                    headers.append("\x1f".join(next(csv.reader(text, delimiter=separator), [])))
            batch["header"] = headers
            yield batch

    return files.select("path").mapInPandas(first_lines, "path string, header string")


def union_scans(scans: list[DataFrame]) -> DataFrame:
    """Union by name; a column absent from some files is NULL there."""
    return reduce(lambda done, more: done.unionByName(more, allowMissingColumns=True), scans)
