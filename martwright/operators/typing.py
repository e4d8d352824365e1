"""Metadata-driven typing of all-text rows, and the required-field check.

One scan serves every column: failures are gathered per row in an array and
exploded, instead of one filter per column over the same input.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.functions.casting import failed_cast, parse_type, tolerant_cast
from martwright.functions.columns import reorder_columns
from martwright.functions.lineage import LINEAGE_COLUMNS, quoted
from martwright.sources.files import MALFORMED_LINE

# Reasons, and the columns a reject carries.
CAST_FAILED = "DATATYPE_CAST_FAILED"
REQUIRED_NULL = "REQUIRED_COLUMN_NULL"
MALFORMED = "MALFORMED_LINE"
FAILURE_COLUMNS = ("failed_column", "expected_data_type", "actual_value", "rejection_reason")
_FAILURE = "__failure"


@dataclass(frozen=True)
class Field:
    """One line of the expected-schema metadata."""

    name: str
    data_type: str
    date_format: str | None = None
    nullable: bool = True


@dataclass(frozen=True)
class TypedSplit:
    """``valid`` and ``rejected`` are lazy and read the same input.

    ``rejected`` has one row per failing (row, column).
    """

    valid: DataFrame
    rejected: DataFrame


def as_fields(schema: DataFrame | Iterable[Field]) -> list[Field]:
    """Fields from a metadata table (standard_column, data_type, ...) or as given."""
    if not isinstance(schema, DataFrame):
        return list(schema)
    if "column_order" in schema.columns:
        schema = schema.orderBy("column_order")
    rows = [row.asDict() for row in schema.collect()]
    return [
        Field(r["standard_column"], r["data_type"], r.get("date_format"), r.get("nullable", True))
        for r in rows
    ]


def cast_split(df: DataFrame, schema: DataFrame | Iterable[Field]) -> TypedSplit:
    """Type the columns; rows with a value that does not parse are rejected."""
    fields = as_fields(schema)
    return _split(df, fields, _parsed_columns(df, fields), required=False)


def required_split(df: DataFrame, schema: DataFrame | Iterable[Field]) -> TypedSplit:
    """Reject rows with a NULL in a non-nullable column."""
    failures = _required_failures(as_fields(schema))
    return TypedSplit(
        valid=df.filter(_none_of(failures)),
        rejected=_exploded(df.filter(~_none_of(failures)), failures, df.columns),
    )


def typed_split(df: DataFrame, schema: DataFrame | Iterable[Field]) -> TypedSplit:
    """Cast, then required check on the rows that cast; source values in the rejects.

    Where the scan kept malformed lines (a column ``MALFORMED_LINE``), those are
    rejected first, once each and with the whole line; valid rows lack the column.
    """
    fields = as_fields(schema)
    if MALFORMED_LINE in df.columns and MALFORMED_LINE not in [f.name for f in fields]:
        split = _split(df, fields, _parsed_columns(df, fields), True, F.col(MALFORMED_LINE).isNotNull())
        return TypedSplit(split.valid.drop(MALFORMED_LINE), split.rejected)
    return _split(df, fields, _parsed_columns(df, fields), required=True)


Failure = tuple[Field, Column, str]


def _split(
    df: DataFrame, fields: list[Field], parsed: dict[str, str], required: bool, malformed: Column | None = None
) -> TypedSplit:
    rows = _with_parsed(df, fields, parsed)
    casts = [
        (f, failed_cast(f.name, F.col(parsed[f.name])), CAST_FAILED)
        for f in fields
        if f.name in parsed
    ]
    gaps = _required_failures(fields) if required else []
    lines = []
    if malformed is not None:
        lines = [(Field(MALFORMED_LINE, "line of its header's fields"), malformed, MALFORMED)]
        casts = [(field, ~malformed & broken, reason) for field, broken, reason in casts]
        gaps = [(field, ~malformed & gap, reason) for field, gap, reason in gaps]
    castable = _none_of(casts)
    only_castable = [(field, castable & gap, reason) for field, gap, reason in gaps]
    passed = _none_of(lines) & castable & _none_of(gaps)
    return TypedSplit(
        valid=_typed(rows.filter(passed), df, fields, parsed),
        rejected=_exploded(rows.filter(~passed), lines + casts + only_castable, df.columns),
    )


def _parsed_columns(df: DataFrame, fields: list[Field]) -> dict[str, str]:
    """Helper column per column that can fail: present, and its type really changes."""
    return {
        f.name: f"__parsed_{position}"
        for position, f in enumerate(fields)
        if f.name in df.columns and _can_fail(df.schema[f.name].dataType, f)
    }


def _can_fail(source: T.DataType, field: Field) -> bool:
    target = parse_type(field.data_type)
    return source != target and not isinstance(target, T.StringType)


def _with_parsed(df: DataFrame, fields: list[Field], parsed: dict[str, str]) -> DataFrame:
    """Rows with the parsed values next to the source values.

    A plain projection would be merged with the filter that follows, and every
    value parsed once for each; a generator of one struct is not.
    """
    if not parsed:
        return df
    values = [
        tolerant_cast(f.name, f.data_type, f.date_format).alias(parsed[f.name])
        for f in fields
        if f.name in parsed
    ]
    return df.select("*", F.inline(F.array(F.struct(*values))))


def _required_failures(fields: list[Field]) -> list[Failure]:
    return [
        (f, F.col(quoted(f.name)).isNull(), REQUIRED_NULL)
        for f in fields
        if not f.nullable and f.name not in LINEAGE_COLUMNS
    ]


def _none_of(failures: list[Failure]) -> Column:
    return reduce(lambda ok, failure: ok & ~failure[1], failures, F.lit(True))


def _typed(rows: DataFrame, df: DataFrame, fields: list[Field], parsed: dict[str, str]) -> DataFrame:
    """Metadata columns typed and in metadata order, then the others."""
    by_name = {f.name: f for f in fields}

    def value(name: str) -> Column:
        if name in parsed:
            return F.col(parsed[name]).alias(name)
        if name in by_name and df.schema[name].dataType != parse_type(by_name[name].data_type):
            return tolerant_cast(name, by_name[name].data_type)
        return F.col(quoted(name))

    return rows.select(*[value(name) for name in reorder_columns(df, by_name).columns])


def _exploded(failing: DataFrame, failures: list[Failure], columns: list[str]) -> DataFrame:
    """One row per failure of the failing rows, the row's own columns first."""
    kept = [F.col(quoted(name)) for name in columns]
    if not failures:
        details = [F.lit(None).cast("string").alias(name) for name in FAILURE_COLUMNS]
        return failing.filter(F.lit(False)).select(*kept, *details)
    entries = F.explode(F.array(*[_entry(*failure) for failure in failures])).alias(_FAILURE)
    details = [F.col(f"{_FAILURE}.{name}").alias(name) for name in FAILURE_COLUMNS]
    exploded = failing.select(*kept, entries).filter(F.col(_FAILURE).isNotNull())
    return exploded.select(*kept, *details)


def _entry(field: Field, broken: Column, reason: str) -> Column:
    values = (
        F.lit(field.name),
        F.lit(field.data_type),
        F.col(quoted(field.name)).cast("string"),
        F.lit(reason),
    )
    named = [value.alias(name) for value, name in zip(values, FAILURE_COLUMNS, strict=True)]
    return F.when(broken, F.struct(*named))
