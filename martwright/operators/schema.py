"""Schema and table checks. Only metadata and counts reach the driver."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.functions.casting import parse_type
from martwright.operators.typing import Field, as_fields


@dataclass(frozen=True)
class SchemaDiff:
    missing: list[str] = field(default_factory=list)
    extra: list[str] = field(default_factory=list)
    # (column, expected type, actual type)
    mismatched: list[tuple[str, str, str]] = field(default_factory=list)

    @property
    def valid(self) -> bool:
        """Extra columns do not invalidate a table."""
        return not self.missing and not self.mismatched

    def log_rows(self, run_id: str, table_name: str) -> list[tuple[str, ...]]:
        """Rows for the schema-validation log."""
        types = [(c, want, got) for c, want, got in self.mismatched]
        absent = [(c, "Present", "Missing") for c in self.missing]
        return [(run_id, table_name, *line, "FAILED") for line in types + absent]


def schema_diff(df: DataFrame, schema: DataFrame | Iterable[Field]) -> SchemaDiff:
    """Expected against actual columns; types compare parsed, so integer is int."""
    expected = {f.name: parse_type(f.data_type) for f in as_fields(schema)}
    actual = {f.name: f.dataType for f in df.schema.fields}
    shared = [name for name in expected if name in actual]
    return SchemaDiff(
        missing=[name for name in expected if name not in actual],
        extra=[name for name in actual if name not in expected],
        mismatched=[
            (name, expected[name].simpleString(), actual[name].simpleString())
            for name in shared
            if expected[name] != actual[name]
        ],
    )


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    return [name for name in required if name not in df.columns]


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    absent = missing_columns(df, required)
    if absent:
        raise RuntimeError(f"missing columns: {absent}")
    return df


def require_table(spark: SparkSession, name: str, minimum_rows: int = 1) -> DataFrame:
    """The table, once it exists with at least ``minimum_rows``; stops counting there."""
    df = spark.table(name)
    found = df.limit(minimum_rows).count()
    if found < minimum_rows:
        raise RuntimeError(f"{name} has {found} rows, expected at least {minimum_rows}")
    return df


def table_report(
    tables: Mapping[str, DataFrame], required: Mapping[str, Iterable[str]], minimum_rows: int = 1
) -> DataFrame:
    """One row per table: row count, absent columns, verdict.

    The branches are counts over one column-free scan each.
    """
    lines = []
    for name, df in tables.items():
        absent = missing_columns(df, required.get(name, ()))
        lines.append(
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"),
                "row_count",
                F.lit(",".join(absent)).alias("missing_columns"),
                ((F.col("row_count") >= minimum_rows) & F.lit(not absent)).alias("passed"),
            )
        )
    report = lines[0]
    for line in lines[1:]:
        report = report.unionByName(line)
    return report
