"""Tolerant casts: text that does not parse becomes NULL instead of an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.functions.lineage import quoted


def parse_type(name: str) -> T.DataType:
    """A SQL type name from metadata, e.g. ``integer`` or ``decimal(10, 2)``."""
    return T.DataType.fromDDL(name.strip())


def tolerant_cast(column: str, data_type: str, pattern: str | None = None) -> Column:
    """Typed ``column``, NULL where it does not parse.

    ``pattern`` is honoured for dates and timestamps only.
    """
    target = parse_type(data_type)
    source = F.col(quoted(column))
    if pattern and isinstance(target, (T.DateType, T.TimestampType)):
        return F.try_to_timestamp(source, F.lit(pattern)).cast(target).alias(column)
    return source.try_cast(target).alias(column)


def failed_cast(column: str, typed: Column) -> Column:
    """True where a value was present but did not parse; NULL is no failure."""
    return F.col(quoted(column)).isNotNull() & typed.isNull()
