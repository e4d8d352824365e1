"""Intermediate results written once to the shared work folder.

A staged table survives lost executors, cuts lineage, and its size is known
when the next plan is built, so a broadcast of it is a checked decision.
"""

from __future__ import annotations

from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.functions.lineage import quoted
from martwright.session import work_dir

# Largest relation we hint to broadcast; beyond it Spark shuffles or decides by itself.
BROADCAST_BYTES = 128 * 1024 * 1024
NESTED = (T.StructType, T.ArrayType, T.MapType)
# Packed with zstd at its fastest: texts and hexadecimal ids take up much less disk than with Spark's default.
# A column of many ids gives its dictionary up early: large ones cost more time to look up, in
# writing and in reading, than they save in bytes. Other formats ignore all this.
PARQUET_OPTIONS = {
    "parquet.compression": "zstd",
    "parquet.compression.codec.zstd.level": "1",
    "parquet.dictionary.page.size": str(256 * 1024),
}


def row_bytes(schema: T.StructType) -> Column:
    """Upper bound of a row's size in a broadcast hash table."""
    total = F.lit(64)
    for field in schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            length = F.coalesce(F.octet_length(F.col(quoted(field.name))), F.lit(0))
            total = total + length + 24
        elif isinstance(field.dataType, NESTED):
            raise TypeError(f"no size bound for nested column {field.name}")
        else:
            total = total + 32
    return total.cast("long")


def broadcast_within(df: DataFrame, size: int | None, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint only when the measured ``size`` is within ``limit``."""
    return F.broadcast(df) if size is not None and size <= limit else df


@dataclass(frozen=True)
class Staged:
    """A written frame; ``bytes`` is None where nested columns have no size bound."""

    frame: DataFrame
    path: str
    rows: int
    bytes: int | None


def stage(df: DataFrame, label: str) -> Staged:
    """Write ``df`` to the work folder, measuring it during the write."""
    spark = df.sparkSession
    path = f"{work_dir(spark)}/martwright/{label}-{uuid4().hex}"
    measured = Observation()
    metrics = [F.count(F.lit(1)).alias("rows")]
    if not any(isinstance(f.dataType, NESTED) for f in df.schema.fields):
        metrics.append(F.coalesce(F.sum(row_bytes(df.schema)), F.lit(0)).alias("bytes"))
    df.observe(measured, *metrics).write.options(**PARQUET_OPTIONS).parquet(path)
    frame = spark.read.schema(df.schema).parquet(path)
    return Staged(frame, path, measured.get["rows"], measured.get.get("bytes"))
