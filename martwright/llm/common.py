"""Small helpers the operators share."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martwright.functions.lineage import quoted
from martwright.session import work_dir

# Texts of one slice that a task holds as Python objects at a time.
SLICE_BYTES = 4 << 20
SLICE_ROWS = 2048

Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def picked(docs: DataFrame, **columns: str) -> DataFrame:
    """Only the columns an operator reads, under its own names.

    Other columns, whatever their names, never reach the operator.
    """
    return docs.select(*(F.col(quoted(source)).alias(name) for name, source in columns.items()))


def shared_path(spark: SparkSession, label: str) -> str:
    """A new folder below the one that all executors share."""
    return f"{work_dir(spark)}/martwright/{label}-{uuid4().hex}"


def written(df: DataFrame, label: str, codec: str = "snappy") -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage, survives lost executors."""
    path = shared_path(df.sparkSession, label)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(docs: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``docs`` written once with a row number that stays, and the number's column (a name not in use)."""
    row = "_row"
    while row in docs.columns:
        row = f"_{row}"
    return written(docs.withColumn(row, F.monotonically_increasing_id()), label), row


# Row numbers known to be fewer than this are broadcast (8 bytes each and overhead).
BROADCAST_ROWS = 1_000_000


def without(docs: DataFrame, row: str, dropped: DataFrame) -> DataFrame:
    """``docs`` but for the rows whose numbers are in ``dropped``, and without the number's column."""
    gone = written(dropped.select(F.col(dropped.columns[0]).alias(row)), "dropped")
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone
    return docs.join(gone, row, "left_anti").drop(row)


# Groups that a join may broadcast. Their rows must be of fixed width, a few longs each.
HELD_GROUPS = 1_000_000


def held(groups: DataFrame) -> bool:
    """Whether ``groups``, written, may be broadcast."""
    return groups.count() <= HELD_GROUPS


def matched(rows: DataFrame, groups: DataFrame, keys: list[str], weight: str, total: int) -> DataFrame:
    """``rows`` joined with ``groups`` (written, one line a key; ``weight`` of the ``total`` rows have it).

    Groups are broadcast if their count allows it. Beyond that only those with a
    share of 1 / ``HELD_GROUPS`` or more are, which no more than ``HELD_GROUPS``
    can have; the others are joined by shuffle, where none of them is hot.
    """
    if held(groups):
        return rows.join(F.broadcast(groups), keys)
    share = F.col(weight).cast("decimal(38,0)") * HELD_GROUPS
    hot, rest = groups.where(share >= total), groups.where(share < total)
    others = rows.join(F.broadcast(hot.select(keys)), keys, "left_anti")
    return rows.join(F.broadcast(hot), keys).unionByName(others.join(rest.hint("merge"), keys))


def partitions_for(df: DataFrame, rows: int, rows_each: int) -> int:
    """Partitions with at most about ``rows_each`` rows each, and no fewer than the session's."""
    session = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(session, -(-rows // rows_each))


def sliced(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with their texts as UTF-8 bytes; null counts as empty."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(column).cast(pa.large_binary())
        ends = _ends(texts)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = int(np.searchsorted(ends, before + SLICE_BYTES, side="right"))
            stop = min(max(stop, start + 1), start + SLICE_ROWS, batch.num_rows)
            part = texts.slice(start, stop - start)
            yield batch.slice(start, stop - start), [b"" if t is None else t for t in part.to_pylist()]
            start = stop


def _ends(texts: pa.Array) -> np.ndarray:
    sizes = pc.fill_null(pc.binary_length(texts), 0)
    return np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once a session, unless their search path holds it."""
    root, context = Path(__file__).parents[2], spark.sparkContext
    if str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or context.applicationId in _SHIPPED:
        return
    package = Path(__file__).parents[1].name
    archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='package-')}/{package}", "zip", root, package)
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def mapped(df: DataFrame, function: Batches, schema: str | StructType) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(released(function), schema)


def released(function: Batches) -> Batches:
    """``function``; at a task's end its worker, which is kept, gives memory that it no longer uses back to the system."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            pa.default_memory_pool().release_unused()
            pa.system_memory_pool().release_unused()

    return run


def ragged(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows of the given lengths laid end to end: starts, and the row of each element."""
    lengths = np.asarray(lengths, np.int64)
    starts = np.cumsum(lengths) - lengths
    return starts, np.repeat(np.arange(len(lengths)), lengths)


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = np.asarray(values, np.uint64).copy()
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x
