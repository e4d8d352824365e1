"""Incremental ingestion: the file source's checkpoint is the ledger, so every
file is loaded exactly once, also across failures and restarts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from martwright.functions.lineage import INGESTED_ON, RUN_ID, SOURCE_FILE, file_name_of
from martwright.operators.bronze import to_bronze
from martwright.operators.staging import stage
from martwright.sinks.tables import write_table
from martwright.sources.files import FORMATS, scan_landing, union_scans
from martwright.sources.listing import hadoop_glob
from martwright.sources.tables import full_name

# Files of one batch into a table: their paths pass through the driver.
FILES_PER_BATCH = 1000
FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def stream_landing(
    spark: SparkSession,
    landing_path: str,
    file_pattern: str,
    file_type: str,
    schema: str,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Landing folder as a stream. ``schema`` is the file layout, in file order.

    Of the ``options``, ``maxFilesPerTrigger`` bounds the files of one batch.
    """
    known = FORMATS.get(file_type.lower())
    if known is None:
        raise ValueError(f"unsupported file type: {file_type}")
    settings = {"pathGlobFilter": hadoop_glob(file_pattern)} | dict(known.options) | dict(options or {})
    settings.pop("inferSchema", None)
    return spark.readStream.format(known.source).schema(schema).options(**settings).load(landing_path)


def ingest_new_files(
    stream: DataFrame, run_id: str, source_system: str, target_path: str, checkpoint: str
) -> StreamingQuery:
    """Bronze rows of the files not seen before, then stop.

    The sink partitions by ingestion date like the batch path. Call
    ``awaitTermination()`` on the result.
    """
    bronze = to_bronze(stream, run_id, source_system)
    return (
        bronze.writeStream.format("parquet")
        .partitionBy(INGESTED_ON)
        .option("path", target_path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_files_into(
    spark: SparkSession,
    landing_path: str,
    file_pattern: str,
    file_type: str,
    stream_id: str,
    source_system: str,
    bronze_table: str,
    checkpoint: str,
    options: Mapping[str, str] | None = None,
    files_per_batch: int = FILES_PER_BATCH,
) -> StreamingQuery:
    """Bronze rows of the files not seen before into a catalog table, then stop.

    The stream is of files, not of rows: a batch reads its own as the batch path
    does, so CSV files may differ in their headers, and new columns reach the table.
    ``stream_id`` stays with the checkpoint; the run of a row is ``stream_id/batch``.
    A batch that had written its rows when the stream stopped comes again on the
    next start, with the same number: files that are in the table are left out.
    Only the first batch of a start can be such a one.
    """
    if file_type.lower() not in FORMATS:
        raise ValueError(f"unsupported file type: {file_type}")
    first = True

    def load(batch: DataFrame, batch_id: int) -> None:
        nonlocal first
        # In the caller's session, not the stream's copy of it: there the table's files would stay unseen.
        run_id, table = f"{stream_id}/{batch_id}", full_name(spark, bronze_table)
        seen = stage(batch.withColumn("file_name", file_name_of(F.col("path"))), "stream-files")
        files = spark.read.schema(seen.frame.schema).parquet(seen.path)
        if first and spark.catalog.tableExists(table):
            landed = spark.table(table).filter(F.col(RUN_ID) == run_id)
            names = landed.select(F.col(SOURCE_FILE).alias("file_name")).distinct()
            files = stage(files.join(names, "file_name", "left_anti"), "stream-files").frame
        first = False
        if files.isEmpty():
            return
        scans = scan_landing(spark, landing_path, file_pattern, file_type, files, options=options)
        bronze = union_scans([to_bronze(scanned, run_id, source_system) for scanned in scans])
        write_table(bronze, bronze_table, "append", merge_schema=True, partition_by=[INGESTED_ON])

    settings = {"pathGlobFilter": hadoop_glob(file_pattern), "maxFilesPerTrigger": str(files_per_batch)}
    files = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).options(**settings).load(landing_path)
    return (
        files.select("path")  # the content is not read
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
