"""Landing folders as DataFrames, and the ledger of files already loaded."""

from __future__ import annotations

import fnmatch

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.functions.lineage import file_name_of


def file_listing(spark: SparkSession, landing_path: str, file_pattern: str = "*") -> DataFrame:
    """The matching files of a folder, oldest first."""
    return matching_files(spark, landing_path, file_pattern).orderBy("modification_time", "path")


def matching_files(spark: SparkSession, landing_path: str, file_pattern: str = "*") -> DataFrame:
    """(path, file_name, modification_time, length), in no order.

    The pattern is a glob on the base name, upper and lower case alike. Names
    that begin with ``_`` or ``.`` are hidden files to Spark and never listed.
    The content column is pruned, so no file is opened; the coalesce keeps the
    number of tasks to the cluster's cores rather than to the bytes listed.
    """
    files = spark.read.format("binaryFile").load(landing_path)
    base_name = F.element_at(F.split("path", "/"), -1)
    return (
        files.filter(F.lower(base_name).rlike(fnmatch.translate(file_pattern.lower())))
        .select(
            "path",
            file_name_of(F.col("path")).alias("file_name"),
            F.col("modificationTime").alias("modification_time"),
            "length",
        )
        .coalesce(spark.sparkContext.defaultParallelism)
    )


def hadoop_glob(file_pattern: str) -> str:
    """The same pattern for Spark's own path filter, which minds case."""
    inside, glob = False, []
    for char in file_pattern:
        if inside:
            inside = char != "]"
            glob.append(char.lower() + char.upper() if char.isalpha() else char)
        elif char == "[":
            inside = True
            glob.append(char)
        elif char in "{}":
            glob.append(f"\\{char}")
        else:
            glob.append(f"[{char.lower()}{char.upper()}]" if char.isalpha() else char)
    return "".join(glob).replace("[!", "[^")


# One line per source, file and state: STARTED before a file's rows are written, LOADED after,
# VALIDATING before the validated table changes, VALIDATED after. ``compacted`` makes it one line per file.
LEDGER_COLUMNS = ("path", "modification_time", "file_name", "length")
STARTED, LOADED, VALIDATING, VALIDATED = STATES = ("STARTED", "LOADED", "VALIDATING", "VALIDATED")
FILE_KEY = ["path", "modification_time"]


def unloaded(listing: DataFrame, ledger: DataFrame, source_name: str | None = None) -> DataFrame:
    """Files of the listing not yet loaded by the ledger; a rewritten file is new.

    Sources may share a folder: what one has loaded is still new to another.
    """
    own = ledger if source_name is None else ledger.filter(F.col("source_name") == source_name)
    return listing.join(own.filter(F.col("state") != STARTED), FILE_KEY, "left_anti")


def ledger_rows(files: DataFrame, source_name: str, run_id: str | None, state: str) -> DataFrame:
    """Ledger lines for files of one load, or, without a ``run_id``, of the loads that the files name."""
    return files.select(
        *LEDGER_COLUMNS,
        F.lit(source_name).alias("source_name"),
        (F.col("run_id") if run_id is None else F.lit(run_id)).alias("run_id"),
        F.lit(state).alias("state"),
    )


def interrupted(ledger: DataFrame, source_name: str) -> DataFrame:
    """Lines of loads that started but were never confirmed."""
    own = ledger.filter(F.col("source_name") == source_name)
    loaded = own.filter(F.col("state") != STARTED).select(*FILE_KEY)
    return own.filter(F.col("state") == STARTED).join(loaded, FILE_KEY, "left_anti")


def _by_load(ledger: DataFrame) -> DataFrame:
    """One line per file and run: the last state, when it was noted, and when the load began and ended."""
    place = F.array_position(F.array(*map(F.lit, STATES)), F.col("state"))

    def noted(state: str, kept: str) -> Column:
        at = F.when(F.col("state") == state, F.col("noted_at"))
        return F.coalesce(F.col(kept), at) if kept in ledger.columns else at

    loads = ledger.groupBy(*FILE_KEY, "file_name", "length", "source_name", "run_id").agg(
        F.max(place).cast("int").alias("place"),
        F.max("noted_at").alias("noted_at"),
        F.min(noted(STARTED, "started_at")).alias("started_at"),
        F.max(noted(LOADED, "loaded_at")).alias("loaded_at"),
    )
    return loads.withColumn("state", F.element_at(F.array(*map(F.lit, STATES)), F.col("place")))


def compacted(ledger: DataFrame, source_name: str) -> DataFrame:
    """A source's lines, one for each file that has been loaded: its last state, with the times of its load.

    Lines of loads that were only started stay as they are.
    """
    own = ledger.filter(F.col("source_name") == source_name)
    loads = _by_load(own)
    last = F.max(F.struct("place", "noted_at", *[c for c in loads.columns if c not in (*FILE_KEY, "place", "noted_at")]))
    files = loads.filter(F.col("state") != STARTED).groupBy(*FILE_KEY).agg(last.alias("last")).select(*FILE_KEY, "last.*")
    return files.drop("place").unionByName(interrupted(ledger, source_name), allowMissingColumns=True)


def unvalidated(ledger: DataFrame, source_name: str) -> DataFrame:
    """Loaded files whose rows no validation has written yet, with the days they may have landed on.

    ``first_day`` and ``last_day`` come from the lines before and after the write;
    ``begun`` tells files whose validation began, so that its rows may be there already.
    """
    own = ledger.filter(F.col("source_name") == source_name)
    done = own.filter(F.col("state") == VALIDATED).select(*FILE_KEY)
    loads = _by_load(own).filter(F.col("state").isin(LOADED, VALIDATING)).join(done, FILE_KEY, "left_anti")
    return loads.select(
        *LEDGER_COLUMNS, "source_name", "run_id", "loaded_at",
        F.to_date(F.coalesce("started_at", "loaded_at")).alias("first_day"),
        F.to_date("loaded_at").alias("last_day"),
        (F.col("state") == VALIDATING).alias("begun"),
    )


def landed_after_all(unconfirmed: DataFrame, bronze: DataFrame) -> DataFrame:
    """Interrupted loads whose rows did reach bronze before the interruption."""
    runs = bronze.select(
        F.col("pipeline_run_id").alias("run_id"), F.col("source_file_name").alias("file_name")
    )
    return unconfirmed.join(runs, ["run_id", "file_name"], "left_semi")
