"""The five stages from landing folder to marts, driven by metadata tables.

Stages hand over through tables only, so each can run as a job of its own.
Within a stage the sources' jobs are submitted side by side, so a small source
does not leave the cluster idle. One bad source does not stop the others;
``run_all`` stops at the first stage that is not a full success. Rows read,
written and rejected are observed during the writes, not by jobs of their own;
rows by file are counted in bronze, once after a source's last load. Stages that
shuffle whole tables have the driver collect garbage, so that shuffle files do not pile up.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta
from functools import reduce
from itertools import batched
from threading import Lock
from urllib.parse import unquote, urlsplit
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from martwright.functions.columns import rename_columns
from martwright.functions.enrich import enrich
from martwright.functions.lineage import INGESTED_ON, RUN_ID, SOURCE_FILE, quoted, scanned_file_name
from martwright.operators.bronze import to_bronze
from martwright.operators.quality import PASSED, REJECT_COLUMNS, quality_split
from martwright.operators.schema import SchemaDiff, schema_diff
from martwright.operators.staging import broadcast_within, stage
from martwright.operators.typing import Field, as_fields, typed_split
from martwright.plans.marts import MARTS, over_master
from martwright.plans.star import sales_master, star
from martwright.sinks.audit import RunEntry, log_runs, log_schema_checks, rejected_records
from martwright.sinks.tables import (
    BUCKET,
    BUCKETS,
    add_missing_columns,
    load_mode,
    overwrite_by_flag,
    overwrite_in_buckets,
    partition_columns,
    repoint_partition,
    upsert,
    write_table,
)
from martwright.sources.files import scan_landing, union_scans
from martwright.sources.listing import (
    FILE_KEY,
    LOADED,
    STARTED,
    VALIDATED,
    VALIDATING,
    compacted,
    interrupted,
    landed_after_all,
    ledger_rows,
    matching_files,
    unloaded,
    unvalidated,
)
from martwright.sources.metadata import active_rules, active_sources, column_mapping, table_schema
from martwright.sources.tables import full_name, read_table

# Statuses in results and run log.
SUCCESS, PARTIAL, FAILED = "SUCCESS", "PARTIAL_SUCCESS", "FAILED"

# Sources whose jobs run side by side.
SIDE_BY_SIDE = 4

# Ledger lines that a source may have for each file before they are compacted.
LINES_PER_FILE = 2

# Paths one scan names; a larger delivery is loaded by several scans.
FILES_PER_SCAN = 20_000


@dataclass(frozen=True)
class Flow:
    """Where metadata, audit and gold tables live, and one run's identity."""

    spark: SparkSession
    metadata_schema: str = "metadata"
    audit_schema: str = "audit"
    gold_schema: str = "gold"
    pipeline_name: str = "Sales"
    run_id: str = field(default_factory=lambda: str(uuid4()))
    # Sources share the audit tables, and two appends to one folder must not overlap.
    shared_tables: Lock = field(default_factory=Lock, repr=False, compare=False)
    # The reject log has a lock of its own: it is held while rejects are made.
    shared_rejects: Lock = field(default_factory=Lock, repr=False, compare=False)

    def audit(self, table: str) -> str:
        return f"{self.audit_schema}.{table}"

    def metadata(self, table: str) -> DataFrame:
        return read_table(self.spark, f"{self.metadata_schema}.{table}")

    def sources(self) -> list[Row]:
        return active_sources(self.metadata("ingestion_config")).collect()

    def renames(self, source: str) -> dict[str, str]:
        """New names of a source's standardized columns, where the metadata schema has a ``column_mapping``."""
        if not self.spark.catalog.tableExists(full_name(self.spark, f"{self.metadata_schema}.column_mapping")):
            return {}
        lines = column_mapping(self.metadata("column_mapping"), source).collect()
        return {line.source_column: line.target_column for line in lines}

    def fields(self, source: str) -> list[Field]:
        return as_fields(table_schema(self.metadata("required_schema"), source))

    def entry(self, stage_name: str, source: str, **details) -> RunEntry:
        return RunEntry(
            self.run_id, self.pipeline_name, stage_name, source, start_time=datetime.now(), **details
        )

    def log(self, entries: list[RunEntry]) -> None:
        log_runs(self.spark, entries, self.audit("pipeline_run_log"))


def counted_write(df: DataFrame, name: str, mode: str, keys: list[str] | None = None, buckets: int = 0, **how) -> int:
    """Write and return the number of rows, observed on the way.

    A merge into a table that lacks some of the columns adds them first. A table
    with keys and without partitions is made in ``buckets``, if there are to be any.
    """
    spark = df.sparkSession
    if mode == "merge" and spark.catalog.tableExists(full_name(spark, name)):
        add_missing_columns(df, full_name(spark, name))
        return upsert(df, full_name(spark, name), keys or [])
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if mode != "append" and keys and buckets and not how.get("partition_by"):
        overwrite_in_buckets(counted, name, keys, buckets)
    else:
        write_table(counted, name, "overwrite" if mode == "merge" else mode, **how)
    return seen.get["rows"]


def free_shuffles(spark: SparkSession) -> None:
    """Delete the shuffle files of queries that are done.

    Spark deletes them once their frames are garbage, which a driver with little to do seldom collects.
    """
    spark.sparkContext._jvm.System.gc()


def _side_by_side[T, R](work: Callable[[T], R], items: Iterable[T]) -> list[R]:
    with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
        return list(pool.map(work, items))


def _attempt(entry: RunEntry, work: Callable[[RunEntry], None]) -> RunEntry:
    """Run one source's part of a stage; whatever happens ends in its log entry."""
    try:
        work(entry)
    except Exception as problem:  # noqa: BLE001 - reported in the run log
        entry.status, entry.error_message = FAILED, str(problem)
    entry.end_time = datetime.now()
    return entry


def _summary(stage_name: str, flow: Flow, entries: list[RunEntry], none_is_failed: bool) -> dict:
    failed = sum(entry.status == FAILED for entry in entries)
    status = SUCCESS if not failed else PARTIAL
    if failed and none_is_failed and failed == len(entries):
        status = FAILED
    return {
        "stage": stage_name,
        "run_id": flow.run_id,
        "status": status,
        "processed_tables": len(entries) - failed,
        "failed_tables": failed,
        "rows_read": sum(entry.records_read for entry in entries),
        "rows_written": sum(entry.records_written for entry in entries),
        "rejected_rows": sum(entry.rejected_records for entry in entries),
    }


# --- files to bronze -------------------------------------------------------


def ingest(flow: Flow) -> dict:
    """New files of every source to its bronze table, each file once."""
    loads = _side_by_side(lambda source: _ingest_source(flow, source), flow.sources())
    entries = [entry for load in loads for entry in load]
    flow.log(entries)
    return _summary("ingestion", flow, entries, none_is_failed=False)


def _ingest_source(flow: Flow, source: Row) -> list[RunEntry]:
    started = datetime.now()
    loaded: list[Row] = []
    failed: list[RunEntry] = []
    counted: list[RunEntry] = []

    def load(_: RunEntry) -> None:
        _confirm_interrupted(flow, source)
        for files in _new_files(flow, source):
            done, bad = _load(flow, source, files)
            loaded.extend(done)
            failed.extend(bad)
        _compact_ledger(flow, source)
        counted.extend(_loaded_entries(flow, source, loaded, started))

    entry = _attempt(_file_entry(flow, source, ""), load)
    return [*counted, *failed, *([entry] if entry.status == FAILED else [])]


def _load(flow: Flow, source: Row, files: list[Row]) -> tuple[list[Row], list[RunEntry]]:
    """Load a set of files at once: the files loaded, and log entries of those that can't be read.

    A file that the error names is set aside and the others are tried again; any
    other error ends the load. An error after the rows are in bronze ends it too:
    the next start finds them there and confirms the load.
    """
    bad: list[RunEntry] = []
    while files:
        started = datetime.now()
        listed = flow.spark.createDataFrame(files)
        try:
            _append_to_bronze(flow, source, listed)
        except Exception as problem:  # noqa: BLE001 - reported in the run log
            named = _named_in(str(problem), files)
            if not named or _landed(flow, source, listed, started):
                raise
            for file in named:
                entry = _file_entry(flow, source, file.file_name)
                entry.start_time, entry.end_time = started, datetime.now()
                entry.status, entry.error_message = FAILED, str(problem)
                bad.append(entry)
            files = [file for file in files if file not in named]
            continue
        _note(flow, listed, source, flow.run_id, LOADED)
        return files, bad
    return [], bad


def _named_in(message: str, files: list[Row]) -> list[Row]:
    """The files that an error message tells by path."""
    plain = unquote(message)
    paths = {urlsplit(file.path).path.split("/", 1)[-1]: file for file in files}
    return [file for path, file in paths.items() if re.search(rf"{re.escape(unquote(path))}(?![\w.])", plain)]


def _landed(flow: Flow, source: Row, files: DataFrame, started: datetime) -> bool:
    """Whether rows of these files, loaded in this run, are in bronze."""
    name = full_name(flow.spark, source.bronze_table)
    if not flow.spark.catalog.tableExists(name):
        return False
    flow.spark.catalog.refreshTable(name)
    since = started.date() - timedelta(days=1)
    own = flow.spark.table(name).filter((F.col(INGESTED_ON) >= F.lit(since)) & (F.col(RUN_ID) == flow.run_id))
    return not own.join(files, F.col(SOURCE_FILE) == F.col("file_name"), "left_semi").isEmpty()


def _file_entry(flow: Flow, source: Row, file_name: str) -> RunEntry:
    return flow.entry(
        "Bronze",
        source.source_name,
        source_file_name=file_name,
        source_table=source.landing_path,
        target_table=source.bronze_table,
    )


def _new_files(flow: Flow, source: Row) -> Iterator[list[Row]]:
    """Files to load, oldest first, in sets of at most FILES_PER_SCAN."""
    listing = matching_files(flow.spark, source.landing_path, source.file_pattern)
    ledger = _ledger(flow)
    fresh = stage(unloaded(listing, ledger, source.source_name) if ledger else listing, "landing").frame
    rows = fresh.orderBy("modification_time", "path").toLocalIterator()
    return (list(batch) for batch in batched(rows, FILES_PER_SCAN))


def _ledger(flow: Flow) -> DataFrame | None:
    name = full_name(flow.spark, flow.audit("file_ledger"))
    return flow.spark.table(name) if flow.spark.catalog.tableExists(name) else None


def _note(flow: Flow, files: DataFrame, source: Row, run_id: str | None, state: str) -> None:
    """Ledger lines, in the source's own partition; files of several loads name their runs."""
    lines = ledger_rows(files, source.source_name, run_id, state).withColumn("noted_at", F.current_timestamp())
    with flow.shared_tables:
        new = _ledger(flow) is None
        write_table(lines.coalesce(1), flow.audit("file_ledger"), merge_schema=True, partition_by=["source_name"] if new else None)


def _compact_ledger(flow: Flow, source: Row) -> None:
    """Once a source has over LINES_PER_FILE ledger lines a file, they become one a file."""
    ledger = _ledger(flow)
    if ledger is None or "source_name" not in partition_columns(flow.spark, full_name(flow.spark, flow.audit("file_ledger"))):
        return
    own = ledger.filter(F.col("source_name") == source.source_name)
    files = own.groupBy(*FILE_KEY).agg(F.count(F.lit(1)).alias("lines"))
    size = files.agg(F.count(F.lit(1)).alias("files"), F.sum("lines").alias("lines")).first()
    if (size.lines or 0) <= LINES_PER_FILE * size.files:
        return
    name = full_name(flow.spark, flow.audit("file_ledger"))
    with flow.shared_tables:
        lines = stage(compacted(_ledger(flow), source.source_name), "ledger").frame
        add_missing_columns(lines, name)
        repoint_partition(lines.coalesce(1), name, "source_name", source.source_name)


def _confirm_interrupted(flow: Flow, source: Row) -> None:
    """Settle loads that wrote their rows but stopped before the ledger said so."""
    ledger = _ledger(flow)
    bronze = full_name(flow.spark, source.bronze_table)
    if ledger is None or not flow.spark.catalog.tableExists(bronze):
        return
    open_loads = stage(interrupted(ledger, source.source_name), "interrupted")
    if not open_loads.rows:
        return
    since = open_loads.frame.agg(F.to_date(F.min("noted_at"))).first()[0]
    runs = [row.run_id for row in open_loads.frame.select("run_id").distinct().collect()]
    written = flow.spark.table(bronze).filter((F.col(INGESTED_ON) >= F.lit(since)) & F.col(RUN_ID).isin(runs))
    settled = stage(landed_after_all(open_loads.frame, written), "settled").frame
    for run_id in runs:
        _note(flow, settled.filter(F.col("run_id") == run_id), source, run_id, LOADED)


def _append_to_bronze(flow: Flow, source: Row, files: DataFrame) -> None:
    """One append for a set of files."""
    scans = scan_landing(
        flow.spark,
        source.landing_path,
        source.file_pattern,
        source.file_type,
        files,
        options=source.asDict().get("reader_options"),
        schema=source.asDict().get("source_schema"),
    )
    renames = flow.renames(source.source_name)
    file_name = scanned_file_name(row.path for row in files.select("path").collect())
    bronze = union_scans([_renamed(to_bronze(scan, flow.run_id, source.source_name, file_name), renames) for scan in scans])
    _note(flow, files, source, flow.run_id, STARTED)
    write_table(
        bronze, source.bronze_table, "append", merge_schema=True, partition_by=[INGESTED_ON]
    )


def _renamed(bronze: DataFrame, renames: dict[str, str]) -> DataFrame:
    """Mapped names of one layout; no two of its columns may end with one name."""
    renamed = rename_columns(bronze, renames)
    clashes = sorted(name for name, times in Counter(renamed.columns).items() if times > 1)
    if clashes:
        raise ValueError(f"column names become ambiguous once mapped: {clashes}")
    return renamed


def _loaded_entries(flow: Flow, source: Row, files: list[Row], started: datetime) -> list[RunEntry]:
    """A log line per file."""
    rows = _rows_per_file(flow, source, started.date() - timedelta(days=1)) if files else {}
    entries = []
    for file in files:
        entry = _file_entry(flow, source, file.file_name)
        entry.start_time, entry.end_time = started, datetime.now()
        entry.records_read = entry.records_written = rows.get(file.file_name, 0)
        entries.append(entry)
    return entries


def _rows_per_file(flow: Flow, source: Row, since: date) -> dict[str, int]:
    """Rows of this run by file, counted where they landed; older partitions are pruned."""
    bronze = read_table(flow.spark, source.bronze_table)
    written = bronze.filter((F.col(INGESTED_ON) >= F.lit(since)) & (F.col(RUN_ID) == flow.run_id))
    counts = written.groupBy(SOURCE_FILE).agg(F.count(F.lit(1)).alias("rows")).collect()
    return {row[SOURCE_FILE]: row.rows for row in counts}


# --- bronze to validated ---------------------------------------------------


def validate(flow: Flow) -> dict:
    """Typed, complete rows of every source to its validated table; the rest to the reject log."""

    def run(source: Row) -> RunEntry:
        entry = flow.entry(
            "Schema Validation",
            source.source_name,
            source_table=source.bronze_table,
            target_table=source.validated_table,
        )
        return _attempt(entry, lambda e: _validate_source(flow, source, e))

    entries = _side_by_side(run, flow.sources())
    flow.log(entries)
    return _summary("schema_validation", flow, entries, none_is_failed=False)


def _validate_source(flow: Flow, source: Row, entry: RunEntry) -> None:
    bronze = read_table(flow.spark, source.bronze_table)
    fields = flow.fields(source.source_name)
    _require(flow, source, SchemaDiff(missing=schema_diff(bronze, fields).missing))
    _require(flow, source, schema_diff(typed_split(bronze, fields).valid, fields))
    open_files = _unvalidated_files(flow, source)
    if load_mode(source.load_type) == "overwrite":
        # What is in bronze now is in the table afterwards, should the source's load type change.
        with _noted(flow, source, open_files):
            _write_valid(flow, source, entry, bronze, fields)
    elif open_files:
        for files, rows, begun in _unvalidated_loads(open_files, bronze):
            with _noted(flow, source, files):
                _write_valid(flow, source, entry, rows, fields, again=begun)
    _compact_ledger(flow, source)


@contextmanager
def _noted(flow: Flow, source: Row, files: DataFrame | None) -> Iterator[None]:
    """Ledger lines of the files' validation before and after it."""
    some = files is not None and not files.isEmpty()
    if some:
        _note(flow, files, source, None, VALIDATING)
    yield
    if some:
        _note(flow, files, source, None, VALIDATED)


def _write_valid(
    flow: Flow, source: Row, entry: RunEntry, bronze: DataFrame, fields: list[Field], again: bool = False
) -> None:
    """Valid rows to their table, and the others, if there are any, to the reject log.

    ``again`` tells that a validation of this load began before: what it wrote is
    not written twice. Rows with keys replace themselves; of those without, and of
    rejects, what is there already is left out.
    """
    seen, passed = Observation(), Observation()
    split = typed_split(bronze.observe(seen, F.count(F.lit(1)).alias("rows")), fields)
    keys = [key.strip() for key in (source.merge_keys or "").split(",") if key.strip()]
    valid = split.valid.observe(passed, F.count(F.lit(1)).alias("rows"))
    if again and keys and flow.spark.catalog.tableExists(full_name(flow.spark, source.validated_table)):
        valid = _not_there_yet(valid, read_table(flow.spark, source.validated_table), keys)
    settings = source.asDict()
    layout = {"partition_by": [c.strip() for c in (settings.get("partition_by") or "").split(",") if c.strip()]}
    buckets = settings.get("merge_buckets")
    buckets = BUCKETS if buckets is None else int(buckets)
    written = counted_write(valid, source.validated_table, load_mode(source.load_type), keys, buckets, **layout)
    rejected = seen.get["rows"] - passed.get["rows"]
    if rejected:
        _log_rejects(flow, source, typed_split(bronze, fields).rejected, "Schema Validation", source.validated_table, again)
    entry.records_read += seen.get["rows"]
    entry.records_written += written
    entry.rejected_records += rejected


def _not_there_yet(rows: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Rows but for those without a key whose load (run and file) has such rows in the target.

    A load's rows reach the table by one commit, so one of them stands for all.
    """
    load = [RUN_ID, SOURCE_FILE]
    if not set(load) <= set(target.columns):
        return rows
    keyless = reduce(Column.__or__, [F.col(quoted(key)).isNull() for key in keys])
    there = stage(target.filter(keyless).select(*load).distinct(), "keyless-loads")
    found = broadcast_within(there.frame, there.bytes).withColumn("__there", F.lit(True))
    marked = rows.join(found, load, "left").filter(F.col("__there").isNull() | ~keyless)
    return marked.select(*[F.col(quoted(c)) for c in rows.columns])


def _unvalidated_files(flow: Flow, source: Row) -> DataFrame | None:
    ledger = _ledger(flow)
    return None if ledger is None else stage(unvalidated(ledger, source.source_name), "unvalidated").frame


def _unvalidated_loads(open_files: DataFrame, bronze: DataFrame) -> Iterator[tuple[DataFrame, DataFrame, bool]]:
    """The loads that no validation has finished yet, oldest first: files, bronze rows, and whether one began.

    Whatever run loaded them. Only the partitions of the days they landed on are read.
    """
    loads = open_files.groupBy("run_id").agg(
        F.min("first_day").alias("first"), F.max("last_day").alias("last"), F.min("loaded_at").alias("at"),
        F.max("begun").alias("begun"),
    )
    for load in loads.orderBy("at", "run_id").collect():
        files = open_files.filter(F.col("run_id") == load.run_id)
        days = F.col(INGESTED_ON).between(F.lit(load.first), F.lit(load.last))
        rows = bronze.filter(days & (F.col(RUN_ID) == load.run_id))
        names = files.select(F.col("file_name").alias(SOURCE_FILE)).distinct()
        yield files, rows.join(names, SOURCE_FILE, "left_semi").select(*bronze.columns), load.begun


def _require(flow: Flow, source: Row, diff: SchemaDiff) -> None:
    rows = diff.log_rows(flow.run_id, source.source_name)
    with flow.shared_tables:
        log_schema_checks(flow.spark, rows, flow.audit("schema_validation_log"))
    if not diff.valid:
        raise ValueError(f"schema validation failed: {rows}")


def _log_rejects(
    flow: Flow, source: Row, rejected: DataFrame, stage_name: str, table: str, again: bool = False
) -> None:
    """One write: the rows are made as they are appended.

    ``again`` leaves out those that are logged already; equal rejects have equal ids.
    """
    rows = rejected_records(
        rejected, run_id=flow.run_id, stage=stage_name, table_name=table, source_name=source.source_name
    )
    name = full_name(flow.spark, flow.audit("rejected_records"))
    if again and flow.spark.catalog.tableExists(name):
        own = flow.spark.table(name).filter((F.col("source_name") == source.source_name) & (F.col("pipeline_stage") == stage_name))
        left = rows.join(own.select("rejection_id"), "rejection_id", "left_anti").select(*rows.columns)
        rows = stage(left, "rejects").frame  # not from the table that they go to
    with flow.shared_rejects:
        write_table(rows, flow.audit("rejected_records"))


# --- validated to checked --------------------------------------------------


def check(flow: Flow) -> dict:
    """Rows that pass the source's rules to its checked table, the others to its rejected table."""

    def run(source: Row) -> RunEntry:
        entry = flow.entry(
            "Data Quality",
            source.source_name,
            source_table=source.validated_table,
            target_table=f"{source.checked_table},{source.rejected_table}",
        )
        return _attempt(entry, lambda e: _check_source(flow, source, e))

    entries = _side_by_side(run, flow.sources())
    free_shuffles(flow.spark)
    flow.log(entries)
    return _summary("data_quality", flow, entries, none_is_failed=True)


def _check_source(flow: Flow, source: Row, entry: RunEntry) -> None:
    for column in ("validated_table", "checked_table", "rejected_table"):
        if not source[column]:
            raise ValueError(f"{column} is not configured for {source.source_name}")
    validated = read_table(flow.spark, source.validated_table).drop(BUCKET)
    rules = active_rules(flow.metadata("data_quality_rules"), source.source_name)
    split = quality_split(validated, rules)
    seen = Observation()
    judged = split.judged.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(PASSED).alias("passed"))
    checked = (source.checked_table, validated.columns)
    rejected = (source.rejected_table, [*validated.columns, *REJECT_COLUMNS])
    overwrite_by_flag(judged, PASSED, {True: checked, False: rejected})
    entry.records_read, entry.records_written = seen.get["rows"], seen.get["passed"]
    entry.rejected_records = entry.records_read - entry.records_written
    if entry.rejected_records:
        rejected = read_table(flow.spark, source.rejected_table)
        _log_rejects(flow, source, rejected, "Data Quality", source.rejected_table)
    if split.skipped:
        entry.error_message = f"unknown rules skipped: {split.skipped}"


# --- checked to enriched ---------------------------------------------------


def enrich_all(flow: Flow) -> dict:
    """Derived columns; a source without enrich_table is left as it is."""

    def run(source: Row) -> RunEntry:
        entry = flow.entry(
            "Enrichment",
            source.source_name,
            source_table=source.checked_table,
            target_table=source.enrich_table or source.checked_table,
        )
        return _attempt(entry, lambda e: _enrich_source(flow, source, e))

    entries = _side_by_side(run, flow.sources())
    flow.log(entries)
    return _summary("enrichment", flow, entries, none_is_failed=True)


def _enrich_source(flow: Flow, source: Row, entry: RunEntry) -> None:
    checked = read_table(flow.spark, source.checked_table)
    if source.enrich_table:
        enriched = enrich(checked, source.source_name)
        entry.records_written = counted_write(enriched, source.enrich_table, "overwrite")
        entry.records_read = entry.records_written
    else:
        entry.records_read = checked.count()


# --- enriched to marts -----------------------------------------------------


def _master(flow: Flow) -> DataFrame:
    by_name = {source.source_name: source for source in flow.sources()}
    return sales_master(
        star(
            read_table(flow.spark, by_name["orders"].checked_table),
            read_table(flow.spark, by_name["customer"].enrich_table),
            read_table(flow.spark, by_name["products"].enrich_table),
        )
    )


def build_gold(flow: Flow) -> dict[str, DataFrame]:
    """Sales master and marts as lazy frames over the tables of the last stages."""
    master = _master(flow)
    marts = {name: over_master(master, mart) for name, mart in MARTS.items()}
    return {f"{flow.gold_schema}.{name}": df for name, df in {"sales_master": master, **marts}.items()}


def gold(flow: Flow) -> dict:
    """Write the sales master, then every mart from the written master: no join runs twice.

    Marts in turn: each reads the whole master and fills the cluster by itself, and only one's shuffle is on disk.
    """

    def write(name: str, build: Callable[[], DataFrame]) -> RunEntry:
        target = f"{flow.gold_schema}.{name}"
        entry = flow.entry("Gold", "Multiple", source_table="Curated", target_table=target)

        def work(e: RunEntry) -> None:
            e.records_written = counted_write(build(), target, "overwrite")

        done = _attempt(entry, work)
        free_shuffles(flow.spark)
        return done

    def write_mart(name: str) -> RunEntry:
        master = read_table(flow.spark, f"{flow.gold_schema}.sales_master")
        return write(name, lambda: over_master(master, MARTS[name], ordered=False))

    entries = [write("sales_master", lambda: _master(flow))]
    if entries[0].status == SUCCESS:
        entries += [write_mart(name) for name in MARTS]
    flow.log(entries)
    result = _summary("gold", flow, entries, none_is_failed=True)
    return result | {"status": FAILED if result["failed_tables"] else SUCCESS}


STAGES: dict[str, Callable[[Flow], dict]] = {
    "ingestion": ingest,
    "schema_validation": validate,
    "data_quality": check,
    "enrichment": enrich_all,
    "gold": gold,
}


def run_all(flow: Flow, stages: dict[str, Callable[[Flow], dict]] | None = None) -> dict:
    """Every stage in order; anything short of SUCCESS stops the run."""
    started = datetime.now()
    results = {}
    for name, run in (stages or STAGES).items():
        results[name] = run(flow)
        status = (results[name] or {}).get("status", FAILED)
        if status != SUCCESS:
            raise RuntimeError(f"stage {name} ended with status {status}")
    return {
        "stage": "all",
        "run_id": flow.run_id,
        "status": SUCCESS,
        "stage_results": results,
        "start_time": started,
        "end_time": datetime.now(),
    }
