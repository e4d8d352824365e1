"""Table sinks: append, overwrite, evolving append, upsert."""

from __future__ import annotations

from functools import reduce
from urllib.parse import quote
from uuid import uuid4

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.functions.lineage import quoted
from martwright.operators.quality import duplicate_rows
from martwright.operators.staging import NESTED, PARQUET_OPTIONS, Staged, broadcast_within, stage
from martwright.sources.tables import full_name

MODES = ("append", "overwrite", "merge")

# Up to so many touched partitions are named in the scan's filter, so that the
# others are not even listed; beyond, the join alone picks them.
LISTED_PARTITIONS = 10_000

# A table that is merged by key may be laid out in buckets: partitions by a hash of the keys, so that
# a merge rewrites only the buckets its own keys fall in. Keys and number are properties of the table.
BUCKET = "_merge_bucket"
BUCKETED_BY = "martwright.merge_keys"
BUCKETS = 32

# Folder names of table versions that merges and overwrites made begin with this.
VERSIONS = "_versions-"

# How a source's load type becomes a sink mode.
LOAD_POLICY = {"FULL": "overwrite", "INCREMENTAL": "merge", "CDC": "merge"}


def write_table(
    df: DataFrame,
    name: str,
    mode: str = "append",
    merge_schema: bool = False,
    merge_keys: list[str] | None = None,
    partition_by: list[str] | None = None,
) -> dict[str, object]:
    """Write to a catalog table by one of MODES.

    Columns that the table lacks are added with ``merge_schema``. Without it an
    append refuses them, and a merge leaves them out and names them in its result.
    """
    if mode not in MODES:
        raise ValueError(f"unsupported mode: {mode}")
    spark = df.sparkSession
    table = full_name(spark, name)
    if mode == "merge":
        if merge_schema:
            add_missing_columns(df, table)
        left_out = unknown_columns(df, spark.table(table))
        upsert(df, table, merge_keys or [])
        if left_out:
            return {"status": "SUCCESS", "mode": mode, "table": table, "left_out": left_out}
    else:
        _save(df, table, mode, merge_schema, partition_by or [])
    return {"status": "SUCCESS", "mode": mode, "table": table}


def load_mode(load_type: str | None) -> str:
    """Sink mode of a load type; none given means a full load."""
    chosen = (load_type or "FULL").strip().upper()
    if chosen not in LOAD_POLICY:
        raise ValueError(f"unsupported load type: {load_type}")
    return LOAD_POLICY[chosen]


def _save(df: DataFrame, table: str, mode: str, merge_schema: bool, partition_by: list[str]) -> None:
    absent = [name for name in partition_by if name not in df.columns]
    if absent:
        raise ValueError(f"partition columns not found: {absent}")
    spark = df.sparkSession
    exists = spark.catalog.tableExists(table)
    if mode == "append" and exists:
        if merge_schema:
            add_missing_columns(df, table)
            df = _aligned(df, spark.table(table))
        partition_by = partition_by or partition_columns(spark, table)
    writer = df.write.mode(mode).options(**PARQUET_OPTIONS).partitionBy(*partition_by)
    if exists and mode == "overwrite" and VERSIONS in _location(spark, table):
        # Its own folder still holds what it held before a merge: overwrite as a new version too.
        writer = writer.option("path", _new_version(spark, table))
    try:
        writer.saveAsTable(table)
    except PySparkException as problem:
        if problem.getCondition() != "LOCATION_ALREADY_EXISTS":
            raise
        # A table of this name was merged, and dropped, before.
        writer.option("path", _new_version(spark, table)).saveAsTable(table)


def overwrite_in_buckets(df: DataFrame, name: str, keys: list[str], buckets: int = BUCKETS) -> None:
    """Write a table anew in ``buckets`` partitions by its merge keys, each in few files."""
    spark = df.sparkSession
    placed = df.drop(BUCKET).withColumn(BUCKET, bucket_of(df.drop(BUCKET), keys, buckets))
    write_table(placed.hint("rebalance", F.col(BUCKET)), name, "overwrite", partition_by=[BUCKET])
    properties = f"'{BUCKETED_BY}' = {_literal(','.join(keys))}, '{BUCKETED_BY}.buckets' = '{buckets}'"
    spark.sql(f"ALTER TABLE {full_name(spark, name)} SET TBLPROPERTIES ({properties})")


def bucket_of(df: DataFrame, keys: list[str], buckets: int) -> Column:
    """A row's bucket. Rows with a NULL key match nothing; they are dealt by their other values."""
    flat = [F.col(quoted(f.name)) for f in df.schema if not isinstance(f.dataType, NESTED)]
    columns = [F.col(quoted(key)) for key in keys]
    missing = reduce(Column.__or__, [column.isNull() for column in columns])
    place = F.when(missing, F.xxhash64(*flat)).otherwise(F.xxhash64(*columns))
    return F.pmod(place, F.lit(buckets)).cast("int")


def _bucket_layout(spark: SparkSession, table: str) -> tuple[list[str], int] | None:
    """Keys and number of a table's buckets."""
    found = {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    if BUCKETED_BY not in found or partition_columns(spark, table) != [BUCKET]:
        return None
    return found[BUCKETED_BY].split(","), int(found[f"{BUCKETED_BY}.buckets"])


def add_missing_columns(df: DataFrame, table: str) -> None:
    """Columns the table lacks are added to it; rows already there read NULL."""
    spark = df.sparkSession
    new = [f"{quoted(f.name)} {f.dataType.simpleString()}" for f in df.schema if f.name in unknown_columns(df, spark.table(table))]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(new)})")


def unknown_columns(df: DataFrame, target: DataFrame) -> list[str]:
    """Columns that the target lacks, by name as the session compares names."""
    fold = str if target.sparkSession.conf.get("spark.sql.caseSensitive") == "true" else str.lower
    known = {fold(name) for name in target.columns}
    return [name for name in df.columns if fold(name) not in known]


def _aligned(df: DataFrame, target: DataFrame) -> DataFrame:
    """Columns of ``target`` in its order, NULL where ``df`` has none."""
    return df.unionByName(target.limit(0), allowMissingColumns=True).select(
        *[F.col(quoted(name)) for name in target.columns]
    )


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [column.name for column in spark.catalog.listColumns(table) if column.isPartition]


def _provider(spark: SparkSession, table: str) -> str:
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    return details.filter("col_name = 'Provider'").first().data_type.lower()


def merged(target: DataFrame, source: DataFrame, keys: list[str], size: int | None) -> DataFrame:
    """``source`` over ``target`` by key: matched rows replaced, others added.

    NULL keys match nothing, so NULL-key rows of both sides stay. A source
    measured small is broadcast, which spares shuffling the target.
    """
    changed = broadcast_within(source.select(*keys), size)
    kept = target.join(changed, keys, "left_anti").select(*target.columns)
    return kept.unionByName(source)


def touched_partitions(
    target: DataFrame, source: DataFrame, keys: list[str], partitions: list[str], by_key: bool = False
) -> DataFrame:
    """The partitions that a merge of ``source`` changes: its own, and those of the rows it replaces.

    If the keys cover the partition columns, or determine them (``by_key``), a
    replaced row is in a partition of its own source row; else only the target's
    keys and partition columns are read.
    """
    own = source.select(*partitions)
    if by_key or set(partitions) <= set(keys):
        return own.distinct()
    changed = stage(source.select(*keys).na.drop().distinct(), "changed-keys")
    found = target.select(*dict.fromkeys([*keys, *partitions])).join(
        broadcast_within(changed.frame, changed.bytes), keys, "left_semi"
    )
    return own.unionByName(found.select(*partitions)).distinct()


def within_partitions(target: DataFrame, touched: Staged, partitions: list[str]) -> DataFrame:
    """All rows of the target in the ``touched`` partitions; NULL is a partition like any other."""
    candidates = target
    if touched.rows <= LISTED_PARTITIONS:
        values = touched.frame.collect()
        for position, name in enumerate(partitions):
            column, present = F.col(quoted(name)), {row[position] for row in values}
            listed = column.isin(list(present - {None}))
            candidates = candidates.filter(listed | column.isNull() if None in present else listed)
    wanted = broadcast_within(touched.frame, touched.bytes).toDF(*[f"touched_{k}" for k in range(len(partitions))])
    same = [F.col(quoted(name)).eqNullSafe(F.col(f"touched_{k}")) for k, name in enumerate(partitions)]
    return candidates.join(wanted, reduce(Column.__and__, same), "left_semi").select(*target.columns)


def upsert(source: DataFrame, table: str, keys: list[str]) -> int:
    """Merge ``source`` into ``table``; returns the number of source rows.

    The source must have every column of the target (but for the bucket) and takes
    their types; others are left out. It is staged, since the merge reads it several times. Formats with row-level
    commands run MERGE INTO. Of a partitioned parquet table only the partitions
    with replaced or new rows are rewritten; they change when the write is
    committed. If it is laid out in buckets by these keys, these are found without
    reading it. A table without partitions is written as a new version
    that it is then pointed to.
    """
    if not keys:
        raise ValueError("merge needs merge_keys")
    spark = source.sparkSession
    target = spark.table(table)
    layout = _bucket_layout(spark, table)
    fields = [f for f in target.schema.fields if not layout or f.name != BUCKET]
    typed = source.select(*[F.col(quoted(f.name)).cast(f.dataType).alias(f.name) for f in fields])
    if layout:
        # By the values as the table has them, or a key would land in another bucket.
        typed = typed.withColumn(BUCKET, bucket_of(typed, *layout)).select(*target.columns)
    staged = stage(typed, "upsert")
    rows, size = staged.frame, staged.bytes
    _require_single_match(rows, target, keys)
    if _provider(spark, table) != "parquet":
        rows.createOrReplaceTempView(view := f"upsert_{uuid4().hex}")
        spark.sql(merge_statement(table, view, keys))
        return staged.rows
    partitions = partition_columns(spark, table)
    if partitions:
        by_key = layout is not None and layout[0] == keys
        touched = stage(touched_partitions(target, rows, keys, partitions, by_key), "touched")
        affected = within_partitions(target, touched, partitions)
        _replace_partitions(merged(affected, rows, keys, size), table, touched, partitions)
    else:
        _repoint(merged(target, rows, keys, size), table)
    return staged.rows


def merge_statement(table: str, source_view: str, keys: list[str]) -> str:
    matched = " AND ".join(f"t.{quoted(key)} = s.{quoted(key)}" for key in keys)
    return (
        f"MERGE INTO {table} t USING {source_view} s ON {matched} "
        "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )


def _require_single_match(source: DataFrame, target: DataFrame, keys: list[str]) -> None:
    """Refuse a source key that occurs twice and matches: which row wins is undefined.

    The target is read only if the source does repeat a key.
    """
    repeated = stage(duplicate_rows(source, keys).select(*keys), "repeated")
    if not repeated.rows:
        return
    found = broadcast_within(repeated.frame, repeated.bytes)
    if not target.select(*keys).join(found, keys, "left_semi").isEmpty():
        raise ValueError(f"several source rows match one target row on {keys}")


def _location(spark: SparkSession, table: str) -> str:
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    return details.filter("col_name = 'Location'").first().data_type.rstrip("/")


def _new_version(spark: SparkSession, table: str) -> str:
    """A folder beside the table's own, never inside it."""
    base = spark.sql(f"DESCRIBE DATABASE {table.rsplit('.', 1)[0]}").filter("info_name = 'Location'").first()
    return f"{base.info_value.rstrip('/')}/{VERSIONS}{table.rsplit('.', 1)[-1].strip('`')}/{uuid4().hex}"


def _repoint(df: DataFrame, table: str) -> None:
    """New version in its own folder, then one catalog change.

    The version before it stays, for running readers; older ones are deleted.
    """
    spark = df.sparkSession
    before, location = _location(spark, table), _new_version(spark, table)
    df.write.options(**PARQUET_OPTIONS).parquet(location)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
    spark.catalog.refreshTable(table)
    _drop_versions(spark, location, keep={location.rsplit("/", 1)[-1], before.rsplit("/", 1)[-1]})


def overwrite_by_flag(df: DataFrame, flag: str, tables: dict[bool, tuple[str, list[str]]]) -> None:
    """Overwrite two tables by one write: each row goes to the table that its ``flag`` names, with that one's columns.

    The rows are written once, partitioned by the flag, as a new version that both
    tables are then pointed to, one catalog change each.
    """
    spark = df.sparkSession
    names = {value: full_name(spark, name) for value, (name, _) in tables.items()}
    for value, (_, columns) in tables.items():
        _shaped(spark, names[value], df.select(*[F.col(quoted(c)) for c in columns]).schema)
    before = {_version_of(_location(spark, table)) for table in names.values()}
    base = _new_version(spark, next(iter(names.values())))
    df.write.options(**PARQUET_OPTIONS).partitionBy(flag).parquet(base)
    for value, table in names.items():
        location = f"{base}/{flag}={str(value).lower()}"
        path = spark._jvm.org.apache.hadoop.fs.Path(location)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).mkdirs(path)
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
        spark.catalog.refreshTable(table)
    _drop_versions(spark, base, keep={base.rsplit("/", 1)[-1], *before})


def _shaped(spark: SparkSession, table: str, schema: T.StructType) -> None:
    """Make an empty table of these columns unless there is one just like it."""
    if spark.catalog.tableExists(table) and _provider(spark, table) == "parquet" and not partition_columns(spark, table):
        if [(f.name, f.dataType) for f in spark.table(table).schema] == [(f.name, f.dataType) for f in schema]:
            return
    _save(spark.createDataFrame([], schema), table, "overwrite", False, [])


def _version_of(location: str) -> str:
    """The folder of a version that a location lies in."""
    return location.split(VERSIONS, 1)[-1].split("/")[1] if VERSIONS in location else ""


def _drop_versions(spark: SparkSession, location: str, keep: set[str]) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(location).getParent()
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    for status in files.listStatus(path):
        if status.getPath().getName() not in keep:
            files.delete(status.getPath(), True)


def _replace_partitions(df: DataFrame, table: str, touched: Staged, partitions: list[str]) -> None:
    """Overwrite the partitions that ``df`` has rows for, and drop the touched ones that it leaves empty.

    Staged first, since a table cannot be overwritten while it is read. The
    overwrite mode is a session setting, so the write has a session of its own.
    """
    spark = df.sparkSession
    target = spark.table(table)
    staged = stage(df.select(*target.columns), "merged")
    filled = staged.frame.select(*partitions).distinct()
    writing = spark.newSession()
    writing.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    rows = writing.read.schema(target.schema).parquet(staged.path)
    rows.hint("rebalance", *[F.col(quoted(name)) for name in partitions]).write.insertInto(table, overwrite=True)
    for row in touched.frame.exceptAll(filled).toLocalIterator():
        spec = ", ".join(f"{quoted(n)} = {_literal(v)}" for n, v in zip(partitions, row, strict=True))
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
    spark.catalog.refreshTable(table)


def repoint_partition(df: DataFrame, table: str, name: str, value: str) -> None:
    """One partition anew in a folder of its own, by one catalog change.

    The files before stay for running readers; older versions are deleted.
    """
    spark = df.sparkSession
    location = f"{_new_version(spark, table).rsplit('/', 1)[0]}/{quote(f'{name}={value}', safe='')}/{uuid4().hex}"
    spec = f"PARTITION ({quoted(name)} = {_literal(value)})"
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {spec}").filter("col_name = 'Location'")
    before = details.first().data_type.rstrip("/")
    df.drop(name).write.parquet(location)
    spark.sql(f"ALTER TABLE {table} {spec} SET LOCATION '{location}'")
    spark.catalog.refreshTable(table)
    _drop_versions(spark, location, keep={location.rsplit("/", 1)[-1], before.rsplit("/", 1)[-1]})


def _literal(value: object) -> str:
    if value is None:
        return "NULL"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"
