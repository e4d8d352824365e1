from __future__ import annotations

import json
import random
import re
from pathlib import Path
from urllib.parse import urlsplit
from datetime import datetime

import pyarrow.parquet as pq
import pytest

from martwright.functions.rules import Rule
from martwright.operators.quality import quality_split
from martwright.operators.typing import Field, cast_split
from martwright.sinks.audit import (
    REJECTED_COLUMNS,
    RunEntry,
    log_rejected,
    log_runs,
    log_schema_checks,
    rejected_records,
)
from martwright.operators.staging import stage
from martwright.sinks.tables import (
    BUCKET,
    load_mode,
    merge_statement,
    overwrite_in_buckets,
    repoint_partition,
    touched_partitions,
    within_partitions,
    write_table,
)


def frame(spark, data, schema="k int, v string"):
    return spark.createDataFrame(data, schema)


def test_append_and_overwrite(spark, database, rows):
    name = f"{database}.t"
    done = write_table(frame(spark, [(1, "a")]), name)
    assert done == {"status": "SUCCESS", "mode": "append", "table": f"{spark.catalog.currentCatalog()}.{name}"}
    write_table(frame(spark, [(2, "b")]), name)
    assert rows(spark.table(name)) == [(1, "a"), (2, "b")]
    write_table(frame(spark, [(3, "c")]), name, "overwrite")
    assert rows(spark.table(name)) == [(3, "c")]


def test_refusals(spark, database):
    df = frame(spark, [(1, "a")])
    with pytest.raises(ValueError, match="unsupported mode"):
        write_table(df, f"{database}.t", "upsert")
    with pytest.raises(ValueError, match="invalid table name"):
        write_table(df, "t")
    with pytest.raises(ValueError, match="nope"):
        write_table(df, f"{database}.t", partition_by=["nope"])
    write_table(df, f"{database}.t")
    with pytest.raises(ValueError, match="merge_keys"):
        write_table(df, f"{database}.t", "merge")
    with pytest.raises(Exception, match="(?i)schema|column"):
        write_table(frame(spark, [(1, "a", 2)], "k int, v string, extra int"), f"{database}.t")


def test_partitioned_append(spark, database, rows):
    name = f"{database}.t"
    write_table(frame(spark, [(1, "a")]), name, partition_by=["v"])
    write_table(frame(spark, [(2, "b")]), name, partition_by=["v"])
    write_table(frame(spark, [(3, "b")]), name)
    assert rows(spark.table(name)) == [(1, "a"), (2, "b"), (3, "b")]
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 2


def test_evolving_append(spark, database, rows):
    name = f"{database}.t"
    write_table(frame(spark, [(1, "a")]), name, partition_by=["v"])
    write_table(frame(spark, [("b", 2.5, 2)], "v string, w double, k int"), name, merge_schema=True)
    write_table(frame(spark, [(3, "c")]), name, merge_schema=True)
    assert rows(spark.table(name), "k", "v", "w") == [(1, "a", None), (2, "b", 2.5), (3, "c", None)]


def brute_merge(target, source, key):
    matched = {key(s) for s in source if None not in key(s)}
    return sorted([t for t in target if key(t) not in matched] + source, key=repr)


@pytest.mark.parametrize(
    ("partition", "keys"),
    [([], ["k"]), ([], ["k", "v"]), (["v"], ["k", "v"]), (["v"], ["k"])],
)
def test_merge_against_brute_force(spark, database, rows, partition, keys):
    rng = random.Random(len(partition) * 10 + len(keys))
    values = [None, "a", "b", "c"]
    target = [(rng.choice([None, *range(30)]), rng.choice(values), i) for i in range(60)]
    source = list({(rng.choice([*range(40)]), rng.choice(values[:3])) for _ in range(25)})
    source = list({k: (k, v, 1000 + k) for k, v in source}.values()) + [(None, "a", 2000), (None, None, 2001)]
    name = f"{database}.t"
    schema = "k int, v string, n int"
    write_table(frame(spark, target, schema), name, partition_by=partition)
    for _ in range(2):  # merging the same rows again adds only the NULL-key ones
        write_table(frame(spark, source, schema), name, "merge", merge_keys=keys)
        columns = {"k": 0, "v": 1}
        target = brute_merge(target, source, lambda r: tuple(r[columns[c]] for c in keys))
        assert rows(spark.table(name), "k", "v", "n") == target


def test_merge_refuses_ambiguous_source(spark, database, rows):
    name = f"{database}.t"
    write_table(frame(spark, [(1, "a")]), name)
    with pytest.raises(ValueError, match="several source rows"):
        write_table(frame(spark, [(1, "x"), (1, "y")]), name, "merge", merge_keys=["k"])
    assert rows(spark.table(name)) == [(1, "a")]
    write_table(frame(spark, [(2, "x"), (2, "y")]), name, "merge", merge_keys=["k"])
    assert spark.table(name).count() == 3


def test_merge_takes_target_types(spark, database, rows):
    name = f"{database}.t"
    write_table(frame(spark, [(1, "a")]), name)
    write_table(frame(spark, [("b", 1, 9)], "v string, k bigint, extra int"), name, "merge", merge_keys=["k"])
    assert spark.table(name).dtypes == [("k", "int"), ("v", "string")]
    assert rows(spark.table(name)) == [(1, "b")]


def test_merge_says_or_adds_columns_that_the_table_lacks(spark, database, rows):
    name = f"{database}.t"
    write_table(frame(spark, [(1, "a")]), name)
    wide = frame(spark, [("b", 1, 9)], "V string, k int, extra int")
    assert write_table(wide, name, "merge", merge_keys=["k"])["left_out"] == ["extra"]
    done = write_table(wide, name, "merge", merge_schema=True, merge_keys=["k"])
    assert "left_out" not in done
    assert rows(spark.table(name), "k", "v", "extra") == [(1, "b", 9)]


def bucket_files(spark, name):
    return {p.parent.name: p.name for p in Path(urlsplit(location(spark, name)).path).rglob("*.parquet")}


def location(spark, name):
    return spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").first().data_type


def test_merge_rewrites_only_the_buckets_of_its_keys(spark, database, rows):
    name = f"{database}.t"
    first = [(k, f"v{k}") for k in range(200)] + [(None, "n1"), (None, "n2")]
    overwrite_in_buckets(frame(spark, first), name, ["k"], 16)
    before = bucket_files(spark, name)
    assert len(before) == 16
    change = frame(spark, [("7", "new"), ("1000", "more"), (None, "n3")], "k string, v string")
    write_table(change, name, "merge", merge_keys=["k"])
    after = bucket_files(spark, name)
    touched = {b for b in after if after[b] != before.get(b)}
    assert 1 <= len(touched) <= 3
    kept = [r for r in first if r[0] != 7]
    assert rows(spark.table(name), "k", "v") == sorted([*kept, (7, "new"), (1000, "more"), (None, "n3")], key=repr)
    # Twice the same merge changes nothing but keyless rows; other keys find their rows in any bucket.
    write_table(change.filter("k IS NOT NULL"), name, "merge", merge_keys=["k"])
    assert spark.table(name).count() == len(first) + 2
    write_table(frame(spark, [(5000, "v8")]), name, "merge", merge_keys=["v"])
    assert rows(spark.table(name).filter("v = 'v8'"), "k") == [(5000,)]
    assert spark.table(name).count() == len(first) + 2


def test_keyless_rows_are_dealt_to_many_buckets(spark, database):
    name = f"{database}.t"
    overwrite_in_buckets(frame(spark, [(None, f"v{k}") for k in range(400)]), name, ["k"], 8)
    counts = [r["count"] for r in spark.table(name).groupBy(BUCKET).count().collect()]
    assert len(counts) == 8 and max(counts) < 100


def test_partition_is_replaced_by_one_catalog_change(spark, database, rows):
    name = f"{spark.catalog.currentCatalog()}.{database}.t"
    write_table(frame(spark, [(1, "a'b"), (2, "c")]), name, partition_by=["v"])
    for k in (10, 11, 12):
        repoint_partition(frame(spark, [(k, "a'b")]), name, "v", "a'b")
        assert rows(spark.table(name)) == [(2, "c"), (k, "a'b")]
    write_table(frame(spark, [(13, "a'b")]), name)
    assert rows(spark.table(name)) == [(12, "a'b"), (13, "a'b"), (2, "c")]


def test_reject_ids_follow_from_the_content(spark, rows):
    split = cast_split(frame(spark, [("x", "a"), ("y", "a"), ("x", "a")], "k string, v string"), [Field("k", "int")])
    ids = [rows(rejected_records(split.rejected, run, "s", "t", "n", "f"), "rejection_id") for run in ("r1", "r2")]
    assert ids[0] == ids[1]
    assert len(ids[0]) == 3 and len(set(ids[0])) == 2


def test_merge_statement():
    assert merge_statement("c.s.t", "v", ["a", "b"]) == (
        "MERGE INTO c.s.t t USING v s ON t.`a` = s.`a` AND t.`b` = s.`b` "
        "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )


def test_load_policy():
    assert [load_mode(t) for t in ("full", " Incremental", "CDC", None)] == [
        "overwrite", "merge", "merge", "overwrite"]
    with pytest.raises(ValueError, match="weekly"):
        load_mode("weekly")


def test_run_and_schema_logs(spark, database, rows):
    entry = RunEntry("r", "Sales", "Gold", "Multiple", start_time=datetime(2024, 1, 1), records_written=5)
    log_runs(spark, [entry, RunEntry("r", "Sales", "Bronze", "orders", status="FAILED")], f"{database}.log")
    log_runs(spark, [], f"{database}.log")
    assert rows(spark.table(f"{database}.log"), "pipeline_stage", "status", "records_written", "error_message") == [
        ("Bronze", "FAILED", 0, ""), ("Gold", "SUCCESS", 5, "")]
    log_schema_checks(spark, [], f"{database}.checks")
    assert not spark.catalog.tableExists(f"{database}.checks")
    log_schema_checks(spark, [("r", "t", "c", "Present", "Missing", "FAILED")], f"{database}.checks")
    assert spark.table(f"{database}.checks").count() == 1


def test_rejected_records(spark, database):
    df = frame(spark, [("x", "f1"), ("2", "f2"), (None, "f3")], "n string, source_file_name string")
    rejected = cast_split(df, [Field("n", "int")]).rejected
    details = {"run_id": "r", "stage": "s", "table_name": "t", "source_name": "n"}
    log_rejected(rejected, f"{database}.rejects", **details)
    log_rejected(None, f"{database}.rejects", **details)
    log_rejected(rejected.limit(0), f"{database}.rejects", **details)
    logged = spark.table(f"{database}.rejects")
    assert tuple(logged.columns) == REJECTED_COLUMNS
    row = logged.collect()[0]
    assert logged.count() == 1
    assert (row.source_file_name, row.actual_value, len(row.rejection_id)) == ("f1", "x", 36)
    assert json.loads(row.raw_record)["n"] == "x"
    broken = quality_split(frame(spark, [(None, "v")]), [Rule("k", "NOT_NULL")]).rejected
    line = rejected_records(broken, "r", "s", "t", "n", "file.csv").first()
    assert (line.source_file_name, line.expected_data_type, line.failed_column) == ("file.csv", "NOT_NULL", "k")


def test_partitioned_merge_prunes_the_target(spark, database):
    """Only touched partitions are scanned and rewritten."""
    name = f"{database}.t"
    write_table(frame(spark, [(i, f"p{i % 4}") for i in range(40)]), name, partition_by=["v"])
    touched = stage(touched_partitions(spark.table(name), frame(spark, [(1, "p1")]), ["k", "v"], ["v"]), "touched")
    plan = within_partitions(spark.table(name), touched, ["v"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*v#\d+ = p1", text)
    before = {f: f.split("/v=")[1][:2] for f in spark.table(name).inputFiles()}
    write_table(frame(spark, [(1, "p1"), (99, "p1")]), name, "merge", merge_keys=["k", "v"])
    after = set(spark.table(name).inputFiles())
    assert {part for f, part in before.items() if f not in after} == {"p1"}
    assert spark.table(name).count() == 41


def test_merge_moves_rows_between_partitions(spark, database, rows):
    """Keys without the partition column: emptied partitions go, untouched ones keep their files."""
    name = f"{database}.t"
    write_table(frame(spark, [(1, "a"), (2, "b"), (3, "b"), (4, None), (5, "c")]), name, partition_by=["v"])
    kept = {f for f in spark.table(name).inputFiles() if "v=c" in f or "HIVE_DEFAULT" in f}
    write_table(frame(spark, [(1, "b"), (9, "n'w")]), name, "merge", merge_keys=["k"])
    assert rows(spark.table(name)) == sorted([(1, "b"), (2, "b"), (3, "b"), (4, None), (5, "c"), (9, "n'w")], key=repr)
    assert kept <= set(spark.table(name).inputFiles())
    write_table(frame(spark, [(4, "c"), (9, None)]), name, "merge", merge_keys=["k"])
    assert rows(spark.table(name)) == sorted([(1, "b"), (2, "b"), (3, "b"), (4, "c"), (5, "c"), (9, None)], key=repr)
    assert rows(spark.sql(f"SHOW PARTITIONS {name}")) == [("v=__HIVE_DEFAULT_PARTITION__",), ("v=b",), ("v=c",)]


def test_table_stays_usable_after_a_merge(spark, database, rows):
    name = f"{database}.t"
    write_table(frame(spark, [(1, "a")]), name)
    for k in range(4):
        write_table(frame(spark, [(1, f"m{k}")]), name, "merge", merge_keys=["k"])
    folder = Path(urlsplit(spark.table(name).inputFiles()[0]).path).parents[1]
    assert len(list(folder.iterdir())) == 2  # this version and the one before
    write_table(frame(spark, [(7, "new")]), name, "overwrite")
    write_table(frame(spark, [(7, "newer"), (8, "x")]), name, "merge", merge_keys=["k"])
    assert rows(spark.table(name)) == [(7, "newer"), (8, "x")]
    spark.sql(f"DROP TABLE {name}")
    write_table(frame(spark, [(1, "again")]), name, "overwrite")
    assert rows(spark.table(name)) == [(1, "again")]


def test_columns_of_many_ids_give_their_dictionary_up(spark, database):
    """60,000 ids of four rows each would fill a dictionary of 840 KB; few values keep theirs."""
    name = f"{spark.catalog.currentCatalog()}.{database}.t"
    ids = spark.range(0, 240_000, 1, 1).selectExpr("lpad(id div 4, 10, '0') AS k", "id % 3 AS few")
    write_table(ids, name)
    ((path,),) = spark.table(name).select("_metadata.file_path").distinct().collect()
    columns = pq.ParquetFile(path.removeprefix("file:")).metadata.row_group(0)
    assert ["PLAIN" in columns.column(k).encodings for k in (0, 1)] == [True, False]


@pytest.mark.parametrize("mode", ["overwrite", "append", "merge"])
def test_tables_are_packed_with_zstd(spark, database, mode):
    name = f"{spark.catalog.currentCatalog()}.{database}.t"
    write_table(frame(spark, [(1, "a")]), name, "overwrite")
    write_table(frame(spark, [(2, "b")]), name, mode, merge_keys=["k"])
    paths = [path for (path,) in spark.table(name).select("_metadata.file_path").distinct().collect()]
    assert {pq.ParquetFile(p.removeprefix("file:")).metadata.row_group(0).column(1).compression for p in paths} == {"ZSTD"}
