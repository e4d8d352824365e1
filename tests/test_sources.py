from __future__ import annotations

import gzip
import os

import pytest
from pyspark.sql import functions as F

from martwright.sources.files import (
    FORMATS,
    MALFORMED_LINE,
    RAW_LINE_OPTION,
    register_format,
    scan,
    scan_csv,
    scan_json,
    scan_landing,
    scan_parquet,
    union_scans,
)
from martwright.sources.listing import (
    LOADED,
    STARTED,
    file_listing,
    hadoop_glob,
    interrupted,
    ledger_rows,
    unloaded,
)
from martwright.sources.metadata import active_sources, column_mapping, table_schema
from martwright.sources.tables import full_name, read_table
from martwright.streaming.bronze import ingest_files_into, ingest_new_files, stream_landing


def test_csv_is_text_with_header(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text("id,name\n1,x\n02,\n")
    df = scan_csv(spark, str(tmp_path))
    assert df.dtypes == [("id", "string"), ("name", "string")]
    assert rows(df) == [("02", None), ("1", "x")]
    (tmp_path / "b.txt").write_text("1;x\n")
    custom = scan(spark, str(tmp_path / "b.txt"), "CSV", {"header": "false", "sep": ";"})
    assert rows(custom) == [("1", "x")]


def test_json_keeps_source_text(spark, tmp_path, rows):
    (tmp_path / "o.json").write_text('[{"p": 4999, "q": "7", "s": {"k": 1}},\n {"p": 1199.98, "q": 7}]')
    df = scan_json(spark, str(tmp_path / "o.json"))
    assert rows(df, "p", "q") == [("1199.98", "7"), ("4999", "7")]
    known = scan(spark, str(tmp_path / "o.json"), "Json", schema="q string, p string")
    assert rows(known) == [("7", "1199.98"), ("7", "4999")]


def test_parquet_and_unknown(spark, tmp_path, rows):
    spark.range(2).write.parquet(str(tmp_path / "p"))
    assert rows(scan_parquet(spark, str(tmp_path / "p"))) == [(0,), (1,)]
    with pytest.raises(ValueError, match="xml2"):
        scan(spark, str(tmp_path), "xml2")
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        scan(spark, str(tmp_path / "absent"), "parquet").count()
    register_format("JsonLines", "json", {"primitivesAsString": "true"})
    (tmp_path / "l.jsonl").write_text('{"a": 1}\n{"a": 2}\n')
    assert rows(scan(spark, str(tmp_path / "l.jsonl"), "jsonlines")) == [("1",), ("2",)]
    del FORMATS["jsonlines"]


def test_listing(spark, tmp_path):
    for age, name in enumerate(["c one.CSV", "b.csv", "x.json", "A.Csv"]):
        (tmp_path / name).write_text("h\n")
        os.utime(tmp_path / name, (1_700_000_000 + age, 1_700_000_000 + age))
    listed = file_listing(spark, str(tmp_path), "*.csv")
    assert [r.file_name for r in listed.collect()] == ["c one.CSV", "b.csv", "A.Csv"]
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]
    assert [r.file_name for r in file_listing(spark, str(tmp_path), "[ab]*").collect()] == ["b.csv", "A.Csv"]
    assert file_listing(spark, str(tmp_path), "?.json").count() == 1


def test_hadoop_glob(spark, tmp_path):
    assert hadoop_glob("a*.[cC]sv") == "[aA]*.[cCcC][sS][vV]"
    assert hadoop_glob("[!x]1?") == "[^xX]1?"
    assert hadoop_glob("{1}") == r"\{1\}"
    for name in ("B.CSV", "b2.csv", "x.csv"):
        (tmp_path / name).write_text("h\n1\n")
    found = scan(spark, str(tmp_path), "csv", {"pathGlobFilter": hadoop_glob("[!x]*.csv")})
    assert found.count() == 2


def test_ledger(spark, tmp_path):
    for name in ("a.csv", "b.csv"):
        (tmp_path / name).write_text("h\n1\n")
    listing = file_listing(spark, str(tmp_path), "*.csv")
    one = listing.filter("file_name = 'a.csv'")
    ledger = ledger_rows(one, "s", "r", LOADED).unionAll(ledger_rows(listing, "s", "r", STARTED))
    ledger = spark.createDataFrame(ledger.collect(), ledger.schema)
    assert [r.file_name for r in unloaded(listing, ledger).collect()] == ["b.csv"]
    assert [r.file_name for r in interrupted(ledger, "s").collect()] == ["b.csv"]
    assert interrupted(ledger, "other").count() == 0
    os.utime(tmp_path / "a.csv", (1_700_000_000, 1_700_000_000))
    fresh = file_listing(spark, str(tmp_path), "*.csv")
    assert unloaded(fresh, ledger).count() == 2


def test_csv_with_different_headers(spark, tmp_path, rows):
    (tmp_path / "one file.csv").write_text("id,name\n1,x\n")
    (tmp_path / "two.csv").write_text("name,id,extra\ny,2,e\n")
    with gzip.open(tmp_path / "three.csv.gz", "wt") as out:
        out.write('"id",name\n3,z\n')
    scans = scan_landing(spark, str(tmp_path), "*.csv*", "csv")
    assert len(scans) == 2
    assert rows(union_scans(scans), "id", "name", "extra") == [
        ("1", "x", None), ("2", "y", "e"), ("3", "z", None)]
    assert len(scan_landing(spark, str(tmp_path), "t*.csv.gz", "csv")) == 1
    assert len(scan_landing(spark, str(tmp_path), "*.csv", "csv", options={"header": "false"})) == 1


def test_table_names(spark, database, rows):
    spark.range(2).write.saveAsTable(f"{database}.t")
    catalog = spark.catalog.currentCatalog()
    assert full_name(spark, "a.b") == f"{catalog}.a.b"
    assert full_name(spark, "x.a.b") == "x.a.b"
    assert rows(read_table(spark, f"{database}.t")) == [(0,), (1,)]
    assert rows(read_table(spark, f"{catalog}.{database}.t")) == [(0,), (1,)]
    for bad in ("t", "a.b.c.d"):
        with pytest.raises(ValueError, match="invalid table name"):
            read_table(spark, bad)


def test_metadata_filters(spark):
    config = spark.createDataFrame([("a", True), ("b", False)], "source_name string, active_flag boolean")
    assert [r.source_name for r in active_sources(config).collect()] == ["a"]
    schema = spark.createDataFrame(
        [("t", 2, "y"), ("t", 1, "x"), ("o'k", 1, "z")],
        "table_name string, column_order int, standard_column string")
    assert [r.standard_column for r in table_schema(schema, "t").collect()] == ["x", "y"]
    assert [r.standard_column for r in table_schema(schema, "o'k").collect()] == ["z"]
    assert table_schema(schema, "none").count() == 0
    mapping = spark.createDataFrame([("t", "a", "b")], ["table_name", "source_column", "target_column"])
    assert column_mapping(mapping, "t").count() == 1


def test_stream_loads_every_file_once(spark, tmp_path, rows):
    landing, target, checkpoint = (str(tmp_path / n) for n in ("landing", "bronze", "checkpoint"))
    os.mkdir(landing)

    def run():
        stream = stream_landing(spark, landing, "*.csv", "csv", "`Order ID` string, qty string")
        ingest_new_files(stream, "run", "orders", target, checkpoint).awaitTermination()
        return rows(spark.read.parquet(target), "order_id", "qty", "source_file_name")

    (tmp_path / "landing" / "first file.CSV").write_text("Order ID,qty\nO1,1\n")
    (tmp_path / "landing" / "note.txt").write_text("Order ID,qty\nnot,me\n")
    assert run() == [("O1", "1", "first file.CSV")]
    assert len(run()) == 1
    (tmp_path / "landing" / "second.csv").write_text("Order ID,qty\nO2,2\n")
    assert run() == [("O1", "1", "first file.CSV"), ("O2", "2", "second.csv")]


def test_stream_of_unknown_type(spark, tmp_path):
    with pytest.raises(ValueError, match="xml2"):
        stream_landing(spark, str(tmp_path), "*", "xml2", "a string")


def test_partition_folders_of_listed_files(spark, tmp_path, rows):
    for day in ("1", "2"):
        (tmp_path / f"d={day}").mkdir()
        (tmp_path / f"d={day}" / "a.csv").write_text("x\n7\n")
    listed = file_listing(spark, str(tmp_path), "*.CSV")
    assert [r.file_name for r in listed.collect()] == ["d=1/a.csv", "d=2/a.csv"]
    scans = scan_landing(spark, str(tmp_path), "*.csv", "csv", listed)
    assert rows(union_scans(scans), "x", "d") == [("7", 1), ("7", 2)]


def test_malformed_lines_are_kept_whole(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text('id,name,qty\n1,x,2\n2,"long",3,4\n3,short\n4,"open,5\n5,,\n\n6,"a,b",7\n')
    df = scan_csv(spark, str(tmp_path), {RAW_LINE_OPTION: MALFORMED_LINE})
    assert df.columns == ["id", "name", "qty", MALFORMED_LINE]
    assert rows(df.filter(f"{MALFORMED_LINE} IS NULL"), "id", "name", "qty") == [
        ("1", "x", "2"), ("5", None, None), ("6", "a,b", "7")
    ]
    lines = ['2,"long",3,4', "3,short", '4,"open,5']
    # the verdict does not depend on the columns that are read
    assert sorted(r[1] for r in df.select("id", MALFORMED_LINE).collect() if r[1]) == lines
    (tmp_path / "c.csv").write_text(f"{MALFORMED_LINE}\n1\n")
    with pytest.raises(ValueError, match="of their own"):
        scan_csv(spark, str(tmp_path / "c.csv"), {RAW_LINE_OPTION: MALFORMED_LINE})


def test_malformed_lines_over_two_layouts(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text("id,name\n1,x\n2\n")
    (tmp_path / "b.csv").write_text("name,id,more\ny,3,z\ny,4,z,?\n")
    scans = scan_landing(spark, str(tmp_path), "*.csv", "csv", options={RAW_LINE_OPTION: MALFORMED_LINE})
    got = union_scans(scans)
    assert rows(got.filter(f"{MALFORMED_LINE} IS NULL"), "id", "name", "more") == [("1", "x", None), ("3", "y", "z")]
    assert sorted(r[0] for r in got.select(MALFORMED_LINE, "id").collect() if r[0]) == ["2", "y,4,z,?"]


def test_stream_into_a_table_takes_layouts_and_replays(spark, database, tmp_path, rows, monkeypatch):
    landing, checkpoint, table = tmp_path / "landing", str(tmp_path / "checkpoint"), f"{database}.orders"
    landing.mkdir()

    def run(**how):
        query = ingest_files_into(spark, str(landing), "*.csv", "csv", "s", "shop", table, checkpoint, **how)
        query.awaitTermination()
        return rows(spark.table(table), "order_id", "qty", "more", "source_file_name", "pipeline_run_id")

    (landing / "first file.CSV").write_text("Order ID,qty,more\nO1,1,a\n")
    (landing / "second.csv").write_text("qty,Order ID\n2,O2\n")
    (landing / "note.txt").write_text("not,me\n")
    loaded = [("O1", "1", "a", "first file.CSV", "s/0"), ("O2", "2", None, "second.csv", "s/0")]
    assert run() == loaded
    assert run() == loaded

    # The rows are written, then the stream stops before its checkpoint says so.
    from martwright.sinks.tables import write_table as write

    def write_and_stop(*args, **kwargs):
        write(*args, **kwargs)
        raise RuntimeError("stopped")

    (landing / "third.csv").write_text("Order ID,late\nO3,x\n")
    monkeypatch.setattr("martwright.streaming.bronze.write_table", write_and_stop)
    with pytest.raises(Exception, match="stopped"):
        run()
    monkeypatch.undo()
    loaded.append(("O3", None, None, "third.csv", "s/1"))
    assert run() == loaded
    (landing / "fourth.csv").write_text("Order ID,qty\nO4,4\n")
    (landing / "fifth.csv").write_text("Order ID,qty\nO5,5\n")
    assert [r[0] for r in run(files_per_batch=1)] == ["O1", "O2", "O3", "O4", "O5"]


def test_stream_into_a_table_of_unknown_type(spark, tmp_path):
    with pytest.raises(ValueError, match="xml2"):
        ingest_files_into(spark, str(tmp_path), "*", "xml2", "s", "shop", "t", str(tmp_path / "c"))


def test_json_files_of_many_lines_read_as_records(spark, tmp_path, rows):
    """Arrays and single objects over many lines, as the multi-line reader reads them, without going back to the file."""
    texts = {
        "array.json": b'[ {"a" : 1199.980, "b" : "x\\ny",\n "c": {"d": [1, 2.50]}},\n\n {"a":1e2,\r\n"b":null, "c": {"d": []}} ]\n',
        "object.json": '{"a": 123456789012345678901234567890.10,\n "b": "\u00fc\u4e00", "c": {"d": [true]}}'.encode(),
        "bom.json": b'\xef\xbb\xbf[{"a": -0.0,\n "e": 7}]',
        "empty.json": b"", "none.json": b"[]",
    }
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text)
    read = scan_json(spark, str(tmp_path))
    plain = spark.read.options(multiLine="true", primitivesAsString="true").json(str(tmp_path))
    assert read.schema == plain.schema
    assert rows(read) == rows(plain)
    assert {r.a for r in read.collect()} == {"1199.980", "1e2", "123456789012345678901234567890.10", "-0.0"}
    named = read.select("a", F.element_at(F.split("_metadata.file_path", "/"), -1))
    assert ("1e2", "array.json") in rows(named)
    scanned = read._jdf.queryExecution().analyzed().collectLeaves().apply(0).relation().options()
    assert scanned.get("multiLine").get() == "false"


def test_a_malformed_json_file_is_kept_whole(spark, tmp_path, rows):
    (tmp_path / "good.json").write_text('[{"a": 1},\n {"a": 2}]')
    (tmp_path / "bad.json").write_text('[{"a": 3},\n {"a": ')
    assert rows(scan_json(spark, str(tmp_path)), "a", "_corrupt_record") == rows(
        spark.read.options(multiLine="true", primitivesAsString="true").json(str(tmp_path)), "a", "_corrupt_record"
    )
