from __future__ import annotations

import random
from datetime import date, datetime

import pytest

from martwright.operators.schema import (
    missing_columns,
    require_columns,
    require_table,
    schema_diff,
)
from martwright.operators.typing import Field, as_fields, cast_split, required_split, typed_split


def texts(spark, values, name="c"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


@pytest.mark.parametrize(
    ("data_type", "pattern", "value", "typed"),
    [
        ("integer", None, "100", 100),
        ("int", None, "10.5", None),
        ("int", None, "1e3", None),
        ("double", None, "10.55", 10.55),
        ("double", None, "1d", 1.0),
        ("double", None, "ABC", None),
        ("date", None, "2016-08-21", date(2016, 8, 21)),
        ("date", None, "2016", date(2016, 1, 1)),
        ("date", "d/M/yyyy", "21/8/2016", date(2016, 8, 21)),
        ("date", "d/M/yyyy", "21/08/2016", date(2016, 8, 21)),
        ("date", "d/M/yyyy", "99/99/2024", None),
        ("date", "d/M/yyyy", "31/2/2016", None),
        ("date", "d/M/yyyy", "2016-08-21", None),
        ("date", "d/M/yyyy", " 21/8/2016", None),
        ("date", "d/M/yyyy", "21/8/16", None),
        ("timestamp", None, "2016-08-21 10:11:12", datetime(2016, 8, 21, 10, 11, 12)),
        ("timestamp", "d/M/yyyy HH:mm", "21/8/2016 10:11", datetime(2016, 8, 21, 10, 11)),
        ("boolean", None, "maybe", None),
        ("string", None, "anything", "anything"),
    ],
)
def test_tolerant_cast(spark, data_type, pattern, value, typed):
    split = cast_split(texts(spark, [value]), [Field("c", data_type, pattern)])
    valid, rejected = split.valid.collect(), split.rejected.collect()
    if typed is None:
        assert not valid
        assert [tuple(r) for r in rejected] == [(value, "c", data_type, value, "DATATYPE_CAST_FAILED")]
    else:
        assert [r.c for r in valid] == [typed]
        assert not rejected


def test_null_is_no_cast_failure(spark, rows):
    split = cast_split(texts(spark, [None, "10.5", "ABC", "99.99"], "price"), [Field("price", "double")])
    assert rows(split.valid) == [(10.5,), (99.99,), (None,)]
    assert split.rejected.count() == 1


def test_one_row_per_failing_column(spark, rows):
    df = spark.createDataFrame([("x", "y", "k1"), ("1", "z", "k2")], "a string, b string, k string")
    split = cast_split(df, [Field("b", "int"), Field("a", "int"), Field("absent", "int")])
    assert split.valid.columns == ["b", "a", "k"]
    assert split.valid.count() == 0
    assert rows(split.rejected, "a", "b", "k", "failed_column", "actual_value") == [
        ("1", "z", "k2", "b", "z"), ("x", "y", "k1", "a", "x"), ("x", "y", "k1", "b", "y")]


def test_empty_inputs(spark):
    df = texts(spark, [])
    split = cast_split(df, [Field("c", "int")])
    assert dict(split.valid.dtypes) == {"c": "int"}
    assert split.rejected.count() == 0
    assert cast_split(texts(spark, ["1"]), []).rejected.count() == 0
    assert cast_split(texts(spark, ["1"]), []).valid.first().c == "1"


def test_required_split(spark, rows):
    df = spark.createDataFrame([(1, None), (None, None), (3, "z")], "a int, b string")
    fields = [Field("a", "int", nullable=False), Field("b", "string", nullable=False)]
    split = required_split(df, fields)
    assert rows(split.valid) == [(3, "z")]
    assert rows(split.rejected, "a", "failed_column", "rejection_reason") == [
        (1, "b", "REQUIRED_COLUMN_NULL"), (None, "a", "REQUIRED_COLUMN_NULL"),
        (None, "b", "REQUIRED_COLUMN_NULL")]
    lineage = Field("source_file_name", "string", nullable=False)
    assert required_split(df, [lineage]).valid.count() == 3


def test_typed_split_matches_the_two_steps(spark, rows):
    """Random rows: one pass against cast_split, then required_split on its survivors."""
    rng = random.Random(7)
    values = [None, "1", "2.5", "x", "21/8/2016", "99/9/2016"]
    data = [(i, rng.choice(values), rng.choice(values), rng.choice(values)) for i in range(500)]
    df = spark.createDataFrame(data, "id int, a string, b string, d string")
    fields = [
        Field("a", "int", nullable=False),
        Field("b", "double", nullable=False),
        Field("d", "date", "d/M/yyyy"),
    ]
    casts = cast_split(df, fields)
    required = required_split(casts.valid, fields)
    both = typed_split(df, fields)
    assert rows(both.valid) == rows(required.valid)
    details = ("id", "failed_column", "rejection_reason")
    stepwise = rows(casts.rejected, *details) + rows(required.rejected, *details)
    assert rows(both.rejected, *details) == sorted(stepwise, key=repr)
    failing = {r.id for r in both.rejected.collect()}
    assert failing.isdisjoint({r.id for r in both.valid.collect()})
    assert len(failing) + both.valid.count() == 500


def test_split_scans_its_input_once(spark, tmp_path):
    path = str(tmp_path / "wide")
    names = [f"c{i}" for i in range(12)]
    spark.createDataFrame([tuple("1" * 12)], names).write.parquet(path)
    split = typed_split(spark.read.parquet(path), [Field(n, "int", nullable=False) for n in names])
    for frame in (split.valid, split.rejected):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1
        assert "Exchange" not in plan


def test_fields_from_metadata(spark):
    table = spark.createDataFrame(
        [("t", 2, "b", "date", "d/M/yyyy", False), ("t", 1, "a", "int", None, True)],
        "table_name string, column_order int, standard_column string, data_type string, "
        "date_format string, nullable boolean",
    )
    assert as_fields(table) == [Field("a", "int"), Field("b", "date", "d/M/yyyy", False)]


def test_schema_diff(spark):
    df = spark.createDataFrame([(1, "x", 2)], "a int, b string, extra int")
    same = schema_diff(df, [Field("a", "INTEGER"), Field("b", "string")])
    assert same.valid
    assert same.extra == ["extra"]
    diff = schema_diff(df, [Field("a", "decimal(10, 2)"), Field("b", "string"), Field("z", "int")])
    assert not diff.valid
    assert diff.missing == ["z"]
    assert diff.mismatched == [("a", "decimal(10,2)", "int")]
    assert diff.log_rows("r", "t") == [
        ("r", "t", "a", "decimal(10,2)", "int", "FAILED"),
        ("r", "t", "z", "Present", "Missing", "FAILED"),
    ]
    assert schema_diff(df, []).valid


def test_table_checks(spark, database):
    spark.range(3).write.saveAsTable(f"{database}.three")
    assert require_table(spark, f"{database}.three", 3).count() == 3
    with pytest.raises(RuntimeError, match="3 rows"):
        require_table(spark, f"{database}.three", 4)
    assert missing_columns(spark.range(1), ["id", "x"]) == ["x"]
    with pytest.raises(RuntimeError, match="x"):
        require_columns(spark.range(1), ["x"])
