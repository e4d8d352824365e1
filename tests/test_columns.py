from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from martwright.functions.columns import (
    rename_columns,
    reorder_columns,
    standard_name,
    standardize_columns,
)
from martwright.functions.enrich import enrich
from martwright.functions.lineage import LINEAGE_COLUMNS, add_lineage, scanned_file_name, stringify
from martwright.operators.bronze import to_bronze


@pytest.mark.parametrize(
    ("raw", "standard"),
    [
        ("Customer ID", "customer_id"),
        (" Order-Date ", "order_date"),
        ("Product(Name)", "productname"),
        ("a / b -- c", "a_b_c"),
        ("Price ($)", "price_"),
        ("_Kept_", "_kept_"),
        ("größe", "gre"),
        ("x__y", "x_y"),
    ],
)
def test_standard_name(raw, standard):
    assert standard_name(raw) == standard


def test_standardize_columns_refuses_clashes(spark):
    df = spark.createDataFrame([(1, 2)], ["Order ID", "Name"])
    assert standardize_columns(df).columns == ["order_id", "name"]
    with pytest.raises(ValueError, match="order_id"):
        standardize_columns(df.toDF("Order ID", "order-id"))


def test_rename_and_reorder(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["a", "b", "c"])
    mapping = spark.createDataFrame([("a", "x"), ("zz", "y")], ["source_column", "target_column"])
    assert rename_columns(df, mapping).columns == ["x", "b", "c"]
    assert reorder_columns(df, ["c", "nope", "a"]).columns == ["c", "a", "b"]


def test_stringify_is_lossless_for_nested(spark):
    df = spark.sql("SELECT 1 AS n, 1.50 AS d, struct(1 AS k) AS s, array(1, 2) AS a, map('a', 1) AS m")
    row = stringify(df).first()
    assert tuple(row) == ("1", "1.50", '{"k":1}', "[1,2]", '{"a":1}')


def test_lineage_and_bronze(spark):
    df = spark.createDataFrame([(1, "x")], ["Row ID", "Value"])
    bronze = to_bronze(df, "run", "orders", "o.json")
    assert bronze.columns == ["row_id", "value", *LINEAGE_COLUMNS]
    row = bronze.first()
    assert (row.row_id, row.pipeline_run_id, row.source_system, row.source_file_name) == (
        "1", "run", "orders", "o.json")
    types = dict(bronze.dtypes)
    assert (types["ingestion_timestamp"], types["ingestion_date"]) == ("timestamp", "date")
    assert add_lineage(df, "r", "s", F.lit("f")).first().source_file_name == "f"


def test_enrich_customer(spark, rows):
    df = spark.createDataFrame(
        [("S1", "B", "K", "India", "south"), (None, "B", "", "India", None), (None,) * 5],
        "address string, city string, state string, country string, region string",
    )
    assert rows(enrich(df, "CUSTOMER"), "customer_full_address", "customer_region") == [
        ("", None), ("B, , India", None), ("S1, B, K, India", "SOUTH")]


def test_enrich_products_and_others(spark):
    df = spark.createDataFrame([("office supplies", "home-office SUPPLIES")], ["category", "sub_category"])
    row = enrich(df, "products").first()
    assert (row.category_name, row.sub_category_name) == ("Office Supplies", "Home-office Supplies")
    assert enrich(df, "orders").columns == enrich(df, "unknown").columns == df.columns


@pytest.mark.parametrize("names", [["a-1.parquet"], ["a-1.parquet", "b c+d%.parquet"], ["dt=1/a.parquet"]])
def test_file_names_need_no_search_where_paths_are_plain(spark, tmp_path, rows, names):
    for name in names:
        spark.range(0, 2, 1, 1).write.parquet(str(tmp_path / "made" / name))
        (part,) = (tmp_path / "made" / name).glob("*.parquet")
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_bytes(part.read_bytes())
    scanned = spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    named = scanned.select(scanned_file_name(f"file:{tmp_path}/in/{name}" for name in names))
    assert rows(named) == rows(scanned.select(scanned_file_name())) == sorted([(n,) for n in names * 2], key=repr)
    plan = named._jdf.queryExecution().optimizedPlan().toString()
    assert ("file_path" in plan) == (names != ["a-1.parquet"])
