"""Column operators, tolerant typing and required fields over the raw feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.functions.columns import rename_columns, reorder_columns, standardize_columns
from martwright.functions.enrich import enrich
from martwright.functions.lineage import add_lineage, stringify
from martwright.operators.bronze import to_bronze
from martwright.operators.schema import table_report
from martwright.operators.typing import Field, cast_split, required_split, typed_split
from martwright.sources.metadata import column_mapping
from workload.adapter import (
    CUSTOMERS_SQL,
    ORDERS_SQL,
    PRODUCTS_SQL,
    RAW_SQL,
    customers,
    doubles,
    order_lines,
    products,
    raw_lines,
    table,
)
from workload.registry import query
from workload.sales import TITLE

LINE_FIELDS = [
    Field("row_id", "string", nullable=False),
    Field("order_id", "string", nullable=False),
    Field("order_date", "date", "d/M/yyyy", nullable=False),
    Field("ship_date", "date", "d/M/yyyy", nullable=False),
    Field("customer_id", "string", nullable=False),
    Field("product_id", "string"),
    Field("quantity", "integer"),
    Field("price", "decimal(18,2)", nullable=False),
    Field("discount", "decimal(4,2)"),
]

TYPED_SQL = f"""
WITH {RAW_SQL},
typed AS (
    SELECT row_id, order_id,
           try_strptime(order_date, '%d/%m/%Y')::DATE AS order_date,
           try_strptime(ship_date, '%d/%m/%Y')::DATE AS ship_date,
           customer_id, product_id,
           TRY_CAST(quantity AS INTEGER) AS quantity,
           TRY_CAST(price AS DECIMAL(18,2)) AS price,
           TRY_CAST(discount AS DECIMAL(4,2)) AS discount,
           order_date AS raw_order_date, ship_date AS raw_ship_date,
           quantity AS raw_quantity, price AS raw_price, discount AS raw_discount
    FROM raw_lines
),
flagged AS (
    SELECT *,
           raw_order_date IS NOT NULL AND order_date IS NULL AS bad_order_date,
           raw_ship_date IS NOT NULL AND ship_date IS NULL AS bad_ship_date,
           raw_quantity IS NOT NULL AND quantity IS NULL AS bad_quantity,
           raw_price IS NOT NULL AND price IS NULL AS bad_price,
           raw_discount IS NOT NULL AND discount IS NULL AS bad_discount
    FROM typed
),
castable AS (
    SELECT * FROM flagged
    WHERE NOT (bad_order_date OR bad_ship_date OR bad_quantity OR bad_price OR bad_discount)
)"""
TYPED_COLUMNS = """row_id, order_id, order_date, ship_date, customer_id, product_id, quantity,
    price::DOUBLE AS price, discount::DOUBLE AS discount"""
RAW_COLUMNS = """row_id, order_id, raw_order_date AS order_date, raw_ship_date AS ship_date,
    customer_id, product_id, raw_quantity AS quantity, raw_price AS price, raw_discount AS discount"""


def failure_sql(source: str, columns: str, failures: list[tuple[str, str, str, str, str]]) -> str:
    """One branch per (column, type, condition, value, reason)."""
    return "\nUNION ALL\n".join(
        f"SELECT {columns}, '{name}' AS failed_column, '{kind}' AS expected_data_type, "
        f"{value} AS actual_value, '{reason}' AS rejection_reason FROM {source} WHERE {condition}"
        for name, kind, condition, value, reason in failures
    )


CAST_FAILURES = [
    ("order_date", "date", "bad_order_date", "raw_order_date", "DATATYPE_CAST_FAILED"),
    ("ship_date", "date", "bad_ship_date", "raw_ship_date", "DATATYPE_CAST_FAILED"),
    ("quantity", "integer", "bad_quantity", "raw_quantity", "DATATYPE_CAST_FAILED"),
    ("price", "decimal(18,2)", "bad_price", "raw_price", "DATATYPE_CAST_FAILED"),
    ("discount", "decimal(4,2)", "bad_discount", "raw_discount", "DATATYPE_CAST_FAILED"),
]
REQUIRED_FAILURES = [
    (name, kind, f"{name} IS NULL", "NULL::VARCHAR", "REQUIRED_COLUMN_NULL")
    for name, kind in [
        ("row_id", "string"),
        ("order_id", "string"),
        ("order_date", "date"),
        ("ship_date", "date"),
        ("customer_id", "string"),
        ("price", "decimal(18,2)"),
    ]
]
REQUIRED_PRESENT = " AND ".join(f"{name} IS NOT NULL" for name, *_ in REQUIRED_FAILURES)


@query("cast_valid", f"{TYPED_SQL} SELECT {TYPED_COLUMNS} FROM castable")
def cast_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubles(cast_split(raw_lines(spark, sf_dir), LINE_FIELDS).valid)


@query("cast_failures", TYPED_SQL + failure_sql("flagged", RAW_COLUMNS, CAST_FAILURES))
def cast_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cast_split(raw_lines(spark, sf_dir), LINE_FIELDS).rejected


@query("required_valid", f"{TYPED_SQL} SELECT {TYPED_COLUMNS} FROM castable WHERE {REQUIRED_PRESENT}")
def required_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    castable = cast_split(raw_lines(spark, sf_dir), LINE_FIELDS).valid
    return doubles(required_split(castable, LINE_FIELDS).valid)


@query("required_failures", TYPED_SQL + failure_sql("castable", TYPED_COLUMNS, REQUIRED_FAILURES))
def required_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    castable = cast_split(raw_lines(spark, sf_dir), LINE_FIELDS).valid
    return doubles(required_split(castable, LINE_FIELDS).rejected)


@query("typed_valid", f"{TYPED_SQL} SELECT {TYPED_COLUMNS} FROM castable WHERE {REQUIRED_PRESENT}")
def typed_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubles(typed_split(raw_lines(spark, sf_dir), LINE_FIELDS).valid)


@query(
    "typed_rejected",
    TYPED_SQL
    + failure_sql("flagged", RAW_COLUMNS, CAST_FAILURES)
    + "\nUNION ALL\n"
    + failure_sql("castable", RAW_COLUMNS, REQUIRED_FAILURES),
)
def typed_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both kinds of failure in one pass over the feed, with source values."""
    return typed_split(raw_lines(spark, sf_dir), LINE_FIELDS).rejected


@query(
    "cast_timestamps",
    """SELECT event_id, TRY_CAST(strftime(ts, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS ts,
              try_strptime(strftime(ts, '%d/%m/%Y %H:%M'), '%d/%m/%Y %H:%M') AS minute,
              value::DECIMAL(18,2)::DOUBLE AS value, user_id
       FROM events""",
)
def cast_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as text and back: timestamps with and without a pattern."""
    events = table(spark, sf_dir, "events")
    text = stringify(
        events.select(
            "event_id",
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"),
            F.date_format("ts", "dd/MM/yyyy HH:mm").alias("minute"),
            F.col("value").cast("decimal(18,2)").alias("value"),
            "user_id",
        )
    )
    fields = [
        Field("event_id", "bigint"),
        Field("ts", "timestamp"),
        Field("minute", "timestamp", "dd/MM/yyyy HH:mm"),
        Field("value", "double"),
        Field("user_id", "bigint"),
    ]
    typed = cast_split(text, fields).valid
    return typed.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("ts", "minute")})


@query(
    "enrich_customer",
    f"""WITH {CUSTOMERS_SQL}
        SELECT * REPLACE (balance::DOUBLE AS balance),
               concat_ws(', ', address, city, state, country) AS customer_full_address,
               upper(region) AS customer_region
        FROM customers""",
)
def enrich_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubles(enrich(customers(spark, sf_dir), "customer"))


@query(
    "enrich_products",
    f"""WITH {PRODUCTS_SQL}
        SELECT * REPLACE (price_per_product::DOUBLE AS price_per_product),
               {TITLE.format("category")} AS category_name,
               {TITLE.format("sub_category")} AS sub_category_name
        FROM products""",
)
def enrich_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubles(enrich(products(spark, sf_dir), "Products"))


@query(
    "enrich_orders",
    f"""WITH {ORDERS_SQL}
        SELECT * REPLACE (price::DOUBLE AS price, discount::DOUBLE AS discount,
                          profit::DOUBLE AS profit)
        FROM order_lines""",
)
def enrich_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubles(enrich(order_lines(spark, sf_dir), "orders"))


@query(
    "standardize_names",
    """SELECT o_orderkey AS order_key, o_custkey AS customer_id, o_orderstatus AS order_status,
              o_totalprice AS total_price_usd, o_orderdate AS order_date,
              o_orderpriority AS _priority_ FROM orders""",
)
def standardize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers = [
        "Order Key", " Customer/ID", "order-status", "Total Price (USD)", "Order - Date", "_Priority!_",
    ]
    return standardize_columns(table(spark, sf_dir, "orders").toDF(*headers))


@query(
    "map_columns",
    """SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS sub_category,
              p_type AS category, p_size, p_retailprice AS price_per_product FROM part""",
)
def map_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = {
        "p_partkey": "product_id",
        "p_name": "product_name",
        "p_brand": "sub_category",
        "p_type": "category",
        "p_retailprice": "price_per_product",
        "p_comment": "comment",
    }
    return rename_columns(table(spark, sf_dir, "part"), mapping)


@query(
    "map_columns_by_table",
    """SELECT p_partkey AS product_id, p_name AS product_name, p_brand, p_type AS category, p_size, p_retailprice
       FROM part""",
)
def map_columns_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = [
        ("products", "p_partkey", "product_id"), ("products", "p_name", "product_name"), ("products", "p_type", "category"),
        ("products", "p_comment", "comment"), ("customers", "p_brand", "name"),
    ]
    mapping = spark.createDataFrame(lines, "table_name string, source_column string, target_column string")
    return rename_columns(table(spark, sf_dir, "part"), column_mapping(mapping, "products"))


@query("reorder_columns", "SELECT * FROM supplier")
def reorder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reorder_columns(table(spark, sf_dir, "supplier"), ["s_name", "s_phone", "s_suppkey"])


@query(
    "bronze_strings",
    f"""WITH {ORDERS_SQL}
        SELECT row_id, order_id, strftime(order_date, '%Y-%m-%d') AS order_date,
               quantity::VARCHAR AS quantity, price::VARCHAR AS price, discount::VARCHAR AS discount,
               'run-2' AS pipeline_run_id, 'orders' AS source_system,
               'lineitem.parquet' AS source_file_name
        FROM order_lines""",
)
def bronze_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns and lineage; the two time columns differ per run and are left out."""
    lines = order_lines(spark, sf_dir).select(
        "row_id", "order_id", "order_date", "quantity", "price", "discount"
    )
    bronze = stringify(add_lineage(lines, "run-2", "orders", "lineitem.parquet"))
    return bronze.drop("ingestion_timestamp", "ingestion_date")


@query(
    "bronze_from_files",
    """SELECT event_id::VARCHAR AS event_id, user_id::VARCHAR AS user_id, event_type, props,
              'run-2' AS pipeline_run_id, 'events' AS source_system,
              'events.parquet' AS source_file_name FROM events""",
)
def bronze_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze of a file scan: each row names its own file."""
    bronze = to_bronze(table(spark, sf_dir, "events"), "run-2", "events")
    return bronze.drop("ingestion_timestamp", "ingestion_date", "ts", "value")


REQUIRED = {
    "customer": ["c_custkey", "c_name", "c_phone"],
    "orders": ["o_orderkey", "o_custkey", "o_orderdate"],
    "lineitem": ["l_orderkey", "l_comment", "l_shipmode"],
    "part": ["p_partkey", "p_name"],
}


@query(
    "table_checks",
    """SELECT 'customer' AS table_name, count(*) AS row_count, 'c_phone' AS missing_columns,
              false AS passed FROM customer
       UNION ALL SELECT 'orders', count(*), '', count(*) >= 1000 FROM orders
       UNION ALL SELECT 'lineitem', count(*), 'l_comment,l_shipmode', false FROM lineitem
       UNION ALL SELECT 'part', count(*), '', count(*) >= 1000 FROM part""",
)
def table_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {name: table(spark, sf_dir, name) for name in REQUIRED}
    return table_report(tables, REQUIRED, minimum_rows=1000)
