"""The given tables seen as customer, product and order-line feeds.

``*_SQL`` are the same definitions for the SQL check. Dirt in the raw feed
follows from the rows' own values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN_ID = "run-1"


_schemas: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its footer is read for the schema once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer feed; an e-mail lacks its @ where the balance is negative."""
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    joined = table(spark, sf_dir, "customer").join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )
    mark = F.when(F.col("c_acctbal") < 0, "").otherwise("@")
    user = F.lower(F.replace("c_name", F.lit("#"), F.lit(".")))
    return joined.select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.concat(user, mark, F.lower("c_mktsegment"), F.lit(".com")).alias("email"),
        F.concat(F.lit("Street "), F.col("c_custkey")).alias("address"),
        F.col("c_mktsegment").alias("segment"),
        F.col("n_name").alias("country"),
        F.concat(F.lit("City "), F.col("c_nationkey")).alias("city"),
        F.col("r_name").alias("state"),
        F.concat(F.lit("PC"), F.col("c_custkey")).alias("postal_code"),
        F.lower("r_name").alias("region"),
        F.col("c_acctbal").cast("decimal(18,2)").alias("balance"),
    )


CUSTOMERS_SQL = """
customers AS (
    SELECT c_custkey::VARCHAR AS customer_id,
           c_name AS customer_name,
           lower(replace(c_name, '#', '.')) || CASE WHEN c_acctbal < 0 THEN '' ELSE '@' END
               || lower(c_mktsegment) || '.com' AS email,
           'Street ' || c_custkey AS address,
           c_mktsegment AS segment,
           n_name AS country,
           'City ' || c_nationkey AS city,
           r_name AS state,
           'PC' || c_custkey AS postal_code,
           lower(r_name) AS region,
           c_acctbal::DECIMAL(18,2) AS balance
    FROM customer
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
)"""


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.concat(F.lower("p_type"), F.lit(" goods")).alias("category"),
        F.lower("p_brand").alias("sub_category"),
        F.col("p_name").alias("product_name"),
        F.concat(F.lit("size "), F.col("p_size")).alias("state"),
        F.col("p_retailprice").cast("decimal(18,2)").alias("price_per_product"),
    )


PRODUCTS_SQL = """
products AS (
    SELECT p_partkey::VARCHAR AS product_id,
           lower(p_type) || ' goods' AS category,
           lower(p_brand) AS sub_category,
           p_name AS product_name,
           'size ' || p_size AS state,
           p_retailprice::DECIMAL(18,2) AS price_per_product
    FROM part
)"""


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed order lines. Money is decimal, so sums do not depend on row order;
    twelve digits keep the arithmetic per line within 64 bits."""
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    discount = F.col("l_discount").cast("decimal(4,2)")
    margin = F.lit("0.05").cast("decimal(4,2)") - discount
    return lines.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("row_id"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.to_date("o_orderdate").alias("order_date"),
        F.to_date("l_shipdate").alias("ship_date"),
        F.col("o_orderpriority").alias("ship_mode"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        price.alias("price"),
        discount.alias("discount"),
        (price * margin).alias("profit"),
        F.lit(RUN_ID).alias("pipeline_run_id"),
        F.lit("orders").alias("source_system"),
        F.lit("lineitem.parquet").alias("source_file_name"),
        F.col("o_orderdate").alias("ingestion_timestamp"),
        F.to_date("o_orderdate").alias("ingestion_date"),
    )


ORDERS_SQL = f"""
order_lines AS (
    SELECT l_orderkey || '-' || l_linenumber AS row_id,
           l_orderkey::VARCHAR AS order_id,
           o_orderdate::DATE AS order_date,
           l_shipdate::DATE AS ship_date,
           o_orderpriority AS ship_mode,
           o_custkey::VARCHAR AS customer_id,
           l_partkey::VARCHAR AS product_id,
           l_quantity::INTEGER AS quantity,
           l_extendedprice::DECIMAL(12,2) AS price,
           l_discount::DECIMAL(4,2) AS discount,
           l_extendedprice::DECIMAL(12,2) * (0.05::DECIMAL(4,2) - l_discount::DECIMAL(4,2)) AS profit,
           '{RUN_ID}' AS pipeline_run_id,
           'orders' AS source_system,
           'lineitem.parquet' AS source_file_name,
           o_orderdate AS ingestion_timestamp,
           o_orderdate::DATE AS ingestion_date
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as a text feed with dirt: unparsable dates, prices and
    quantities, missing ids and dates."""
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    ordered = F.date_format("o_orderdate", "d/M/yyyy")
    shipped = F.date_format("l_shipdate", "d/M/yyyy")
    untaxed, undiscounted = F.col("l_tax") == 0, F.col("l_discount") == 0
    returned, urgent = F.col("l_returnflag") == "R", F.col("o_orderpriority").startswith("1")
    return lines.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("row_id"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.when(untaxed & returned, "99/99/2024").otherwise(ordered).alias("order_date"),
        F.when(~undiscounted | urgent, shipped).alias("ship_date"),
        F.when(~(untaxed & undiscounted), F.col("o_custkey").cast("string")).alias("customer_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.when(undiscounted & returned, "many")
        .otherwise(F.col("l_quantity").cast("int").cast("string"))
        .alias("quantity"),
        F.when(untaxed & urgent, "ABC")
        .otherwise(F.col("l_extendedprice").cast("decimal(18,2)").cast("string"))
        .alias("price"),
        F.col("l_discount").cast("decimal(4,2)").cast("string").alias("discount"),
    )


RAW_SQL = """
raw_lines AS (
    SELECT l_orderkey || '-' || l_linenumber AS row_id,
           l_orderkey::VARCHAR AS order_id,
           CASE WHEN l_tax = 0 AND l_returnflag = 'R' THEN '99/99/2024'
                ELSE strftime(o_orderdate, '%-d/%-m/%Y') END AS order_date,
           CASE WHEN l_discount <> 0 OR o_orderpriority LIKE '1%'
                THEN strftime(l_shipdate, '%-d/%-m/%Y') END AS ship_date,
           CASE WHEN NOT (l_tax = 0 AND l_discount = 0) THEN o_custkey::VARCHAR END AS customer_id,
           l_partkey::VARCHAR AS product_id,
           CASE WHEN l_discount = 0 AND l_returnflag = 'R' THEN 'many'
                ELSE l_quantity::INTEGER::VARCHAR END AS quantity,
           CASE WHEN l_tax = 0 AND o_orderpriority LIKE '1%' THEN 'ABC'
                ELSE l_extendedprice::DECIMAL(18,2)::VARCHAR END AS price,
           l_discount::DECIMAL(4,2)::VARCHAR AS discount
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""


def doubles(df: DataFrame) -> DataFrame:
    """Decimal columns as double, for comparison across engines."""
    decimal = [f.name for f in df.schema.fields if f.dataType.typeName() == "decimal"]
    return df.withColumns({name: F.col(name).cast("double") for name in decimal})
