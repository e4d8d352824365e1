"""Sales master, marts and profit reports over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.functions.enrich import enrich_customers, enrich_products
from martwright.plans.marts import MARTS, REPORTS, over_star, placed, profit_rollup
from martwright.plans.star import Star, measured_star, sales_master, star
from martwright.sources.files import union_scans
from workload.adapter import (
    CUSTOMERS_SQL,
    ORDERS_SQL,
    PRODUCTS_SQL,
    customers,
    doubles,
    order_lines,
    products,
)
from workload.registry import Query, query

# Title case: each word of a space-separated text.
TITLE = (
    "array_to_string(list_transform(string_split({0}, ' '), "
    "lambda w: upper(w[1:1]) || lower(w[2:])), ' ')"
)

ENRICHED_SQL = f"""
WITH {CUSTOMERS_SQL}, {PRODUCTS_SQL}, {ORDERS_SQL},
customer_enriched AS (
    SELECT *, concat_ws(', ', address, city, state, country) AS customer_full_address,
           upper(region) AS customer_region
    FROM customers
),
product_enriched AS (
    SELECT *, {TITLE.format("category")} AS category_name,
           {TITLE.format("sub_category")} AS sub_category_name
    FROM products
)"""

MASTER_SQL = """,
master AS (
    SELECT o.* REPLACE (round(o.profit, 2) AS profit),
           c.customer_name, c.segment, c.country, c.city, c.state, c.postal_code, c.region,
           c.customer_full_address, c.customer_region,
           p.category AS product_category, p.sub_category AS product_sub_category,
           p.product_name, p.category_name, p.sub_category_name, p.price_per_product
    FROM order_lines o
    LEFT JOIN {customers} c ON o.customer_id = c.customer_id
    LEFT JOIN {products} p ON o.product_id = p.product_id
)"""

FULL_MASTER = ENRICHED_SQL + MASTER_SQL.format(
    customers="customer_enriched", products="product_enriched"
)
# Lookups as they come out of the quality checks: customers in credit, products of some size.
CHECKED_MASTER = ENRICHED_SQL + MASTER_SQL.format(
    customers="(SELECT * FROM customer_enriched WHERE balance > 0)",
    products="(SELECT * FROM product_enriched WHERE price_per_product >= 950)",
)

MASTER_COLUMNS = """
SELECT * REPLACE (price::DOUBLE AS price, discount::DOUBLE AS discount, profit::DOUBLE AS profit,
                  price_per_product::DOUBLE AS price_per_product)
FROM master"""

MEASURES = """
    sum(quantity)::BIGINT AS total_quantity,
    sum(price)::DOUBLE AS total_sales,
    sum(profit)::DOUBLE AS total_profit,
    sum(discount)::DOUBLE / count(discount) AS average_discount,
    count(DISTINCT order_id) AS total_orders"""
PROFIT = "round(sum(profit), 2)::DOUBLE AS total_profit"
YEAR = "year(order_date)::INTEGER AS order_year"


def sales_star(spark: SparkSession, sf_dir: str) -> Star:
    return star(
        order_lines(spark, sf_dir),
        enrich_customers(customers(spark, sf_dir)),
        enrich_products(products(spark, sf_dir)),
    )


def checked_star(spark: SparkSession, sf_dir: str) -> Star:
    return star(
        order_lines(spark, sf_dir),
        enrich_customers(customers(spark, sf_dir).filter("balance > 0")),
        enrich_products(products(spark, sf_dir).filter("price_per_product >= 950")),
    )


@query("sales_master", FULL_MASTER + MASTER_COLUMNS)
def master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubles(sales_master(sales_star(spark, sf_dir)))


@query("sales_master_missing_dims", CHECKED_MASTER + MASTER_COLUMNS)
def master_missing_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines whose customer or product did not pass the checks keep NULLs."""
    return doubles(sales_master(checked_star(spark, sf_dir)))


def mart_sql(name: str, source: str) -> str:
    mart = MARTS.get(name) or REPORTS[name]
    keys = [YEAR if key == "order_year" else key for key in mart.keys]
    measures = PROFIT if mart.profit_only else MEASURES
    return f"{source}\nSELECT {', '.join(keys)}, {measures}\nFROM master GROUP BY {', '.join(mart.keys)}"


def mart_query(name: str, build_star) -> Query:
    mart = MARTS.get(name) or REPORTS[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return doubles(over_star(build_star(spark, sf_dir), mart))

    return run


for _name in [*MARTS, *REPORTS]:
    query(_name, mart_sql(_name, FULL_MASTER))(mart_query(_name, sales_star))
for _name in MARTS:
    _missing = f"{_name}_missing_dims"
    query(_missing, mart_sql(_name, CHECKED_MASTER))(mart_query(_name, checked_star))


_ROLLUP_KEYS = ("order_year", "product_category", "customer_id", "customer_name")


def rollup_sql(report: str, keys: tuple[str, ...]) -> str:
    """A report's rows, NULL for the keys that it lacks."""
    source = {"order_year": "year(order_date)::INTEGER"}
    columns = [f"{source.get(k, k) if k in keys else 'NULL'} AS {k}" for k in _ROLLUP_KEYS]
    by = f"GROUP BY {', '.join(source.get(k, k) for k in keys)}" if keys else "HAVING count(*) > 0"
    return f"SELECT '{report}' AS report, {', '.join(columns)}, {PROFIT} FROM master {by}"


@query(
    "profit_rollup",
    FULL_MASTER + " UNION ALL ".join(rollup_sql(r, k) for r, k in [*((n, m.keys) for n, m in REPORTS.items()), ("total", ())]),
)
def rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four profit reports and the grand total, by one aggregation."""
    return doubles(profit_rollup(sales_master(sales_star(spark, sf_dir))))


def placed_sql(name: str) -> str:
    mart = REPORTS.get(name) or MARTS[name]
    order = [f"{c} {'DESC NULLS LAST' if mart.descending else 'NULLS FIRST'}" for c in mart.order]
    order += [f"{key} NULLS FIRST" for key in mart.keys if key not in mart.order]
    return (
        f"{mart_sql(name, CHECKED_MASTER + ', report AS (')}) "
        f"SELECT row_number() OVER (ORDER BY {', '.join(order)}) AS position, * FROM report"
    )


@query("profit_by_customer_ranked", placed_sql("profit_by_customer"))
def customers_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by profit, highest first, with their place; equal profits by id, then name."""
    mart = REPORTS["profit_by_customer"]
    return doubles(placed(over_star(checked_star(spark, sf_dir), mart, ordered=False), mart))


@query("profit_summary_ranked", placed_sql("profit_summary"))
def summary_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profit summary in its order, with each row's place; unknown customers and products first."""
    mart = MARTS["profit_summary"]
    return doubles(placed(over_star(checked_star(spark, sf_dir), mart, ordered=False), mart))


@query(
    "marts_measured_once",
    FULL_MASTER
    + " UNION ALL ".join(
        f"SELECT '{name}' AS mart, count(*) AS groups, sum(profit)::DOUBLE AS profit FROM "
        f"(SELECT sum(profit) AS profit FROM master GROUP BY {', '.join('year(order_date)' if k == 'order_year' else k for k in mart.keys)})"
        for name, mart in MARTS.items() if not mart.profit_only
    ),
)
def marts_measured_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and profit of the marts over one star, whose lookups are measured by one job."""
    source = measured_star(sales_star(spark, sf_dir))
    totals = [
        over_star(source, mart, ordered=False).agg(
            F.lit(name).alias("mart"), F.count(F.lit(1)).alias("groups"), F.sum("total_profit").alias("profit")
        )
        for name, mart in MARTS.items() if not mart.profit_only
    ]
    return doubles(union_scans(totals))
