"""Quality rules over typed order lines, customers and products."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martwright.functions.rules import Rule
from martwright.operators.quality import (
    QualitySplit,
    duplicate_rows,
    quality_split,
    rule_violations,
)
from martwright.operators.staging import stage
from martwright.operators.typing import cast_split
from workload.adapter import (
    CUSTOMERS_SQL,
    ORDERS_SQL,
    PRODUCTS_SQL,
    customers,
    doubles,
    order_lines,
    products,
    raw_lines,
    table,
)
from workload.registry import query
from workload.typing import LINE_FIELDS, TYPED_COLUMNS, TYPED_SQL

# Fixed value: the e-mail pattern of the rule table.
EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
CUSTOMERS = f"""WITH {CUSTOMERS_SQL}
SELECT * REPLACE (balance::DOUBLE AS balance) FROM customers"""
PRODUCTS = f"""WITH {PRODUCTS_SQL}
SELECT * REPLACE (price_per_product::DOUBLE AS price_per_product) FROM products"""
LINES = f"""WITH {ORDERS_SQL}
SELECT * REPLACE (price::DOUBLE AS price, discount::DOUBLE AS discount, profit::DOUBLE AS profit)
FROM order_lines"""


@query("rule_not_null", f"{TYPED_SQL} SELECT {TYPED_COLUMNS} FROM castable WHERE customer_id IS NULL")
def rule_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = cast_split(raw_lines(spark, sf_dir), LINE_FIELDS).valid
    return doubles(rule_violations(typed, Rule("customer_id", "NOT_NULL")))


@query("rule_positive", f"{CUSTOMERS} WHERE balance <= 0")
def rule_positive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubles(rule_violations(customers(spark, sf_dir), Rule("balance", "POSITIVE")))


@query(
    "rule_unique",
    f"{LINES} WHERE row_id IN (SELECT row_id FROM order_lines GROUP BY row_id HAVING count(*) > 1)",
)
def rule_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubles(rule_violations(order_lines(spark, sf_dir), Rule("row_id", "UNIQUE")))


@query("rule_regex", f"{CUSTOMERS} WHERE NOT regexp_matches(email, '{EMAIL}')")
def rule_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubles(rule_violations(customers(spark, sf_dir), Rule("email", "REGEX", EMAIL)))


@query("rule_min_value", f"{PRODUCTS} WHERE price_per_product < 950")
def rule_min_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = Rule("price_per_product", "MIN_VALUE", "950")
    return doubles(rule_violations(products(spark, sf_dir), rule))


@query("rule_domain", f"{LINES} WHERE ship_mode NOT IN ('1-URGENT', '2-HIGH', '5-LOW')")
def rule_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = Rule("ship_mode", "DOMAIN", "1-URGENT, 2-HIGH, 5-LOW")
    return doubles(rule_violations(order_lines(spark, sf_dir), rule))


@query("rule_range", f"{LINES} WHERE quantity NOT BETWEEN 5 AND 45")
def rule_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubles(rule_violations(order_lines(spark, sf_dir), Rule("quantity", "RANGE", "5,45")))


@query(
    "duplicate_key_count",
    """SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem
       GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def duplicate_key_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_rows(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


# UNIQUE stands between row-local rules: it counts only rows that passed the first
# two, and the last ones see only what it left.
LINE_RULES = [
    Rule("customer_id", "NOT_NULL"),
    Rule("quantity", "MIN_VALUE", "2"),
    Rule("row_id", "UNIQUE"),
    Rule("price", "POSITIVE"),
    Rule("discount", "RANGE", "0,0.09"),
    Rule("order_id", "CHECKSUM"),
]

CHAIN_SQL = f"""{TYPED_SQL},
first_two AS (
    SELECT *, CASE WHEN customer_id IS NULL THEN 'customer_id NOT_NULL'
                   WHEN quantity < 2 THEN 'quantity MIN_VALUE' END AS broken
    FROM castable
),
repeated AS (
    SELECT row_id FROM first_two WHERE broken IS NULL AND row_id IS NOT NULL
    GROUP BY row_id HAVING count(*) > 1
),
with_unique AS (
    SELECT f.*, CASE WHEN broken IS NOT NULL THEN broken
                     WHEN r.row_id IS NOT NULL THEN 'row_id UNIQUE' END AS broken_so_far
    FROM first_two f LEFT JOIN repeated r ON f.row_id = r.row_id
),
checked AS (
    SELECT *, CASE WHEN broken_so_far IS NOT NULL THEN broken_so_far
                   WHEN price <= 0 THEN 'price POSITIVE'
                   WHEN discount NOT BETWEEN 0 AND 0.09 THEN 'discount RANGE' END AS verdict
    FROM with_unique
)"""


def checked_lines(spark: SparkSession, sf_dir: str) -> QualitySplit:
    """The validated lines are written first, as in the flow: the split reads them
    twice, and their join and parsing are dearer than a table."""
    typed = stage(cast_split(raw_lines(spark, sf_dir), LINE_FIELDS).valid, "validated").frame
    return quality_split(typed, LINE_RULES)


@query("quality_valid", f"{CHAIN_SQL} SELECT {TYPED_COLUMNS} FROM checked WHERE verdict IS NULL")
def quality_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubles(checked_lines(spark, sf_dir).valid)


@query(
    "quality_rejected",
    f"""{CHAIN_SQL} SELECT {TYPED_COLUMNS},
        split_part(verdict, ' ', 1) AS failed_column, split_part(verdict, ' ', 2) AS failed_rule,
        CASE split_part(verdict, ' ', 1)
            WHEN 'customer_id' THEN customer_id WHEN 'quantity' THEN quantity::VARCHAR
            WHEN 'row_id' THEN row_id WHEN 'price' THEN price::VARCHAR
            WHEN 'discount' THEN discount::VARCHAR END AS actual_value,
        'DATA_QUALITY_RULE_FAILED' AS rejection_reason
        FROM checked WHERE verdict IS NOT NULL""",
)
def quality_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubles(checked_lines(spark, sf_dir).rejected)


@query(
    "quality_metrics",
    f"""{CHAIN_SQL} SELECT count(*) AS total_records,
        count(*) FILTER (verdict IS NULL) AS valid_records,
        count(*) FILTER (verdict IS NOT NULL) AS rejected_records FROM checked""",
)
def quality_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checked_lines(spark, sf_dir).metrics()


CATEGORY_RULES = [Rule("price_per_product", "MIN_VALUE", "950"), Rule("product_name", "NOT_NULL")]


@query(
    "quality_valid_distinct",
    f"""WITH {PRODUCTS_SQL}
        SELECT DISTINCT category, sub_category, product_name,
               price_per_product::DOUBLE AS price_per_product
        FROM products WHERE price_per_product >= 950""",
)
def quality_valid_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set semantics: survivors without their exact duplicates."""
    catalogue = products(spark, sf_dir).drop("product_id", "state")
    return doubles(quality_split(catalogue, CATEGORY_RULES, distinct=True).valid)
