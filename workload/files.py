"""Sources, sinks, streaming and the whole flow, over files and tables that Spark
first derives from the given ones in the shared work folder."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.functions.lineage import scanned_file_name, stringify
from martwright.operators.staging import PARQUET_OPTIONS
from martwright.operators.typing import Field, typed_split
from martwright.plans.flow import Flow, free_shuffles, ingest, run_all, validate
from martwright.plans.marts import run_report
from martwright.plans.star import sales_master
from martwright.session import work_dir
from martwright.sinks.audit import rejected_records
from martwright.sinks.tables import write_table
from martwright.sources.files import MALFORMED_LINE, RAW_LINE_OPTION, scan, scan_csv, scan_json, scan_landing, scan_parquet, union_scans
from martwright.sources.listing import (
    LOADED,
    file_listing,
    ledger_rows,
    matching_files,
    unloaded,
)
from martwright.sources.tables import read_table
from martwright.streaming.bronze import ingest_files_into, ingest_new_files, stream_landing
from workload.adapter import (
    CUSTOMERS_SQL,
    PRODUCTS_SQL,
    RAW_SQL,
    customers,
    doubles,
    products,
    raw_lines,
    table,
)
from workload.quality import EMAIL
from workload.registry import query
from workload.sales import FULL_MASTER, PROFIT, YEAR, sales_star
from workload.typing import (
    CAST_FAILURES,
    LINE_FIELDS,
    RAW_COLUMNS,
    REQUIRED_FAILURES,
    TYPED_SQL,
    failure_sql,
)


def folder(spark: SparkSession, label: str) -> str:
    return f"{work_dir(spark)}/martwright/{label}-{uuid4().hex}"


def database(spark: SparkSession, label: str) -> str:
    """A database of its own in the work folder."""
    name = f"martwright_{label}_{uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{folder(spark, name)}'")
    return name


# --- scans -----------------------------------------------------------------

ORDERS_TEXT = """SELECT o_orderkey::VARCHAR AS o_orderkey, o_custkey::VARCHAR AS o_custkey,
    o_orderstatus, o_totalprice::DECIMAL(18,2)::VARCHAR AS o_totalprice,
    strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders"""


def orders_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumns(
        {
            "o_totalprice": F.col("o_totalprice").cast("decimal(18,2)"),
            "o_orderdate": F.to_date("o_orderdate"),
        }
    )


@query("csv_scan", ORDERS_TEXT)
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = folder(spark, "csv")
    orders_feed(spark, sf_dir).write.option("header", True).csv(path)
    return scan_csv(spark, path)


@query(
    "csv_scan_options",
    "SELECT n_nationkey, n_name, n_regionkey, c_custkey, c_name FROM nation "
    "JOIN customer ON c_nationkey = n_nationkey",
)
def csv_scan_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Caller options override the defaults: separator, no header, given types."""
    path = folder(spark, "csv")
    joined = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "customer"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    columns = ["n_nationkey", "n_name", "n_regionkey", "c_custkey", "c_name"]
    joined.select(*columns).write.option("sep", "|").csv(path)
    schema = "n_nationkey int, n_name string, n_regionkey int, c_custkey bigint, c_name string"
    return scan(spark, path, "CSV", {"sep": "|", "header": "false"}, schema=schema)


@query("json_scan", ORDERS_TEXT)
def json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers keep their source text; line-delimited here, so that large files split."""
    path = folder(spark, "json")
    orders_feed(spark, sf_dir).write.json(path)
    return scan(spark, path, "json", {"multiLine": "false"})


@query("json_array_scan", ORDERS_TEXT)
def json_array_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default reading: files that are one array over many lines, of at most 10,000 orders."""
    path = folder(spark, "json")
    orders = orders_feed(spark, sf_dir)
    records = F.to_json(F.collect_list(F.struct(*orders.columns)), {"pretty": "true"})
    arrays = orders.groupBy(F.expr("o_orderkey DIV 10000")).agg(records.alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return scan_json(spark, path)


@query("parquet_scan", "SELECT * REPLACE (o_totalprice::DECIMAL(18,2)::DOUBLE AS o_totalprice, o_orderdate::DATE AS o_orderdate) FROM orders")
def parquet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = folder(spark, "parquet")
    orders_feed(spark, sf_dir).write.parquet(path)
    return doubles(scan_parquet(spark, path))


def two_layouts(spark: SparkSession, sf_dir: str) -> str:
    """Parts as CSV files of two layouts: other column order, one column less."""
    path = folder(spark, "layouts")
    part = stringify(table(spark, sf_dir, "part").drop("p_retailprice"))
    sized = F.col("p_type").isin("SMALL", "MEDIUM", "LARGE")
    writer = {"header": "true"}
    part.filter(sized).write.options(**writer).csv(path)
    rest = part.filter(~sized).select("p_type", "p_name", "p_partkey", "p_brand")
    rest.write.options(**writer).mode("append").csv(path)
    return path


@query(
    "csv_two_layouts",
    """SELECT p_partkey::VARCHAR AS p_partkey, p_name, p_brand, p_type,
              CASE WHEN p_type IN ('SMALL', 'MEDIUM', 'LARGE') THEN p_size::VARCHAR END AS p_size
       FROM part""",
)
def csv_two_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with different headers in one folder: united by column name."""
    return union_scans(scan_landing(spark, two_layouts(spark, sf_dir), "*.CSV", "csv"))


# Every seventh line is short of a field, every eleventh has one too many, every thirteenth a quote left open.
LINE_KINDS = """CASE WHEN o_orderkey % 7 = 0 THEN 'short' WHEN o_orderkey % 11 = 0 THEN 'long'
    WHEN o_orderkey % 13 = 0 THEN 'open' END"""


def broken_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as written CSV lines, part of them malformed."""
    path = folder(spark, "lines")
    line = F.when(F.col("kind") == "short", F.concat_ws(",", "o_orderkey", "o_orderstatus")).when(
        F.col("kind") == "long", F.concat_ws(",", "o_orderkey", "o_orderstatus", "o_orderpriority", F.lit("more"))
    ).when(F.col("kind") == "open", F.concat(F.col("o_orderkey"), F.lit(',"'), "o_orderstatus", F.lit(","), "o_orderpriority"))
    whole = F.concat_ws(",", "o_orderkey", "o_orderstatus", "o_orderpriority")
    orders = table(spark, sf_dir, "orders").withColumn("kind", F.expr(LINE_KINDS))
    lines = orders.select(F.coalesce(line, whole).alias("order_key,status,priority"))
    lines.write.options(header="true", quote="", escapeQuotes="false", sep="\x01").csv(path)
    return scan_csv(spark, path, {RAW_LINE_OPTION: MALFORMED_LINE})


@query(
    "csv_malformed",
    f"""WITH lines AS (SELECT o_orderkey AS k, o_orderstatus AS s, o_orderpriority AS p, {LINE_KINDS} AS kind FROM orders)
    SELECT k AS order_key, s AS status, p AS priority, NULL AS actual_value, NULL AS rejection_reason
    FROM lines WHERE kind IS NULL
    UNION ALL SELECT NULL, NULL, NULL,
        CASE kind WHEN 'short' THEN k || ',' || s WHEN 'long' THEN k || ',' || s || ',' || p || ',more'
             ELSE k || ',"' || s || ',' || p END, 'MALFORMED_LINE'
    FROM lines WHERE kind IS NOT NULL""",
)
def csv_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines too short, too long and with an open quote are rejected whole; the others are typed."""
    fields = [Field("order_key", "bigint", None, False), Field("status", "string"), Field("priority", "string")]
    split = typed_split(broken_lines(spark, sf_dir), fields)
    rejected = split.rejected.select("actual_value", "rejection_reason")
    return split.valid.unionByName(rejected, allowMissingColumns=True)


# --- landing folder, ledger, stream ----------------------------------------


def deliver(spark: SparkSession, sf_dir: str, landing: str, late: bool) -> None:
    """Orders placed before 1998, later the rest, as more files of the same folder."""
    after = F.year("o_orderdate") >= 1998
    drop = orders_feed(spark, sf_dir).filter(after if late else ~after)
    drop.write.option("header", True).mode("append").csv(landing)


@query("file_listing", "SELECT o_orderstatus AS part, count(*) AS orders FROM orders GROUP BY ALL")
def listed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order count per status, read through the file listing of a partitioned landing folder."""
    landing = folder(spark, "landing")
    orders = orders_feed(spark, sf_dir).withColumn("part", F.col("o_orderstatus"))
    orders.write.partitionBy("part").parquet(landing)
    files = file_listing(spark, landing, "PART-*.Parquet").select("path", "file_name")
    rows = spark.read.option("basePath", landing).parquet(landing)
    named = rows.select("part", scanned_file_name().alias("file_name"))
    return named.join(files, "file_name", "left_semi").groupBy("part").agg(
        F.count(F.lit(1)).alias("orders")
    )


@query("file_ledger", ORDERS_TEXT)
def file_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries, two loads: the second reads only files the ledger lacks."""
    landing, ledger_path = folder(spark, "landing"), folder(spark, "ledger")
    deliver(spark, sf_dir, landing, late=False)
    first = matching_files(spark, landing, "*.csv")
    ledger_rows(first, "orders", "run-1", LOADED).write.parquet(ledger_path)
    loaded = union_scans(scan_landing(spark, landing, "*.csv", "csv", first))
    bronze = folder(spark, "bronze")
    loaded.write.parquet(bronze)
    deliver(spark, sf_dir, landing, late=True)
    new = unloaded(matching_files(spark, landing, "*.csv"), spark.read.parquet(ledger_path))
    more = union_scans(scan_landing(spark, landing, "*.csv", "csv", new))
    more.write.mode("append").parquet(bronze)
    return spark.read.parquet(bronze)


@query("stream_ingest", ORDERS_TEXT)
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same two deliveries through the streaming source: every file once."""
    landing, bronze, checkpoint = (folder(spark, n) for n in ("landing", "bronze", "checkpoint"))
    schema = ", ".join(f"{name} string" for name in table(spark, sf_dir, "orders").columns)
    for late in (False, True):
        deliver(spark, sf_dir, landing, late)
        stream = stream_landing(spark, landing, "*.csv", "csv", schema)
        ingest_new_files(stream, "run-1", "orders", bronze, checkpoint).awaitTermination()
    rows = spark.read.parquet(bronze)
    return rows.select(*table(spark, sf_dir, "orders").columns)


@query(
    "stream_two_layouts",
    """SELECT p_partkey::VARCHAR AS p_partkey, p_name, p_brand, p_type,
              CASE WHEN p_type IN ('SMALL', 'MEDIUM', 'LARGE') THEN p_size::VARCHAR END AS p_size, 'parts' AS source_system
       FROM part""",
)
def stream_two_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of two layouts through the stream into a bronze table, started twice."""
    landing, checkpoint = two_layouts(spark, sf_dir), folder(spark, "checkpoint")
    name = f"{database(spark, 'stream')}.parts"
    for _ in range(2):
        ingest_files_into(spark, landing, "*.csv", "csv", "parts", "parts", name, checkpoint).awaitTermination()
    return read_table(spark, name).select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "source_system")


# --- table sinks -----------------------------------------------------------

PART_SQL = "SELECT p_partkey, p_name, p_type, p_retailprice FROM part"


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")


@query("table_append", f"{PART_SQL} UNION ALL {PART_SQL} WHERE p_type = 'PROMO'")
def table_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{database(spark, 'append')}.parts"
    write_table(parts(spark, sf_dir), name, partition_by=["p_type"])
    write_table(parts(spark, sf_dir).filter("p_type = 'PROMO'"), name)
    return read_table(spark, name)


@query("table_overwrite", f"{PART_SQL} WHERE p_type <> 'PROMO'")
def table_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{database(spark, 'overwrite')}.parts"
    write_table(parts(spark, sf_dir), name)
    write_table(parts(spark, sf_dir).filter("p_type <> 'PROMO'"), name, "overwrite")
    return read_table(spark, name)


@query(
    "table_evolve",
    """SELECT p_partkey, p_name, NULL::VARCHAR AS p_brand FROM part
       UNION ALL SELECT p_partkey, NULL, p_brand FROM part""",
)
def table_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An append may bring new columns; rows without them read NULL."""
    name = f"{database(spark, 'evolve')}.parts"
    part = table(spark, sf_dir, "part")
    write_table(part.select("p_partkey", "p_name"), name)
    write_table(part.select("p_brand", "p_partkey"), name, merge_schema=True)
    return read_table(spark, name)


# New price for promoted parts, and one new part per supplier.
CHANGES_SQL = """changes AS (
    SELECT p_partkey, p_name, p_type, p_retailprice * 2 AS p_retailprice
    FROM part WHERE p_type = 'PROMO'
    UNION ALL
    SELECT s_suppkey + 1000000000, s_name, 'SUPPLIED', abs(s_acctbal) FROM supplier
    UNION ALL
    SELECT NULL, s_name, 'UNKNOWN', 0 FROM supplier
)"""
UPSERT_SQL = f"""WITH {CHANGES_SQL}
{PART_SQL} WHERE p_partkey NOT IN (SELECT p_partkey FROM changes WHERE p_partkey IS NOT NULL)
UNION ALL SELECT * FROM changes"""


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    promoted = parts(spark, sf_dir).filter("p_type = 'PROMO'")
    supplier = table(spark, sf_dir, "supplier")
    added = supplier.selectExpr("s_suppkey + 1000000000", "s_name", "'SUPPLIED'", "abs(s_acctbal)")
    unknown = supplier.selectExpr("CAST(NULL AS BIGINT)", "s_name", "'UNKNOWN'", "0D")
    doubled = promoted.withColumn("p_retailprice", F.col("p_retailprice") * 2)
    return doubled.unionAll(added).unionAll(unknown)


@query("upsert", UPSERT_SQL)
def upsert_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{database(spark, 'upsert')}.parts"
    write_table(parts(spark, sf_dir), name, "overwrite")
    write_table(changes(spark, sf_dir), name, "merge", merge_keys=["p_partkey"])
    return read_table(spark, name)


@query("upsert_partitioned", UPSERT_SQL)
def upsert_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys cover the partition column: only touched partitions are rewritten."""
    name = f"{database(spark, 'upsert')}.parts"
    write_table(parts(spark, sf_dir), name, "overwrite", partition_by=["p_type"])
    keys = ["p_type", "p_partkey"]
    write_table(changes(spark, sf_dir), name, "merge", merge_keys=keys)
    return read_table(spark, name)


# --- rejected records ------------------------------------------------------

REJECT_FIELDS = [field.name for field in LINE_FIELDS]
RAW_RECORD = "'{' || concat_ws(',', " + ", ".join(
    f"""'"{name}":"' || {name} || '"'"""
    for name in [*REJECT_FIELDS, "failed_column", "expected_data_type", "actual_value", "rejection_reason"]
) + ") || '}'"


@query(
    "rejected_log",
    TYPED_SQL
    + ", failures AS ("
    + failure_sql("flagged", RAW_COLUMNS, CAST_FAILURES)
    + "\nUNION ALL\n"
    + failure_sql("castable", RAW_COLUMNS, REQUIRED_FAILURES)
    + f""") SELECT 'run-1' AS run_id, 'Schema Validation' AS pipeline_stage,
        'silver.orders' AS table_name, 'orders' AS source_name, 'lines.csv' AS source_file_name,
        failed_column, expected_data_type, actual_value, rejection_reason,
        {RAW_RECORD} AS raw_record FROM failures""",
)
def rejected_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects in the shape of the audit table, without its random id and clock."""
    rejected = typed_split(raw_lines(spark, sf_dir), LINE_FIELDS).rejected
    details = ("run-1", "Schema Validation", "silver.orders", "orders", "lines.csv")
    return rejected_records(rejected, *details).drop("rejection_id", "rejected_timestamp")


# --- the whole flow --------------------------------------------------------

CUSTOMER_FIELDS = [
    "customer_id", "customer_name", "email", "address", "segment", "country", "city", "state",
    "postal_code", "region",
]
FLOW_FIELDS = {
    "customer": [(name, "string", None, name != "customer_id") for name in CUSTOMER_FIELDS]
    + [("balance", "decimal(18,2)", None, False)],
    "products": [
        ("product_id", "string", None, False),
        ("category", "string", None, True),
        ("sub_category", "string", None, True),
        ("product_name", "string", None, True),
        ("price_per_product", "decimal(18,2)", None, False),
    ],
    "orders": [(f.name, f.data_type, f.date_format, f.nullable) for f in LINE_FIELDS]
    + [("ship_mode", "string", None, True), ("profit", "decimal(18,2)", None, True)],
}
FLOW_RULES = [
    ("customer", "email", "REGEX", EMAIL),
    ("products", "price_per_product", "MIN_VALUE", "950"),
    ("orders", "row_id", "UNIQUE", None),
    ("orders", "quantity", "MIN_VALUE", "2"),
]

FLOW_CTES = f"""
WITH {CUSTOMERS_SQL}, {PRODUCTS_SQL}, {TYPED_SQL.replace("WITH ", "", 1)},
valid_lines AS (
    SELECT * FROM castable
    WHERE order_date IS NOT NULL AND ship_date IS NOT NULL
      AND customer_id IS NOT NULL AND price IS NOT NULL
),
survivors AS (
    SELECT *, round(price * (0.05::DECIMAL(4,2) - discount), 2) AS profit FROM valid_lines
    WHERE quantity >= 2
      AND row_id NOT IN (SELECT row_id FROM valid_lines GROUP BY row_id HAVING count(*) > 1)
),
flow_customers AS (SELECT * FROM customers WHERE regexp_matches(email, '{EMAIL}')),
flow_products AS (SELECT * FROM products WHERE price_per_product >= 950)"""

FLOW_SQL = f"""{FLOW_CTES}
SELECT {YEAR}, p.category AS product_category, p.sub_category AS product_sub_category,
       o.customer_id, c.customer_name, {PROFIT}
FROM survivors o
LEFT JOIN flow_customers c ON o.customer_id = c.customer_id
LEFT JOIN flow_products p ON o.product_id = p.product_id
GROUP BY year(order_date), p.category, p.sub_category, o.customer_id, c.customer_name"""


def flow_over(spark: SparkSession, sf_dir: str, absent: str | None = None) -> Flow:
    """Landing files of all three sources, and the metadata tables that describe them."""
    name, landing = database(spark, "flow"), folder(spark, "landing")
    people, goods, lines = f"{landing}/customer", f"{landing}/products", f"{landing}/orders"
    customers(spark, sf_dir).write.option("header", True).csv(people)
    products(spark, sf_dir).write.option("header", True).csv(goods)
    typed = raw_lines(spark, sf_dir).withColumns(
        {
            "ship_mode": F.lit("Air"),
            "profit": F.expr(
                "CAST(round(try_cast(price AS decimal(18,2)) * "
                "(CAST('0.05' AS decimal(4,2)) - CAST(discount AS decimal(4,2))), 2) AS decimal(18,2))"
            ),
        }
    )
    typed.write.options(**PARQUET_OPTIONS).parquet(lines)
    del typed
    free_shuffles(spark)
    config = []
    for source, path, kind in (
        ("customer", people, "csv"),
        ("products", goods, "csv"),
        ("orders", lines, "parquet"),
    ):
        tables = [f"{name}.{source}_{t}" for t in ("bronze", "validated", "checked", "rejected")]
        enriched = "" if source == "orders" else f"{name}.{source}_enriched"
        config.append((source, path, f"*.{kind}", kind, *tables, enriched, "FULL", None, True))
    fields = [(t, i, *f) for t, lines in FLOW_FIELDS.items() for i, f in enumerate(lines)]
    if absent:
        fields.append(("orders", len(fields), absent, "string", None, True))
    metadata = {
        "ingestion_config": spark.createDataFrame(
            config,
            "source_name string, landing_path string, file_pattern string, file_type string, "
            "bronze_table string, validated_table string, checked_table string, "
            "rejected_table string, enrich_table string, load_type string, merge_keys string, "
            "active_flag boolean",
        ),
        "required_schema": spark.createDataFrame(
            fields,
            "table_name string, column_order int, standard_column string, data_type string, "
            "date_format string, nullable boolean",
        ),
        "data_quality_rules": spark.createDataFrame(
            [(t, i, c, k, v, True) for i, (t, c, k, v) in enumerate(FLOW_RULES)],
            "table_name string, priority int, column_name string, rule_type string, "
            "rule_value string, active_flag boolean",
        ),
    }
    for table_name, df in metadata.items():
        df.coalesce(1).write.saveAsTable(f"{name}.{table_name}")
    return Flow(spark, name, name, name)


@query("full_flow", FLOW_SQL)
def full_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files to marts through all five stages; the profit summary of the gold tables."""
    flow = flow_over(spark, sf_dir)
    run_all(flow)
    return doubles(read_table(spark, f"{flow.gold_schema}.profit_summary"))


@query(
    "bronze_ingestion",
    f"""WITH {CUSTOMERS_SQL}, {PRODUCTS_SQL}, {RAW_SQL}
        SELECT 'customer' AS source_name, count(*) AS rows FROM customers
        UNION ALL SELECT 'products', count(*) FROM products
        UNION ALL SELECT 'orders', count(*) FROM raw_lines""",
)
def bronze_ingestion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per source in the run log, one log line per landing file."""
    flow = flow_over(spark, sf_dir)
    ingest(flow)
    log = read_table(spark, flow.audit("pipeline_run_log"))
    return log.groupBy("source_name").agg(F.sum("records_written").alias("rows"))


@query(
    "flow_run_log",
    f"""{FLOW_CTES}
SELECT 'Bronze' AS pipeline_stage, 'customer' AS source_name, count(*) AS records_read,
       count(*) AS records_written, 0::BIGINT AS rejected_records FROM customers
UNION ALL SELECT 'Bronze', 'products', count(*), count(*), 0 FROM products
UNION ALL SELECT 'Bronze', 'orders', count(*), count(*), 0 FROM raw_lines
UNION ALL SELECT 'Schema Validation', 'customer', count(*), count(*), 0 FROM customers
UNION ALL SELECT 'Schema Validation', 'products', count(*), count(*), 0 FROM products
UNION ALL SELECT 'Schema Validation', 'orders', count(*), (SELECT count(*) FROM valid_lines),
    count(*) - (SELECT count(*) FROM valid_lines) FROM raw_lines
UNION ALL SELECT 'Data Quality', 'customer', count(*), (SELECT count(*) FROM flow_customers),
    count(*) - (SELECT count(*) FROM flow_customers) FROM customers
UNION ALL SELECT 'Data Quality', 'products', count(*), (SELECT count(*) FROM flow_products),
    count(*) - (SELECT count(*) FROM flow_products) FROM products
UNION ALL SELECT 'Data Quality', 'orders', count(*), (SELECT count(*) FROM survivors),
    count(*) - (SELECT count(*) FROM survivors) FROM valid_lines
UNION ALL SELECT 'Enrichment', 'customer', count(*), count(*), 0 FROM flow_customers
UNION ALL SELECT 'Enrichment', 'products', count(*), count(*), 0 FROM flow_products
UNION ALL SELECT 'Enrichment', 'orders', count(*), 0, 0 FROM survivors
UNION ALL SELECT 'Gold', 'sales_master', 0, count(*), 0 FROM survivors""",
)
def flow_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per stage and source as the run log has them after a full run."""
    flow = flow_over(spark, sf_dir)
    run_all(flow)
    log = read_table(spark, flow.audit("pipeline_run_log"))
    target = F.element_at(F.split("target_table", r"\."), -1)
    is_gold = F.col("pipeline_stage") == "Gold"
    named = log.withColumn("source_name", F.when(is_gold, target).otherwise(F.col("source_name")))
    kept = named.filter(~is_gold | (F.col("source_name") == "sales_master"))
    counts = ("records_read", "records_written", "rejected_records")
    return kept.groupBy("pipeline_stage", "source_name").agg(*[F.sum(c).alias(c) for c in counts])


@query(
    "validation_stage",
    f"""{FLOW_CTES}
SELECT 'customer' AS source_name, 'SUCCESS' AS status, count(*) AS records_written,
       NULL::VARCHAR AS column_name, NULL::VARCHAR AS expected_type, NULL::VARCHAR AS actual_type
FROM customers
UNION ALL SELECT 'products', 'SUCCESS', count(*), NULL, NULL, NULL FROM products
UNION ALL SELECT 'orders', 'FAILED', 0, 'ship_priority', 'Present', 'Missing'""",
)
def validation_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source whose files lack an expected column fails and is logged; the others pass."""
    flow = flow_over(spark, sf_dir, absent="ship_priority")
    ingest(flow)
    validate(flow)
    log = read_table(spark, flow.audit("pipeline_run_log"))
    runs = log.filter("pipeline_stage = 'Schema Validation'")
    checks = read_table(spark, flow.audit("schema_validation_log"))
    return runs.join(checks.withColumnRenamed("table_name", "source_name"), "source_name", "left").select(
        "source_name", "status", "records_written", "column_name", "expected_type", "actual_type"
    )


@query("report_over_table", f"{FULL_MASTER} SELECT customer_id, customer_name, {YEAR}, {PROFIT} FROM master GROUP BY ALL")
def report_over_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A profit report as SQL text over a written sales master."""
    name = f"{database(spark, 'gold')}.sales_master"
    write_table(sales_master(sales_star(spark, sf_dir)), name, "overwrite")
    return doubles(run_report(spark, "profit_by_customer_year", name))
