"""Incremental loads, retries and merges, over deliveries that Spark first derives from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.plans.flow import Flow, ingest, validate
from martwright.operators.staging import stage
from martwright.sinks.tables import BUCKET, write_table
from martwright.sources.files import scan_landing, union_scans
from martwright.operators.bronze import to_bronze
from martwright.sources.tables import read_table
from workload.adapter import PRODUCTS_SQL, products, table
from workload.files import PART_SQL, changes, database, folder, parts
from workload.registry import query

FIELDS = [
    ("product_id", "string", None, False),
    ("category", "string", None, True),
    ("price_per_product", "decimal(18,2)", None, False),
]
# The second delivery changes the price of every third product, and brings a product per supplier.
SECOND_SQL = """second AS (
    SELECT product_id, category, price_per_product * 2 AS price_per_product
    FROM products WHERE product_id::BIGINT % 3 = 0
    UNION ALL SELECT 'S' || s_suppkey, 'supplied', abs(s_acctbal)::DECIMAL(18,2) FROM supplier
)"""
MERGED_SQL = f"""WITH {PRODUCTS_SQL}, {SECOND_SQL}
SELECT product_id, category, price_per_product::DOUBLE AS price_per_product FROM second
UNION ALL SELECT product_id, category, price_per_product::DOUBLE FROM products
WHERE product_id NOT IN (SELECT product_id FROM second)"""


CONFIG = (
    "source_name string, landing_path string, file_pattern string, file_type string, "
    "bronze_table string, validated_table string, checked_table string, rejected_table string, "
    "enrich_table string, load_type string, merge_keys string, active_flag boolean"
)


class Deliveries:
    """A landing folder of products, and the metadata of a source over it (incremental, unless changed)."""

    def __init__(self, spark: SparkSession, sf_dir: str, load_type: str = "INCREMENTAL") -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self.name, self.landing = database(spark, "loads"), folder(spark, "landing")
        self.configure(load_type)

    def configure(self, load_type: str, *others: tuple) -> None:
        """The source's load type, and further sources: (name, file pattern)."""
        rows = [
            (name, self.landing, pattern, "csv", *(f"{self.name}.{prefix}{t}" for t in ("bronze", "validated", "checked", "rejected")),
             "", load_type, "product_id", True)
            for name, pattern, prefix in [("products", "*.csv", ""), *((n, p, f"{n}_") for n, p in others)]
        ]
        config = self.spark.createDataFrame(rows, CONFIG).coalesce(1)
        config.write.mode("overwrite").saveAsTable(f"{self.name}.ingestion_config")

    def expect(self, fields: list[tuple]) -> None:
        """What the source must look like from now on."""
        rows = [("products", i, *field) for i, field in enumerate(fields)]
        kinds = "table_name string, column_order int, standard_column string, data_type string, date_format string, nullable boolean"
        self.spark.createDataFrame(rows, kinds).coalesce(1).write.mode("overwrite").saveAsTable(f"{self.name}.required_schema")

    def first(self) -> None:
        self.land(products(self.spark, self.sf_dir).select("product_id", "category", "price_per_product"))

    def second(self) -> None:
        changed = products(self.spark, self.sf_dir).filter("CAST(product_id AS BIGINT) % 3 = 0").select(
            "product_id", "category", (F.col("price_per_product") * 2).alias("price_per_product")
        )
        price = F.abs("s_acctbal").cast("decimal(18,2)").alias("price_per_product")
        added = table(self.spark, self.sf_dir, "supplier").select(
            F.concat(F.lit("S"), "s_suppkey").alias("product_id"), F.lit("supplied").alias("category"), price
        )
        self.land(changed.unionByName(added))

    def land(self, df: DataFrame) -> None:
        df.write.mode("append").option("header", True).csv(self.landing)

    def run(self, stage) -> dict:
        """One stage as a run of its own."""
        return stage(Flow(self.spark, self.name, self.name, self.name))

    def validated(self) -> DataFrame:
        rows = read_table(self.spark, f"{self.name}.validated")
        return rows.select("product_id", "category", F.col("price_per_product").cast("double").alias("price_per_product"))


@query("flow_incremental", MERGED_SQL)
def flow_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries, each stage under a run id of its own."""
    deliveries = Deliveries(spark, sf_dir)
    deliveries.expect(FIELDS)
    for land in (deliveries.first, deliveries.second):
        land()
        deliveries.run(ingest)
        deliveries.run(validate)
    return deliveries.validated()


@query("flow_incremental_after_failure", MERGED_SQL)
def flow_incremental_after_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first validation fails; after the second delivery one run catches up on both."""
    deliveries = Deliveries(spark, sf_dir)
    deliveries.expect([*FIELDS, ("colour", "string", None, True)])
    deliveries.first()
    deliveries.run(ingest)
    assert deliveries.run(validate)["failed_tables"] == 1
    deliveries.expect(FIELDS)
    deliveries.second()
    deliveries.run(ingest)
    deliveries.run(validate)
    return deliveries.validated()


# Products that lack an id: NULL keys match nothing, so a second writing would double them.
NAMELESS = "CASE WHEN product_id::BIGINT % 4 <> 0 THEN product_id END"
# Every fifth price is no number.
UNPRICED = "product_id::BIGINT % 5 = 0"
KEYLESS_FIELDS = [("product_id", "string", None, True), *FIELDS[1:]]
OUTCOME_SQL = f"""
SELECT 'valid' AS kind, product_id, category, price_per_product::DOUBLE AS price_per_product, NULL::VARCHAR AS actual_value
FROM rows WHERE price_per_product IS NOT NULL
UNION ALL SELECT 'rejected', product_id, category, NULL, 'price of ' || category FROM rows WHERE price_per_product IS NULL"""
KEYLESS_SQL = f"""keyless AS (
    SELECT {NAMELESS} AS product_id, category, CASE WHEN NOT ({UNPRICED}) THEN price_per_product END AS price_per_product FROM products)"""
KEYLESS_OUTCOME = f"WITH {PRODUCTS_SQL}, {KEYLESS_SQL}, rows AS (SELECT * FROM keyless) {OUTCOME_SQL}"


def land_keyless(deliveries: Deliveries) -> None:
    """Products of which a quarter has no id and a fifth no price."""
    price = F.when(F.expr("CAST(product_id AS BIGINT) % 5 <> 0"), F.col("price_per_product").cast("string"))
    deliveries.land(
        products(deliveries.spark, deliveries.sf_dir).select(
            F.when(F.expr("CAST(product_id AS BIGINT) % 4 <> 0"), F.col("product_id")).alias("product_id"),
            "category",
            F.coalesce(price, F.concat(F.lit("price of "), "category")).alias("price_per_product"),
        )
    )


def outcome(deliveries: Deliveries) -> DataFrame:
    """Valid rows and logged rejects."""
    log = read_table(deliveries.spark, f"{deliveries.name}.rejected_records")
    rejected = log.select(
        F.lit("rejected").alias("kind"),
        F.get_json_object("raw_record", "$.product_id").alias("product_id"),
        F.get_json_object("raw_record", "$.category").alias("category"),
        F.lit(None).cast("double").alias("price_per_product"),
        "actual_value",
    )
    valid = deliveries.validated().withColumns({"kind": F.lit("valid"), "actual_value": F.lit(None).cast("string")})
    return valid.unionByName(rejected)


@query("flow_full_then_incremental", KEYLESS_OUTCOME)
def flow_full_then_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source loaded in full becomes incremental: what the full load wrote is not merged again."""
    deliveries = Deliveries(spark, sf_dir, "FULL")
    deliveries.expect(KEYLESS_FIELDS)
    land_keyless(deliveries)
    deliveries.run(ingest)
    deliveries.run(validate)
    deliveries.configure("INCREMENTAL")
    deliveries.run(ingest)
    deliveries.run(validate)
    return outcome(deliveries)


@query("flow_replayed_load", KEYLESS_OUTCOME)
def flow_replayed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A validation that stopped between its merge and the ledger's note runs again, and writes nothing twice."""
    deliveries = Deliveries(spark, sf_dir)
    deliveries.expect(KEYLESS_FIELDS)
    land_keyless(deliveries)
    deliveries.run(ingest)
    deliveries.run(validate)
    ledger = read_table(spark, f"{deliveries.name}.file_ledger")
    lines = spark.createDataFrame(ledger.filter("state <> 'VALIDATED'").collect(), ledger.schema)
    begun = lines if not lines.isEmpty() else spark.createDataFrame(
        [row.asDict() | {"state": "VALIDATING"} for row in ledger.collect()], ledger.schema
    )
    write_table(begun.coalesce(1), f"{deliveries.name}.file_ledger", "overwrite", partition_by=["source_name"])
    assert deliveries.run(validate)["rows_read"] > 0
    return outcome(deliveries)


@query(
    "ledger_shared_folder",
    f"""WITH {PRODUCTS_SQL}, {SECOND_SQL}, landed AS (SELECT * FROM products UNION ALL BY NAME SELECT * FROM second)
SELECT source_name, product_id, category, price_per_product::DECIMAL(18,2)::VARCHAR AS price_per_product
FROM landed, (VALUES ('products'), ('parts')) AS s(source_name)""",
)
def ledger_shared_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources over one folder: each loads every file, once."""
    deliveries = Deliveries(spark, sf_dir)
    deliveries.configure("INCREMENTAL", ("parts", "part-*.CSV"))
    for land in (deliveries.first, deliveries.second):
        land()
        deliveries.run(ingest)
    deliveries.run(ingest)
    bronze = [read_table(spark, f"{deliveries.name}.{t}") for t in ("bronze", "parts_bronze")]
    rows = bronze[0].unionByName(bronze[1])
    return rows.select(F.col("source_system").alias("source_name"), "product_id", "category", "price_per_product")


PRUNED_SQL = """WITH {products}, second AS (
    SELECT product_id, 'changed' AS category, price_per_product FROM products WHERE product_id::BIGINT % 1000 = 7)
SELECT product_id, category, price_per_product::DOUBLE AS price_per_product, true AS others_kept FROM second
UNION ALL SELECT product_id, category, price_per_product::DOUBLE, true FROM products
WHERE product_id NOT IN (SELECT product_id FROM second)"""


@query("flow_incremental_pruned", PRUNED_SQL.format(products=PRODUCTS_SQL))
def flow_incremental_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A small delivery changes only the buckets of its keys; the files of all others stay as they were."""
    deliveries = Deliveries(spark, sf_dir)
    deliveries.expect(FIELDS)
    deliveries.first()
    deliveries.run(ingest)
    deliveries.run(validate)
    files = F.col("_metadata.file_path").alias("file")
    before = stage(read_table(spark, f"{deliveries.name}.validated").select(BUCKET, files).distinct(), "files-before").frame
    few = products(spark, sf_dir).filter("CAST(product_id AS BIGINT) % 1000 = 7")
    deliveries.land(few.select("product_id", F.lit("changed").alias("category"), "price_per_product"))
    deliveries.run(ingest)
    deliveries.run(validate)
    validated = read_table(spark, f"{deliveries.name}.validated")
    after = validated.select(BUCKET, files).distinct()
    touched = validated.filter("category = 'changed'").select(BUCKET).distinct()
    lost = before.join(touched, BUCKET, "left_anti").join(after, [BUCKET, "file"], "left_anti")
    return deliveries.validated().withColumn("others_kept", F.lit(lost.isEmpty()))


CHANGED = "p_type = 'PROMO'"


@query(
    "overwrite_after_merge",
    f"""{PART_SQL} WHERE p_type <> 'PROMO' UNION ALL SELECT p_partkey, p_name, p_type, p_retailprice * 2
        FROM part WHERE {CHANGED}""",
)
def overwrite_after_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merge, append, overwrite and merge again on one table."""
    name = f"{database(spark, 'again')}.parts"
    doubled = parts(spark, sf_dir).filter(CHANGED).withColumn("p_retailprice", F.col("p_retailprice") * 2)
    write_table(parts(spark, sf_dir), name, "overwrite")
    write_table(changes(spark, sf_dir), name, "merge", merge_keys=["p_partkey"])
    write_table(changes(spark, sf_dir), name, "append")
    write_table(parts(spark, sf_dir), name, "overwrite")
    write_table(doubled, name, "merge", merge_keys=["p_partkey"])
    return read_table(spark, name)


@query(
    "upsert_other_partition",
    f"""{PART_SQL} WHERE p_type <> 'PROMO' UNION ALL SELECT p_partkey, p_name, 'MOVED', p_retailprice
        FROM part WHERE {CHANGED}""",
)
def upsert_other_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows move to another partition: their old one is emptied, the others keep their files."""
    name = f"{database(spark, 'moved')}.parts"
    write_table(parts(spark, sf_dir), name, "overwrite", partition_by=["p_type"])
    moved = parts(spark, sf_dir).filter(CHANGED).withColumn("p_type", F.lit("MOVED"))
    write_table(moved, name, "merge", merge_keys=["p_partkey"])
    return read_table(spark, name)


@query(
    "bronze_partitioned_landing",
    "SELECT p_type AS kind, 'kind=' || p_type AS folder, count(*) AS rows FROM part GROUP BY p_type",
)
def bronze_partitioned_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files in partition folders keep the folder's column, and their lineage tells the folders apart."""
    landing = folder(spark, "landing")
    named = parts(spark, sf_dir).withColumnRenamed("p_type", "kind")
    named.coalesce(1).write.partitionBy("kind").parquet(landing)
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(landing).select("path")
    bronze = union_scans([to_bronze(s, "run-1", "parts") for s in scan_landing(spark, landing, "*.parquet", "parquet", listed)])
    return bronze.groupBy("kind", F.split("source_file_name", "/")[0].alias("folder")).agg(F.count("*").alias("rows"))
