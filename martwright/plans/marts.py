"""The marts and profit reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martwright.operators.staging import stage
from martwright.plans.star import Lookup, Star, master_profit, measured
from martwright.sources.tables import full_name

YEAR = "order_year"
TOTAL = "total"


@dataclass(frozen=True)
class Mart:
    keys: tuple[str, ...]
    order: tuple[str, ...] = ()
    descending: bool = False
    # profit only, rounded; otherwise all five sales measures
    profit_only: bool = False


# Keys and sort order of the marts and reports.
MARTS: dict[str, Mart] = {
    "profit_summary": Mart(
        keys=(YEAR, "product_category", "product_sub_category", "customer_id", "customer_name"),
        order=(YEAR, "product_category", "product_sub_category", "customer_name"),
        profit_only=True,
    ),
    "customer_summary": Mart(
        keys=(
            "customer_id",
            "customer_name",
            "segment",
            "country",
            "state",
            "city",
            "customer_region",
        )
    ),
    "product_summary": Mart(
        keys=("product_id", "product_name", "product_category", "product_sub_category")
    ),
    "daily_sales": Mart(keys=("order_date",), order=("order_date",)),
}

# Keys and sort order of the profit reports.
REPORTS: dict[str, Mart] = {
    "profit_by_year": Mart(keys=(YEAR,), order=(YEAR,), profit_only=True),
    "profit_by_year_category": Mart(
        keys=(YEAR, "product_category"), order=(YEAR, "product_category"), profit_only=True
    ),
    "profit_by_customer": Mart(
        keys=("customer_id", "customer_name"), order=("total_profit",), descending=True, profit_only=True
    ),
    "profit_by_customer_year": Mart(
        keys=("customer_id", "customer_name", YEAR),
        order=("customer_name", YEAR),
        profit_only=True,
    ),
}

# partial measure: (column, how it is computed over lines)
_PARTIALS = {
    "total_quantity": F.sum,
    "total_sales": F.sum,
    "total_profit": F.sum,
    "discount_sum": F.sum,
    "discount_count": F.count,
    "total_orders": F.count_distinct,
}
_SOURCES = {
    "total_quantity": "quantity",
    "total_sales": "price",
    "total_profit": "profit",
    "discount_sum": "discount",
    "discount_count": "discount",
    "total_orders": "order_id",
}


def over_master(master: DataFrame, mart: Mart, ordered: bool = True) -> DataFrame:
    """The mart as one aggregation over a sales master. Sort only what is read, not written."""
    rows = master.withColumn(YEAR, F.year("order_date"))
    grouped = rows.groupBy(*mart.keys).agg(*_line_measures(mart))
    return _finished(grouped, mart, ordered)


def over_star(source: Star, mart: Mart, ordered: bool = True) -> DataFrame:
    """The mart straight from order lines and lookups, joining only what it needs."""
    needs = [(lookup, _needed(lookup, mart)) for lookup in source.lookups]
    lookups = zip(measured(needs), (names for _, names in needs), strict=True)
    rows = source.orders.withColumns({YEAR: F.year("order_date"), "profit": master_profit()})
    late: list[tuple[Lookup, list[str]]] = []
    keys = list(mart.keys)
    for lookup, names in lookups:
        if lookup.unique and not names:
            continue
        if lookup.key in mart.keys:
            late.append((lookup, names))
            keys = [key for key in keys if key not in names]
        else:
            rows = rows.join(lookup.lend(names), lookup.key, "left")
    grouped = rows.groupBy(*keys).agg(*_line_measures(mart))
    for lookup, names in late:
        grouped = grouped.join(lookup.lend(names), lookup.key, "left")
    if any(not lookup.unique for lookup, _ in late):
        grouped = grouped.groupBy(*mart.keys).agg(*_group_measures(mart))
    return _finished(grouped, mart, ordered)


def _needed(lookup: Lookup, mart: Mart) -> list[str]:
    return [name for name in lookup.columns if name in mart.keys]


def _measures(mart: Mart) -> list[str]:
    return ["total_profit"] if mart.profit_only else list(_PARTIALS)


def _line_measures(mart: Mart) -> list[Column]:
    return [_PARTIALS[name](_SOURCES[name]).alias(name) for name in _measures(mart)]


def _group_measures(mart: Mart) -> list[Column]:
    """Again after a late join to a lookup with repeated keys.

    All rows of such a group stem from one aggregated row, so its order count stands.
    """
    return [
        (F.max if name == "total_orders" else F.sum)(name).alias(name) for name in _measures(mart)
    ]


def _finished(grouped: DataFrame, mart: Mart, ordered: bool) -> DataFrame:
    if mart.profit_only:
        measures = [F.round("total_profit", 2).alias("total_profit")]
    else:
        average = F.try_divide(F.col("discount_sum").cast("double"), "discount_count")
        measures = [
            F.col("total_quantity"),
            F.col("total_sales"),
            F.col("total_profit"),
            average.alias("average_discount"),
            F.col("total_orders"),
        ]
    result = grouped.select(*mart.keys, *measures)
    if ordered and mart.order:
        return result.orderBy(*mart.order, ascending=not mart.descending)
    return result


def profit_rollup(master: DataFrame, reports: dict[str, Mart] | None = None) -> DataFrame:
    """All profit reports and the grand total by one aggregation over a sales master.

    One shuffle: each line counts towards every report in the partial
    aggregation. Columns: report, every report's keys (NULL where a report has no
    such key), total_profit. Over no lines the result is empty.
    """
    reports = REPORTS if reports is None else reports
    keys = list(dict.fromkeys(key for report in reports.values() for key in report.keys))
    sets = [list(report.keys) for report in reports.values()]
    # The bit of a key, the first one's the highest, is set where the report lacks it.
    levels = [sum((key not in names) << k for k, key in enumerate(reversed(keys))) for names in [*sets, []]]
    lines = master.select(*[F.year("order_date").alias(YEAR) if key == YEAR else key for key in keys], "profit")
    grouped = lines.groupingSets([*sets, []], *keys).agg(
        F.grouping_id().alias("level"), F.sum("profit").alias("total_profit")
    )
    name = F.lit(None).cast("string")
    for level, report in zip(levels, [*reports, TOTAL], strict=True):
        name = F.when(F.col("level") == level, report).otherwise(name)
    return grouped.select(
        name.alias("report"), *keys, F.round("total_profit", 2).alias("total_profit")
    )


def placed(rows: DataFrame, mart: Mart, position: str = "position") -> DataFrame:
    """A mart's rows with their place in its order, from 1; ties go by the keys, in their order.

    Sorted by ranges and staged; a range begins after the rows of all ranges
    before it, so no task holds more than one range. Only the counts of the ranges
    pass through one task.
    """
    upwards = not mart.descending
    order = [F.asc(c) if upwards else F.desc(c) for c in mart.order]
    order += [F.asc(key) for key in mart.keys if key not in mart.order]
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    numbered = rows.orderBy(*order).withColumns({"__range": F.spark_partition_id(), "__within": within})
    ranges = stage(numbered, "placed").frame
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranges.groupBy("__range").agg(F.count(F.lit(1)).alias("rows"))
    starts = sizes.select("__range", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("__start"))
    place = (F.col("__start") + F.col("__within") + 1).alias(position)
    # One row a range of the sort, at most spark.sql.shuffle.partitions.
    return ranges.join(F.broadcast(starts), "__range").select(place, *rows.columns)


def report_sql(name: str, table: str) -> str:
    """A profit report as SQL text over a written sales master."""
    report = REPORTS[name]
    keys = [f"year(order_date) AS {YEAR}" if key == YEAR else key for key in report.keys]
    direction = " DESC" if report.descending else ""
    return (
        f"SELECT {', '.join(keys)}, round(sum(profit), 2) AS total_profit FROM {table} "
        f"GROUP BY {', '.join(report.keys)} ORDER BY {', '.join(report.order)}{direction}"
    )


def run_report(spark: SparkSession, name: str, table: str) -> DataFrame:
    return spark.sql(report_sql(name, full_name(spark, table)))
