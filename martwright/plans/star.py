"""Order lines with customer and product lookups, and the marts over them.

A mart is declared by its keys and measures. Over a written sales master it is
one aggregation. Straight from the star it joins only what its keys need:
an unused lookup is left out once its key is known to be unique, and a lookup
whose id is itself a mart key is joined after the aggregation, on far fewer
rows. Both give the rows of the full join, also when lookup keys repeat.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace
from functools import reduce
from math import ceil, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.operators.staging import BROADCAST_BYTES, broadcast_within, row_bytes

# Columns of the sales master, in order.
ORDER_COLUMNS = (
    "row_id",
    "order_id",
    "order_date",
    "ship_date",
    "ship_mode",
    "customer_id",
    "product_id",
    "quantity",
    "price",
    "discount",
    "profit",
    "pipeline_run_id",
    "source_system",
    "source_file_name",
    "ingestion_timestamp",
    "ingestion_date",
)
CUSTOMER_COLUMNS = (
    "customer_name",
    "segment",
    "country",
    "city",
    "state",
    "postal_code",
    "region",
    "customer_full_address",
    "customer_region",
)
# sales-master name: name in the product table
PRODUCT_COLUMNS = {
    "product_category": "category",
    "product_sub_category": "sub_category",
    "product_name": "product_name",
    "category_name": "category_name",
    "sub_category_name": "sub_category_name",
    "price_per_product": "price_per_product",
}

# Lines are dealt to cells by both lookups' keys when neither lookup is small: so much of each, by the
# bound of row_bytes, a cell's task holds in memory, and so many cells there are at most.
CELL_BYTES = 256 * 1024 * 1024
MOST_CELLS = 1024
CELL = "__cell"
# Key types whose equal values have equal hashes.
DEALT_TYPES = (T.StringType(), T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.DateType())


@dataclass(frozen=True)
class Lookup:
    """A dimension: its key and the columns it lends, under their master names."""

    frame: DataFrame
    key: str
    columns: Mapping[str, str]
    unique: bool = False
    bytes: int | None = None
    # Bytes by column, and of the key alone under its name, once the whole lookup is measured.
    sizes: Mapping[str, int] | None = None

    def rows(self, names: list[str]) -> DataFrame:
        picked = [F.col(self.columns[name]).alias(name) for name in names]
        return self.frame.select(self.key, *picked)

    def lend(self, names: list[str]) -> DataFrame:
        """The rows to join, to be broadcast if measured small."""
        return broadcast_within(self.rows(names), self.bytes)


@dataclass(frozen=True)
class Star:
    orders: DataFrame
    customers: Lookup
    products: Lookup

    @property
    def lookups(self) -> tuple[Lookup, Lookup]:
        return self.customers, self.products


def star(orders: DataFrame, customers: DataFrame, products: DataFrame) -> Star:
    return Star(
        orders,
        Lookup(customers, "customer_id", {name: name for name in CUSTOMER_COLUMNS}),
        Lookup(products, "product_id", PRODUCT_COLUMNS),
    )


def measured(needs: list[tuple[Lookup, list[str]]]) -> list[Lookup]:
    """Each lookup with its key's uniqueness and its broadcast size known.

    One job over the lookups' needed columns. Hot keys shrink in the partial
    aggregation; a NULL key joins nothing and is no duplicate.
    """
    if all(lookup.sizes is not None for lookup, _ in needs):
        return [replace(lookup, bytes=sum(lookup.sizes[n] for n in [lookup.key, *names])) for lookup, names in needs]
    parts = []
    for position, (lookup, names) in enumerate(needs):
        rows = lookup.rows(names)
        key = F.col(lookup.key).cast("string").alias("key")
        size = row_bytes(rows.schema).alias("bytes")
        parts.append(rows.select(F.lit(position).alias("lookup"), key, size))
    per_key = (
        reduce(DataFrame.unionAll, parts)
        .groupBy("lookup", "key")
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("bytes").alias("bytes"))
    )
    repeats = F.max(F.when(F.col("key").isNotNull(), F.col("rows")).otherwise(0)).alias("repeats")
    found = per_key.groupBy("lookup").agg(repeats, F.sum("bytes").alias("bytes")).collect()
    by_position = {row.lookup: row for row in found}
    return [
        replace(lookup, unique=row.repeats <= 1, bytes=row.bytes)
        if (row := by_position.get(position))
        else replace(lookup, unique=True, bytes=0)
        for position, (lookup, _) in enumerate(needs)
    ]


def measured_star(source: Star) -> Star:
    """The star with its lookups measured column by column, once for any number of marts.

    One job. The lookups must not change while marts are built from the result.
    """
    parts = []
    for position, lookup in enumerate(source.lookups):
        rows = lookup.rows(list(lookup.columns))
        base = row_bytes(rows.select(lookup.key).schema)
        extra = [row_bytes(rows.select(name).schema) - row_bytes(T.StructType()) for name in lookup.columns]
        key = F.col(lookup.key).cast("string").alias("key")
        parts.append(rows.select(F.lit(position).alias("lookup"), key, F.array(base, *extra).alias("sizes")))
    widest = max(len(lookup.columns) for lookup in source.lookups) + 1
    columns = [F.try_element_at("sizes", F.lit(k + 1)).alias(f"size_{k}") for k in range(widest)]
    sums = [F.sum(f"size_{k}").alias(f"size_{k}") for k in range(widest)]
    per_key = (
        reduce(DataFrame.unionAll, parts)
        .select("lookup", "key", *columns)
        .groupBy("lookup", "key")
        .agg(F.count(F.lit(1)).alias("rows"), *sums)
    )
    repeats = F.max(F.when(F.col("key").isNotNull(), F.col("rows")).otherwise(0)).alias("repeats")
    found = {row.lookup: row for row in per_key.groupBy("lookup").agg(repeats, *sums).collect()}
    done = []
    for position, lookup in enumerate(source.lookups):
        row, names = found.get(position), [lookup.key, *lookup.columns]
        sizes = {name: row[f"size_{k}"] if row else 0 for k, name in enumerate(names)}
        done.append(replace(lookup, unique=row is None or row.repeats <= 1, sizes=sizes))
    return replace(source, customers=done[0], products=done[1])


def master_profit() -> Column:
    return F.round("profit", 2).alias("profit")


def sales_master(source: Star, measure: bool = True) -> DataFrame:
    """Every order line, with its customer and product where known (left joins).

    Measured lookups are broadcast when small, which spares shuffling the
    lines. Two large ones with unique keys are joined cell by cell, after one
    shuffle of the narrow lines; otherwise both joins shuffle, the second one lines with the first
    one's columns, and adaptive execution splits hot keys.
    """
    joined = source.orders
    lookups = source.lookups
    if measure:
        lookups = measured([(lookup, list(lookup.columns)) for lookup in lookups])
    if grid := _grid(joined, *lookups):
        joined = _joined_by_cell(joined, *lookups, *grid)
    else:
        for lookup in lookups:
            joined = joined.join(lookup.lend(list(lookup.columns)), lookup.key, "left")
    facts = [master_profit() if name == "profit" else F.col(name) for name in ORDER_COLUMNS]
    return joined.select(*facts, *CUSTOMER_COLUMNS, *PRODUCT_COLUMNS)


def _grid(lines: DataFrame, first: Lookup, second: Lookup) -> tuple[int, int] | None:
    """Parts of each lookup's keys, if its rows and the lines are to be dealt to cells.

    A part of a lookup goes to all cells in its row, or column, of the grid; the numbers
    are chosen so that these copies are few.
    """
    for lookup in (first, second):
        if not lookup.unique or lookup.bytes is None or lookup.bytes <= BROADCAST_BYTES:
            return None
        kind = lines.schema[lookup.key].dataType
        if kind not in DEALT_TYPES or kind != lookup.frame.schema[lookup.key].dataType:
            return None
    least = [ceil(lookup.bytes / CELL_BYTES) for lookup in (first, second)]
    cells = max(least[0] * least[1], 2 * lines.sparkSession.sparkContext.defaultParallelism)
    across = max(least[0], round(sqrt(cells * first.bytes / second.bytes)))
    down = max(least[1], round(cells / across))
    return (across, down) if across * down <= MOST_CELLS else None


def _joined_by_cell(lines: DataFrame, first: Lookup, second: Lookup, across: int, down: int) -> DataFrame:
    """Both left joins after one shuffle: a line lies in one cell, with the parts of both lookups that its keys can be in."""
    cells = across * down

    def part(key: str, parts: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")

    def dealt(lookup: Lookup, parts: int, others: int, cell: Callable[[Column, Column], Column]) -> DataFrame:
        rows = lookup.rows(list(lookup.columns)).filter(F.col(lookup.key).isNotNull())
        copies = rows.withColumn("__other", F.explode(F.sequence(F.lit(0), F.lit(others - 1))))
        placed = copies.withColumn(CELL, cell(part(lookup.key, parts), F.col("__other"))).drop("__other")
        return placed.repartitionById(cells, CELL).hint("shuffle_hash")

    def line_part(key: str, parts: int) -> Column:
        # A NULL key matches nothing; such lines are dealt by their own ids.
        own = F.pmod(F.xxhash64("row_id", "order_id", F.lit(key)), F.lit(parts)).cast("int")
        return F.when(F.col(key).isNull(), own).otherwise(part(key, parts))

    placed = lines.withColumn(CELL, line_part(first.key, across) * down + line_part(second.key, down))
    joined = placed.repartitionById(cells, CELL)
    joined = joined.join(dealt(first, across, down, lambda own, other: own * down + other), [CELL, first.key], "left")
    return joined.join(dealt(second, down, across, lambda own, other: other * down + own), [CELL, second.key], "left")
