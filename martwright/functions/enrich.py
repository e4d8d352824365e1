"""Derived columns per source."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enrich_customers(df: DataFrame) -> DataFrame:
    """One-line address (NULL parts left out) and upper-case region."""
    parts = ["address", "city", "state", "country"]
    return df.withColumns(
        {
            "customer_full_address": F.concat_ws(", ", *parts),
            "customer_region": F.upper("region"),
        }
    )


def enrich_products(df: DataFrame) -> DataFrame:
    """Title-case category names."""
    return df.withColumns(
        {
            "category_name": F.initcap("category"),
            "sub_category_name": F.initcap("sub_category"),
        }
    )


def unchanged(df: DataFrame) -> DataFrame:
    return df


ENRICHMENTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "customer": enrich_customers,
    "products": enrich_products,
    "orders": unchanged,
}


def enrich(df: DataFrame, source_name: str) -> DataFrame:
    """Enrichment registered for the source; other sources pass unchanged."""
    return df.transform(ENRICHMENTS.get(source_name.lower(), unchanged))
