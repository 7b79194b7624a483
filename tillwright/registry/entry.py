"""One registered query."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tillwright.fixtures import oracle_views


@dataclass(frozen=True)
class Query:
    """``run`` and ``sql`` give the same rows; without ``sql`` only rows are checked."""

    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def daily(select: str) -> str:
    return f"{oracle_views()}\n{select.strip()}"


def yearly(select: str) -> str:
    return f"{oracle_views(yearly=True)}\n{select.strip()}"


# Columns of the datasets as SQL text.
CATALOG_COLUMNS = (
    "ingestion_date, ingestion_hour, product_id, product_name, category_id, category_name, "
    "brand, description, unit_price, supplier_name, tags, date, hour"
)
SALES_COLUMNS = (
    "transaction_date, transaction_hour, transaction_id, customer_id, order_country, "
    "product_id, unit_price, units_sold, discount_applied, total_ammount_paid, date, hour"
)
INVENTORY_COLUMNS = (
    "inventory_date, inventory_hour, product_id, in_stock, new_product, returned_product, "
    "units_sold, final_stock, date, hour"
)
