"""Stock after sales, and the products that ran below zero."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.functions.stock import final_stock, outgoing
from tillwright.schemas import INVENTORY, STOCK_KEY


def units_per_product(sales: DataFrame) -> DataFrame:
    """Units sold per slot and product."""
    return sales.groupBy(*STOCK_KEY).agg(F.sum("units_sold").alias("units"))


def reconcile_inventory(opening: DataFrame, sales: DataFrame) -> DataFrame:
    """Opening stock with the units sold in its slot taken off.

    ``opening`` has one row per slot and product with ``in_stock``,
    ``new_product`` and ``returned_product``. Products without sales keep their
    stock; sales of products that are not stocked are left to ``orphan_sales``.
    Sales are summed before the join, so each key meets at most one row.
    """
    sold = units_per_product(sales)
    stock = (
        opening.join(sold, STOCK_KEY, "left")
        .withColumn("units_sold", outgoing(F.col("units")))
        .withColumn("final_stock", final_stock())
        .withColumn("inventory_date", F.col("date").cast("string"))
        .withColumn("inventory_hour", F.col("hour"))
    )
    return stock.select(*INVENTORY.fieldNames(), "date", "hour")


def negative_stock(inventory: DataFrame) -> DataFrame:
    """Rows whose stock ended below zero."""
    return inventory.where(F.col("final_stock") < 0)
