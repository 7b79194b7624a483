"""Stock arithmetic. Sold units and returns are stored as negative numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def outgoing(units: Column) -> Column:
    """Sold units as stored in inventory: negative, 0 where nothing was sold."""
    return -F.coalesce(units, F.lit(0))


def final_stock() -> Column:
    return (
        F.col("in_stock") + F.col("new_product") + F.col("returned_product")
        + F.col("units_sold")
    )
