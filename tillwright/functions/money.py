"""Prices and discounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Discount rule (fixed values): nothing up to the threshold, then 5 to 20 percent.
TIER_UNITS = 500
TIER_UNITS_DAILY = 5
TIER_LOW = 0.05
TIER_HIGH = 0.20


def net_amount(unit_price: Column, discount: Column, units: Column) -> Column:
    return unit_price * (F.lit(1) - discount) * units


def percent(points: Column) -> Column:
    return points / F.lit(100)


def discount_in_tier(units: Column, discount: Column, threshold: int = TIER_UNITS) -> Column:
    """True where the discount is one the rule allows for that many units."""
    return F.when(units > threshold, discount.between(TIER_LOW, TIER_HIGH)).otherwise(
        discount == 0
    )

