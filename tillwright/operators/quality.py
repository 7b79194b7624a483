"""Rows that break the pricing and stock rules, with the reasons."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.functions.money import TIER_UNITS, discount_in_tier, net_amount
from tillwright.functions.stock import final_stock
from tillwright.operators.inventory import units_per_product
from tillwright.schemas import STOCK_KEY

# Stored totals are products of doubles and never rounded.
TOLERANCE = 0.005
# What a sale must have; a rule on a missing value says nothing.
STOCKED = ["product_id", "in_stock", "new_product", "returned_product", "units_sold", "final_stock"]
MEASURED = ["product_id", "unit_price", "units_sold", "discount_applied", "total_ammount_paid"]


def _differs(left: Column, right: Column, tolerance: float = TOLERANCE) -> Column:
    return F.abs(left - right) > tolerance


def _reasons(**rules: Column) -> Column:
    """Comma text of the rules that are true; null counts as not broken."""
    return F.concat_ws(",", *[F.when(broken, F.lit(name)) for name, broken in rules.items()])


def _other_slot(body_date: str, body_hour: str) -> Column:
    return ~(
        F.col(body_date).eqNullSafe(F.col("date").cast("string"))
        & F.col(body_hour).eqNullSafe(F.col("hour"))
    )


def discount_violations(sales: DataFrame, threshold: int = TIER_UNITS) -> DataFrame:
    """Sales whose discount is outside the tier of their units."""
    return sales.where(
        ~discount_in_tier(F.col("units_sold"), F.col("discount_applied"), threshold)
    )


def catalog_prices(catalog: DataFrame) -> DataFrame:
    """Lowest and highest listed price per slot and product (one row per key)."""
    # Keys hardly repeat, so a task holds all it gets: that is evened out first, a hot
    # product included.
    listed = catalog.select(*STOCK_KEY, "unit_price").hint("rebalance", *[F.col(k) for k in STOCK_KEY])
    prices = listed.groupBy(*STOCK_KEY).agg(
        F.min("unit_price").alias("low_price"), F.max("unit_price").alias("high_price")
    )
    # Dealt out anew, or adaptive execution could not split the join of a hot product:
    # it does so only where both sides are shuffled for the join itself.
    return prices.hint("rebalance")


def _outside_listed(price: Column) -> Column:
    return (price < F.col("low_price") - TOLERANCE) | (price > F.col("high_price") + TOLERANCE)


def price_mismatch(sales: DataFrame, catalog: DataFrame) -> DataFrame:
    """Sales whose price is not the one of their product's snapshot in that slot."""
    return (
        sales.join(catalog_prices(catalog), STOCK_KEY)
        .where(_outside_listed(F.col("unit_price")))
        .select(*sales.columns, "low_price", "high_price")
    )


def check_sales(sales: DataFrame, catalog: DataFrame, threshold: int = TIER_UNITS) -> DataFrame:
    """Sales that break a rule, with ``reasons`` out of missing, total, price, discount, slot.

    Products missing from the catalog are no finding here; see ``orphan_sales``.
    """
    checked = sales.join(catalog_prices(catalog), STOCK_KEY, "left").withColumn(
        "reasons",
        _reasons(
            missing=reduce(or_, [F.col(name).isNull() for name in MEASURED]),
            total=_differs(
                F.col("total_ammount_paid"),
                net_amount(F.col("unit_price"), F.col("discount_applied"), F.col("units_sold")),
            ),
            price=_outside_listed(F.col("unit_price")),
            discount=~discount_in_tier(
                F.col("units_sold"), F.col("discount_applied"), threshold
            ),
            slot=_other_slot("transaction_date", "transaction_hour"),
        ),
    )
    return checked.where(F.col("reasons") != "").select(*sales.columns, "reasons")


def check_inventory(inventory: DataFrame, sales: DataFrame) -> DataFrame:
    """Stock rows that break a rule, with ``reasons`` out of missing, stock, units, slot."""
    checked = inventory.join(units_per_product(sales), STOCK_KEY, "left").withColumn(
        "reasons",
        _reasons(
            missing=reduce(or_, [F.col(name).isNull() for name in STOCKED]),
            stock=F.col("final_stock") != final_stock(),
            units=-F.col("units_sold") != F.coalesce(F.col("units"), F.lit(0)),
            slot=_other_slot("inventory_date", "inventory_hour"),
        ),
    )
    return checked.where(F.col("reasons") != "").select(*inventory.columns, "reasons")
