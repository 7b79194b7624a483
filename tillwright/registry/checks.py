"""Stock reconciliation and rule checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwright import fixtures as fx
from tillwright.operators import inventory as inv
from tillwright.operators import quality as op
from tillwright.registry.entry import INVENTORY_COLUMNS, Query, daily

# Order lines hold 1 to 50 units, so the tier starts at 25 here.
_TIER = 25


def _units_per_product(spark, sf_dir):
    return inv.units_per_product(fx.sales(spark, sf_dir))


def _reconcile_inventory(spark, sf_dir):
    return fx.inventory(spark, sf_dir)


def _negative_stock(spark, sf_dir):
    return inv.negative_stock(fx.inventory(spark, sf_dir))


def _discount_violations(spark, sf_dir):
    return op.discount_violations(fx.sales(spark, sf_dir), _TIER).select(
        "transaction_id", "units_sold", "discount_applied"
    )


def _price_mismatch(spark, sf_dir):
    found = op.price_mismatch(fx.sales(spark, sf_dir), fx.catalog(spark, sf_dir))
    return found.select("date", "hour", "transaction_id", "unit_price", "low_price", "high_price")


def _check_sales(spark, sf_dir):
    found = op.check_sales(fx.sales(spark, sf_dir), fx.catalog(spark, sf_dir), _TIER)
    return found.select("date", "hour", "transaction_id", "reasons")


def _check_inventory(spark, sf_dir):
    """Inventory that hides negative stock, against the sales that were kept."""
    shown = fx.inventory(spark, sf_dir).withColumn(
        "final_stock", F.greatest(F.col("final_stock"), F.lit(0))
    )
    kept = fx.sales(spark, sf_dir).where(F.col("l_returnflag") != "R")
    return op.check_inventory(shown, kept).select("date", "hour", "product_id", "reasons")


_PRICES = """
, prices AS (
  SELECT date, hour, product_id, min(unit_price) AS low_price, max(unit_price) AS high_price
  FROM catalog GROUP BY date, hour, product_id
)"""
_BAD_DISCOUNT = f"""CASE WHEN units_sold > {_TIER}
  THEN NOT (discount_applied >= 0.05::DOUBLE AND discount_applied <= 0.2::DOUBLE)
  ELSE discount_applied <> 0 END"""

QUERIES = [
    Query(
        "units_per_product", _units_per_product,
        daily("SELECT date, hour, product_id, units FROM sold"),
    ),
    Query(
        "reconcile_inventory", _reconcile_inventory,
        daily(f"SELECT {INVENTORY_COLUMNS} FROM inventory"),
    ),
    Query(
        "negative_stock", _negative_stock,
        daily(f"SELECT {INVENTORY_COLUMNS} FROM inventory WHERE final_stock < 0"),
    ),
    Query(
        "discount_rule_violations", _discount_violations,
        daily(f"""
SELECT transaction_id, units_sold, discount_applied FROM sales WHERE {_BAD_DISCOUNT}"""),
    ),
    Query(
        "price_mismatch", _price_mismatch,
        daily(f"""{_PRICES}
SELECT s.date, s.hour, transaction_id, unit_price, low_price, high_price
FROM sales s JOIN prices p
ON s.date = p.date AND s.hour = p.hour AND s.product_id = p.product_id
WHERE unit_price < low_price - 0.005::DOUBLE OR unit_price > high_price + 0.005::DOUBLE"""),
    ),
    Query(
        "check_sales", _check_sales,
        daily(f"""{_PRICES}
, judged AS (
  SELECT s.date, s.hour, transaction_id, concat_ws(',',
    CASE WHEN abs(total_ammount_paid - unit_price * (1 - discount_applied) * units_sold)
              > 0.005::DOUBLE THEN 'total' END,
    CASE WHEN unit_price < low_price - 0.005::DOUBLE
           OR unit_price > high_price + 0.005::DOUBLE THEN 'price' END,
    CASE WHEN {_BAD_DISCOUNT} THEN 'discount' END,
    CASE WHEN transaction_date <> s.date OR transaction_hour <> s.hour THEN 'slot' END) AS reasons
  FROM sales s LEFT JOIN prices p
  ON s.date = p.date AND s.hour = p.hour AND s.product_id = p.product_id
)
SELECT date, hour, transaction_id, reasons FROM judged WHERE reasons <> ''"""),
    ),
    Query(
        "check_inventory", _check_inventory,
        daily("""
, kept_sold AS (
  SELECT date, hour, product_id, sum(units_sold) AS units FROM sales
  WHERE l_returnflag <> 'R' GROUP BY date, hour, product_id
), judged AS (
  SELECT i.date, i.hour, i.product_id, concat_ws(',',
    CASE WHEN greatest(final_stock, 0) <> final_stock THEN 'stock' END,
    CASE WHEN -units_sold <> coalesce(units, 0) THEN 'units' END) AS reasons
  FROM inventory i LEFT JOIN kept_sold k
  ON i.date = k.date AND i.hour = k.hour AND i.product_id = k.product_id
)
SELECT date, hour, product_id, reasons FROM judged WHERE reasons <> ''"""),
    ),
]
