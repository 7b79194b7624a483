"""Reports, catalog snapshots and expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwright import fixtures as fx
from tillwright.functions import money, texts
from tillwright.operators import reports as op
from tillwright.operators.catalog import expand_catalog
from tillwright.operators.slots import latest_lists, resolve_slots
from tillwright.registry.entry import Query, daily

# The report as specified: hour is no join key, so a sale counts per snapshot. Sums of
# doubles depend on the order of the rows, so both sides are rounded to the four
# decimals that the amounts of the given tables have.
_REPORT = """
SELECT a.date, b.category_name,
       CAST(SUM(a.units_sold) AS BIGINT) AS units_sold,
       round(SUM(a.total_ammount_paid), 4) AS total_ammount_paid
FROM sales a JOIN {catalog} b ON a.date = b.date AND a.product_id = b.product_id
WHERE b.category_name IS NOT NULL {dates}
GROUP BY a.date, b.category_name
"""
REPORT = _REPORT.format(catalog="catalog", dates="")
_PINNED = """(SELECT c.* FROM catalog c
  JOIN (SELECT date, max(hour) AS hour FROM catalog GROUP BY date) m
  ON c.date = m.date AND c.hour = m.hour)"""
_IN_DATES = "AND a.date IN (SELECT date FROM catalog GROUP BY date HAVING max(hour) = '23')"


def rounded(report):
    return report.withColumn("total_ammount_paid", F.round("total_ammount_paid", 4))


def _category_sales(spark, sf_dir):
    return rounded(op.category_sales(fx.sales(spark, sf_dir), fx.catalog(spark, sf_dir)))


def _category_sales_dates(spark, sf_dir):
    """The report for the dates whose catalog reaches the last hour of the day."""
    catalog = fx.catalog(spark, sf_dir)
    # Found from the listings, which name each slot, before any product is looked up.
    full = fx.listings(spark, sf_dir).where(F.col("hour") == "23").select("date").distinct()
    dates = [r.date for r in full.collect()]
    return rounded(op.category_sales(fx.sales(spark, sf_dir), catalog, dates))


def _category_sales_pinned(spark, sf_dir):
    return rounded(
        op.category_sales_pinned(fx.sales(spark, sf_dir), fx.catalog(spark, sf_dir))
    )


def _latest_snapshots(spark, sf_dir):
    return op.latest_snapshots(fx.catalog(spark, sf_dir)).select("date", "hour", "product_id")


def _orphan_sales(spark, sf_dir):
    orphans = op.orphan_sales(fx.sales(spark, sf_dir), fx.catalog(spark, sf_dir))
    return orphans.select("date", "hour", "transaction_id", "product_id", "units_sold")


def _unstocked_sales(spark, sf_dir):
    orphans = op.orphan_sales(
        fx.sales(spark, sf_dir), fx.opening_stock(spark, sf_dir), ("date", "hour", "product_id")
    )
    return orphans.select("date", "hour", "transaction_id", "product_id", "units_sold")


def _net_amount(spark, sf_dir):
    return fx.tier_price(fx.sales(spark, sf_dir)).select("transaction_id", "units_sold", "net")


def _expand_catalog(spark, sf_dir):
    makers = (
        fx.table(spark, sf_dir, "supplier")
        .join(fx.table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(fx.table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").alias("position"),
            F.col("n_name").alias("base_name"),
            texts.category_code(F.col("r_regionkey")).alias("category_id"),
            F.col("r_name").alias("category"),
            F.col("s_name").alias("brand"),
            F.concat(F.lit("Made in "), "n_name", F.lit(".")).alias("description_suffix"),
            F.round("s_acctbal", 1).alias("unit_price"),
            F.col("s_name").alias("supplier"),
            texts.tag_text(F.array("n_name", "r_name")).alias("tags"),
        )
    )
    dates, hours = resolve_slots(fx.sales(spark, sf_dir), backfill=False)
    products = fx.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("index"))
    return expand_catalog(makers, products, list(zip(dates, hours)))


def _product_texts(spark, sf_dir):
    number = F.col("p_partkey")
    return fx.table(spark, sf_dir, "part").select(
        texts.product_code(number).alias("product_id"),
        texts.customer_code(number * 7).alias("customer_id"),
        texts.category_code(F.col("p_size").cast("long")).alias("category_id"),
        texts.product_title(F.col("p_name"), number, F.lit(9)).alias("title"),
        texts.tag_text(texts.tag_list(F.concat_ws(" , ", "p_brand", "p_type"))).alias("tags"),
        F.round(F.col("p_retailprice"), 2).alias("price"),
        money.percent(F.col("p_size")).alias("share"),
    )


def _latest_sales_day(spark, sf_dir):
    """Rows of the latest date, found by a scalar subquery in the predicate."""
    sales = fx.sales(spark, sf_dir)
    newest = latest_lists(sales).select(F.col("dates")[0])
    return sales.where(F.col("date") == newest.scalar()).select(
        "date", "hour", "transaction_id", "units_sold"
    )


QUERIES = [
    Query("category_sales", _category_sales, daily(REPORT)),
    Query(
        "category_sales_dates", _category_sales_dates,
        daily(_REPORT.format(catalog="catalog", dates=_IN_DATES)),
    ),
    Query(
        "category_sales_pinned", _category_sales_pinned,
        daily(_REPORT.format(catalog=_PINNED, dates="")),
    ),
    Query(
        "latest_snapshots", _latest_snapshots,
        daily(f"SELECT date, hour, product_id FROM {_PINNED} p"),
    ),
    Query(
        "orphan_sales", _orphan_sales,
        daily("""
SELECT date, hour, transaction_id, product_id, units_sold FROM sales s
WHERE NOT EXISTS (SELECT 1 FROM catalog c
                  WHERE c.date = s.date AND c.product_id = s.product_id)"""),
    ),
    Query(
        "unstocked_sales", _unstocked_sales,
        daily("""
SELECT date, hour, transaction_id, product_id, units_sold FROM sales s
WHERE NOT EXISTS (SELECT 1 FROM opening o
                  WHERE o.date = s.date AND o.hour = s.hour AND o.product_id = s.product_id)"""),
    ),
    Query(
        "net_amount", _net_amount,
        daily("""
SELECT transaction_id, units_sold,
       unit_price * (1 - discount_applied) * units_sold AS net FROM sales"""),
    ),
    Query(
        "expand_catalog", _expand_catalog,
        daily("""
, makers AS (
  SELECT s_suppkey AS position, n_name, s_name, r_name, r_regionkey,
         round(s_acctbal, 1) AS unit_price, (SELECT count(*) FROM supplier) AS n
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
), newest AS (
  SELECT date, max(hour) AS hour FROM sales
  WHERE date = (SELECT max(date) FROM sales) GROUP BY date
)
SELECT date AS ingestion_date, hour AS ingestion_hour,
       printf('PROD_%04d', p_partkey + 1) AS product_id,
       n_name || ' ' || printf('%02d', p_partkey + 1) || ' - '
         || CAST(CAST(ceil((p_partkey + 1) / CAST(n AS DOUBLE)) AS BIGINT) AS VARCHAR)
         AS product_name,
       printf('CAT_%03d', r_regionkey) AS category_id, r_name AS category_name,
       s_name AS brand, 'A high-quality product. Made in ' || n_name || '.' AS description,
       unit_price, s_name AS supplier_name, n_name || ', ' || r_name AS tags, date, hour
FROM part JOIN makers ON p_partkey % n = position CROSS JOIN newest"""),
    ),
    Query(
        "product_texts", _product_texts,
        """
SELECT printf('PROD_%04d', p_partkey) AS product_id,
       printf('CUST_%04d', p_partkey * 7) AS customer_id,
       printf('CAT_%03d', p_size) AS category_id,
       p_name || ' ' || printf('%02d', p_partkey + 1) || ' - '
         || CAST(CAST(ceil((p_partkey + 1) / 9.0) AS BIGINT) AS VARCHAR) AS title,
       p_brand || ', ' || p_type AS tags, round(p_retailprice, 2) AS price,
       p_size / CAST(100 AS DOUBLE) AS share
FROM part""",
    ),
    Query(
        "latest_sales_day", _latest_sales_day,
        daily("""
SELECT date, hour, transaction_id, units_sold FROM sales
WHERE date = (SELECT max(date) FROM sales)"""),
    ),
]
