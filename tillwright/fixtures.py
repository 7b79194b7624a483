"""Retail datasets derived from the given tables, in Spark and as oracle SQL.

Every view covers its whole tables. ``yearly`` posts rows on the last day of
their year: the lake and table queries use it, as a folder per ship date and
hour would hold one or two rows here. That gives some 170 slots of a few hundred
rows, the size the datasets are made for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.functions.money import net_amount
from tillwright.functions.texts import customer_code, padded, product_code
from tillwright.operators.inventory import reconcile_inventory
from tillwright.operators.slots import hour_code, local_slots
from tillwright.schemas import CATALOG, SALES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _posted(yearly: bool) -> Column:
    shipped = F.col("l_shipdate").cast("date")
    return F.concat(F.year(shipped), F.lit("-12-31")) if yearly else shipped.cast("string")


def _slotted(lines: DataFrame, yearly: bool) -> DataFrame:
    return (
        lines
        .withColumn("date", _posted(yearly))
        .withColumn("at", F.col("l_orderkey") % 24)
        .withColumn("hour", hour_code(F.col("at")))
    )


def _lines(spark: SparkSession, sf_dir: str, yearly: bool) -> DataFrame:
    return _slotted(table(spark, sf_dir, "lineitem"), yearly)


def _sold() -> list[Column]:
    """Columns of a sale, told from its order line."""
    return [
        F.col("date").alias("transaction_date"),
        F.when(F.col("l_returnflag") == "R", "00").otherwise(F.col("hour"))
        .alias("transaction_hour"),
        F.concat_ws(
            "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
        ).alias("transaction_id"),
        product_code(F.col("l_partkey")).alias("product_id"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        F.col("l_quantity").cast("long").alias("units_sold"),
        F.col("l_discount").alias("discount_applied"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("total_ammount_paid"),
        F.col("date"),
        F.col("hour"),
        F.col("l_orderkey"),
        F.col("l_returnflag"),
    ]


def sales(spark: SparkSession, sf_dir: str, yearly: bool = False) -> DataFrame:
    """One sale per order line, without its buyer.

    Returned lines carry hour 00 in the row, whatever slot they are stored in.
    """
    return _lines(spark, sf_dir, yearly).select(*_sold())


def full_sales(spark: SparkSession, sf_dir: str, yearly: bool = False, *more: str) -> DataFrame:
    """Sales with customer and country, in the columns of the sales dataset, and ``more``.

    Order lines are joined as they are stored, the texts are made of the joined rows: they
    are twice as wide.
    """
    buyers = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "n_name")
    )
    bought = _slotted(table(spark, sf_dir, "lineitem").join(buyers, "l_orderkey"), yearly)
    return bought.select(
        *_sold(), customer_code(F.col("o_custkey")).alias("customer_id"),
        F.col("n_name").alias("order_country"),
    ).select(*SALES.fieldNames(), "date", "hour", *more)


def listings(spark: SparkSession, sf_dir: str, yearly: bool = False) -> DataFrame:
    """Slots and parts of the catalog.

    A part is listed on a date when a line of it was shipped and not returned,
    in two snapshots: at its first such hour and at the date's last. Sales of
    parts that were only returned stay without a listing.
    """
    kept = _lines(spark, sf_dir, yearly).where(F.col("l_returnflag") != "R")
    # Numbers, as a least or greatest text per group would need sorted groups. The
    # date's last hour comes from the lines, so a row per date and task is shuffled for it; it is
    # joined, as a window would make a date, or a year, the work of one task.
    opened = kept.groupBy("date", "l_partkey").agg(F.min("at").alias("first"))
    closing = kept.groupBy(F.col("date").alias("day")).agg(F.max("at").alias("last"))
    # A row per date is broadcast.
    listed = opened.join(F.broadcast(closing), F.col("date").eqNullSafe(F.col("day"))).select(
        "date", "l_partkey", F.explode(F.array_distinct(F.array("first", "last"))).alias("at")
    )
    return listed.select("date", "l_partkey", hour_code(F.col("at")).alias("hour"))


def catalog(spark: SparkSession, sf_dir: str, yearly: bool = False) -> DataFrame:
    """Catalog snapshots in the columns of the catalog dataset."""
    parts = table(spark, sf_dir, "part")
    return (
        listings(spark, sf_dir, yearly)
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("date").alias("ingestion_date"),
            F.col("hour").alias("ingestion_hour"),
            product_code(F.col("p_partkey")).alias("product_id"),
            # Quotes and commas, so that files have to escape them.
            F.concat(F.lit('"'), "p_name", F.lit('" no. '), F.col("p_size").cast("string"))
            .alias("product_name"),
            F.concat(F.lit("CAT-"), padded(F.length("p_type"), 2)).alias("category_id"),
            F.col("p_type").alias("category_name"),
            F.col("p_brand").alias("brand"),
            F.concat(F.lit("A "), "p_type", F.lit(", "), "p_name").alias("description"),
            F.col("p_retailprice").alias("unit_price"),
            F.concat(F.col("p_brand"), F.lit(" Supplies")).alias("supplier_name"),
            F.concat_ws(", ", "p_type", "p_brand", "p_name").alias("tags"),
            "date",
            "hour",
        )
        .select(*CATALOG.fieldNames(), "date", "hour")
    )


def opening_stock(spark: SparkSession, sf_dir: str, yearly: bool = False) -> DataFrame:
    """Stock before sales of every listed part, by formula of its number."""
    number = F.col("l_partkey")
    return listings(spark, sf_dir, yearly).select(
        "date",
        "hour",
        product_code(number).alias("product_id"),
        (number * 13 % 40).alias("in_stock"),
        (number * 7 % 20).alias("new_product"),
        (-(number * 3 % 20)).alias("returned_product"),
    )


def inventory(spark: SparkSession, sf_dir: str, yearly: bool = False) -> DataFrame:
    return reconcile_inventory(
        opening_stock(spark, sf_dir, yearly), sales(spark, sf_dir, yearly)
    )


def event_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the wall-time slot of their instant."""
    return local_slots(table(spark, sf_dir, "events"), "ts")


def user_clocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A clock per user, stopped at the user's last event."""
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.max("ts").alias("now_utc"))


def tier_price(df: DataFrame) -> DataFrame:
    """Sales with the total recomputed from price, discount and units."""
    return df.withColumn(
        "net",
        net_amount(F.col("unit_price"), F.col("discount_applied"), F.col("units_sold")),
    )


def oracle_views(yearly: bool = False) -> str:
    """The same views for DuckDB: a WITH list, to be followed by a SELECT."""
    form = "%Y-12-31" if yearly else "%Y-%m-%d"
    return f"""
WITH lines AS (
  SELECT *, strftime(l_shipdate, '{form}') AS date,
         printf('%02d', l_orderkey % 24) AS hour
  FROM lineitem
), sales AS (
  SELECT date AS transaction_date,
         CASE WHEN l_returnflag = 'R' THEN '00' ELSE hour END AS transaction_hour,
         concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS transaction_id,
         printf('CUST_%04d', o_custkey) AS customer_id, n_name AS order_country,
         printf('PROD_%04d', l_partkey) AS product_id,
         l_extendedprice / l_quantity AS unit_price,
         CAST(l_quantity AS BIGINT) AS units_sold,
         l_discount AS discount_applied,
         l_extendedprice * (1 - l_discount) AS total_ammount_paid,
         date, hour, l_returnflag
  FROM lines JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
), kept AS (
  SELECT * FROM lines WHERE l_returnflag <> 'R'
), listings AS (
  SELECT date, l_partkey, min(hour) AS hour FROM kept GROUP BY date, l_partkey
  UNION
  SELECT a.date, a.l_partkey, b.hour
  FROM (SELECT DISTINCT date, l_partkey FROM kept) a
  JOIN (SELECT date, max(hour) AS hour FROM kept GROUP BY date) b ON a.date = b.date
), catalog AS (
  SELECT date AS ingestion_date, hour AS ingestion_hour,
         printf('PROD_%04d', p_partkey) AS product_id,
         '"' || p_name || '" no. ' || CAST(p_size AS VARCHAR) AS product_name,
         printf('CAT-%02d', length(p_type)) AS category_id,
         p_type AS category_name, p_brand AS brand,
         'A ' || p_type || ', ' || p_name AS description,
         p_retailprice AS unit_price, p_brand || ' Supplies' AS supplier_name,
         p_type || ', ' || p_brand || ', ' || p_name AS tags, date, hour
  FROM listings JOIN part ON l_partkey = p_partkey
), opening AS (
  SELECT date, hour, printf('PROD_%04d', l_partkey) AS product_id,
         l_partkey * 13 % 40 AS in_stock, l_partkey * 7 % 20 AS new_product,
         -(l_partkey * 3 % 20) AS returned_product
  FROM listings
), sold AS (
  SELECT date, hour, product_id, CAST(sum(units_sold) AS BIGINT) AS units
  FROM sales GROUP BY date, hour, product_id
), inventory AS (
  SELECT o.date AS inventory_date, o.hour AS inventory_hour, o.product_id, in_stock,
         new_product, returned_product, -coalesce(units, 0) AS units_sold,
         in_stock + new_product + returned_product - coalesce(units, 0) AS final_stock,
         o.date AS date, o.hour AS hour
  FROM opening o LEFT JOIN sold s
  ON o.date = s.date AND o.hour = s.hour AND o.product_id = s.product_id
)"""
