"""Sales per category, and the sales such a report loses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.functions.slotted import in_dates, in_slots
from tillwright.operators.slots import slot_columns


def _of_dates(df: DataFrame, dates: list[str] | None) -> DataFrame:
    return df if dates is None else df.where(in_dates(dates))


def category_sales(sales: DataFrame, catalog: DataFrame,
                   dates: list[str] | None = None) -> DataFrame:
    """Units and revenue per date and category, joined on ``(date, product_id)``.

    The catalog holds one snapshot per hour and ``hour`` is no join key, so a
    sale counts once for every catalog row of its product and date. Rows without
    a category drop out. That is the report as specified; ``category_sales_pinned``
    counts each sale once.

    The repeated rows are never built: sales are summed per product and date,
    catalog rows are counted per product, date and category, and each sum is
    multiplied by its count. Both sides shrink before they are shuffled, and a
    product with a third of all sales joins as one row.
    """
    sold = (
        _of_dates(sales, dates)
        .groupBy("date", "product_id")
        .agg(
            F.sum("units_sold").alias("units"),
            F.sum("total_ammount_paid").alias("paid"),
        )
    )
    listed = (
        _of_dates(catalog, dates)
        .where(F.col("category_name").isNotNull())
        .groupBy("date", "product_id", "category_name")
        .agg(F.count(F.lit(1)).alias("listings"))
    )
    return _per_category(sold, listed)


def category_sales_of_sums(sums: DataFrame, counts: DataFrame,
                           dates: list[str] | None = None) -> DataFrame:
    """``category_sales`` from sums per slot and product, which ``slot_sums`` and
    ``slot_counts`` give, in place of sales and catalog rows."""
    sold = _of_dates(sums, dates).groupBy("date", "product_id").agg(
        F.sum("units").alias("units"), F.sum("paid").alias("paid"))
    listed = _of_dates(counts, dates).groupBy("date", "product_id", "category_name").agg(
        F.sum("listings").alias("listings"))
    return _per_category(sold, listed)


def slot_sums(sales: DataFrame) -> DataFrame:
    """Units and revenue per slot and product."""
    return sales.groupBy("date", "hour", "product_id").agg(
        F.sum("units_sold").alias("units"), F.sum("total_ammount_paid").alias("paid"))


def slot_counts(catalog: DataFrame) -> DataFrame:
    """Catalog rows per slot, product and category; rows without a category left out."""
    return catalog.where(F.col("category_name").isNotNull()).groupBy(
        "date", "hour", "product_id", "category_name").agg(F.count(F.lit(1)).alias("listings"))


def _per_category(sold: DataFrame, listed: DataFrame) -> DataFrame:
    return (
        sold.join(listed, ["date", "product_id"], "left")
        .where(F.col("category_name").isNotNull())
        .groupBy("date", "category_name")
        .agg(
            F.sum(F.col("units") * F.col("listings")).alias("units_sold"),
            F.sum(F.col("paid") * F.col("listings")).alias("total_ammount_paid"),
        )
    )


def last_hours(slots: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """The last slot of each date in a slot list."""
    newest: dict[str, str] = {}
    for date, hour in slots:
        newest[date] = max(hour, newest.get(date, hour))
    return sorted(newest.items())


def latest_snapshots(catalog: DataFrame,
                     slots: list[tuple[str, str]] | None = None) -> DataFrame:
    """Catalog rows of each date's last hour.

    With ``slots``, which every stored table and lake lists, the last slots become
    a predicate on ``date`` and ``hour``: nothing is shuffled, and one hour per date
    is read. Without, a semi join finds them; it runs no job ahead, but reads all
    rows, as it cannot prune partitions.
    """
    if slots is not None:
        return catalog.where(in_slots(last_hours(slots)))
    # Distinct slots first, then the few hours of a date as a set: both steps hash,
    # where the greatest text per date would sort the rows.
    last = slot_columns(catalog).groupBy("date").agg(
        F.array_max(F.collect_set("hour")).alias("_hour")
    )
    newest = last.withColumnRenamed("date", "_date")
    same = (F.col("date").cast("string") == F.col("_date")) & (F.col("hour") == F.col("_hour"))
    return catalog.join(newest, same, "left_semi")


def category_sales_pinned(sales: DataFrame, catalog: DataFrame,
                          dates: list[str] | None = None,
                          slots: list[tuple[str, str]] | None = None) -> DataFrame:
    """``category_sales`` with one catalog snapshot per date: each sale counts once."""
    return category_sales(sales, latest_snapshots(_of_dates(catalog, dates), slots), dates)


def orphan_sales(sales: DataFrame, listed: DataFrame,
                 keys: tuple[str, ...] = ("date", "product_id")) -> DataFrame:
    """Sales whose product is not in ``listed``, a catalog or a stock table.

    The listed keys may repeat, which changes nothing for an anti join. Making
    them distinct first would leave them dealt out by key already, and adaptive
    execution splits a hot product only where both sides are shuffled for the join.
    """
    return sales.join(listed.select(*keys), list(keys), "left_anti")
