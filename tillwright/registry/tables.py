"""Queries that go through managed tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwright import fixtures as fx
from tillwright.plans.loads import (
    Refresh, load_from_lake, load_managed, managed_name, run_refresh,
)
from tillwright.registry.entry import SALES_COLUMNS, Query, yearly
from tillwright.registry.reports import REPORT, rounded
from tillwright.schemas import DATASETS, PRODUCT_CATALOG, SALES_DATA
from tillwright.session import scratch_folder
from tillwright.sources import lake, tables


def _namespace(spark, label):
    """A schema of this run, stored in the shared scratch folder."""
    folder = scratch_folder(spark, label)
    name = f"{label}_{folder.rsplit('-', 1)[1]}"
    tables.ensure_namespace(spark, name, folder)
    return name


def _plain(df):
    """Timestamps as seconds, which no session time zone can shift."""
    return df.withColumn("date_tmsp", F.unix_seconds("date_tmsp"))


def _sales(spark, sf_dir):
    return fx.full_sales(spark, sf_dir, yearly=True)


def _repriced(rows):
    return rows.withColumn("order_country", F.lit("again"))


def _managed_replace(spark, sf_dir):
    """With its default flag the catalog ends up with its latest slot alone."""
    name = managed_name(_namespace(spark, "replaced"), PRODUCT_CATALOG)
    rows = fx.catalog(spark, sf_dir, yearly=True)
    load_managed(spark, PRODUCT_CATALOG, rows, name, "replace", backfill=True)
    load_managed(spark, PRODUCT_CATALOG, rows, name, "replace")
    return _plain(spark.table(name)).select(
        "date", "hour", "product_id", "category_name", "unit_price", "date_tmsp"
    )


def _managed_backfill(spark, sf_dir):
    name = managed_name(_namespace(spark, "backfilled"), SALES_DATA)
    load_managed(spark, SALES_DATA, _sales(spark, sf_dir), name, "replace")
    return _plain(spark.table(name))


def _managed_incremental(spark, sf_dir):
    """A full load, then the latest slot again with other values."""
    name = managed_name(_namespace(spark, "incremental"), SALES_DATA)
    rows = _sales(spark, sf_dir)
    load_managed(spark, SALES_DATA, rows, name)
    load_managed(spark, SALES_DATA, _repriced(rows), name, backfill=False)
    return _plain(spark.table(name))


def _replace_slots(spark, sf_dir):
    """Six hours of the last years are replaced by four, so two end up empty.

    A row of an hour that is not listed joins those that its slot holds.
    """
    name = managed_name(_namespace(spark, "slots"), SALES_DATA)
    rows = _sales(spark, sf_dir)
    load_managed(spark, SALES_DATA, rows, name)
    late = rows.where(
        (F.col("date") >= "2000-01-01") & ((F.col("hour") <= "03") | (F.col("hour") == "09"))
        & (F.col("transaction_hour") == "00")
    )
    dates = sorted({d for d, _ in tables.table_slots(spark, name) if d >= "2000-01-01"})
    tables.replace_slots(
        spark, name, tables.to_managed(_repriced(late), SALES_DATA), dates,
        ["00", "01", "02", "03", "04", "05"],
    )
    return _plain(spark.table(name)).select("date", "hour", "transaction_id", "order_country")


def _delete_slots(spark, sf_dir):
    name = managed_name(_namespace(spark, "deleted"), SALES_DATA)
    load_managed(spark, SALES_DATA, _sales(spark, sf_dir), name)
    tables.delete_slots(spark, name, ["1998-12-31", "2000-12-31"], ["00", "07", "23"])
    return _plain(spark.table(name)).select("date", "hour", "transaction_id", "units_sold")


def _merge_by_key(spark, sf_dir):
    """All categories but one are loaded; that one and a dearer other are merged in."""
    name = managed_name(_namespace(spark, "merged"), PRODUCT_CATALOG)
    rows = fx.catalog(spark, sf_dir, yearly=True)
    load_managed(
        spark, PRODUCT_CATALOG, rows.where(F.col("category_name") != "PROMO"), name, backfill=True
    )
    changed = rows.where(F.col("category_name").isin("PROMO", "SMALL")).withColumn(
        "unit_price", F.col("unit_price") * 2
    )
    tables.merge_by_key(
        spark, name, tables.to_managed(changed, PRODUCT_CATALOG), ["date", "hour", "product_id"]
    )
    return _plain(spark.table(name)).select(
        "date", "hour", "product_id", "category_name", "unit_price"
    )


def _run_refresh(spark, sf_dir):
    """Lake, three loads with a catalog backfill, report."""
    root = scratch_folder(spark, "refresh")
    views = {"product_catalog": fx.catalog, "sales_data": fx.full_sales,
             "inventory_data": fx.inventory}
    for name in DATASETS:
        lake.write_slots_csv(views[name](spark, sf_dir, yearly=True), f"{root}/{name}", packed=True)
    job = Refresh(
        "refresh_" + root.rsplit("-", 1)[1], root, f"{root}/tables",
        backfill={"product_catalog": True},
    )
    return rounded(run_refresh(spark, job))


def _lake_load(spark, sf_dir, spoil):
    """The catalog's latest slot, loaded from a lake after ``spoil`` had its way with it."""
    root = scratch_folder(spark, "lake-load")
    rows = fx.catalog(spark, sf_dir, yearly=True)
    lake.write_slots_csv(rows, root)
    space = _namespace(spark, "lake_load")
    load_from_lake(spark, PRODUCT_CATALOG, root, space)
    spoil(rows, root)
    load_from_lake(spark, PRODUCT_CATALOG, root, space, "replace")
    return _plain(spark.table(managed_name(space, PRODUCT_CATALOG))).select(
        "date", "hour", "product_id", "category_name", "unit_price", "date_tmsp"
    )


def _without_slot(rows):
    """Each row without its date, and without its hour; dealt out evenly, as the writer sorts them."""
    twice = rows.hint("rebalance").withColumn("_lost", F.explode(F.array(F.lit("date"), F.lit("hour"))))
    return twice.withColumns({
        name: F.when(F.col("_lost") != name, F.col(name)) for name in ("date", "hour")}).drop("_lost")


def _null_slot(rows, root):
    """Rows without a date, and rows without an hour, in folders that other tools wrote."""
    _without_slot(rows).write.mode("append").options(**lake.CSV_WRITE).partitionBy("date", "hour").csv(root)


def _header_only(rows, root):
    """A later slot whose file has a header and no row."""
    body = rows.drop("date", "hour").where("false").coalesce(1)
    body.write.options(**lake.CSV_WRITE).csv(f"{root}/date=9999-12-31/hour=23")


def _lake_replace_empty(spark, sf_dir):
    """A lake without files replaces the loaded table by nothing, as an empty source does."""
    root = scratch_folder(spark, "lake-empty")
    lake.write_slots_csv(fx.catalog(spark, sf_dir, yearly=True), root)
    space = _namespace(spark, "lake_empty")
    load_from_lake(spark, PRODUCT_CATALOG, root, space, backfill=True)
    held = spark.table(managed_name(space, PRODUCT_CATALOG)).count()
    load_from_lake(spark, PRODUCT_CATALOG, f"{root}-none", space, "replace")
    return spark.table(managed_name(space, PRODUCT_CATALOG)).agg(
        F.count(F.lit(1)).alias("left_over")).withColumn("held_before", F.lit(held).cast("long"))


_STAMP = "CAST(epoch(CAST(date AS TIMESTAMP)) AS BIGINT) AS date_tmsp"
_LATEST = """(SELECT max(date) FROM {view}) AND hour =
  (SELECT max(hour) FROM {view} WHERE date = (SELECT max(date) FROM {view}))"""
_LATEST_CATALOG = f"""
SELECT date, hour, product_id, category_name, unit_price, {_STAMP} FROM catalog
WHERE date = {_LATEST.format(view="catalog")}"""

QUERIES = [
    Query(
        "managed_replace", _managed_replace,
        yearly(_LATEST_CATALOG),
    ),
    Query(
        "lake_load_null_slot", lambda spark, sf_dir: _lake_load(spark, sf_dir, _null_slot),
        yearly(_LATEST_CATALOG),
    ),
    Query(
        "lake_load_header_only", lambda spark, sf_dir: _lake_load(spark, sf_dir, _header_only),
        yearly(_LATEST_CATALOG),
    ),
    Query(
        "lake_replace_empty", _lake_replace_empty,
        yearly("SELECT CAST(0 AS BIGINT) AS left_over, count(*) AS held_before FROM catalog"),
    ),
    Query(
        "managed_backfill", _managed_backfill,
        yearly(f"SELECT {SALES_COLUMNS}, {_STAMP} FROM sales"),
    ),
    Query(
        "managed_incremental", _managed_incremental,
        yearly(f"""
SELECT * REPLACE (CASE WHEN date = {_LATEST.format(view="sales")}
                  THEN 'again' ELSE order_country END AS order_country)
FROM (SELECT {SALES_COLUMNS}, {_STAMP} FROM sales)"""),
    ),
    Query(
        "replace_slots", _replace_slots,
        yearly("""
SELECT date, hour, transaction_id, order_country FROM sales
WHERE NOT (date >= '2000-01-01' AND hour <= '05')
UNION ALL
SELECT date, hour, transaction_id, 'again' FROM sales
WHERE date >= '2000-01-01' AND (hour <= '03' OR hour = '09') AND transaction_hour = '00'"""),
    ),
    Query(
        "delete_slots", _delete_slots,
        yearly("""
SELECT date, hour, transaction_id, units_sold FROM sales
WHERE NOT (date IN ('1998-12-31', '2000-12-31') AND hour IN ('00', '07', '23'))"""),
    ),
    Query(
        "merge_by_key", _merge_by_key,
        yearly("""
SELECT date, hour, product_id, category_name,
       CASE WHEN category_name IN ('PROMO', 'SMALL') THEN unit_price * 2 ELSE unit_price END
         AS unit_price
FROM catalog"""),
    ),
    Query(
        "run_refresh", _run_refresh,
        yearly(REPORT),
    ),
]
