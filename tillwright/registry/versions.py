"""Queries that go through versioned tables, and through slots with odd names."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwright import fixtures as fx
from tillwright.operators.reports import category_sales_pinned
from tillwright.plans.loads import Refresh, load_managed, load_versioned, managed_name, run_refresh
from tillwright.registry.entry import SALES_COLUMNS, Query, yearly
from tillwright.registry.reports import REPORT, rounded
from tillwright.registry.tables import _LATEST, _STAMP, _namespace, _plain, _repriced, _sales
from tillwright.schemas import DATASETS, INVENTORY_DATA, PRODUCT_CATALOG, SALES_DATA
from tillwright.session import scratch_folder
from tillwright.sources import lake, tables, versions
from tillwright.sources.versions import Store


def _store(spark, dataset):
    return Store(scratch_folder(spark, f"versions-{dataset.name}"), dataset)


def _odd(rows):
    """Hours whose folder names have to be escaped, or must not be."""
    return rows.withColumn("hour", F.expr(
        "CASE hour WHEN '07' THEN '00:30' WHEN '09' THEN 'a+b' WHEN '11' THEN '50%' ELSE hour END"))


_ODD = "CASE hour WHEN '07' THEN '00:30' WHEN '09' THEN 'a+b' WHEN '11' THEN '50%' ELSE hour END"
_ODD_HOURS = ["00:30", "a+b", "50%", "13"]


def _odd_loaded(spark, sf_dir, label):
    name = managed_name(_namespace(spark, label), SALES_DATA)
    load_managed(spark, SALES_DATA, _odd(_sales(spark, sf_dir)), name)
    return name


def _odd_deleted(spark, sf_dir):
    name = _odd_loaded(spark, sf_dir, "odd_deleted")
    dates = sorted({d for d, _ in tables.table_slots(spark, name) if d >= "1996-01-01"})
    tables.delete_slots(spark, name, dates, _ODD_HOURS)
    return spark.table(name).select("date", "hour", "transaction_id", "units_sold")


def _odd_replaced(spark, sf_dir):
    """All slots are loaded, then the table is replaced by its odd hours alone."""
    name = _odd_loaded(spark, sf_dir, "odd_replaced")
    odd = _odd(_repriced(_sales(spark, sf_dir))).where(F.col("hour").isin(_ODD_HOURS))
    load_managed(spark, SALES_DATA, odd, name, "replace")
    return spark.table(name).select("date", "hour", "transaction_id", "order_country")


def _odd_pinned(spark, sf_dir):
    """The report on the last snapshot of each date, which has an odd hour."""
    space = _namespace(spark, "odd_pinned")
    name = managed_name(space, PRODUCT_CATALOG)
    late = fx.catalog(spark, sf_dir, yearly=True).withColumn(
        "hour", F.when(F.col("hour") == "23", F.lit("a+b")).otherwise(F.col("hour")))
    load_managed(spark, PRODUCT_CATALOG, late, name, backfill=True)
    return rounded(category_sales_pinned(
        fx.sales(spark, sf_dir, yearly=True), spark.table(name),
        slots=tables.table_slots(spark, name)))


def _versioned_incremental(spark, sf_dir):
    """All slots in one version, then the latest slot again with other values."""
    store = _store(spark, SALES_DATA)
    rows = _sales(spark, sf_dir)
    load_versioned(spark, rows, store)
    load_versioned(spark, _repriced(rows), store, backfill=False)
    return _plain(versions.read(spark, store))


def _versioned_replace(spark, sf_dir):
    """Odd hours replace all slots; then listed slots go, and a date's hours with them."""
    store = _store(spark, SALES_DATA)
    rows = _odd(_sales(spark, sf_dir))
    load_versioned(spark, rows, store)
    load_versioned(spark, _repriced(rows).where(F.col("hour").isin(_ODD_HOURS)), store, "replace")
    versions.delete_slots(spark, store, ["1998-12-31", "1999-12-31"], ["00:30", "13", "none"])
    return versions.read(spark, store).select("date", "hour", "transaction_id", "order_country")


def _versioned_history(spark, sf_dir):
    """The first version, read after later ones emptied the table."""
    store = _store(spark, PRODUCT_CATALOG)
    rows = fx.catalog(spark, sf_dir, yearly=True)
    load_versioned(spark, rows, store, backfill=True)
    load_versioned(spark, rows.where("false"), store, "replace")
    left = versions.read(spark, store).agg(F.count(F.lit(1)))
    return versions.read(spark, store, number=1).select(
        "date", "hour", "product_id", "unit_price", left.scalar().alias("left_over"))


def _versioned_merge(spark, sf_dir):
    """One category comes in, another gets dearer, a third goes; a second run changes nothing."""
    store = _store(spark, PRODUCT_CATALOG)
    rows = fx.catalog(spark, sf_dir, yearly=True)
    load_versioned(spark, rows.where("category_name != 'PROMO'"), store, backfill=True)
    changed = rows.where(F.col("category_name").isin("PROMO", "SMALL", "LARGE")).withColumn(
        "unit_price", F.when(F.col("category_name") == "LARGE", F.lit(None).cast("double"))
        .otherwise(F.col("unit_price") * 2))
    for _ in range(2):
        versions.merge(store, changed, ["date", "hour", "product_id"],
                       delete_when=F.col("unit_price").isNull())
    found = versions.read(spark, store)
    return found.select("date", "hour", "product_id", "category_name", "unit_price",
                        F.lit(versions.version(spark, store).number).alias("version"))


def _versioned_rules(spark, sf_dir):
    """Stock is checked while it is loaded: good rows, rejected rows, counts per rule."""
    store = _store(spark, INVENTORY_DATA)
    done = load_versioned(spark, fx.inventory(spark, sf_dir, yearly=True), store, rules={
        "negative": F.col("final_stock") < 0, "idle": F.col("units_sold") == 0})
    good = versions.read(spark, store).withColumn("reasons", F.lit(""))
    both = good.unionByName(versions.read_rejected(spark, store).drop("lineage"))
    facts = [F.lit(done.facts[n]).cast("bigint").alias(n)
             for n in ("rejected", "rule_negative", "rule_idle")]
    return both.select("date", "hour", "product_id", "final_stock", "reasons", *facts)


def _versioned_mend(spark, sf_dir):
    """Stock below zero is held back, half of it mended and taken in twice."""
    store = _store(spark, INVENTORY_DATA)
    rules = {"negative": F.col("final_stock") < 0}
    load_versioned(spark, fx.inventory(spark, sf_dir, yearly=True), store, rules=rules)
    mended = versions.read_rejected(spark, store, 1).withColumn(
        "final_stock", F.when(F.col("hour") < "12", F.lit(0).cast("long")).otherwise(F.col("final_stock")))
    for _ in range(2):
        versions.mend(store, mended, ["date", "hour", "product_id"], rules)
    good = versions.read(spark, store).withColumn("reasons", F.lit(""))
    return good.unionByName(versions.read_rejected(spark, store).drop("lineage")).select(
        "date", "hour", "product_id", "final_stock", "reasons")


def _versioned_refresh(spark, sf_dir):
    """The lake in two parts, a refresh after each: the second reads changed slots alone."""
    root = scratch_folder(spark, "versioned-refresh")
    views = {"product_catalog": fx.catalog, "sales_data": fx.full_sales,
             "inventory_data": fx.inventory}
    job = Refresh("unused", root, f"{root}/tables", backfill={"product_catalog": True}, versioned=True)
    for part in (F.col("hour") < "15", F.col("hour") >= "15"):
        for name in DATASETS:
            lake.write_missing_slots(views[name](spark, sf_dir, yearly=True).where(part),
                                     f"{root}/{name}", packed=True)
        report = run_refresh(spark, job)
    return rounded(report)


def _followed_external(spark, sf_dir):
    """Half of the slots come after the table was registered; a stream adds them."""
    root = scratch_folder(spark, "followed")
    rows = fx.inventory(spark, sf_dir, yearly=True)
    lake.write_slots_csv(rows.where("hour < '12'"), root)
    name = f"{_namespace(spark, 'followed')}.inventory_data_ext"
    lake.register_external(spark, name, root, INVENTORY_DATA)
    ledger = scratch_folder(spark, "ledger")
    lake.follow_external(spark, name, root, ledger).awaitTermination()
    lake.write_slots_csv(rows.where("hour >= '12'"), root)
    lake.follow_external(spark, name, root, ledger).awaitTermination()
    return spark.table(name).select(
        F.col("date").cast("string").alias("date"), "hour", "product_id", "final_stock")


_ODD_LIST = "('00:30', 'a+b', '50%', '13')"
_ODD_SALES = f"(SELECT * REPLACE ({_ODD} AS hour) FROM sales)"

QUERIES = [
    Query(
        "odd_hours_deleted", _odd_deleted,
        yearly(f"""
SELECT date, hour, transaction_id, units_sold FROM {_ODD_SALES}
WHERE NOT (date >= '1996-01-01' AND hour IN {_ODD_LIST})"""),
    ),
    Query(
        "odd_hours_replaced", _odd_replaced,
        yearly(f"""
SELECT date, hour, transaction_id, 'again' AS order_country FROM {_ODD_SALES}
WHERE hour IN {_ODD_LIST}"""),
    ),
    Query(
        "odd_hours_pinned", _odd_pinned,
        yearly("""
, named AS (
  SELECT * REPLACE (CASE WHEN hour = '23' THEN 'a+b' ELSE hour END AS hour) FROM catalog
), last AS (SELECT date, max(hour) AS hour FROM named GROUP BY date
), sold_by AS (
  SELECT date, product_id, sum(units_sold) AS units, sum(total_ammount_paid) AS paid
  FROM sales GROUP BY date, product_id
)
SELECT n.date, category_name, CAST(sum(units) AS BIGINT) AS units_sold,
       round(sum(paid), 4) AS total_ammount_paid
FROM named n JOIN last USING (date, hour) JOIN sold_by s ON s.date = n.date AND s.product_id = n.product_id
GROUP BY n.date, category_name"""),
    ),
    Query(
        "versioned_incremental", _versioned_incremental,
        yearly(f"""
SELECT * REPLACE (CASE WHEN date = {_LATEST.format(view="sales")}
                  THEN 'again' ELSE order_country END AS order_country)
FROM (SELECT {SALES_COLUMNS}, {_STAMP} FROM sales)"""),
    ),
    Query(
        "versioned_replace", _versioned_replace,
        yearly(f"""
SELECT date, hour, transaction_id, 'again' AS order_country FROM {_ODD_SALES}
WHERE hour IN {_ODD_LIST}
  AND NOT (date IN ('1998-12-31', '1999-12-31') AND hour IN ('00:30', '13'))"""),
    ),
    Query(
        "versioned_history", _versioned_history,
        yearly("SELECT date, hour, product_id, unit_price, CAST(0 AS BIGINT) AS left_over FROM catalog"),
    ),
    Query(
        "versioned_merge", _versioned_merge,
        yearly("""
SELECT date, hour, product_id, category_name, 2 AS version,
       CASE WHEN category_name IN ('PROMO', 'SMALL') THEN unit_price * 2 ELSE unit_price END
         AS unit_price
FROM catalog WHERE category_name <> 'LARGE'"""),
    ),
    Query(
        "versioned_rules", _versioned_rules,
        yearly("""
, judged AS (
  SELECT date, hour, product_id, final_stock, concat_ws(',',
    CASE WHEN final_stock < 0 THEN 'negative' END,
    CASE WHEN units_sold = 0 THEN 'idle' END) AS reasons FROM inventory
)
SELECT *, (SELECT count(*) FROM judged WHERE reasons <> '') AS rejected,
       (SELECT count(*) FROM judged WHERE reasons LIKE '%negative%') AS rule_negative,
       (SELECT count(*) FROM judged WHERE reasons LIKE '%idle%') AS rule_idle
FROM judged"""),
    ),
    Query(
        "versioned_mend", _versioned_mend,
        yearly("""
SELECT date, hour, product_id,
       CASE WHEN final_stock < 0 AND hour < '12' THEN 0 ELSE final_stock END AS final_stock,
       CASE WHEN final_stock < 0 AND hour >= '12' THEN 'negative' ELSE '' END AS reasons
FROM inventory"""),
    ),
    Query(
        "versioned_refresh", _versioned_refresh,
        yearly(REPORT),
    ),
    Query(
        "followed_external", _followed_external,
        yearly("SELECT date, hour, product_id, final_stock FROM inventory"),
    ),
]
