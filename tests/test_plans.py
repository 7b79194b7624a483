"""What the plans must look like for tables of any size."""

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

import samples
from samples import slot
from tillwright import fixtures as fx
from tillwright.operators import slots as slot_op
from tillwright.operators.quality import check_sales, price_mismatch
from tillwright.operators.reports import (
    category_sales, category_sales_pinned, latest_snapshots, orphan_sales,
)
from tillwright.plans.loads import load_managed
from tillwright.schemas import PRODUCT_CATALOG
from tillwright.sources import lake, tables

SF_DIR = "/root/testdata/sf0.001"
D1, D2 = "2025-01-01", "2025-01-02"


def _plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@contextmanager
def _conf(spark, **settings):
    old = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_the_report_joins_sums_and_reads_few_columns(spark):
    df = category_sales(fx.sales(spark, SF_DIR), fx.catalog(spark, SF_DIR))
    logical = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner, ((date" in logical and "LeftOuter" not in logical
    reads = re.findall(r"ReadSchema: (struct<[^\n]*>)", _plan(df))
    # The sales scan is the one with the quantity; the others make the catalog.
    (sales,) = [r for r in reads if "l_quantity" in r]
    assert not re.search("l_suppkey|l_tax|l_orderkey|l_linenumber|l_returnflag", sales)


def test_slices_and_snapshots_prune_partitions(spark, namespace):
    name = f"{namespace}.c"
    rows = samples.catalog(spark, slot(D1, "00"), slot(D1, "23"), slot(D2, "05"), slot(D2, "07"))
    load_managed(spark, PRODUCT_CATALOG, rows, name, backfill=True)
    table = spark.table(name)
    assert len(slot_op.select_slice(table, [D1], ["00", "05"]).inputFiles()) == 1
    slots = tables.table_slots(spark, name)
    pinned = latest_snapshots(table, slots)
    assert re.search(r"PartitionFilters: \[[^\n]*date", _plan(pinned))
    assert len(pinned.inputFiles()) == 2
    report = category_sales_pinned(samples.sales(spark, slot(D1, "01")), table, slots=slots)
    assert report.count() == 1


def test_snapshots_and_merges_run_no_job_ahead_and_prune(spark, namespace, monkeypatch):
    """Without a slot list nothing is collected to build the plan; a merge reads its slots alone."""
    rows = samples.catalog(spark, slot(D1, "00"), slot(D1, "23"), slot(D2, "05"))
    with monkeypatch.context() as patch:
        patch.setattr(type(rows), "collect", None)
        lazy = latest_snapshots(rows)
    assert lazy.count() == 2
    name = f"{namespace}.m"
    load_managed(spark, PRODUCT_CATALOG, rows, name, backfill=True)
    kept = []
    real = tables.overwrite_slots
    monkeypatch.setattr(tables, "overwrite_slots", lambda df, to: kept.append(_plan(df)) or real(df, to))
    change = tables.to_managed(samples.catalog(spark, slot(D2, "05")), PRODUCT_CATALOG)
    tables.merge_by_key(spark, name, change, ["date", "hour", "product_id"])
    assert re.search(r"PartitionFilters: \[[^\n]*date", kept[0])


def test_the_csv_lake_prunes_folders(spark, tmp_path):
    lake.write_slots_csv(
        samples.catalog(spark, slot(D1, "00"), slot(D2, "05")), str(tmp_path / "c"))
    df = slot_op.select_slice(lake.read_catalog(spark, str(tmp_path / "c")), [D2], ["05"])
    assert re.search(r"PartitionFilters: \[[^\n]*date[^\n]*hour", _plan(df))
    assert df.count() == 1


def test_writing_sorts_once_after_one_rebalance(spark):
    rows = samples.catalog(spark, slot(D1, "00"))
    plan = _plan(lake.by_slot(rows, "product_id"))
    assert plan.count("REBALANCE_PARTITIONS_BY_COL") == 1
    assert len(re.findall(r"\n\(\d+\) Sort\n", plan)) == 1


def _hot_sales(spark):
    """Sales of which two thirds are of one product; nothing in them is a constant."""
    days = F.concat(F.lit("2025-01-0"), (F.col("id") % 2 + 1).cast("string"))
    hours = F.lpad((F.col("id") % 2).cast("string"), 2, "0")
    return spark.range(0, 300_000, 1, 12).select(
        days.alias("date"), hours.alias("hour"),
        F.when(F.col("id") % 3 > 0, "HOT").otherwise(F.concat(F.lit("P"), "id"))
        .alias("product_id"),
        days.alias("transaction_date"), hours.alias("transaction_hour"),
        F.sha2(F.col("id").cast("string"), 256).alias("transaction_id"),
        (F.col("id") % 7 + 1.0).alias("unit_price"), F.lit(1).alias("units_sold"),
        F.lit(0.0).alias("discount_applied"),
        (F.col("id") % 7 + 1.0).alias("total_ammount_paid"),
    )


@pytest.mark.parametrize("what,rows", [
    ("orphans", 200_000), ("unstocked", 200_000), ("checks", 300_000), ("prices", 85_714),
])
def test_a_hot_product_is_split_over_tasks(spark, what, rows):
    """Adaptive execution has to split the join of one product that holds most sales."""
    sales = _hot_sales(spark)
    days = F.concat(F.lit("2025-01-0"), (F.col("id") % 2 + 1).cast("string"))
    catalog = spark.range(0, 300_000, 3).select(
        days.alias("date"), F.lpad((F.col("id") % 2).cast("string"), 2, "0").alias("hour"),
        F.concat(F.lit("P"), "id").alias("product_id"), F.lit(1.0).alias("unit_price"),
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128k",
        "spark.sql.shuffle.partitions": "16",
    }
    key = ("date", "hour", "product_id")
    with _conf(spark, **settings):
        df = {
            "orphans": lambda: orphan_sales(sales, catalog),
            "unstocked": lambda: orphan_sales(sales, catalog, key),
            "checks": lambda: check_sales(sales, catalog, 0),
            "prices": lambda: price_mismatch(sales, catalog),
        }[what]()
        found = [r.transaction_id for r in df.select("transaction_id").collect()]
        final = df.select("transaction_id")
        final.collect()
        plan = final._jdf.queryExecution().executedPlan().toString()
    assert len(found) == len(set(found)) == rows
    assert "skew=true" in plan


def test_a_hot_product_shrinks_before_the_report_joins(spark):
    """However many sales a product has, it enters the shuffle once per map task."""
    sales = spark.range(0, 100_000, 1, 4).select(
        F.lit(D1).alias("date"), F.lit("HOT").alias("product_id"),
        F.lit(1).cast("long").alias("units_sold"), F.lit(0.5).alias("total_ammount_paid"),
    )
    catalog = samples.catalog(spark, *[slot(D1, f"{h:02d}", "HOT") for h in range(24)])
    df = category_sales(sales, catalog)
    assert [tuple(r) for r in df.collect()] == [(D1, "Tools", 2_400_000, 1_200_000.0)]
    plan = _plan(df)
    assert plan.count("partial_sum") >= 2 and "partial_count" in plan
