import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import samples
from samples import slot
from tillwright.operators.catalog import expand_catalog
from tillwright.operators.reports import (
    category_sales, category_sales_pinned, last_hours, latest_snapshots, orphan_sales,
)

D1, D2 = "2025-01-01", "2025-01-02"


def _report(df):
    return sorted(
        (r.date, r.category_name, r.units_sold, r.total_ammount_paid) for r in df.collect()
    )


def test_a_sale_counts_once_per_hourly_snapshot(spark):
    catalog = samples.catalog(spark, *[slot(D1, f"{h:02d}") for h in range(24)])
    sales = samples.sales(spark, slot(D1, "05", units_sold=3))
    assert _report(category_sales(sales, catalog)) == [(D1, "Tools", 72, 720.0)]
    assert _report(category_sales_pinned(sales, catalog)) == [(D1, "Tools", 3, 30.0)]


def test_a_catalog_of_one_slot_drops_sales_of_other_dates(spark):
    catalog = samples.catalog(spark, slot(D2, "07"))
    sales = samples.sales(spark, slot(D1, "05"), slot(D2, "01", units_sold=2))
    assert _report(category_sales(sales, catalog)) == [(D2, "Tools", 2, 20.0)]
    assert [r.date for r in orphan_sales(sales, catalog).collect()] == [D1]


def test_rows_without_a_category_drop_out(spark):
    catalog = samples.catalog(
        spark, slot(D1, "00", category_name=None), slot(D1, "01", category_name="Toys")
    )
    sales = samples.sales(spark, slot(D1, "05"))
    assert _report(category_sales(sales, catalog)) == [(D1, "Toys", 1, 10.0)]


def test_a_product_may_change_its_category_during_the_day(spark):
    catalog = samples.catalog(
        spark, slot(D1, "00", category_name="A"), slot(D1, "01", category_name="B"),
        slot(D1, "02", category_name="B"),
    )
    sales = samples.sales(spark, slot(D1, "05", units_sold=2), slot(D1, "06", units_sold=1))
    assert _report(category_sales(sales, catalog)) == [(D1, "A", 3, 30.0), (D1, "B", 6, 60.0)]
    assert _report(category_sales_pinned(sales, catalog)) == [(D1, "B", 3, 30.0)]


def test_dates_restrict_the_report(spark):
    catalog = samples.catalog(spark, slot(D1, "00"), slot(D2, "00"))
    sales = samples.sales(spark, slot(D1, "05"), slot(D2, "05"))
    assert _report(category_sales(sales, catalog, [D2])) == [(D2, "Tools", 1, 10.0)]
    assert _report(category_sales_pinned(sales, catalog, [D2])) == [(D2, "Tools", 1, 10.0)]
    assert _report(category_sales(sales, catalog, [])) == []


@pytest.mark.parametrize("amount,times,total", [
    (4e-7, 1000, 4e-4), (5e12, 2, 1e13), (0.1, 1000, 100.0), (float("nan"), 1, float("nan")),
])
def test_money_is_summed_as_it_is(spark, amount, times, total):
    """Small and large amounts keep their value; one that is no number leaves no number."""
    sales = spark.range(times).select(
        F.lit(D1).alias("date"), F.lit("PROD_0001").alias("product_id"),
        F.lit(1).cast("long").alias("units_sold"), F.lit(amount).alias("total_ammount_paid"),
    ).repartition(7)
    catalog = samples.catalog(spark, slot(D1, "00"))
    ((_, _, units, paid),) = _report(category_sales(sales, catalog))
    assert units == times and paid == pytest.approx(total, rel=1e-12, nan_ok=True)


def test_latest_snapshots_by_list_and_by_join_agree(spark, rows_of):
    catalog = samples.catalog(
        spark, slot(D1, "00"), slot(D1, "23"), slot(D2, "02"), slot(D2, "11", "B"), slot(None, "23")
    )
    by_join = rows_of(latest_snapshots(catalog))
    assert [(r[-2], r[-1]) for r in by_join] == [(D1, "23"), (D2, "11")]
    slots = [(D1, "23"), (D1, "00"), (D2, "02"), (D2, "11")]
    assert last_hours(slots) == [(D1, "23"), (D2, "11")]
    assert rows_of(latest_snapshots(catalog, slots)) == by_join


def test_random_data_against_nested_loops(spark):
    """Brute force over every pair; one product holds a third of all sales."""
    rng = random.Random(7)
    products = [f"PROD_{i:04d}" for i in range(6)]
    sold = [
        slot(
            rng.choice([D1, D2]), f"{rng.randrange(24):02d}",
            "PROD_0000" if rng.random() < 1 / 3 else rng.choice(products),
            units_sold=rng.randrange(1, 9), transaction_id=str(i),
        )
        for i in range(200)
    ]
    listed = [
        slot(d, f"{h:02d}", p, category_name=rng.choice(["A", "B", None]))
        for d in (D1, D2) for h in range(0, 24, 5) for p in products if rng.random() < 0.6
    ]
    sales, catalog = samples.sales(spark, *sold), samples.catalog(spark, *listed)

    def brute(snapshots):
        sums = defaultdict(int)
        for a in sold:
            for b in snapshots:
                same = (a["date"], a["product_id"]) == (b["date"], b["product_id"])
                if same and b["category_name"] is not None:
                    sums[a["date"], b["category_name"]] += a["units_sold"]
        return sorted((d, c, u, 10.0 * u) for (d, c), u in sums.items())

    assert _report(category_sales(sales, catalog)) == brute(listed)
    last = {d: max(b["hour"] for b in listed if b["date"] == d) for d in (D1, D2)}
    newest = [b for b in listed if b["hour"] == last[b["date"]]]
    pinned = category_sales_pinned(sales, catalog)
    assert _report(pinned) == brute(newest)
    # Nothing is lost without a trace: report, orphans and rows without category.
    lost = orphan_sales(sales, latest_snapshots(catalog)).agg(F.sum("units_sold")).first()[0]
    nameless = {(b["date"], b["product_id"]) for b in newest if b["category_name"] is None}
    hidden = sum(a["units_sold"] for a in sold if (a["date"], a["product_id"]) in nameless)
    reported = sum(r[2] for r in _report(pinned))
    assert reported + (lost or 0) + hidden == sum(a["units_sold"] for a in sold)


def test_products_cycle_through_the_archetypes(spark):
    archetypes = spark.createDataFrame(
        [(0, "Lamp", "CAT-01", "Home", "x", "Bright.", 10.43, "s1", "a, b"),
         (1, "Boot", "CAT-02", "Wear", "y", "Warm.", 20.987, "s2", "c")],
        "position long, base_name string, category_id string, category string, brand string, "
        "description_suffix string, unit_price double, supplier string, tags string",
    )
    products = spark.range(12_000).withColumnRenamed("id", "index")
    made = expand_catalog(archetypes, products, [(D1, "00"), (D1, "01")])
    assert made.count() == 24_000
    found = {
        r.product_id: r for r in made.where("hour = '01'").where(
            F.col("product_id").isin("PROD_0001", "PROD_0002", "PROD_0003", "PROD_12000")
        ).collect()
    }
    assert found["PROD_0001"].product_name == "Lamp 01 - 1"
    assert found["PROD_0002"].product_name == "Boot 02 - 1"
    assert found["PROD_0003"].product_name == "Lamp 03 - 2"
    assert found["PROD_12000"].product_name == "Boot 12000 - 6000"
    assert found["PROD_0001"].description == "A high-quality product. Bright."
    assert found["PROD_0002"].unit_price == 20.987 and found["PROD_0002"].ingestion_hour == "01"
