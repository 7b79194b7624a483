import samples
from samples import slot
from tillwright.operators.inventory import negative_stock, reconcile_inventory
from tillwright.operators.quality import (
    check_inventory, check_sales, discount_violations, price_mismatch,
)
from tillwright.operators.reports import orphan_sales
from tillwright.schemas import INVENTORY, STOCK_KEY

D1 = "2025-01-01"


def _opening(spark, *rows):
    return samples.inventory(spark, *rows).select(
        *STOCK_KEY, "in_stock", "new_product", "returned_product"
    )


def test_sold_units_turn_negative_and_lower_the_stock(spark):
    opening = _opening(
        spark,
        slot(D1, "00", "A", in_stock=10, new_product=5, returned_product=-2),
        slot(D1, "00", "B", in_stock=1, new_product=0, returned_product=-4),
        slot(D1, "01", "A", in_stock=7, new_product=0, returned_product=0),
    )
    sales = samples.sales(
        spark, slot(D1, "00", "A", units_sold=4), slot(D1, "00", "A", units_sold=9),
        slot(D1, "00", "UNKNOWN", units_sold=2),
    )
    stock = reconcile_inventory(opening, sales)
    assert stock.columns == [*INVENTORY.fieldNames(), "date", "hour"]
    found = {(r.hour, r.product_id): (r.units_sold, r.final_stock) for r in stock.collect()}
    assert found == {("00", "A"): (-13, 0), ("00", "B"): (0, -3), ("01", "A"): (0, 7)}
    assert [r.product_id for r in negative_stock(stock).collect()] == ["B"]
    orphans = orphan_sales(sales, opening, ("date", "hour", "product_id"))
    assert [r.product_id for r in orphans.collect()] == ["UNKNOWN"]


def test_discount_tiers(spark):
    cases = [(500, 0.0, True), (500, 0.05, False), (501, 0.05, True), (501, 0.2, True),
             (501, 0.04, False), (501, 0.21, False), (501, 0.0, False)]
    sales = samples.sales(spark, *[
        slot(D1, "00", units_sold=u, discount_applied=d, transaction_id=str(i))
        for i, (u, d, _) in enumerate(cases)
    ])
    bad = {int(r.transaction_id) for r in discount_violations(sales).collect()}
    assert bad == {i for i, (_, _, fine) in enumerate(cases) if not fine}


def test_prices_follow_the_snapshot_of_the_slot(spark):
    catalog = samples.catalog(
        spark, slot(D1, "00", unit_price=10.0), slot(D1, "01", unit_price=12.0)
    )
    sales = samples.sales(
        spark, slot(D1, "00", transaction_id="fine"), slot(D1, "01", transaction_id="stale"),
        slot(D1, "02", transaction_id="unlisted"),
    )
    assert [r.transaction_id for r in price_mismatch(sales, catalog).collect()] == ["stale"]


def test_sales_findings_name_every_reason(spark):
    catalog = samples.catalog(spark, slot(D1, "00"))
    sales = samples.sales(
        spark,
        slot(D1, "00", transaction_id="fine"),
        slot(D1, "00", transaction_id="all", unit_price=11.0, units_sold=600,
             total_ammount_paid=1.0, transaction_hour="23"),
        slot(D1, "00", transaction_id="moved", transaction_date=None),
        slot(D1, "05", transaction_id="unlisted"),
    )
    found = {r.transaction_id: r.reasons for r in check_sales(sales, catalog).collect()}
    assert found == {"all": "total,price,discount,slot", "moved": "slot"}


def test_inventory_findings(spark):
    inventory = samples.inventory(
        spark,
        slot(D1, "00", "A", in_stock=9, units_sold=-4, final_stock=5),
        slot(D1, "00", "B", in_stock=9, units_sold=0, final_stock=8),
        slot(D1, "00", "C", in_stock=9, units_sold=-1, final_stock=8, inventory_hour="07"),
    )
    sales = samples.sales(spark, slot(D1, "00", "A", units_sold=4))
    found = {r.product_id: r.reasons for r in check_inventory(inventory, sales).collect()}
    assert found == {"B": "stock", "C": "units,slot"}


def test_a_sale_without_a_value_has_a_reason(spark):
    sales = samples.sales(
        spark, slot("2025-01-01", "00"), slot("2025-01-01", "00", "Q", unit_price=None),
        slot("2025-01-01", "00", "R", total_ammount_paid=None, discount_applied=None),
    )
    found = check_sales(sales, samples.catalog(spark, slot("2025-01-01", "00")))
    assert sorted((r.product_id, r.reasons) for r in found.collect()) == [
        ("Q", "missing"), ("R", "missing")]
