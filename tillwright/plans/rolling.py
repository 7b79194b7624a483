"""The category report kept up to date from the slots that changed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillwright.operators.reports import (
    category_sales_of_sums, latest_snapshots, slot_counts, slot_sums,
)
from tillwright.schemas import NUMBER, TEXT, WHOLE, Dataset, struct_of
from tillwright.session import freed_shuffles
from tillwright.sources import versions
from tillwright.sources.lake import Slots
from tillwright.sources.versions import Store

SALES_SUMS = Dataset(
    "sales_sums", struct_of(product_id=TEXT, units=WHOLE, paid=NUMBER),
    ("date", "hour", "product_id"), ("date", "hour"), True, "Sales per slot and product",
)
CATALOG_COUNTS = Dataset(
    "catalog_counts", struct_of(product_id=TEXT, category_name=TEXT, listings=WHOLE),
    ("date", "hour", "product_id", "category_name"), ("date", "hour"), True,
    "Catalog rows per slot, product and category",
)


def follow(spark: SparkSession, source: Store, sums: Store,
           summed: Callable[[DataFrame], DataFrame]) -> Slots:
    """Bring ``sums`` up to the newest version of ``source``; returns the slots it read.

    Each version of the sums says which version of the source it stands for. The slots
    whose files differ between that one and the newest are read and summed, and replace
    what the sums held of them: a slot that is gone takes its sums along. So a run costs the
    changed slots, and a run that was lost, or ran twice, changes nothing.
    """
    now = versions.version(spark, source)
    if now is None:
        return []
    done = versions.version(spark, sums)
    since = done.facts.get("source") if done else None
    if since == now.number:
        return []
    if since is not None and since not in versions.versions(spark, source):
        since = None  # too old to compare with: all slots are read
    changed = versions.changed_slots(spark, source, since, now.number)
    rows = summed(versions.read(spark, source, now.number, slots=changed))
    facts = {"source": now.number}
    if since is None:
        versions.replace_all(sums, rows, facts=facts)
    else:
        versions.replace_slots(sums, rows, slots=changed, facts=facts)
    return changed


def rolling_report(spark: SparkSession, sales: Store, catalog: Store, folder: str,
                   pinned: bool = False) -> DataFrame:
    """``category_sales`` over the newest versions, from sums kept under ``folder``.

    Only slots that changed since the last call are read from the two tables. The report
    then adds up sums, of which there is one per slot and product.
    """
    sums, counts = Store(f"{folder}/sales_sums", SALES_SUMS), Store(
        f"{folder}/catalog_counts", CATALOG_COUNTS)
    with freed_shuffles(spark):
        follow(spark, sales, sums, slot_sums)
        follow(spark, catalog, counts, slot_counts)
    listed = versions.read(spark, counts)
    if pinned:
        listed = latest_snapshots(listed, versions.slots_of(spark, catalog))
    return category_sales_of_sums(versions.read(spark, sums), listed)
