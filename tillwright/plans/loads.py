"""Managed loads and the hourly refresh."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.functions.slotted import in_slots
from tillwright.operators.reports import category_sales, category_sales_pinned
from tillwright.operators.slots import (
    SlotLists, latest_of, lists_of, resolve_slots, select_slice, with_slot,
)
from tillwright.plans.rolling import rolling_report
from tillwright.schemas import DATASETS, PRODUCT_CATALOG, SALES_DATA, Dataset
from tillwright.session import freed_shuffles
from tillwright.sources import lake, quarantine, tables, versions
from tillwright.sources.lake import Slots
from tillwright.sources.versions import Store, Version


def managed_name(namespace: str, dataset: Dataset) -> str:
    return f"{namespace}.{dataset.name}_managed"


def rejected_name(namespace: str, dataset: Dataset) -> str:
    return f"{namespace}.{dataset.name}_rejected"


def load_managed(spark: SparkSession, dataset: Dataset, source: DataFrame, name: str,
                 mode: str = "incremental", backfill: bool | None = None,
                 slots: Slots | None = None) -> None:
    """Load slots of ``source`` into the managed table ``name``.

    With ``mode="replace"`` the table ends up with just the loaded slots;
    ``"incremental"`` replaces those slots and keeps the others. With
    ``backfill`` all slots are loaded, else the latest; the default is the
    dataset's. ``slots`` are those of the source where the caller has them from
    a listing, which may name slots without rows; otherwise one job over the two
    slot columns finds them. An empty source empties the table with ``"replace"``.
    """
    backfill, lists = _slice_of(dataset, source, mode, backfill, slots)
    _load_slice(spark, dataset, source, name, mode, backfill, lists)


def _slice_of(dataset: Dataset, source: DataFrame, mode: str, backfill: bool | None,
              slots: Slots | None) -> tuple[bool, SlotLists | None]:
    """Whether all slots are loaded, and the dates and hours to load, if a list is needed."""
    if mode not in ("replace", "incremental"):
        raise ValueError(f"unknown mode {mode!r}")
    if backfill is None:
        backfill = dataset.backfill
    if backfill and mode == "replace":
        return backfill, None  # all rows that have a slot
    if slots is None:
        return backfill, resolve_slots(source, backfill)
    return backfill, lists_of(slots) if backfill else latest_of(source, slots)


def load_versioned(spark: SparkSession, source: DataFrame, store: Store, mode: str = "incremental",
                   backfill: bool | None = None, slots: Slots | None = None,
                   rules: dict[str, Column] | None = None,
                   origins: dict[tuple[str, str], str] | None = None) -> Version:
    """``load_managed`` into a versioned table: all slots of the load in one step, or none.

    Rows that break one of ``rules`` are held back in the same pass; see ``versions.stage``.
    ``origins`` hold a digest of the source of each of ``slots``. With them, an incremental
    backfill without rules reads and writes only slots that are not what a load made of the
    same source; the others keep their files.
    """
    backfill, lists = _slice_of(store.dataset, source, mode, backfill, slots)
    chosen = with_slot(source) if backfill else select_slice(source, *lists)
    if mode == "replace":
        return versions.replace_all(store, chosen, rules, origins=origins)
    settled = versions.settled_slots(spark, store, origins) if backfill and origins and not rules else []
    return versions.replace_slots(
        store, chosen.where(~in_slots(settled)), lists, rules=rules, origins=origins, spared=settled)


def _load_slice(spark: SparkSession, dataset: Dataset, source: DataFrame, name: str, mode: str,
                backfill: bool, lists: SlotLists | None) -> None:
    chosen = with_slot(source) if backfill else select_slice(source, *lists)
    rows = tables.to_managed(chosen, dataset)
    if mode == "incremental":
        tables.create_managed(spark, name, dataset)
        # All rows are of listed slots, so none is left to be added.
        tables.swap_slots(spark, name, rows, tables.listed_slots(spark, name, *lists))
    else:
        fits = tables.has_layout(spark, name, dataset)
        tables.create_managed(spark, name, dataset, replace=not fits)
        tables.replace_all(spark, name, rows)


def load_from_lake(spark: SparkSession, dataset: Dataset, root: str, namespace: str,
                   mode: str = "incremental", backfill: bool | None = None,
                   keep_bad_rows: bool = False, dates: list[str] | None = None) -> None:
    """Load a dataset of the lake into ``namespace``.

    Slots come from a listing of ``root``, not from reading its files; only for
    the latest slot the rows of the newest date are looked at. With ``dates`` the
    rest of the lake is not even listed, so an hourly run with a backfill of the
    last days costs the same in any year. A lake without files is an empty source.
    A bad CSV row stops the load, or with ``keep_bad_rows`` goes to the
    ``_rejected`` table while the good rows are loaded; of the latest slot that is
    the latest with any row, good or bad.
    """
    if backfill is None:
        backfill = dataset.backfill
    slots = lake.existing_slots(spark, root, dates)
    name = managed_name(namespace, dataset)
    # Where there are no files, nothing tells apart a lake that does not exist yet.
    there = dates if slots else []
    if not keep_bad_rows:
        source = lake.read_lake(spark, root, dataset, there)
        load_managed(spark, dataset, source, name, mode, backfill, slots)
        return
    unchecked = quarantine.read_unchecked(spark, root, dataset, there)
    good, bad = quarantine.split_bad_rows(unchecked, dataset)
    load_managed(spark, dataset, good, name, mode, backfill, slots)
    lists = lists_of(slots) if backfill else latest_of(unchecked, slots)
    held_back = select_slice(bad, *lists).withColumn("date", F.col("date").cast("string"))
    rejected = rejected_name(namespace, dataset)
    tables.create_slot_table(spark, rejected, quarantine.rejected_schema(dataset))
    if mode == "replace":
        tables.replace_all(spark, rejected, held_back)
    else:
        tables.swap_slots(spark, rejected, held_back,
                          tables.listed_slots(spark, rejected, *lists))


@dataclass(frozen=True)
class Refresh:
    """Where a refresh reads and writes, and how it loads.

    ``dates`` limits what is loaded; the report covers the whole tables. ``versioned``
    keeps the tables under ``location`` as versioned ones, loads each in one step and sums
    only slots that changed; a bad CSV row stops such a load. ``rules`` by dataset hold
    rows back.
    """

    namespace: str
    lake_root: str
    location: str | None = None
    mode: str = "incremental"
    backfill: dict[str, bool] | None = None
    dates: list[str] | None = None
    keep_bad_rows: bool = False
    pinned: bool = False
    versioned: bool = False
    rules: dict[str, dict[str, Column]] | None = None

    def store(self, dataset: Dataset) -> Store:
        if not self.location:
            raise ValueError("versioned tables need a location")
        return Store(f"{self.location.rstrip('/')}/{dataset.name}", dataset)


def _refresh_versions(spark: SparkSession, job: Refresh) -> DataFrame:
    for dataset in DATASETS.values():
        root = f"{job.lake_root.rstrip('/')}/{dataset.name}"
        origins = lake.slot_digests(spark, root, job.dates)
        source = lake.read_lake(spark, root, dataset, job.dates if origins else [])
        with freed_shuffles(spark):
            load_versioned(
                spark, source, job.store(dataset), job.mode, (job.backfill or {}).get(dataset.name),
                sorted(origins), (job.rules or {}).get(dataset.name), origins,
            )
    return rolling_report(spark, job.store(SALES_DATA), job.store(PRODUCT_CATALOG),
                          f"{job.location.rstrip('/')}/sums", job.pinned)


def run_refresh(spark: SparkSession, job: Refresh) -> DataFrame:
    """Load catalog, sales and inventory from the lake, then report per category.

    Running it again on the same lake changes nothing.
    """
    if job.versioned:
        return _refresh_versions(spark, job)
    tables.ensure_namespace(spark, job.namespace, job.location)
    for dataset in DATASETS.values():
        tables.create_managed(spark, managed_name(job.namespace, dataset), dataset)
        with freed_shuffles(spark):
            load_from_lake(
                spark, dataset, f"{job.lake_root.rstrip('/')}/{dataset.name}", job.namespace,
                job.mode, (job.backfill or {}).get(dataset.name), job.keep_bad_rows, job.dates,
            )
    sales = spark.table(managed_name(job.namespace, SALES_DATA))
    catalog_name = managed_name(job.namespace, PRODUCT_CATALOG)
    catalog = spark.table(catalog_name)
    if job.pinned:
        slots = tables.table_slots(spark, catalog_name)
        return category_sales_pinned(sales, catalog, slots=slots)
    return category_sales(sales, catalog)
