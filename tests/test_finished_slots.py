"""Slots that a writer was lost in, two writers at once, odd names, tables that follow their folders."""

import time

import pytest
from pyspark.sql import functions as F

import samples
from samples import slot
from tillwright.operators.quality import check_inventory
from tillwright.plans.backlog import backlog, fill_inventory
from tillwright.plans.loads import load_managed, load_versioned
from tillwright.schemas import INVENTORY_DATA, PRODUCT_CATALOG
from tillwright.session import list_names, read_text, rename_new, scratch_folder, write_text
from tillwright.sources import lake, tables

D1, D2 = "2025-01-01", "2025-01-02"
KEYS = ["date", "hour", "product_id"]


def rows(spark, root):
    found = lake.read_inventory(spark, root).select(F.col("date").cast("string"), "hour", "product_id")
    return sorted(tuple(r) for r in found.collect())


def four(spark):
    return samples.inventory(spark, *[slot(D1, h, p) for h in ("00", "00:30") for p in ("P1", "P2")])


def test_a_half_written_slot_is_written_again_whole(spark, tmp_path):
    root = str(tmp_path)
    assert lake.write_missing_slots(samples.inventory(spark, slot(D1, "23")), root) == [(D1, "23")]
    # A writer was lost: its slot has some of its rows and no mark.
    lake.write_slots_csv(samples.inventory(spark, slot(D1, "00", "P1")), root)
    assert (D1, "00") in lake.existing_slots(spark, root)
    assert lake.finished_slots(spark, root) == [(D1, "23")]
    assert lake.write_missing_slots(four(spark), root) == [(D1, "00"), (D1, "00:30")]
    assert rows(spark, root) == [(D1, "00", "P1"), (D1, "00", "P2"), (D1, "00:30", "P1"),
                                 (D1, "00:30", "P2"), (D1, "23", "PROD_0001")]
    assert lake.write_missing_slots(four(spark), root) == []
    assert lake.finished_slots(spark, root, [D1]) == lake.existing_slots(spark, root) == [
        (D1, "00"), (D1, "00:30"), (D1, "23")]
    # What it held is set aside, not lost.
    assert list_names(spark, f"{root}/_unfinished")


def test_a_lake_of_other_writers_counts_as_finished(spark, tmp_path):
    root = str(tmp_path)
    lake.write_slots_csv(samples.inventory(spark, slot(D1, "00", "P1"), slot(D2, "a+b", "P1")), root)
    assert lake.finished_slots(spark, root) == [(D1, "00"), (D2, "a+b")]
    # Only one date is filled, yet marks for the others are there from now on.
    assert lake.write_missing_slots(four(spark), root, [D1]) == [(D1, "00:30")]
    assert lake.finished_slots(spark, root) == [(D1, "00"), (D1, "00:30"), (D2, "a+b")]
    assert len(rows(spark, root)) == 4


def test_a_writer_lost_between_slots_leaves_whole_slots(spark, tmp_path, monkeypatch):
    root, placed = str(tmp_path), []

    def lost(spark, top, run, date, hour):
        if placed:
            raise RuntimeError("lost")
        placed.append(hour)
        return place(spark, top, run, date, hour)

    place = lake._place_slot
    lake.write_missing_slots(samples.inventory(spark, slot(D2, "00")), root)
    with monkeypatch.context() as patch:
        patch.setattr(lake, "_place_slot", lost)
        with pytest.raises(RuntimeError):
            lake.write_missing_slots(four(spark), root)
    assert len(rows(spark, root)) == 3
    assert len(lake.write_missing_slots(four(spark), root)) == 2
    assert len(rows(spark, root)) == 5


def test_two_writers_do_not_double_a_slot(spark, tmp_path, monkeypatch):
    root, both = str(tmp_path), []
    place = lake._place_slot

    def meanwhile(*args):
        if not both:
            both.append(True)
            lake.write_missing_slots(four(spark), root)
        return place(*args)

    monkeypatch.setattr(lake, "_place_slot", meanwhile)
    assert lake.write_missing_slots(four(spark), root) == []
    assert len(rows(spark, root)) == 4


def test_backlog_and_fill_see_unfinished_slots(spark, tmp_path):
    root = str(tmp_path)
    clock = spark.sql("SELECT TIMESTAMP_NTZ '2025-01-02 09:30:00' AS now_utc")
    lake.write_missing_slots(samples.inventory(spark, slot(D2, "00")), f"{root}/inventory_data")
    lake.write_slots_csv(samples.inventory(spark, slot(D1, "05", "P1")), f"{root}/inventory_data")
    missing = {(r.date, r.hour) for r in backlog(spark, clock, root).where("dataset = 'inventory_data'").collect()}
    assert (D1, "05") in missing and (D2, "00") not in missing
    opening = four(spark).select("date", "hour", "product_id", "in_stock", "new_product", "returned_product")
    moved = opening.withColumn("hour", F.lit("05")).distinct()
    fill_inventory(moved, samples.sales(spark, slot(D1, "05", "P1", units_sold=3)), f"{root}/inventory_data")
    found = lake.read_inventory(spark, f"{root}/inventory_data").where("hour = '05'")
    assert sorted((r.product_id, r.final_stock) for r in found.collect()) == [("P1", -3), ("P2", 0)]


def test_odd_hours_in_managed_tables(spark, namespace):
    name = f"{namespace}.c"
    odd = ["00:30", "a+b", "50%", "a=b", "x/y"]
    held = samples.catalog(spark, *[slot(D1, h) for h in odd], slot(D1, "07"))
    load_managed(spark, PRODUCT_CATALOG, held, name, "replace", backfill=True)
    assert tables.table_slots(spark, name) == sorted((D1, h) for h in [*odd, "07"])
    tables.delete_slots(spark, name, [D1], ["00:30", "x/y", "absent"])
    assert sorted(r.hour for r in spark.table(name).collect()) == ["07", "50%", "a+b", "a=b"]
    load_managed(spark, PRODUCT_CATALOG, samples.catalog(spark, slot(D1, "a+b", "new")), name, "replace", backfill=True)
    assert [(r.hour, r.product_id) for r in spark.table(name).collect()] == [("a+b", "new")]
    with pytest.raises(Exception, match="PARTITION"):
        tables.drop_slots(spark, name, [(D1, "absent")])


def test_merging_a_null_key_again_changes_nothing(spark, namespace):
    name = f"{namespace}.c"
    base = samples.catalog(spark, slot(D1, "00", "P1"), slot(D1, "00", None))
    load_managed(spark, PRODUCT_CATALOG, base, name, backfill=True)
    for _ in range(2):
        tables.merge_by_key(spark, name, tables.to_managed(
            samples.catalog(spark, slot(D1, "00", None, unit_price=2.0)), PRODUCT_CATALOG), KEYS)
    assert sorted((str(r.product_id), r.unit_price) for r in spark.table(name).collect()) == [
        ("None", 2.0), ("P1", 10.0)]


def test_stock_rows_without_a_value_are_found(spark):
    stock = samples.inventory(spark, slot(D1, "00", "P1", final_stock=None), slot(D1, "00", "P2", units_sold=None),
                              slot(D1, "00", None), slot(D1, "00", "P4"))
    found = check_inventory(stock, samples.sales(spark, slot(D1, "00", "P9")))
    assert {str(r.product_id): r.reasons for r in found.collect()} == {
        "P1": "missing", "P2": "missing", "None": "missing"}


def test_a_registered_table_follows_its_folders(spark, namespace, tmp_path):
    root, ledger, name = str(tmp_path / "lake"), str(tmp_path / "ledger"), f"{namespace}.ext"
    lake.write_slots_csv(samples.inventory(spark, slot(D1, "00")), root)
    lake.register_external(spark, name, root, INVENTORY_DATA)
    query = lake.follow_external(spark, name, root, ledger, "1 second")
    try:
        lake.write_slots_csv(samples.inventory(spark, slot(D1, "00:30"), slot(D2, "a+b")), root)
        until = time.time() + 60
        while spark.table(name).count() < 3 and time.time() < until:
            time.sleep(0.5)
    finally:
        query.stop()
    assert sorted(r.hour for r in spark.table(name).collect()) == ["00", "00:30", "a+b"]
    # A restart knows from the ledger what it has seen, and takes up what is new.
    lake.write_slots_csv(samples.inventory(spark, slot(D2, "05")), root)
    lake.follow_external(spark, name, root, ledger).awaitTermination()
    assert spark.table(name).count() == 4
    lake.refresh_external(spark, name, root)
    assert spark.table(name).count() == 4


def test_small_files_and_names(spark, tmp_path):
    root = str(tmp_path)
    write_text(spark, f"{root}/a", "one é")
    assert rename_new(spark, f"{root}/a", f"{root}/deep/b") and list_names(spark, f"{root}/deep") == ["b"]
    write_text(spark, f"{root}/c", "two")
    assert not rename_new(spark, f"{root}/c", f"{root}/deep/b")
    assert read_text(spark, f"{root}/deep/b") == "one é" and list_names(spark, f"{root}/none") == []


def test_scratch_on_one_machine_is_refused_on_a_cluster(spark):
    class Conf:
        def get(self, key, default=None):
            return "file:/tmp/warehouse" if "warehouse" in key else default

    class Context:
        master = "spark://somewhere:7077"

    class Session:
        conf, _jvm, _jsc, sparkContext = Conf(), spark._jvm, spark._jsc, Context()

    with pytest.raises(ValueError, match="checkpoint"):
        scratch_folder(Session(), "x")
    Context.master = "local[4]"
    assert scratch_folder(Session(), "x").startswith("file:/tmp/warehouse/_scratch/x-")
