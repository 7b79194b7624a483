"""Versioned tables: whole versions, clustering, pruning, merges, and writers that are lost."""

import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import samples
from samples import slot
from tillwright.operators.reports import category_sales
from tillwright.plans.loads import Refresh, load_versioned, run_refresh
from tillwright.plans.rolling import SALES_SUMS, follow, rolling_report
from tillwright.operators.reports import slot_sums
from tillwright.schemas import INVENTORY_DATA, PRODUCT_CATALOG, SALES_DATA
from tillwright.sources import lake, versions
from tillwright.sources.versions import Store

D1, D2 = "2025-01-01", "2025-01-02"
KEYS = ["date", "hour", "product_id"]


def held(spark, store, *columns, **at):
    return sorted((tuple(r) for r in versions.read(spark, store, **at).select(
        *(columns or ("date", "hour", "product_id"))).collect()), key=repr)


def names(spark, store):
    listed = versions.files(spark, store, versions.version(spark, store))
    return {(r.folder, r.file) for r in listed.where("kind = 'rows'").collect()}


@pytest.fixture()
def store(tmp_path):
    return Store(str(tmp_path / "catalog"), PRODUCT_CATALOG)


def test_loads_replace_slots_and_keep_history(spark, store):
    first = samples.catalog(spark, slot(D1, "00"), slot(D1, "00:30", "P2"), slot(D2, "a+b", "P3"),
                            slot(None, "00", "lost"), slot(D1, None, "lost"))
    load_versioned(spark, first, store, backfill=True)
    assert held(spark, store) == [(D1, "00", "PROD_0001"), (D1, "00:30", "P2"), (D2, "a+b", "P3")]
    assert versions.slots_of(spark, store) == [(D1, "00"), (D1, "00:30"), (D2, "a+b")]
    # By default the catalog loads its latest slot alone.
    load_versioned(spark, samples.catalog(spark, slot(D1, "09", "old"), slot(D2, "a+b", "P4")), store)
    assert held(spark, store)[2:] == [(D2, "a+b", "P4")]
    # Listed dates and hours without rows end up empty.
    versions.replace_slots(store, samples.catalog(spark, slot(D1, "00", "P5")),
                           ([D1, D2], ["00", "00:30"]))
    assert held(spark, store) == [(D1, "00", "P5"), (D2, "a+b", "P4")]
    versions.delete_slots(spark, store, [D2], ["a+b", "00"])
    assert held(spark, store) == [(D1, "00", "P5")]
    load_versioned(spark, first.where("false"), store, "replace")
    assert held(spark, store) == [] and versions.slots_of(spark, store) == []
    assert len(held(spark, store, number=1)) == 3
    assert versions.changed_slots(spark, store, 1, 2) == [(D2, "a+b")]
    assert versions.changed_slots(spark, store, 2, 4) == [(D1, "00"), (D1, "00:30"), (D2, "a+b")]
    assert versions.versions(spark, store) == [1, 2, 3, 4, 5]
    assert versions.vacuum(spark, store, keep=2) > 0
    assert versions.versions(spark, store) == [4, 5]
    assert held(spark, store, number=4) == [(D1, "00", "P5")]


def test_nothing_was_committed_yet(spark, store):
    assert held(spark, store) == [] and versions.version(spark, store) is None
    assert versions.read(spark, store).columns == PRODUCT_CATALOG.managed_schema.fieldNames()
    assert versions.merge(store, samples.catalog(spark, slot(D1, "00")).limit(0), KEYS) is None


def test_a_reader_keeps_its_version(spark, store):
    load_versioned(spark, samples.catalog(spark, slot(D1, "00", "P1")), store, "replace", True)
    reader = versions.read(spark, store)
    load_versioned(spark, samples.catalog(spark, slot(D1, "00", "P2")), store, "replace", True)
    assert [r.product_id for r in reader.collect()] == ["P1"]


def test_writers_that_come_second_apply_their_change_again(spark, store):
    load_versioned(spark, samples.catalog(spark, slot(D1, "00", "P1")), store, backfill=True)
    seen = []

    def change(before, base):
        seen.append(base.number)
        if len(seen) == 1:  # another writer commits meanwhile
            versions.replace_slots(store, samples.catalog(spark, slot(D1, "01", "P2")))
        return before.where("hour != '00'")

    versions.commit(spark, store, change)
    assert seen == [1, 2] and held(spark, store) == [(D1, "01", "P2")]


_LOST = """
import os, sys
sys.path[:0] = [{repo!r}, {tests!r}]
import samples
from samples import slot
from tillwright.plans.loads import load_versioned
from tillwright.schemas import PRODUCT_CATALOG
from tillwright.session import build_session
from tillwright.sources import versions
spark = build_session("lost", "local[1]", {{"spark.ui.enabled": "false"}})
versions._publish = lambda *a: os._exit(9)
rows = samples.catalog(spark, slot("2025-01-01", "00", "new"))
load_versioned(spark, rows, versions.Store({root!r}, PRODUCT_CATALOG), "replace", True)
"""


def test_a_driver_lost_before_its_commit_leaves_the_old_version_whole(spark, store):
    load_versioned(spark, samples.catalog(spark, slot(D1, "00", "P1"), slot(D2, "00", "P2")), store,
                   backfill=True)
    tests = Path(__file__).resolve().parent
    script = _LOST.format(repo=str(tests.parent), tests=str(tests), root=store.root)
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, timeout=300,
                          env={**os.environ, "SPARK_LOCAL_IP": "127.0.0.1"})
    assert done.returncode == 9
    assert held(spark, store) == [(D1, "00", "P1"), (D2, "00", "P2")]
    load_versioned(spark, samples.catalog(spark, slot(D1, "00", "new")), store, "replace", True)
    assert held(spark, store) == [(D1, "00", "new")]
    versions.vacuum(spark, store, keep=1)
    assert held(spark, store) == [(D1, "00", "new")]


def test_files_of_a_hot_slot_share_no_key(spark, store, tmp_path):
    store = Store(str(tmp_path / "sales"), SALES_DATA)
    rows = samples.sales(spark, slot(D1, "00"), slot(D1, "05", "P1")).limit(1)
    many = spark.range(60_000).select(
        F.concat(F.lit("P"), F.lpad((F.col("id") % 997).cast("string"), 4, "0")).alias("product_id"),
        F.col("id").cast("string").alias("transaction_id"))
    hot = rows.drop("product_id", "transaction_id").crossJoin(many).select(*rows.columns)
    with_one = hot.unionByName(hot.where("product_id < 'P0400'").withColumn("product_id", F.lit("P0500")))
    small = samples.sales(spark, slot(D2, "00", "P1"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        load_versioned(spark, with_one.repartition(8).unionByName(small), store, backfill=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    listed = versions.files(spark, store, versions.version(spark, store)).collect()
    ranges = sorted((r.low, r.high, r.n_rows) for r in listed if r.date == D1)
    assert len(ranges) > 3 and sum(n for _, _, n in ranges) == with_one.count()
    for (_, high, _), (low, _, _) in zip(ranges, ranges[1:]):
        # The one product with a quarter of the rows is split, no other is.
        assert high < low or high == low == "P0500"
    assert max(n for _, _, n in ranges) < with_one.count() / 2
    assert versions.read(spark, store).count() == with_one.count() + 1


def test_a_condition_on_the_timestamp_skips_folders(spark, store, namespace):
    rows = samples.catalog(spark, slot(D1, "00"), slot(D1, "23"), slot(D2, "05"))
    load_versioned(spark, rows, store, backfill=True)
    day = versions.read(spark, store).where("date_tmsp = TIMESTAMP '2025-01-02 00:00:00Z'")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "PartitionFilters: []" not in plan
    scanned = day._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert [r.hour for r in day.collect()] == ["05"]
    assert scanned.relation().location().rootPaths().size() == 3
    assert len(versions.read(spark, store, dates=[D2]).inputFiles()) == 1
    assert len(versions.read(spark, store, slots=[(D1, "23")]).inputFiles()) == 1
    from tillwright.plans.loads import load_managed
    from tillwright.sources.tables import read_managed
    load_managed(spark, PRODUCT_CATALOG, rows, f"{namespace}.c", backfill=True)
    managed = read_managed(spark, f"{namespace}.c")
    assert managed.schema.fieldNames() == spark.table(f"{namespace}.c").columns
    assert managed.exceptAll(spark.table(f"{namespace}.c")).count() == 0
    assert len(managed.where("date_tmsp < TIMESTAMP '2025-01-02 00:00:00Z'").inputFiles()) == 2


def merged(spark, store):
    return held(spark, store, "date", "hour", "product_id", "unit_price")


def test_merge_clauses(spark, store):
    base = samples.catalog(spark, *[slot(D1, "00", f"P{i}", unit_price=1.0) for i in range(6)],
                           slot(D1, "01", "P0", unit_price=1.0), slot(D2, "00", "P0", unit_price=1.0))
    load_versioned(spark, base, store, backfill=True)
    before = names(spark, store)
    change = samples.catalog(spark, slot(D1, "00", "P1", unit_price=2.0), slot(D1, "00", "P9", unit_price=2.0),
                             slot(D2, "07", "P1", unit_price=2.0), slot(None, "00", "P1"))
    assert versions.merge(store, change, KEYS, not_matched="ignore").number == 2
    assert len(merged(spark, store)) == 8 and (D1, "00", "P1", 2.0) in merged(spark, store)
    # Slots and files without a changed row keep their files.
    assert len(names(spark, store) & before) == 2
    assert versions.merge(store, change, KEYS, not_matched="ignore") is None
    assert versions.merge(store, change, KEYS).number == 3
    assert {(D1, "00", "P9", 2.0), (D2, "07", "P1", 2.0)} < set(merged(spark, store))
    after = names(spark, store)
    assert versions.merge(store, change, KEYS) is None and names(spark, store) == after
    gone = samples.catalog(spark, slot(D1, "00", "P1", unit_price=0.0), slot(D1, "00", "P2", unit_price=5.0),
                           slot(D1, "00", "none", unit_price=0.0))
    versions.merge(store, gone, KEYS, delete_when=F.col("unit_price") == 0)
    rows = merged(spark, store)
    assert (D1, "00", "P2", 5.0) in rows and not {"P1", "none"} & {r[2] for r in rows if r[1] == "00"}
    versions.merge(store, change, KEYS, matched="ignore", not_matched="insert")
    assert (D1, "00", "P1", 2.0) in merged(spark, store)
    versions.merge(store, change, KEYS, matched="delete", not_matched="ignore")
    assert not {(D1, "00", "P1", 2.0), (D2, "07", "P1", 2.0)} & set(merged(spark, store))
    assert len(held(spark, store, number=1)) == 8


def test_merge_keys(spark, store):
    load_versioned(spark, samples.catalog(spark, slot(D1, "00", None, unit_price=1.0)), store, backfill=True)
    null = samples.catalog(spark, slot(D1, "00", None, unit_price=3.0))
    with pytest.raises(ValueError, match="null key"):
        versions.merge(store, null, KEYS)
    for _ in range(2):
        versions.merge(store, null, KEYS, null_safe=True)
    assert merged(spark, store) == [(D1, "00", None, 3.0)]
    with pytest.raises(ValueError, match="key twice"):
        versions.merge(store, null.union(null), KEYS, null_safe=True)
    with pytest.raises(ValueError, match="date and hour"):
        versions.merge(store, null, ["product_id"])


def test_rows_that_break_a_rule_are_held_back_and_counted(spark, tmp_path):
    store = Store(str(tmp_path / "stock"), INVENTORY_DATA)
    rows = samples.inventory(
        spark, slot(D1, "00", "P1"), slot(D1, "00", "P2", final_stock=-1),
        slot(D1, "01", None, final_stock=-2), slot(D1, "02", "P4", final_stock=None))
    rules = {"negative": F.col("final_stock") < 0, "nameless": F.col("product_id").isNull()}
    done = load_versioned(spark, rows, store, backfill=True, rules=rules)
    assert done.facts == {"rows": 4, "rejected": 2, "rule_negative": 2, "rule_nameless": 1}
    assert versions.version(spark, store).facts == done.facts
    assert held(spark, store) == [(D1, "00", "P1"), (D1, "02", "P4")]
    bad = versions.read_rejected(spark, store)
    assert sorted((r.hour, r.reasons) for r in bad.collect()) == [
        ("00", "negative"), ("01", "negative,nameless")]
    # A mended slot takes its rejected rows along.
    load_versioned(spark, rows.where("hour = '00'").withColumn("final_stock", F.lit(1).cast("long")),
                   store, backfill=True, rules=rules)
    assert [r.hour for r in versions.read_rejected(spark, store).collect()] == ["01"]
    assert len(held(spark, store)) == 3


def test_mended_rows_enter_once(spark, tmp_path):
    store = Store(str(tmp_path / "stock"), INVENTORY_DATA)
    rules = {"negative": F.col("final_stock") < 0, "nameless": F.col("product_id").isNull()}
    load_versioned(spark, samples.inventory(
        spark, slot(D1, "00", "P1"), slot(D1, "00", None, in_stock=7), slot(D1, "00", "P3", final_stock=-3),
        slot(D2, "00", "P4", final_stock=-4)), store, backfill=True, rules=rules)
    bad = versions.read_rejected(spark, store)
    assert len({r.lineage for r in bad.collect()}) == 3
    mended = bad.withColumn("product_id", F.coalesce("product_id", F.lit("P2"))).withColumn(
        "final_stock", F.when(F.col("product_id") == "P4", F.col("final_stock")).otherwise(F.lit(1)))
    copies = spark.createDataFrame(mended.collect(), mended.schema)
    assert versions.mend(store, copies, KEYS, rules) == 2
    assert held(spark, store) == [(D1, "00", "P1"), (D1, "00", "P2"), (D1, "00", "P3")]
    assert [r.product_id for r in versions.read_rejected(spark, store).collect()] == ["P4"]
    number = versions.version(spark, store).number
    for again in (copies, copies.union(copies)):
        assert versions.mend(store, again, KEYS, rules) == 0
    assert versions.version(spark, store).number == number
    assert len(held(spark, store)) == 3


def report(df):
    return sorted((r.date, r.category_name, r.units_sold, round(r.total_ammount_paid, 4))
                  for r in df.collect())


def test_the_report_follows_changed_slots(spark, tmp_path):
    sales, catalog = (Store(str(tmp_path / d.name), d) for d in (SALES_DATA, PRODUCT_CATALOG))
    sums = Store(str(tmp_path / "sums" / "sales_sums"), SALES_SUMS)
    assert rolling_report(spark, sales, catalog, str(tmp_path / "sums")).count() == 0
    load_versioned(spark, samples.catalog(
        spark, slot(D1, "00", "P1"), slot(D1, "05", "P1"), slot(D2, "00", "P2", category_name=None),
        slot(D2, "00", "P1", category_name="Toys")), catalog, backfill=True)
    load_versioned(spark, samples.sales(
        spark, slot(D1, "00", "P1", units_sold=2), slot(D1, "03", "P1", units_sold=3),
        slot(D2, "00", "P1", units_sold=7), slot(D2, "00", "P2")), sales, backfill=True)

    def check():
        whole = category_sales(versions.read(spark, sales), versions.read(spark, catalog))
        found = rolling_report(spark, sales, catalog, str(tmp_path / "sums"))
        assert report(found) == report(whole)
        return report(found)

    assert check()[0] == (D1, "Tools", 10, 100.0)
    # A slot is replaced, one goes, one comes; only these are read.
    versions.replace_slots(sales, samples.sales(
        spark, slot(D1, "00", "P1", units_sold=5), slot(D1, "04", "P1")), ([D1], ["00", "03", "04"]))
    assert follow(spark, sales, sums, slot_sums) == [(D1, "00"), (D1, "03"), (D1, "04")]
    assert follow(spark, sales, sums, slot_sums) == []
    assert check()[0] == (D1, "Tools", 12, 120.0)
    pinned = rolling_report(spark, sales, catalog, str(tmp_path / "sums"), pinned=True)
    assert report(pinned)[0] == (D1, "Tools", 6, 60.0)
    # The version that the sums stand for is gone: all slots are read again.
    versions.replace_slots(sales, samples.sales(spark, slot(D2, "00", "P1", units_sold=1)))
    versions.vacuum(spark, sales, keep=1)
    check()


def test_refresh_with_versioned_tables(spark, tmp_path):
    root = str(tmp_path / "lake")
    lake.write_slots_csv(samples.catalog(spark, slot(D1, "00", "P1")), f"{root}/product_catalog")
    lake.write_slots_csv(samples.sales(spark, slot(D1, "00", "P1", units_sold=4)), f"{root}/sales_data")
    lake.write_slots_csv(samples.inventory(spark, slot(D1, "00", "P1")), f"{root}/inventory_data")
    job = Refresh("unused", root, str(tmp_path / "tables"), versioned=True,
                  rules={"sales_data": {"free": F.col("total_ammount_paid") == 0}})
    for _ in range(2):
        assert report(run_refresh(spark, job)) == [(D1, "Tools", 4, 40.0)]
    lake.write_slots_csv(samples.sales(
        spark, slot(D1, "01", "P1"), slot(D1, "01", "P1", total_ammount_paid=0.0)), f"{root}/sales_data")
    assert report(run_refresh(spark, job)) == [(D1, "Tools", 5, 50.0)]
    assert versions.read_rejected(spark, job.store(SALES_DATA)).count() == 1
    with pytest.raises(ValueError, match="location"):
        run_refresh(spark, Refresh("unused", root, versioned=True))


def test_a_refresh_loads_again_only_slots_whose_source_changed(spark, tmp_path):
    root = str(tmp_path / "lake")
    job = Refresh("unused", root, str(tmp_path / "tables"), versioned=True, backfill={"product_catalog": True})
    sales = job.store(SALES_DATA)

    def put(dataset, frame, *slots, **more):
        lake.write_slots_csv(frame(spark, *[slot(*s, "P1", **more) for s in slots]), f"{root}/{dataset}")

    def in_slots(*slots):
        at = versions.files(spark, sales, versions.version(spark, sales)).where("kind = 'rows'")
        return {(r.folder, r.file) for r in at.collect() if (r.date, r.hour) in slots}

    a, b, c, d = (D1, "00"), (D1, "01"), (D2, "a+b"), (D2, "01")
    put("product_catalog", samples.catalog, a, c)
    put("sales_data", samples.sales, a, b, c, d)
    put("inventory_data", samples.inventory, a)
    assert report(run_refresh(spark, job)) == [(D1, "Tools", 2, 20.0), (D2, "Tools", 2, 20.0)]
    first, old = names(spark, sales), in_slots(a, c)
    # Nothing came: all files stay.
    run_refresh(spark, job)
    assert names(spark, sales) == first
    # One slot gets another file, one is lost to the table, one is merged into, one leaves the lake.
    put("sales_data", samples.sales, b, units_sold=7)
    versions.delete_slots(spark, sales, [D2], ["01"])
    assert report(run_refresh(spark, job)) == [(D1, "Tools", 9, 90.0), (D2, "Tools", 2, 20.0)]
    assert in_slots(a, c) == old and not in_slots(b, d) & first
    versions.merge(sales, samples.sales(spark, slot(*c, "P9", units_sold=5)), KEYS)
    assert (*c, "P9") in held(spark, sales)
    for path in (tmp_path / "lake" / "sales_data" / "date=2025-01-02" / "hour=01").glob("*.csv"):
        path.unlink()
    assert report(run_refresh(spark, job)) == [(D1, "Tools", 9, 90.0), (D2, "Tools", 1, 10.0)]
    assert held(spark, sales) == [(*a, "P1"), (*b, "P1"), (*b, "P1"), (*c, "P1")]
    # Rules look at every row again.
    strict = Refresh("unused", root, job.location, versioned=True, backfill=job.backfill,
                     rules={"sales_data": {"many": F.col("units_sold") > 5}})
    assert report(run_refresh(spark, strict)) == [(D1, "Tools", 2, 20.0), (D2, "Tools", 1, 10.0)]
    assert report(run_refresh(spark, job)) == [(D1, "Tools", 9, 90.0), (D2, "Tools", 1, 10.0)]
    assert versions.read_rejected(spark, sales).count() == 0


def test_files_that_are_dealt_again_leave_no_first_copy(spark, tmp_path):
    store = Store(str(tmp_path / "sales"), SALES_DATA)
    rows = samples.sales(spark, slot(D1, "00:30")).drop("transaction_id", "product_id")
    many = rows.crossJoin(spark.range(40_000).selectExpr(
        "sha2(string(id), 256) AS transaction_id", "concat('P', id) AS product_id"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        load_versioned(spark, many.repartition(8).unionByName(
            samples.sales(spark, slot(D2, "00", "P1"))), store, backfill=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    on_disk = {p.name for p in (tmp_path / "sales" / "data").rglob("*.parquet")}
    assert len(on_disk) > 2 and on_disk == {f for _, f in names(spark, store)}
    assert versions.read(spark, store).count() == 40_001
