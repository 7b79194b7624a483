import time

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import samples
from samples import slot
from tillwright.schemas import INVENTORY, INVENTORY_DATA, PRODUCT_CATALOG, SALES_DATA
from tillwright.sources import lake
from tillwright.sources.quarantine import read_unchecked, split_bad_rows

# The catalog header with its stray comma, CRLF ends, quotes and commas in cells.
CATALOG_FILE = (
    "ingestion_date,ingestion_hour,product_id,product_name,\"category_id,\",category_name,brand,"
    "description,unit_price,supplier_name,tags\r\n"
    "2025-01-01,00,PROD_0001,\"A \"\"q\"\" 01\",CAT-01,Tools,b,d,20.987,s,\"x, y, z\"\r\n"
)
STOCK_HEADER = ",".join(INVENTORY.fieldNames()) + "\n"


def _put(root, folder, text, name="file.csv"):
    path = root / folder
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text(text, newline="")


def test_catalog_goes_by_position_and_keeps_quotes_and_tags(spark, tmp_path):
    for hour in ("00", "03", "09"):
        _put(tmp_path, f"date=2025-01-01/hour={hour}", CATALOG_FILE)
    df = lake.read_catalog(spark, str(tmp_path))
    assert df.columns == PRODUCT_CATALOG.lake_schema.fieldNames()
    row = df.orderBy("hour").first()
    assert row.product_name == 'A "q" 01'
    assert row.category_id == "CAT-01" and row.tags == "x, y, z" and row.unit_price == 20.987
    assert [r.hour for r in df.orderBy("hour").collect()] == ["00", "03", "09"]


def test_new_files_show_up_and_other_files_do_not(spark, tmp_path):
    _put(tmp_path, "date=2025-01-01/hour=00", CATALOG_FILE)
    assert lake.read_catalog(spark, str(tmp_path)).count() == 1
    _put(tmp_path, "date=2025-01-02/hour=00", CATALOG_FILE)
    _put(tmp_path, "date=2025-01-02/hour=00", "not a table", "notes.txt")
    assert lake.read_catalog(spark, str(tmp_path)).count() == 2


def test_round_trip_is_lossless(spark, tmp_path, rows_of):
    written = samples.catalog(
        spark,
        slot("2025-01-01", "00", product_name='say "hi", twice', description="  blanks  "),
        slot("2025-01-01", "07", product_name="", brand=None, unit_price=0.1 + 0.2),
        slot("2025-01-02", "23", description="back\\slash", tags='a, "b"'),
    )
    lake.write_slots_csv(written, str(tmp_path / "c"))
    read = lake.read_catalog(spark, str(tmp_path / "c"))
    assert rows_of(read.withColumn("date", F.col("date").cast("string"))) == rows_of(written)


def test_strict_read_raises_on_a_bad_number(spark, tmp_path):
    _put(tmp_path, "date=2025-01-01/hour=00", STOCK_HEADER + "2025-01-01,00,P,x,1,1,1,1\n")
    with pytest.raises(Exception, match="MALFORMED|NumberFormat"):
        lake.read_inventory(spark, str(tmp_path)).collect()


def test_mixed_layouts_raise(spark, tmp_path):
    _put(tmp_path, "date=2025-01-01/hour=00", CATALOG_FILE)
    _put(tmp_path, "date=2025-01-01", CATALOG_FILE)
    with pytest.raises(Exception, match="CONFLICTING_PARTITION_COLUMN_NAMES"):
        lake.read_catalog(spark, str(tmp_path)).count()


def test_daily_layout_gets_a_null_hour(spark, tmp_path):
    _put(
        tmp_path, "date=2025-01-01",
        "transaction_date,transaction_id,customer_id,order_country,product_id,unit_price,"
        "units_sold,discount_applied,total_ammount_paid\n"
        "2025-01-01,t1,CUST_1001,Spain,PROD_0001,2.5,6,0.1,13.5\n",
    )
    row = lake.read_sales_daily(spark, str(tmp_path)).first()
    assert row.hour is None and row.transaction_hour is None
    assert (row.product_id, row.units_sold, str(row.date)) == ("PROD_0001", 6, "2025-01-01")
    assert lake.read_sales_daily(spark, str(tmp_path)).columns == (
        SALES_DATA.lake_schema.fieldNames()
    )


def test_existing_slots_come_from_names_alone(spark, tmp_path):
    assert lake.existing_slots(spark, str(tmp_path / "none")) == []
    _put(tmp_path, "date=2025-01-01/hour=03", "garbage \x00 that no parser reads")
    _put(tmp_path, "date=2025-01-01/hour=00", "x")
    _put(tmp_path, "date=2025-01-01/hour=04", "")
    _put(tmp_path, "date=2025-01-02/hour=05", "x", "notes.txt")
    _put(tmp_path, "date=2025-01-03/hour=05", "x")
    assert lake.existing_slots(spark, str(tmp_path)) == [
        ("2025-01-01", "00"), ("2025-01-01", "03"), ("2025-01-03", "05"),
    ]


def test_some_dates_can_be_read_without_listing_the_others(spark, tmp_path):
    for date in ("2025-01-01", "2025-01-02", "2025-01-03"):
        _put(tmp_path, f"date={date}/hour=00", CATALOG_FILE)
    # A layout error elsewhere would show if the other folders were listed.
    _put(tmp_path, "date=2025-01-09", CATALOG_FILE)
    dates = ["2025-01-01", "2025-01-03", "2025-01-07"]
    found = lake.read_catalog(spark, str(tmp_path), dates)
    assert sorted(str(r.date) for r in found.collect()) == ["2025-01-01", "2025-01-03"]
    assert found.columns == PRODUCT_CATALOG.lake_schema.fieldNames()
    assert lake.existing_slots(spark, str(tmp_path), dates) == [
        ("2025-01-01", "00"), ("2025-01-03", "00"),
    ]
    for none in (["2025-01-07"], []):
        assert lake.existing_slots(spark, str(tmp_path), none) == []
        absent = lake.read_catalog(spark, str(tmp_path), none)
        assert absent.columns == found.columns and absent.count() == 0
        assert read_unchecked(spark, str(tmp_path), PRODUCT_CATALOG, none).count() == 0


def test_rows_without_a_slot_are_neither_written_nor_listed(spark, tmp_path):
    rows = samples.sales(spark, slot("2025-01-01", "00"), slot(None, "01"), slot("2025-01-01", None))
    lake.write_slots_csv(rows, str(tmp_path / "a"))
    assert lake.read_sales(spark, str(tmp_path / "a")).count() == 1
    rows.write.option("header", True).partitionBy("date", "hour").csv(str(tmp_path / "b"))
    assert lake.existing_slots(spark, str(tmp_path / "b")) == [("2025-01-01", "00")]


def test_a_quote_in_a_path(spark, tmp_path, namespace):
    root = str(tmp_path / "it's")
    lake.write_slots_csv(samples.inventory(spark, slot("2025-01-01", "00")), root)
    lake.register_external(spark, f"{namespace}.quoted", root, INVENTORY_DATA)
    assert spark.table(f"{namespace}.quoted").count() == 1


def test_a_slot_is_written_once(spark, tmp_path, rows_of):
    root = str(tmp_path / "sales")
    first = samples.sales(spark, slot("2025-01-01", "00", order_country="first"))
    both = samples.sales(
        spark,
        slot("2025-01-01", "00", order_country="second"),
        slot("2025-01-01", "01", order_country="second"),
        slot(None, "01"),
    )
    lake.write_missing_slots(first, root)
    for _ in range(2):
        lake.write_missing_slots(both, root)
    read = lake.read_sales(spark, root).select("hour", "order_country")
    assert rows_of(read) == [("00", "first"), ("01", "second")]


def test_external_table_is_kept_and_refreshed(spark, tmp_path, namespace):
    root = tmp_path / "stock"
    _put(root, "date=2025-01-01/hour=00", STOCK_HEADER + "2025-01-01,00,P,1,1,1,1,1\n")
    name = f"{namespace}.inventory_data_ext"
    lake.register_external(spark, name, str(root), INVENTORY_DATA)
    lake.register_external(spark, name, str(root), INVENTORY_DATA)
    assert spark.table(name).count() == 1
    _put(root, "date=2025-01-02/hour=00", STOCK_HEADER + "2025-01-02,00,P,1,1,1,1,1\n")
    lake.refresh_external(spark, name, str(root))
    assert spark.table(name).count() == 2
    assert dict(spark.table(name).dtypes)["date"] == "date"
    assert dict(spark.table(name).dtypes)["hour"] == "string"


def test_bad_rows_stay_bad_whatever_columns_are_read(spark, tmp_path):
    _put(
        tmp_path, "date=2025-01-01/hour=00",
        STOCK_HEADER + "2025-01-01,00,GOOD,1,1,1,1,1\n2025-01-01,00,NUMBER,1,x,1,1,1\n"
        "2025-01-01,00,SHORT,1,1\n2025-01-01,00,LONG,1,1,1,1,1,1\n",
    )
    good, bad = split_bad_rows(read_unchecked(spark, str(tmp_path), INVENTORY_DATA), INVENTORY_DATA)
    assert [r.product_id for r in good.select("product_id").collect()] == ["GOOD"]
    assert good.count() == 1 and bad.count() == 3
    assert good.schema.fieldNames() == INVENTORY_DATA.lake_schema.fieldNames()
    assert {r.product_id: r.bad_columns for r in bad.collect()} == {
        "NUMBER": "new_product", "SHORT": "line", "LONG": "line",
    }


def test_missing_root_is_an_error_for_a_read(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        lake.read_sales(spark, str(tmp_path / "none"))


def test_a_hot_slot_is_split_and_small_ones_share_a_task(spark, tmp_path):
    """One slot with most rows must not be the work of one task."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "64k")
    try:
        rows = spark.range(0, 200_000, 1, 16).select(
            F.lit("2025-01-01").alias("date"),
            F.when(F.col("id") % 2 == 0, "00").otherwise(
                F.lpad((F.col("id") % 24).cast("string"), 2, "0")).alias("hour"),
            F.sha2(F.col("id").cast("string"), 256).alias("product_id"),
        )
        lake.by_slot(rows, "product_id").write.partitionBy("date", "hour").parquet(
            str(tmp_path / "hot"))
    finally:
        spark.conf.unset(key)
    files = list((tmp_path / "hot").glob("date=*/hour=00/*.parquet"))
    assert len(files) > 5
    assert spark.read.parquet(str(tmp_path / "hot")).count() == 200_000


def test_packed_files_are_read_and_listed_like_plain_ones(spark, tmp_path, rows_of):
    rows = samples.catalog(
        spark, *[slot("2025-01-01", f"{i % 3:02d}", f"P{i}", product_name='a "b", ç\t ') for i in range(300)],
        slot("2025-01-02", "05", product_name=""))
    plain, packed = str(tmp_path / "plain"), str(tmp_path / "packed")
    lake.write_slots_csv(rows, plain)
    assert len(lake.write_missing_slots(rows, packed, packed=True)) == 4
    assert lake.write_missing_slots(rows, packed, packed=True) == []
    assert lake.existing_slots(spark, packed) == lake.existing_slots(spark, plain)
    assert rows_of(lake.read_catalog(spark, packed)) == rows_of(lake.read_catalog(spark, plain))
    assert not list(tmp_path.glob("packed/date=*/**/*.csv"))
    size = {n: sum(f.stat().st_size for f in (tmp_path / n).glob("date=*/**/*.csv*")) for n in ("plain", "packed")}
    assert size["packed"] < size["plain"] / 4
    # A lake may hold both.
    lake.write_slots_csv(rows, packed)
    assert lake.read_catalog(spark, packed).count() == 602


def test_the_digest_of_a_slot_tells_when_its_files_change(spark, tmp_path):
    assert lake.slot_digests(spark, str(tmp_path / "none")) == {}
    for hour in ("00", "01"):
        _put(tmp_path, f"date=2025-01-01/hour={hour}", CATALOG_FILE)
    before = lake.slot_digests(spark, str(tmp_path))
    assert sorted(before) == lake.existing_slots(spark, str(tmp_path))
    assert lake.slot_digests(spark, str(tmp_path)) == before
    _put(tmp_path, "date=2025-01-01/hour=01", CATALOG_FILE, "more.csv")
    after = lake.slot_digests(spark, str(tmp_path))
    assert after["2025-01-01", "00"] == before["2025-01-01", "00"]
    assert after["2025-01-01", "01"] != before["2025-01-01", "01"]


def test_a_write_leaves_no_shuffle_behind(spark, tmp_path):
    """The files go as soon as the statement ends, with nothing collected in the driver."""
    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def shuffled():
        files = disk.getAllFiles()
        names = (files.apply(i).getName() for i in range(files.size()))
        return {n for n in names if n.startswith("shuffle_")}

    before = shuffled()
    kept = spark.range(1000).repartition(3, "id")
    assert kept.count() == 1000 and shuffled() - before
    held = shuffled()
    lake.write_slots_csv(samples.catalog(spark, *[slot("2025-01-01", "00", f"P{i}") for i in range(50)]),
                         str(tmp_path / "c"))
    until = time.time() + 20
    while shuffled() - held and time.time() < until:
        time.sleep(0.2)
    assert not shuffled() - held
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
