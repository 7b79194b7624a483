"""Managed parquet tables, partitioned by slot.

Built-in parquet tables know no DELETE, MERGE or REPLACE, so slots are the unit
of change: they are dropped as partitions and replaced by dynamic overwrite,
which writes beside the table and moves the new slots in when the job commits.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwright.functions.slotted import in_lists, in_slots
from tillwright.functions.texts import quoted
from tillwright.functions.times import utc_midnight
from tillwright.operators.slots import with_slot
from tillwright.schemas import Dataset
from tillwright.session import discard, scratch_folder
from tillwright.sources.lake import (
    NO_VALUE, Slots, by_slot, existing_slots, list_files, partition_slots,
)

DROP_BATCH = 500


def ensure_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    at = f" LOCATION '{quoted(location)}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{at}")


def _properties(spark: SparkSession, name: str, dataset: Dataset) -> None:
    spark.sql(f"COMMENT ON TABLE {name} IS '{quoted(dataset.description)}'")
    # Labels are fixed values. No partition filter is required of readers.
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('env' = 'dev', 'source' = 'csv')")


def create_slot_table(spark: SparkSession, name: str, schema: T.StructType) -> None:
    """Create an empty table partitioned by slot unless it exists."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    # As a table option the dynamic mode holds for every overwrite of this table
    # and needs no session setting; the writer ignores it as an option of its own.
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        "OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY (date, hour)"
    )


def create_managed(spark: SparkSession, name: str, dataset: Dataset,
                   replace: bool = False) -> None:
    """Create an empty managed table; with ``replace``, drop the old one first."""
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    elif spark.catalog.tableExists(name):
        return
    create_slot_table(spark, name, dataset.managed_schema)
    _properties(spark, name, dataset)


def has_layout(spark: SparkSession, name: str, dataset: Dataset) -> bool:
    """True if the table exists with the columns of the dataset."""
    if not spark.catalog.tableExists(name):
        return False
    wanted = [(f.name, f.dataType) for f in dataset.managed_schema]
    return [(f.name, f.dataType) for f in spark.table(name).schema] == wanted


def to_managed(df: DataFrame, dataset: Dataset) -> DataFrame:
    """Lake rows in the columns of the managed table: text date, timestamp added."""
    return df.withColumn("date_tmsp", utc_midnight(F.col("date").cast("date"))).withColumn(
        "date", F.col("date").cast("string")
    ).select(*dataset.managed_schema.fieldNames())


def table_slots(spark: SparkSession, name: str) -> Slots:
    """Slots of a managed or external table, from the catalog alone; missing values are none."""
    return [slot for slot in partition_slots(spark, name) if NO_VALUE not in slot]


def read_managed(spark: SparkSession, name: str) -> DataFrame:
    """A managed table with ``date_tmsp`` told from the date instead of read.

    So a condition on ``date_tmsp`` skips the partitions of other days, which one on
    the stored column cannot.
    """
    table = spark.table(name)
    return table.withColumn("date_tmsp", utc_midnight(F.col("date").cast("date"))).select(
        *table.columns)


def drop_slots(spark: SparkSession, name: str, slots: Slots) -> None:
    """Drop slots that the table has; one that it has not is an error."""
    for at in range(0, len(slots), DROP_BATCH):
        specs = ", ".join(
            f"PARTITION (date = '{quoted(d)}', hour = '{quoted(h)}')"
            for d, h in slots[at:at + DROP_BATCH]
        )
        spark.sql(f"ALTER TABLE {name} DROP {specs}")


def append_slots(df: DataFrame, name: str) -> None:
    """Insert ``df`` by column name, sorted by product inside each file."""
    columns = df.sparkSession.table(name).columns
    by_slot(df.select(*columns), "product_id").write.mode("append").insertInto(name)


def overwrite_slots(df: DataFrame, name: str) -> None:
    """Replace the slots that occur in ``df`` and leave all others alone.

    The new files are complete before an old one goes, so a lost executor costs
    a task retry, and ``df`` may read the table it replaces slots of.
    """
    columns = df.sparkSession.table(name).columns
    by_slot(df.select(*columns), "product_id").write.mode("overwrite").insertInto(name)


def _listed(slots: Slots, dates: list[str], hours: list[str]) -> Slots:
    some_dates, some_hours = {str(d) for d in dates if d is not None}, set(hours)
    return [(d, h) for d, h in slots if d in some_dates and h in some_hours]


def delete_slots(spark: SparkSession, name: str, dates: list[str], hours: list[str]) -> None:
    """Delete every listed date with every listed hour."""
    drop_slots(spark, name, _listed(table_slots(spark, name), dates, hours))


def _first_files(spark: SparkSession, name: str, slots: Slots) -> dict[tuple[str, str], str]:
    """First file name of each given slot, from a listing of the table's folders."""
    if not slots:
        return {}
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    root = next(r.data_type for r in described if r.col_name == "Location")
    files = list_files(spark, root, sorted({d for d, _ in slots}), "*.parquet")
    if files is None:
        return {}
    # A row per file goes in, a row per slot comes out.
    first = files.distinct().groupBy("date", "hour").agg(F.min("file").alias("file"))
    return {(r.date, r.hour): r.file for r in first.collect()}


def swap_slots(spark: SparkSession, name: str, df: DataFrame, held: Slots) -> None:
    """Overwrite the slots of ``df`` and drop those of ``held`` it has no rows for.

    Every write names its files anew, so a slot that still starts with the same
    file was not written. That costs two listings, and neither reads a row of the
    table nor computes ``df`` a second time.
    """
    before = _first_files(spark, name, held)
    overwrite_slots(df, name)
    after = _first_files(spark, name, held)
    drop_slots(spark, name, [slot for slot in held if before.get(slot) == after.get(slot)])


def listed_slots(spark: SparkSession, name: str, dates: list[str], hours: list[str]) -> Slots:
    """Held slots of the listed dates and hours."""
    return _listed(table_slots(spark, name), dates, hours)


def replace_slots(spark: SparkSession, name: str, df: DataFrame, dates: list[str],
                  hours: list[str]) -> None:
    """Delete the listed dates and hours, then insert ``df``.

    A listed slot without rows in ``df`` ends up empty; dynamic overwrite alone
    would keep its old rows. Rows of ``df`` outside the lists are added to what
    their slots hold.
    """
    listed = in_lists(dates, hours)
    swap_slots(spark, name, df.where(listed), listed_slots(spark, name, dates, hours))
    append_slots(df.where(~listed), name)


def replace_all(spark: SparkSession, name: str, df: DataFrame) -> None:
    """Make the table hold exactly ``df``; readers never find it empty."""
    swap_slots(spark, name, df, table_slots(spark, name))


def merge_by_key(spark: SparkSession, name: str, df: DataFrame, keys: list[str]) -> None:
    """Rows of ``df`` replace the table rows with the same keys or are added.

    ``keys`` include ``date`` and ``hour``. Only the slots that occur in ``df``
    are read and written. Rows without a date or hour belong to no slot and are
    left out, as in a load. Null in another key is a value like any other and matches
    null. A key that ``df`` has twice is an error.
    """
    if not {"date", "hour"} <= set(keys):
        raise ValueError("keys must include date and hour")
    table = spark.table(name)
    # Computed once: its rows, keys and slots all come from the same files.
    staged_at = scratch_folder(spark, "merge")
    by_slot(with_slot(df).select(*table.columns)).write.partitionBy("date", "hour").parquet(
        staged_at)
    try:
        staged = spark.read.schema(table.schema).parquet(staged_at)
        twice = staged.groupBy(*keys).count().where("count > 1").first()
        if twice:
            raise ValueError(f"the source has a key twice: {twice.asDict()}")
        touched = existing_slots(spark, staged_at, pattern="*.parquet")
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys])
        new = staged.select(*[F.col(k).alias(f"_new_{k}") for k in keys])
        kept = table.where(in_slots(touched)).join(new, same, "left_anti")
        overwrite_slots(kept.unionByName(staged), name)
    finally:
        discard(spark, staged_at)
