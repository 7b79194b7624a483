"""The CSV lake: ``<root>/date=YYYY-MM-DD/hour=HH/*.csv`` or ``.csv.gz``, one root per dataset."""

from __future__ import annotations

import re
import uuid
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillwright.functions.slotted import in_dates, in_slots
from tillwright.functions.texts import quoted
from tillwright.operators.slots import with_slot
from tillwright.schemas import (
    CATALOG_DAILY, INVENTORY_DATA, PRODUCT_CATALOG, SALES_DAILY, SALES_DATA, Dataset,
)
from tillwright.session import FREED, discard, freed_shuffles, list_names, rename_new

Slots = list[tuple[str, str]]

# What counts as a file of the lake, plain or packed.
CSV_FILES = "*.csv{,.gz}"
# The files are written by a CSV writer that doubles quotes inside a field, so
# the quote is its own escape. Columns go by position: the header line is
# skipped, its names are never used (one catalog header holds a stray comma).
CSV_FORMAT = {"header": "true", "quote": '"', "escape": '"', "enforceSchema": "true"}
# The parser puts the null marker in place of an empty cell. With one that is no
# text of its own, an empty cell is null and a quoted empty text stays a text.
CSV_READ = {
    **CSV_FORMAT, "mode": "FAILFAST", "pathGlobFilter": CSV_FILES, "nullValue": "\u0001",
}
# Blanks around a value belong to it.
CSV_WRITE = {
    **CSV_FORMAT, "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}
# A packed lake takes some three tenths of the disk. The fastest level, as the writer waits for it. A
# packed file is read by one task, so files must be of an even size, which ``by_slot`` sees to.
CSV_PACKED = {**CSV_WRITE, "compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def folders(root: str, dates: list[str] | None = None) -> str:
    """``root``, or a pattern for just the folders of some dates below it."""
    if dates is None:
        return root
    return f"{root.rstrip('/')}/date={{{','.join(sorted({str(d) for d in dates}))}}}"


def read_lake(spark: SparkSession, root: str, dataset: Dataset,
              dates: list[str] | None = None) -> DataFrame:
    """Scan one dataset. Folders are listed anew on each call, so new files show up.

    A filter on the date skips the files of other dates, but they are listed
    first. With ``dates`` only the folders of those dates are listed; if none of
    them exists, there are no rows. A root that does not exist is an error.
    """
    if dates is not None and list_files(spark, root, dates) is None:
        return spark.createDataFrame([], dataset.lake_schema)
    reader = spark.read.schema(dataset.lake_schema).options(**CSV_READ, basePath=root)
    return reader.csv(folders(root, dates))


def read_catalog(spark: SparkSession, root: str, dates: list[str] | None = None) -> DataFrame:
    return read_lake(spark, root, PRODUCT_CATALOG, dates)


def read_sales(spark: SparkSession, root: str, dates: list[str] | None = None) -> DataFrame:
    return read_lake(spark, root, SALES_DATA, dates)


def read_inventory(spark: SparkSession, root: str, dates: list[str] | None = None) -> DataFrame:
    return read_lake(spark, root, INVENTORY_DATA, dates)


def _read_daily(spark: SparkSession, root: str, body: T.StructType, dataset: Dataset) -> DataFrame:
    schema = T.StructType([*body.fields, T.StructField("date", T.DateType())])
    daily = spark.read.schema(schema).options(**CSV_READ).csv(root)
    absent = [
        F.lit(None).cast(f.dataType).alias(f.name)
        for f in dataset.lake_schema
        if f.name not in daily.columns
    ]
    return daily.select("*", *absent).select(*dataset.lake_schema.fieldNames())


def read_catalog_daily(spark: SparkSession, root: str) -> DataFrame:
    """The older layout (``date=`` folders only) in today's columns; hours are null."""
    return _read_daily(spark, root, CATALOG_DAILY, PRODUCT_CATALOG)


def read_sales_daily(spark: SparkSession, root: str) -> DataFrame:
    """The older layout (``date=`` folders only) in today's columns; hours are null."""
    return _read_daily(spark, root, SALES_DAILY, SALES_DATA)


# The folder that stands for a missing value (fixed value of the file layout).
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_PLACE = r"/date=([^/]+)/hour=([^/]+)/([^/]+)$"


def unescaped(name: Column) -> Column:
    """The text a folder name stands for: ``%3A`` is a colon, and a plus is a plus."""
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def partition_slots(spark: SparkSession, name: str) -> Slots:
    """Slots of a table's partitions, as the catalog has them; a missing value is ``NO_VALUE``."""
    slots = []
    for row in spark.sql(f"SHOW PARTITIONS {name}").collect():
        date, hour = (unquote(part.split("=", 1)[1]) for part in row.partition.split("/"))
        slots.append((date, hour))
    return sorted(slots)


def list_files(spark: SparkSession, root: str, dates: list[str] | None = None,
               pattern: str = CSV_FILES) -> DataFrame | None:
    """Files under ``root`` as ``(date, hour, file, bytes, changed)``; None if there is no such folder.

    With ``dates`` only the folders of those dates are looked at. Files without a
    byte and folders without a date or hour are left out.

    No file is opened: the binary file source yields names only when its content
    column is not read. A session of its own packs all names into as many tasks
    as there are cores, whatever the files weigh.
    """
    if dates is not None and not dates:
        return None
    listing = spark.newSession()
    listing.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 60))
    listing.conf.set(FREED, "true")
    try:
        files = (
            listing.read.format("binaryFile")
            .option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", "true")
            .load(folders(root, dates))
        )
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    found = files.select(*[
        unescaped(F.regexp_extract("path", _PLACE, group)).alias(name)
        for group, name in enumerate(("date", "hour", "file"), 1)
    ], F.col("length").alias("bytes"), F.col("modificationTime").alias("changed"))
    return found.where((F.col("date") != "") & ~F.col("date").eqNullSafe(NO_VALUE)
                       & ~F.col("hour").eqNullSafe(NO_VALUE))


def existing_slots(spark: SparkSession, root: str, dates: list[str] | None = None,
                   pattern: str = CSV_FILES) -> Slots:
    """Slots that have a file under ``root``, in order; see ``list_files``.

    A file may hold a header alone, so a listed slot need not have rows.
    """
    files = list_files(spark, root, dates, pattern)
    if files is None:
        return []
    return sorted((r.date, r.hour) for r in files.select("date", "hour").distinct().collect())


def slot_digests(spark: SparkSession, root: str,
                 dates: list[str] | None = None) -> dict[tuple[str, str], str]:
    """For each of ``existing_slots`` a digest of the names, sizes and times of its files.

    It is another one as soon as a file of the slot comes, goes or is written anew.
    """
    files = list_files(spark, root, dates)
    if files is None:
        return {}
    facts = F.concat_ws("/", "file", "bytes", F.unix_micros("changed"))
    # A row per file goes in, a row per slot comes out.
    digests = files.groupBy("date", "hour").agg(
        F.sha2(F.array_join(F.sort_array(F.collect_list(facts)), "/"), 256).alias("digest"))
    return {(r.date, r.hour): r.digest for r in digests.collect()}


def slots_frame(spark: SparkSession, slots: Slots) -> DataFrame:
    return spark.createDataFrame(slots, "date string, hour string")


def by_slot(df: DataFrame, *order: str, first: tuple[str, ...] = ()) -> DataFrame:
    """Bring the rows of a slot together for writing, in files of an even size.

    A rebalance lets adaptive execution join small slots into one task and split
    a slot too large for one, which a plain ``repartition`` by slot would not.
    The sort starts with the partition columns, ``first`` and then the slot, so the
    writer adds none.
    """
    place = [*first, "date", "hour"]
    return df.hint("rebalance", *[F.col(c) for c in place]).sortWithinPartitions(*place, *order)


def write_slots_csv(df: DataFrame, root: str, mode: str = "append", packed: bool = False) -> None:
    """Write ``df`` with header lines into ``date=/hour=`` folders; ``packed`` files are gzip.

    Rows without a date or hour belong to no slot and are not written.
    """
    with freed_shuffles(df.sparkSession):
        by_slot(with_slot(df)).write.mode(mode).options(**(CSV_PACKED if packed else CSV_WRITE)).partitionBy(
            "date", "hour").csv(root)


def write_daily_csv(df: DataFrame, root: str, mode: str = "append") -> None:
    """Write ``df`` with header lines into ``date=`` folders."""
    (
        df.hint("rebalance", F.col("date")).sortWithinPartitions("date")
        .write.mode(mode).options(**CSV_WRITE).partitionBy("date").csv(root)
    )


# Folders that readers pass over, as their names start with an underscore.
_MARKS, _STAGING, _UNFINISHED = "_complete", "_staging", "_unfinished"


def mark_slots(spark: SparkSession, root: str, slots: Slots) -> None:
    """Note that these slots are written whole; a slot may be noted twice."""
    marks = slots_frame(spark, slots).withColumn("mark", F.lit("complete"))
    marks.select("mark", "date", "hour").coalesce(1).sortWithinPartitions("date", "hour").write.mode(
        "append").partitionBy("date", "hour").text(f"{root}/{_MARKS}")


def finished_slots(spark: SparkSession, root: str, dates: list[str] | None = None) -> Slots:
    """Slots that count as written: those with a mark.

    A lake that ``write_missing_slots`` never wrote to has no marks at all; there every
    slot with a file counts, as other writers make a slot's file appear whole.
    """
    if not list_names(spark, f"{root}/{_MARKS}"):
        return existing_slots(spark, root, dates)
    return existing_slots(spark, f"{root}/{_MARKS}", dates, "*")


def _folder(root: str, date: str, hour: str) -> str:
    """The folder of a slot, named as Spark's writers do."""
    escaped = [re.sub(r"""["#%'*/:=?\\{\[\]^\x00-\x1f\x7f]""", lambda m: f"%{ord(m[0]):02X}", v)
               for v in (date, hour)]
    return f"{root}/date={escaped[0]}/hour={escaped[1]}"


def write_missing_slots(df: DataFrame, root: str, dates: list[str] | None = None,
                        packed: bool = False) -> Slots:
    """Write the slots that are not finished under ``root`` yet; returns those written.

    The finished slots are a predicate on the rows, so nothing is joined. With
    ``dates`` only those are looked at and written.

    Rows are written beside the lake first. Then each slot's folder is renamed to its
    place, where it shows whole or not at all, and marks follow last. What an unfinished
    slot held is set aside under ``_unfinished``, so the slot has the new rows alone. Of two
    writers the one whose folder comes second leaves its rows out, and a writer that is
    lost leaves slots behind that the next one writes.
    """
    spark = df.sparkSession
    placed = df if dates is None else df.where(in_dates(dates))
    present = finished_slots(spark, root, dates)
    marked = list_names(spark, f"{root}/{_MARKS}")
    if not marked:
        # From now on marks decide, so what was there before gets them, of all dates.
        held = present if dates is None else existing_slots(spark, root)
        if held:
            mark_slots(spark, root, held)
    run = uuid.uuid4().hex
    staged = f"{root}/{_STAGING}/{run}"
    write_slots_csv(placed.where(~in_slots(present)), staged, packed=packed)
    try:
        written = [slot for slot in existing_slots(spark, staged) if _place_slot(spark, root, run, *slot)]
        if written:
            mark_slots(spark, root, written)
    finally:
        discard(spark, staged)
    return written


def _place_slot(spark: SparkSession, root: str, run: str, date: str, hour: str) -> bool:
    """Put a staged slot into the lake; False if another writer was first."""
    staged, place = (_folder(top, date, hour) for top in (f"{root}/{_STAGING}/{run}", root))
    if rename_new(spark, staged, place):
        return True
    if (date, hour) in finished_slots(spark, root, [date]):
        return False
    rename_new(spark, place, _folder(f"{root}/{_UNFINISHED}/{run}", date, hour))
    return rename_new(spark, staged, place)


def register_external(spark: SparkSession, name: str, root: str, dataset: Dataset) -> None:
    """Register the lake of one dataset under ``name``, if that is not done yet.

    The catalog keeps the partition list, so a query on a few slots lists only
    their folders. ``refresh_external`` picks up new ones, ``follow_external`` by itself.
    """
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dataset.lake_schema)
    options = ", ".join(f"'{k}' '{quoted(v)}'" for k, v in CSV_READ.items())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING csv OPTIONS ({options}) "
        f"PARTITIONED BY (date, hour) LOCATION '{quoted(root)}'"
    )
    refresh_external(spark, name, root)


def follow_external(spark: SparkSession, name: str, root: str, ledger: str,
                    every: str | None = None) -> StreamingQuery:
    """Add the slots of new files under ``root`` to the table as they come.

    ``ledger`` is a folder that keeps which files were seen, across restarts, so a round
    costs a listing of names and one statement per some hundred new slots; no file is opened
    and no known partition asked for. With ``every``, such as ``1 minute``, it goes on until
    stopped, and ``spark.table(name)`` shows new folders unasked; without, it ends when all
    files that are there now are known.
    """
    found = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", CSV_FILES).option("recursiveFileLookup", "true").load(root)
        .select("path")
    )

    def add(batch: DataFrame, _: int) -> None:
        slots = batch.select(*[
            unescaped(F.regexp_extract("path", _PLACE, group)).alias(column)
            for group, column in enumerate(("date", "hour"), 1)
        ]).where((F.col("date") != "") & (F.col("date") != NO_VALUE) & (F.col("hour") != NO_VALUE))
        _add_slots(spark, name, [(r.date, r.hour) for r in slots.distinct().collect()])

    writer = found.writeStream.foreachBatch(add).option("checkpointLocation", ledger)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


ADD_BATCH = 500


def _add_slots(spark: SparkSession, name: str, slots: Slots) -> None:
    for at in range(0, len(slots), ADD_BATCH):
        specs = " ".join(f"PARTITION (date = '{quoted(d)}', hour = '{quoted(h)}')"
                         for d, h in slots[at : at + ADD_BATCH])
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {specs}")
    if slots:
        spark.catalog.refreshTable(name)


def refresh_external(spark: SparkSession, name: str, root: str,
                     dates: list[str] | None = None) -> None:
    """Add the slots of ``root`` that the table does not know; ``dates`` limits the look."""
    known = set(partition_slots(spark, name))
    _add_slots(spark, name, [s for s in existing_slots(spark, root, dates) if s not in known])
    spark.catalog.refreshTable(name)
