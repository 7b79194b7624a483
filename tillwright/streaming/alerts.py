"""Alert messages: encode, decode, set bad ones apart, drop repeats, store."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillwright.operators.inventory import negative_stock
from tillwright.schemas import ALERT, ALERT_KEY, INVENTORY_DATA
from tillwright.session import list_names
from tillwright.sources.lake import CSV_READ
from tillwright.sources.quarantine import read_unchecked, split_bad_rows

UNREADABLE = "_unreadable"
BAD_VALUE = "bad_value"
# Longer than the three days in which a slot may be written again.
REPEAT_WINDOW = "4 days"


def to_messages(df: DataFrame) -> DataFrame:
    """One JSON text per row in ``value``; null fields are kept."""
    fields = F.struct(*[F.col(name) for name in ALERT.fieldNames()])
    return df.select(F.to_json(fields, {"ignoreNullFields": "false"}).alias("value"))


def message_source(spark: SparkSession, path: str, per_batch: int | None = None) -> DataFrame:
    """Stream of message lines from files; any stream with a text ``value`` serves as well."""
    reader = spark.readStream.format("text")
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.load(path)


def _decoded() -> Column:
    schema = T.StructType([*ALERT.fields, T.StructField(UNREADABLE, T.StringType())])
    return F.from_json(
        F.col("value").cast("string"), schema,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": UNREADABLE},
    )


def marked_messages(messages: DataFrame) -> DataFrame:
    """Alert columns of each message, and ``bad_value``: its text if it is no alert.

    Bad is what is no JSON object, has a field of the wrong type, or lacks a key.
    """
    decoded = messages.withColumn("_alert", _decoded())
    whole = F.col("_alert").isNotNull() & F.col(f"_alert.{UNREADABLE}").isNull()
    for key in ALERT_KEY:
        whole = whole & F.col(f"_alert.{key}").isNotNull()
    bad = ~F.coalesce(whole, F.lit(False))
    return decoded.select(
        *[F.when(~bad, F.col(f"_alert.{name}")).alias(name) for name in ALERT.fieldNames()],
        F.when(bad, F.coalesce(F.col("value").cast("string"), F.lit(""))).alias(BAD_VALUE),
    )


def _split(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    good = marked.where(F.col(BAD_VALUE).isNull()).select(*ALERT.fieldNames())
    bad = marked.where(F.col(BAD_VALUE).isNotNull()).select(F.col(BAD_VALUE).alias("value"))
    return good, bad


def split_bad_messages(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Decoded alerts, and the ``value`` of messages that are none (null as empty text).

    Works on batches and on streams.
    """
    return _split(marked_messages(messages))


def alert_stream(messages: DataFrame) -> DataFrame:
    """Alerts of a message stream alone; ``start_message_quarantine`` keeps the bad ones, too."""
    return split_bad_messages(messages)[0]


def negative_stock_stream(spark: SparkSession, root: str, per_batch: int | None = None,
                          strict: bool = True) -> DataFrame:
    """Alerts straight from new inventory files of the lake.

    The file source hands out each file once, so a slot alerts when its file
    first appears. A bad CSV row ends the stream; with ``strict=False`` it is
    passed over, and the load sets it apart (or ``start_stock_quarantine``).
    """
    pace = {"maxFilesPerTrigger": str(per_batch)} if per_batch else {}
    if strict:
        reader = spark.readStream.schema(INVENTORY_DATA.lake_schema).options(**CSV_READ, **pace)
        stock = reader.csv(root)
    else:
        rows = read_unchecked(spark, root, INVENTORY_DATA, stream=True, **pace)
        stock, _ = split_bad_rows(rows, INVENTORY_DATA)
    return negative_stock(stock).select(*ALERT.fieldNames())


def dedup_alerts(alerts: DataFrame, delay: str = REPEAT_WINDOW,
                 arrived: Column | None = None, spread: int = 4,
                 keys: tuple[str, ...] = tuple(ALERT_KEY)) -> DataFrame:
    """One alert per slot and product (or other ``keys``) among those that arrive within ``delay``.

    The watermark runs on arrival, not on the slot: a backfill of old slots is
    never late and never lost. A repeat later than ``delay`` passes as new, and
    the state forgets a key after that time. Arrival is the time of the batch
    unless ``arrived`` gives another, which must not run backwards by more than
    ``delay``.

    Repeats are dropped in two steps, first within ``spread`` random shares of a
    key, so that an alert sent over and over is not all work of one task. With
    ``spread=1`` there is only the second step, and less state. Each step keeps as
    many state stores as ``spark.sql.shuffle.partitions`` says when the stream starts
    first; size it to the messages of a batch and not to a batch job's shuffles.
    """
    moment = F.current_timestamp() if arrived is None else arrived
    timed = alerts.withColumn("_arrived", moment).withWatermark("_arrived", delay)
    if spread > 1:
        timed = timed.withColumn("_share", F.floor(F.rand() * spread))
        timed = timed.dropDuplicatesWithinWatermark([*keys, "_share"])
    return timed.dropDuplicatesWithinWatermark(list(keys)).select(*alerts.columns)


def start_alert_sink(alerts: DataFrame, path: str, checkpoint: str,
                     until_caught_up: bool = True) -> StreamingQuery:
    """Append alerts to a parquet folder, exactly once per checkpoint.

    ``checkpoint`` belongs in storage that outlives the job.
    """
    writer = (
        alerts.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if until_caught_up else writer).start()


def read_unique(spark: SparkSession, path: str) -> DataFrame:
    """What ``start_unique_sink`` has stored under ``path``."""
    kinds = T.StructType([*ALERT.fields, T.StructField("query", T.StringType()),
                          T.StructField("batch", T.LongType())])
    if not list_names(spark, path):
        return spark.createDataFrame([], kinds)
    return spark.read.schema(kinds).parquet(path).select(*kinds.fieldNames())


def start_unique_sink(alerts: DataFrame, path: str, checkpoint: str,
                      until_caught_up: bool = True) -> StreamingQuery:
    """Store each alert once, however late and by whichever query it comes again.

    What is stored, by date of the slot, is the memory: a batch reads the keys of its own
    dates alone, three columns of them, and leaves out what is there. So nothing is kept in
    memory or in state stores, a repeat after a year is dropped like one after a minute, and
    a batch costs the alerts stored of its dates; on disk that is one row per slot and
    product below zero. A batch run again replaces its own rows and does not meet them. Nulls
    in a key are a value like any other. Of queries that share a folder one may run at a time.
    """

    def store(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        batch.persist()
        try:
            dates = [r[0] for r in batch.select("inventory_date").distinct().collect()]
            known = [d for d in dates if d is not None]
            of_dates = F.col("inventory_date").isin(known) | F.col("inventory_date").isNull()
            own = (F.col("query") == query) & (F.col("batch") == number)
            seen = read_unique(spark, path).where(of_dates & ~own).select(
                *[F.col(k).alias(f"_{k}") for k in ALERT_KEY])
            same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in ALERT_KEY])
            new = batch.dropDuplicates(list(ALERT_KEY)).join(seen, same, "left_anti")
            new.select("*", F.lit(query).alias("query"), F.lit(number).alias("batch")).write.mode(
                "overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                "inventory_date", "query", "batch").parquet(path)
        finally:
            batch.unpersist()

    writer = alerts.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if until_caught_up else writer).start()


def _store_parts(stream: DataFrame, split, paths: tuple[str, str], checkpoint: str,
                 until_caught_up: bool) -> StreamingQuery:
    """Store the two parts of each batch in two folders; the batch is computed once.

    Each batch overwrites a folder named after it and its query, so a batch run
    again after a failure leaves no second copy, and a stream begun anew does not
    touch what an earlier one stored.
    """

    def store(batch: DataFrame, number: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        batch.persist()
        try:
            for rows, path in zip(split(batch), paths):
                rows.write.mode("overwrite").parquet(f"{path}/query={query}/batch={number}")
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if until_caught_up else writer).start()


def start_message_quarantine(messages: DataFrame, good_path: str, bad_path: str,
                             checkpoint: str, until_caught_up: bool = True,
                             delay: str | None = None, **settings) -> StreamingQuery:
    """Store alerts and undecodable messages in two folders, each message decoded once.

    With ``delay`` repeats are dropped first, see ``dedup_alerts`` (``settings`` are
    its own): alerts by slot and product, bad messages by their text.
    """
    marked = marked_messages(messages)
    if delay:
        marked = dedup_alerts(marked, delay, keys=(*ALERT_KEY, BAD_VALUE), **settings)
    return _store_parts(marked, _split, (good_path, bad_path), checkpoint, until_caught_up)


def start_stock_quarantine(spark: SparkSession, root: str, good_path: str, bad_path: str,
                           checkpoint: str, until_caught_up: bool = True) -> StreamingQuery:
    """Store alerts of new inventory files and their bad rows in two folders."""

    def split(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
        stock, bad = split_bad_rows(batch, INVENTORY_DATA)
        return negative_stock(stock).select(*ALERT.fieldNames()), bad

    rows = read_unchecked(spark, root, INVENTORY_DATA, stream=True)
    return _store_parts(rows, split, (good_path, bad_path), checkpoint, until_caught_up)
