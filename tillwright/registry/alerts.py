"""Alert messages, in batch and as streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwright import fixtures as fx
from tillwright.operators.inventory import negative_stock
from tillwright.registry.entry import Query, yearly
from tillwright.schemas import ALERT
from tillwright.session import scratch_folder
from tillwright.sources import lake
from tillwright.streaming import alerts as op

_ALERT_COLUMNS = (
    "inventory_date, inventory_hour, product_id, in_stock, new_product, returned_product, "
    "units_sold, final_stock"
)
_ALERTS = yearly(f"SELECT {_ALERT_COLUMNS} FROM inventory WHERE final_stock < 0")


def _negative(spark, sf_dir):
    return negative_stock(fx.inventory(spark, sf_dir, yearly=True))


def _alert_messages(spark, sf_dir):
    return op.to_messages(_negative(spark, sf_dir))


def _deliveries(spark, root, messages, times):
    """Append ``messages`` to the topic, again and again; they are made once, and kept beside it."""
    messages.write.text(f"{root}/messages")
    for number in range(times):
        spark.read.text(f"{root}/messages").write.mode("append").text(f"{root}/topic")
        yield number


def _sink(spark, root, alerts):
    op.start_alert_sink(alerts, f"{root}/alerts", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(ALERT).parquet(f"{root}/alerts")


def _negative_stock_stream(spark, sf_dir):
    """Alerts from the inventory files of the lake."""
    root = scratch_folder(spark, "stock-stream")
    lake.write_slots_csv(fx.inventory(spark, sf_dir, yearly=True), f"{root}/inventory")
    return _sink(spark, root, op.negative_stock_stream(spark, f"{root}/inventory"))


def _unique_alerts(spark, sf_dir):
    """Every message is delivered in three runs of two queries; each alert is stored once."""
    root = scratch_folder(spark, "unique-alerts")
    for run in _deliveries(spark, root, _alert_messages(spark, sf_dir), 3):
        alerts = op.alert_stream(op.message_source(spark, f"{root}/topic"))
        op.start_unique_sink(alerts, f"{root}/alerts", f"{root}/checkpoint-{run % 2}").awaitTermination()
    return op.read_unique(spark, f"{root}/alerts").select(*ALERT.fieldNames())


def _alert_stream(spark, sf_dir):
    """Every message is delivered twice; the sink stores it once."""
    root = scratch_folder(spark, "alert-stream")
    for _ in _deliveries(spark, root, _alert_messages(spark, sf_dir), 2):
        pass
    messages = op.message_source(spark, f"{root}/topic")
    return _sink(spark, root, op.dedup_alerts(op.alert_stream(messages)))


def _stream_quarantine(spark, sf_dir):
    """Messages of stock below minus 20 lose their end on the way; all come twice."""
    root = scratch_folder(spark, "message-quarantine")
    messages = op.to_messages(_negative(spark, sf_dir)).withColumn(
        "stock", F.get_json_object("value", "$.final_stock").cast("long")
    )
    cut = F.when(
        F.col("stock") < -20, F.expr("substring(value, 1, length(value) - 1)")
    ).otherwise(F.col("value"))
    for _ in _deliveries(spark, root, messages.select(cut.alias("value")), 2):
        pass
    op.start_message_quarantine(
        op.message_source(spark, f"{root}/topic"),
        f"{root}/good", f"{root}/bad", f"{root}/checkpoint", delay=op.REPEAT_WINDOW,
    ).awaitTermination()
    good = spark.read.schema(ALERT).parquet(f"{root}/good")
    bad = spark.read.schema("value string").parquet(f"{root}/bad")
    return good.select(
        "inventory_date", "inventory_hour", "product_id", F.lit("").alias("value")
    ).unionByName(
        bad.select(
            F.lit("").alias("inventory_date"), F.lit("").alias("inventory_hour"),
            F.lit("").alias("product_id"), "value",
        )
    )


_JSON = """'{"inventory_date":"' || inventory_date || '","inventory_hour":"' || inventory_hour
  || '","product_id":"' || product_id || '","in_stock":' || in_stock
  || ',"new_product":' || new_product || ',"returned_product":' || returned_product
  || ',"units_sold":' || units_sold || ',"final_stock":' || final_stock || '}'"""

QUERIES = [
    Query(
        "alert_messages", _alert_messages,
        yearly(f"SELECT {_JSON} AS value FROM inventory WHERE final_stock < 0"),
    ),
    Query("negative_stock_stream", _negative_stock_stream, _ALERTS),
    Query("alert_stream", _alert_stream, _ALERTS),
    Query("unique_alerts", _unique_alerts, _ALERTS),
    Query(
        "stream_quarantine", _stream_quarantine,
        yearly(f"""
, messages AS (
  SELECT *, {_JSON} AS value FROM inventory WHERE final_stock < 0
)
SELECT inventory_date, inventory_hour, product_id, '' AS value
FROM messages WHERE final_stock >= -20
UNION ALL
SELECT '', '', '', substring(value, 1, length(value) - 1)
FROM messages WHERE final_stock < -20"""),
    ),
]
