"""Slot lists, windows and backlogs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwright import fixtures as fx
from tillwright.functions.times import date_text, utc_midnight
from tillwright.operators import slots as op
from tillwright.registry.entry import Query, daily

_ROW = ["date", "hour", "product_id", "units_sold"]

# Pacific time in January is eight hours behind UTC; all events are of January.
_EVENTS = """
WITH local AS (
  SELECT *, ts - INTERVAL 8 HOUR AS here FROM events
), placed AS (
  SELECT *, strftime(here, '%Y-%m-%d') AS date, strftime(here, '%H') AS hour FROM local
), clocks AS (
  SELECT user_id, max(here) - INTERVAL 1 HOUR AS full_hour FROM local GROUP BY user_id
), spine AS (
  SELECT user_id, strftime(full_hour - to_days(CAST(back AS INTEGER)), '%Y-%m-%d') AS date,
         printf('%02d', h) AS hour
  FROM clocks, range(0, 3) d(back), range(0, 24) t(h)
  WHERE NOT (back = 0 AND printf('%02d', h) > strftime(full_hour, '%H'))
)"""


def _slots_backfill(spark, sf_dir):
    lists = op.backfill_lists(fx.sales(spark, sf_dir))

    def values(kind):
        return F.transform(
            f"{kind}s", lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value"))
        )

    slots = lists.select(F.explode(F.concat(values("date"), values("hour"))).alias("slot"))
    return slots.select("slot.kind", "slot.value")


def _slots_latest(spark, sf_dir):
    return op.latest_lists(fx.sales(spark, sf_dir)).select(
        F.col("dates")[0].alias("date"), F.col("hours")[0].alias("hour")
    )


def _slice(backfill):
    def run(spark, sf_dir):
        sales = fx.sales(spark, sf_dir)
        return op.select_slice(sales, *op.resolve_slots(sales, backfill)).select(*_ROW)
    return run


def _dates(spark, sf_dir):
    return op.distinct_dates(fx.sales(spark, sf_dir))


def _first_dates(spark, sf_dir):
    return op.distinct_dates(fx.sales(spark, sf_dir), 10)


def _date_spine(spark, sf_dir):
    ranges = fx.table(spark, sf_dir, "events").groupBy("user_id").agg(
        date_text(F.min("ts")).alias("start"), date_text(F.max("ts")).alias("end")
    )
    return op.date_spine(ranges)


def _slot_spine(spark, sf_dir):
    return op.slot_spine(fx.user_clocks(spark, sf_dir))


def _missing_slots(spark, sf_dir):
    return op.missing_slots(
        op.slot_spine(fx.user_clocks(spark, sf_dir)), fx.event_slots(spark, sf_dir), ("user_id",)
    )


def _event_slots(spark, sf_dir):
    return fx.event_slots(spark, sf_dir).select(
        "event_id", "date", "hour",
        op.slot_folder().alias("folder"),
        F.unix_seconds(utc_midnight(F.col("date").cast("date"))).alias("midnight"),
    )


def _existing_slots(spark, sf_dir):
    return op.slot_columns(fx.event_slots(spark, sf_dir))


QUERIES = [
    Query(
        "slots_backfill", _slots_backfill,
        daily("""
SELECT DISTINCT 'date' AS kind, date AS value FROM sales
UNION ALL SELECT DISTINCT 'hour', hour FROM sales"""),
    ),
    Query(
        "slots_latest", _slots_latest,
        daily("""
SELECT max(date) AS date, max(hour) AS hour FROM sales
WHERE date = (SELECT max(date) FROM sales)"""),
    ),
    Query(
        "slice_latest", _slice(False),
        daily("""
SELECT date, hour, product_id, units_sold FROM sales
WHERE date IN (SELECT max(date) FROM sales)
AND hour IN (SELECT max(hour) FROM sales WHERE date = (SELECT max(date) FROM sales))"""),
    ),
    Query(
        "slice_backfill", _slice(True),
        daily("SELECT date, hour, product_id, units_sold FROM sales"),
    ),
    Query("distinct_dates", _dates, daily("SELECT DISTINCT date FROM sales")),
    Query(
        "first_dates", _first_dates,
        daily("SELECT DISTINCT date FROM sales ORDER BY date LIMIT 10"),
    ),
    Query(
        "date_spine", _date_spine,
        """
SELECT user_id, strftime(unnest(generate_series(date_trunc('day', min(ts)),
                         date_trunc('day', max(ts)), INTERVAL 1 DAY)), '%Y-%m-%d') AS date
FROM events GROUP BY user_id""",
    ),
    Query("slot_spine", _slot_spine, f"{_EVENTS}\nSELECT user_id, date, hour FROM spine"),
    Query(
        "missing_slots", _missing_slots,
        f"""{_EVENTS}
SELECT user_id, date, hour FROM spine s
WHERE NOT EXISTS (SELECT 1 FROM placed p WHERE p.user_id = s.user_id
                  AND p.date = s.date AND p.hour = s.hour)""",
    ),
    Query(
        "event_slots", _event_slots,
        f"""{_EVENTS}
SELECT event_id, date, hour, 'date=' || date || '/hour=' || hour AS folder,
       CAST(epoch(CAST(date AS TIMESTAMP)) AS BIGINT) AS midnight FROM placed""",
    ),
    Query("existing_slots", _existing_slots, f"{_EVENTS}\nSELECT DISTINCT date, hour FROM placed"),
]
