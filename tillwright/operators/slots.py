"""Slot lists, windows of slots, and the slots still missing.

The only thing the driver ever holds is a list of slots, 8,760 a year.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.functions import times
from tillwright.functions.slotted import in_dates, in_lists
from tillwright.functions.texts import padded

SlotLists = tuple[list[str], list[str]]


def slot_columns(df: DataFrame) -> DataFrame:
    """Distinct ``(date, hour)`` of ``df`` as text, without nulls."""
    return (
        df.select(F.col("date").cast("string").alias("date"), "hour")
        .where(F.col("date").isNotNull() & F.col("hour").isNotNull())
        .distinct()
    )


def distinct_dates(df: DataFrame, first: int | None = None) -> DataFrame:
    """Distinct dates; with ``first``, only that many of the earliest."""
    dates = df.select("date").distinct()
    return dates.orderBy("date").limit(first) if first else dates


def backfill_lists(df: DataFrame) -> DataFrame:
    """One row: all distinct dates and all distinct hours, each sorted, nulls left out.

    Duplicates go map-side before anything is gathered, so the two arrays are
    built from the few distinct slots and not from the rows.
    """
    slots = df.select(F.col("date").cast("string").alias("date"), "hour").distinct()
    return slots.agg(
        F.sort_array(F.collect_set("date")).alias("dates"),
        F.sort_array(F.collect_set("hour")).alias("hours"),
    )


def latest_lists(df: DataFrame) -> DataFrame:
    """One row: the latest date, and the latest hour within that date.

    A single pass instead of three scans. On an empty source both arrays hold
    one null, which matches nothing.
    """
    newest = df.where(F.col("date").isNotNull()).agg(
        # A null hour sorts first inside the struct, so max skips it.
        F.max(F.struct(F.col("date").cast("string").alias("date"), F.col("hour"))).alias("slot")
    )
    return newest.select(
        F.array("slot.date").alias("dates"), F.array("slot.hour").alias("hours")
    )


def resolve_slots(df: DataFrame, backfill: bool) -> SlotLists:
    """Dates and hours to process, on the driver: a calendar, as long as the data's years."""
    row = (backfill_lists(df) if backfill else latest_lists(df)).first()
    return list(row.dates), list(row.hours)


def lists_of(slots: list[tuple[str, str]]) -> SlotLists:
    """All dates and hours of a slot list that is already known, without any job."""
    return sorted({d for d, _ in slots}), sorted({h for _, h in slots})


def with_slot(df: DataFrame) -> DataFrame:
    """Rows that have a date and an hour: what a backfill of all slots covers."""
    return df.where(F.col("date").isNotNull() & F.col("hour").isNotNull())


def latest_of(df: DataFrame, slots: list[tuple[str, str]]) -> SlotLists:
    """The latest slot that has rows, among the listed ones.

    A listed slot may hold files without a row. So the newest date is looked at
    first, its rows alone are read, and only if it has none the date before.
    """
    for date in sorted({d for d, _ in slots}, reverse=True):
        dates, hours = resolve_slots(df.where(in_dates([date])), False)
        if dates != [None]:
            return dates, hours
    return [None], [None]


def select_slice(df: DataFrame, dates: list[str], hours: list[str]) -> DataFrame:
    """Rows of the listed dates and hours (their cross product)."""
    return df.where(in_lists(dates, hours))


def date_spine(ranges: DataFrame) -> DataFrame:
    """One row per date of each ``[start, end]`` text range, both ends included.

    Other columns are kept. Text that is no date and a start after the end give
    no rows; without the guard ``sequence`` would count down.
    """
    start, end = times.parse_date(F.col("start")), times.parse_date(F.col("end"))
    return (
        ranges.withColumn("_start", start)
        .withColumn("_end", end)
        .where(F.col("_start") <= F.col("_end"))
        .withColumn("_day", F.explode(F.sequence("_start", "_end")))
        .withColumn("date", F.col("_day").cast("string"))
        .drop("_start", "_end", "_day", "start", "end")
    )


def slot_spine(clock: DataFrame, days_back: int = 2, zone: str = times.SLOT_ZONE) -> DataFrame:
    """All slots of the rolling window that ends at each row's ``now_utc``.

    ``now_utc`` is a ``timestamp_ntz`` in UTC; other columns are kept, so one
    clock per store or user works. Only complete hours appear.
    """
    full = times.last_full_hour(F.col("now_utc"), zone)
    hours = F.array(*[F.lit(f"{h:02d}") for h in range(24)])
    spine = date_spine(
        clock.withColumn("_today", times.date_text(full))
        .withColumn("_hour", times.hour_text(full))
        .withColumn("start", times.date_text(F.date_sub(full.cast("date"), days_back)))
        .withColumn("end", F.col("_today"))
        .drop("now_utc")
    )
    return (
        spine.withColumn("hour", F.explode(hours))
        .where(~((F.col("date") == F.col("_today")) & (F.col("hour") > F.col("_hour"))))
        .drop("_today", "_hour")
    )


def missing_slots(spine: DataFrame, existing: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Slots of ``spine`` that have no data in ``existing``.

    ``existing`` may hold any number of rows per slot; it is reduced to distinct
    slots before the join, so a hot slot costs one row per map task.
    """
    keys = [*by, "date", "hour"]
    seen = existing.select(*by, F.col("date").cast("string").alias("date"), "hour").distinct()
    return spine.join(seen, keys, "left_anti")


def local_slots(df: DataFrame, moment: str, zone: str = times.SLOT_ZONE) -> DataFrame:
    """Add the wall-time slot of a UTC ``timestamp_ntz`` column."""
    local = times.local_time(F.col(moment), zone)
    return df.withColumn("date", times.date_text(local)).withColumn("hour", times.hour_text(local))


def slot_folder(date: str = "date", hour: str = "hour") -> Column:
    """``date=.../hour=..`` as a column."""
    return F.concat(F.lit("date="), F.col(date).cast("string"), F.lit("/hour="), F.col(hour))


def hour_code(number: Column) -> Column:
    """Two-digit hour text of a number."""
    return padded(number, 2)
