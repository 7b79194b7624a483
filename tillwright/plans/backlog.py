"""What the lake still lacks, and filling it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.functions.slotted import in_dates, in_slots
from tillwright.operators.inventory import reconcile_inventory
from tillwright.operators.slots import missing_slots, slot_spine, with_slot
from tillwright.schemas import DATASETS
from tillwright.sources import lake


def backlog(spark: SparkSession, clock: DataFrame, lake_root: str,
            days_back: int = 2) -> DataFrame:
    """Slots of the rolling window that are not finished, per dataset.

    ``clock`` has one row with ``now_utc``. Only the folders of the window are
    listed, and no file is read. A slot that a lost writer left half is missing.
    """
    window = slot_spine(clock, days_back)
    dates = [r.date for r in window.select("date").distinct().collect()]
    lacking = []
    for name in DATASETS:
        present = lake.finished_slots(spark, f"{lake_root.rstrip('/')}/{name}", dates)
        missing = missing_slots(window, lake.slots_frame(spark, present))
        lacking.append(missing.select(F.lit(name).alias("dataset"), "date", "hour"))
    return reduce(DataFrame.unionByName, lacking)


def fill_inventory(opening: DataFrame, sales: DataFrame, root: str,
                   dates: list[str] | None = None) -> None:
    """Reconcile and write all slots whose inventory is not finished yet, in one job.

    Both inputs are cut to those slots before the join. Running it again writes
    nothing. With ``dates`` only those are listed and filled.
    """
    lacking = ~in_slots(lake.finished_slots(opening.sparkSession, root, dates))
    if dates is not None:
        lacking = lacking & in_dates(dates)
    lake.write_missing_slots(
        reconcile_inventory(with_slot(opening).where(lacking), with_slot(sales).where(lacking)),
        root, dates,
    )
