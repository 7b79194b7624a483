import datetime as dt

import pytest
from pyspark.sql import functions as F

import samples
from samples import slot
from tillwright.functions import texts
from tillwright.functions.slotted import in_lists, in_slots
from tillwright.operators import slots as op
from tillwright.session import scratch_folder, sized_for

D1, D2 = "2025-01-01", "2025-01-02"


def _clock(spark, moment):
    return spark.sql(f"SELECT TIMESTAMP_NTZ '{moment}' AS now_utc")


def _window(spark, moment):
    return {(r.date, r.hour) for r in op.slot_spine(_clock(spark, moment)).collect()}


def _ranges(spark, *pairs):
    return spark.createDataFrame(list(pairs), "start string, end string")


def test_lists_leave_nulls_out_and_are_sorted(spark):
    df = samples.sales(
        spark, slot(D2, "01"), slot(D1, "23"), slot(D1, "00"), slot(None, "07"), slot(D1, None)
    )
    assert op.resolve_slots(df, backfill=True) == ([D1, D2], ["00", "01", "07", "23"])
    assert op.resolve_slots(df, backfill=False) == ([D2], ["01"])


def test_the_latest_hour_is_that_of_the_latest_date(spark):
    df = samples.sales(spark, slot(D1, "23"), slot(D2, "03"), slot(D2, None))
    assert op.resolve_slots(df, backfill=False) == ([D2], ["03"])
    assert op.lists_of([(D1, "23"), (D2, "03")]) == ([D1, D2], ["03", "23"])
    assert op.lists_of([]) == ([], [])


def test_the_latest_slot_is_that_of_rows_and_not_of_listed_files(spark):
    df = samples.sales(spark, slot(D1, "01"), slot(D1, "03"), slot(None, "23"))
    listed = [(D1, "01"), (D1, "03"), (D1, "09"), (D2, "00")]
    assert op.latest_of(df, listed) == ([D1], ["03"])
    assert op.latest_of(df, [(D2, "00")]) == ([None], [None])
    assert op.latest_of(df, []) == ([None], [None])


def test_an_empty_source_matches_nothing(spark):
    df = samples.sales(spark, slot(D1, "00")).where("false")
    lists = op.resolve_slots(df, backfill=False)
    assert lists == ([None], [None])
    assert op.select_slice(samples.sales(spark, slot(D1, "00")), *lists).count() == 0


def test_a_slice_is_the_cross_product_of_both_lists(spark):
    df = samples.sales(spark, slot(D1, "00"), slot(D1, "05"), slot(D2, "00"), slot(D2, "07"))
    found = op.select_slice(df, [D1, D2], ["00", "07"]).collect()
    assert sorted((r.date, r.hour) for r in found) == [(D1, "00"), (D2, "00"), (D2, "07")]
    exact = df.where(in_slots([(D1, "05"), (D2, "00")])).collect()
    assert sorted((r.date, r.hour) for r in exact) == [(D1, "05"), (D2, "00")]


def test_predicates_take_dates_and_odd_text(spark):
    df = spark.sql("SELECT DATE '2025-01-01' AS date, 'o''clock\\\\' AS hour")
    assert df.where(in_lists([dt.date(2025, 1, 1)], ["o'clock\\"])).count() == 1
    assert df.where(in_slots([(D1, "o'clock\\")])).count() == 1


def test_date_spine_includes_both_ends_and_refuses_nonsense(spark):
    ranges = _ranges(
        spark, ("2024-02-28", "2024-03-01"), ("2025-01-02", "2025-01-01"),
        ("soon", "2025-01-01"), ("2025-1-5", "2025-01-05"), ("2025-02-30", "2025-03-01"),
    )
    assert sorted(r.date for r in op.date_spine(ranges).collect()) == [
        "2024-02-28", "2024-02-29", "2024-03-01", "2025-01-05",
    ]


def test_the_window_ends_at_the_last_full_hour(spark):
    # 09:30 UTC is 01:30 in Pacific winter, so 00 is the last complete hour.
    found = _window(spark, "2025-01-10 09:30:00")
    assert len(found) == 24 + 24 + 1
    assert max(found) == ("2025-01-10", "00") and min(found) == ("2025-01-08", "00")
    # 08:30 UTC is 00:30 there: the window still ends on the day before.
    found = _window(spark, "2025-01-10 08:30:00")
    assert max(found) == ("2025-01-09", "23") and len(found) == 72


@pytest.mark.parametrize("session_zone", ["UTC", "America/Los_Angeles", "Australia/Lord_Howe"])
def test_slots_do_not_depend_on_the_session_zone(spark, session_zone):
    """The skipped spring hour of the session zone must not move a slot."""
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        moments = spark.sql(
            "SELECT explode(array(TIMESTAMP_NTZ '2025-03-09 09:59:59', "
            "TIMESTAMP_NTZ '2025-03-09 10:00:00', TIMESTAMP_NTZ '2025-10-04 22:30:00')) AS ts"
        )
        found = op.local_slots(moments, "ts").orderBy("ts").collect()
        assert [(r.date, r.hour) for r in found] == [
            ("2025-03-09", "01"), ("2025-03-09", "03"), ("2025-10-04", "15"),
        ]
        # A daylight saving day has all 24 slots, the skipped hour included.
        spine = op.slot_spine(_clock(spark, "2025-03-11 12:00:00"))
        assert spine.where("date = '2025-03-09'").count() == 24
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_the_backlog_is_empty_once_filled(spark):
    spine = op.slot_spine(_clock(spark, "2025-01-10 09:30:00"))
    some = spine.where("hour < '12'")
    missing = op.missing_slots(spine, some.union(some))
    assert missing.count() == 24
    assert op.missing_slots(spine, some.union(missing)).count() == 0


def test_ids_grow_past_their_width(spark):
    row = spark.sql("SELECT 7L AS a, 12345L AS b").select(
        texts.product_code(F.col("a")).alias("short"), texts.product_code(F.col("b")).alias("long"),
        texts.category_code(F.col("a")).alias("category"),
        texts.tag_text(texts.tag_list(F.lit("x ,y,  z"))).alias("tags"),
    ).first()
    assert tuple(row) == ("PROD_0007", "PROD_12345", "CAT_007", "x, y, z")


class _Session:
    """Just enough of a session to name its shared folders."""

    def __init__(self, **conf):
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, *default: conf.get(
            key.split(".")[-2], *default))})


def test_scratch_follows_the_session():
    named = _Session(checkpoint="/shared/folder/", warehouse="/house")
    assert scratch_folder(named, "x").startswith("/shared/folder/x-")
    assert scratch_folder(named, "x") != scratch_folder(named, "x")
    assert scratch_folder(_Session(warehouse="/house/"), "x").startswith("/house/_scratch/x-")


def test_settings_follow_the_size_of_the_job():
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert sized_for(100 << 40)[key] == str(100 << 13)
    assert sized_for(0)[key] == "200"
