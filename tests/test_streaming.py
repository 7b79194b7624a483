import samples
from samples import slot
from tillwright.operators.inventory import negative_stock
from tillwright.schemas import ALERT
from tillwright.sources import lake
from tillwright.streaming import alerts as op

D1, D2 = "2025-01-01", "2025-01-02"


def _stock(spark, *rows):
    return samples.inventory(spark, *rows)


def _run(spark, alerts, folder):
    op.start_alert_sink(alerts, f"{folder}/alerts", f"{folder}/checkpoint").awaitTermination()
    return spark.read.schema(ALERT).parquet(f"{folder}/alerts")


def test_messages_keep_nulls_and_numbers(spark):
    (row,) = op.to_messages(_stock(spark, slot(D1, "07", in_stock=None, final_stock=-3))).collect()
    assert row.value == (
        '{"inventory_date":"2025-01-01","inventory_hour":"07","product_id":"PROD_0001",'
        '"in_stock":null,"new_product":0,"returned_product":0,"units_sold":0,"final_stock":-3}'
    )


def test_stream_equals_batch_and_goes_on_from_its_checkpoint(spark, tmp_path, rows_of):
    root = str(tmp_path / "inventory")
    first = _stock(spark, slot(D1, "00", "A", final_stock=-1), slot(D1, "00", "B", final_stock=1))
    lake.write_slots_csv(first, root)

    def run():
        return _run(spark, op.negative_stock_stream(spark, root, per_batch=1), tmp_path)

    batch = negative_stock(first).select(*ALERT.fieldNames())
    assert rows_of(run()) == rows_of(batch)
    assert rows_of(run()) == rows_of(batch)
    second = _stock(spark, slot(D2, "00", "C", final_stock=-5))
    lake.write_slots_csv(second, root)
    assert rows_of(run()) == rows_of(
        negative_stock(first.union(second)).select(*ALERT.fieldNames())
    )


def test_a_bad_row_need_not_end_the_stream(spark, tmp_path):
    folder = tmp_path / "inventory" / "date=2025-01-01" / "hour=00"
    folder.mkdir(parents=True)
    (folder / "one.csv").write_text(
        ",".join(ALERT.fieldNames()) + "\n2025-01-01,00,A,0,0,0,0,-1\n2025-01-01,00,B,0,0,0,0,x\n"
    )
    stream = op.negative_stock_stream(spark, str(tmp_path / "inventory"), strict=False)
    assert [r.product_id for r in _run(spark, stream, tmp_path).collect()] == ["A"]


def test_repeats_are_dropped_within_and_across_batches(spark, tmp_path):
    """One alert makes up most messages; old slots arriving late are kept."""
    topic = str(tmp_path / "topic")
    hot = [slot(D2, "05", "HOT", final_stock=-9)] * 300
    others = [slot(D2, "06", f"P{i}", final_stock=-1) for i in range(40)]
    old = [slot("2019-01-01", "00", "OLD", final_stock=-2)]

    def run():
        stream = op.alert_stream(op.message_source(spark, topic, per_batch=1))
        return _run(spark, op.dedup_alerts(stream), tmp_path)

    op.to_messages(_stock(spark, *hot, *others)).write.mode("append").text(topic)
    assert run().count() == 41
    op.to_messages(_stock(spark, *hot, *others, *old)).write.mode("append").text(topic)
    found = run()
    assert found.count() == 42
    assert found.where("product_id in ('HOT', 'OLD')").count() == 2


def test_a_repeat_is_dropped_however_late_and_by_any_query(spark, tmp_path):
    topic, path = str(tmp_path / "topic"), str(tmp_path / "unique")
    stored = lambda: sorted((str(r.inventory_date), str(r.product_id)) for r in op.read_unique(spark, path).collect())

    def run(query):
        alerts = op.alert_stream(op.message_source(spark, topic))
        op.start_unique_sink(alerts, path, str(tmp_path / query)).awaitTermination()

    assert op.read_unique(spark, path).count() == 0
    hot = [slot(D2, "05", "HOT", final_stock=-9)] * 300
    op.to_messages(_stock(spark, *hot, slot("2019-01-01", "00", "OLD", final_stock=-2))).write.text(topic)
    run("first")
    assert stored() == [("2019-01-01", "OLD"), (D2, "HOT")]
    # The same alerts in a later batch, with a new one of an old date.
    op.to_messages(_stock(spark, *hot, slot("2019-01-01", "00", "NEW", final_stock=-1))).write.mode(
        "append").text(topic)
    run("first")
    want = [("2019-01-01", "NEW"), ("2019-01-01", "OLD"), (D2, "HOT")]
    assert stored() == want
    # A query begun anew reads all messages once more.
    run("second")
    assert stored() == want
    # A batch run again meets what other batches stored, and not its own rows.
    (tmp_path / "first" / "commits" / "1").unlink()
    (tmp_path / "first" / "commits" / ".1.crc").unlink(missing_ok=True)
    run("first")
    assert stored() == want


def test_dedup_in_one_step(spark, tmp_path):
    topic = str(tmp_path / "topic")
    op.to_messages(_stock(spark, *[slot(D1, "00", final_stock=-1)] * 5)).write.text(topic)
    stream = op.alert_stream(op.message_source(spark, topic))
    assert _run(spark, op.dedup_alerts(stream, spread=1), tmp_path).count() == 1


BAD = [
    "not json", '{"inventory_date": "2025-01-01"', "", "[]", "null", '"text"',
    '{"inventory_date":"2025-01-01","inventory_hour":"00"}',
    '{"inventory_date":"2025-01-01","inventory_hour":"00","product_id":"A","final_stock":"x"}',
]
GOOD = '{"inventory_date":"2025-01-01","inventory_hour":"00","product_id":"A","final_stock":-1}'


def test_undecodable_messages_are_set_apart(spark):
    good, bad = op.split_bad_messages(
        spark.createDataFrame([(v,) for v in [*BAD, None, GOOD]], "value string")
    )
    assert [r.product_id for r in good.collect()] == ["A"]
    assert sorted(r.value or "" for r in bad.collect()) == sorted([*BAD, ""])


def test_a_stream_stores_good_and_bad_messages(spark, tmp_path):
    topic = tmp_path / "topic"
    topic.mkdir()
    (topic / "one.txt").write_text("\n".join([GOOD, "not json"]) + "\n")

    def run():
        op.start_message_quarantine(
            op.message_source(spark, str(topic)), f"{tmp_path}/good", f"{tmp_path}/bad",
            f"{tmp_path}/checkpoint",
        ).awaitTermination()
        good = spark.read.schema(ALERT).parquet(f"{tmp_path}/good").count()
        bad = spark.read.schema("value string").parquet(f"{tmp_path}/bad").count()
        return good, bad

    assert run() == (1, 1)
    assert run() == (1, 1)
    (topic / "two.txt").write_text(GOOD + "\n")
    assert run() == (2, 1)
    names = [p.name for p in (tmp_path / "good").iterdir()]
    assert len(names) == 1 and len(names[0]) > len("query=") + 30


def test_repeats_and_bad_messages_in_one_stream(spark, tmp_path):
    topic = tmp_path / "topic"
    topic.mkdir()
    for number in range(2):
        (topic / f"{number}.txt").write_text("\n".join([GOOD, "not json", GOOD, "[]"]) + "\n")
    op.start_message_quarantine(
        op.message_source(spark, str(topic), per_batch=1), f"{tmp_path}/good", f"{tmp_path}/bad",
        f"{tmp_path}/checkpoint", delay=op.REPEAT_WINDOW,
    ).awaitTermination()
    assert spark.read.schema(ALERT).parquet(f"{tmp_path}/good").count() == 1
    bad = spark.read.schema("value string").parquet(f"{tmp_path}/bad").collect()
    assert sorted(r.value for r in bad) == ["[]", "not json"]


def test_bad_stock_rows_are_kept_beside_the_alerts(spark, tmp_path):
    folder = tmp_path / "inventory" / "date=2025-01-01" / "hour=00"
    folder.mkdir(parents=True)
    (folder / "one.csv").write_text(
        ",".join(ALERT.fieldNames()) + "\n2025-01-01,00,A,0,0,0,0,-1\n2025-01-01,00,B,0,0,0,0,x\n"
        "2025-01-01,00,C,0,0,0,0,1\n"
    )
    op.start_stock_quarantine(
        spark, str(tmp_path / "inventory"), f"{tmp_path}/good", f"{tmp_path}/bad",
        f"{tmp_path}/checkpoint",
    ).awaitTermination()
    assert [r.product_id for r in spark.read.schema(ALERT).parquet(f"{tmp_path}/good").collect()] == ["A"]
    (bad,) = spark.read.schema("product_id string, bad_columns string").parquet(
        f"{tmp_path}/bad").collect()
    assert (bad.product_id, bad.bad_columns) == ("B", "final_stock")


def test_messages_are_made_once_however_often_they_are_delivered(spark, tmp_path):
    from pyspark.sql import functions as F

    from tillwright.registry.alerts import _deliveries

    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def message(number):
        made.add(1)
        return f"message {number}"

    messages = spark.range(5).select(message("id").alias("value"))
    assert list(_deliveries(spark, str(tmp_path), messages, 3)) == [0, 1, 2]
    assert made.value == 5
    topic = spark.read.text(str(tmp_path / "topic")).collect()
    assert sorted(r.value for r in topic) == sorted([f"message {n}" for n in range(5)] * 3)
