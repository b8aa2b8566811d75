from __future__ import annotations

import datetime as dt

import pytest

from cohortwise.plans import views as V
from cohortwise.plans.queries import QUERIES
from cohortwise.streaming import confusion as ST

SCHEMA = "ts timestamp, y_true int, y_pred int"


def rows(day, n, hit=True):
    start = dt.datetime(2024, 1, day)
    return [(start + dt.timedelta(minutes=i), i % 2, i % 2 if hit else 1 - i % 2) for i in range(n)]


def write(spark, data, folder):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))


def drain(spark, source, out, state):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(source))
    ST.start_confusion(ST.epoch_confusion(stream), str(out), str(state)).awaitTermination()
    return ST.latest_counts(spark.read.parquet(str(out)))


def as_set(df):
    return {tuple(r) for r in df.select("epoch", "y_true", "y_pred", "n").collect()}


def test_drained_stream_equals_batch(spark, tmp_path):
    source, out, state = tmp_path / "in", tmp_path / "out", tmp_path / "state"
    for data in (rows(1, 10), rows(1, 7, hit=False), rows(2, 5)):
        write(spark, data, source)
    got = as_set(drain(spark, source, out, state))
    batch = as_set(ST.epoch_confusion(spark.read.schema(SCHEMA).parquet(str(source))))
    assert got == batch
    assert len([f for f in out.iterdir() if f.name.startswith("batch=")]) >= 3


def test_restart_goes_on_from_the_checkpoint(spark, tmp_path):
    source, out, state = tmp_path / "in", tmp_path / "out", tmp_path / "state"
    write(spark, rows(1, 10), source)
    drain(spark, source, out, state)
    write(spark, rows(1, 6), source)
    got = as_set(drain(spark, source, out, state))
    assert got == {("2024-01-01 00:00:00", 0, 0, 8), ("2024-01-01 00:00:00", 1, 1, 8)}


def test_rows_behind_the_watermark_are_not_counted(spark, tmp_path):
    source, out, state = tmp_path / "in", tmp_path / "out", tmp_path / "state"
    write(spark, rows(1, 4), source)
    drain(spark, source, out, state)
    write(spark, rows(9, 2), source)
    drain(spark, source, out, state)
    write(spark, rows(1, 50), source)
    got = as_set(drain(spark, source, out, state))
    assert {r for r in got if r[0].startswith("2024-01-01")} == {
        ("2024-01-01 00:00:00", 0, 0, 2), ("2024-01-01 00:00:00", 1, 1, 2)}


def test_accuracy_per_epoch(spark):
    df = spark.createDataFrame(rows(1, 6) + rows(1, 2, hit=False) + rows(3, 4), SCHEMA)
    got = {r.epoch: (r.n, r.accuracy) for r in ST.epoch_accuracy(ST.epoch_confusion(df)).collect()}
    assert got == {"2024-01-01 00:00:00": (8, pytest.approx(0.75)), "2024-01-03 00:00:00": (4, 1.0)}


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_epochs_do_not_depend_on_the_session_zone(spark, sf_dir, zone):
    expected = as_set(ST.epoch_confusion(V.pred_stream(V.table(spark, sf_dir, "events"))))
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert as_set(ST.epoch_confusion(V.pred_stream(V.table(spark, sf_dir, "events")))) == expected
        assert as_set(QUERIES["stream_confusion"](spark, sf_dir)) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_late_rows_are_counted_apart(spark, tmp_path):
    """Rows for a closed epoch, before and after a restart: counted and late rows
    together are those of the batch, epoch by epoch."""
    source = tmp_path / "in"

    def drained():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(source))
        parts = {"counts": ST.epoch_confusion(stream), "arrivals": ST.epoch_arrivals(stream)}
        for name, part in parts.items():
            ST.start_confusion(part, str(tmp_path / name), str(tmp_path / f"{name}-state")).awaitTermination()
        counts = ST.latest_counts(spark.read.parquet(str(tmp_path / "counts")))
        arrivals = ST.latest_arrivals(spark.read.parquet(str(tmp_path / "arrivals")))
        return {r.epoch[8:10]: (r.counted, r.late, r.arrived) for r in ST.running_state(counts, arrivals).collect()}

    for data in (rows(1, 10), rows(5, 8), rows(9, 2), rows(1, 3)):  # a watermark takes a batch to hold
        write(spark, data, source)
    assert drained() == {"01": (10, 3, 13), "05": (8, 0, 8), "09": (2, 0, 2)}
    for data in (rows(5, 4), rows(9, 6), rows(2, 1)):  # day 2 is closed before it has any row
        write(spark, data, source)
    assert drained() == {"01": (10, 3, 13), "02": (0, 1, 1), "05": (8, 4, 12), "09": (8, 0, 8)}
