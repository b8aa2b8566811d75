from __future__ import annotations

import datetime as dt
import random

import pytest

from cohortwise.operators import rows as R, runs as W
from cohortwise.plans.oracles import oracle_queries
from cohortwise.plans.queries import QUERIES
from compare import connect, difference, spark_table, sql_table


def stop_rule(values, patience, sign=1):
    """Step by step: a value that is not better than the best one counts as waiting."""
    best, waited = None, 0
    for epoch, value in values:
        score = sign * value
        if best is None or score > best:
            best, waited = score, 0
        else:
            waited += 1
            if waited >= patience:
                return epoch
    return None


@pytest.fixture(scope="module")
def log():
    rng = random.Random(3)
    rows = []
    for run in range(12):
        epoch = 0
        for _ in range(rng.choice([1, 5, 60, 400])):
            epoch += rng.choice([1, 1, 1, 2])
            rows.append((run, epoch, rng.choice([rng.random(), 0.5, epoch / 300])))
    return rows


@pytest.mark.parametrize("chunk_size", [7, 4096])
@pytest.mark.parametrize("score_name,patience", [("accuracy", 3), ("accuracy", 12), ("loss", 5)])
def test_early_stop_step_by_step(spark, log, chunk_size, score_name, patience):
    df = spark.createDataFrame(log, "run int, epoch int, value double").repartition(6)
    got = {r.run: (r.epochs, r.stop_epoch) for r in W.early_stop(df, ["run"], "value", score_name, patience, chunk_size).collect()}
    sign = -1 if score_name == "loss" else 1
    for run in {r[0] for r in log}:
        values = sorted((e, v) for r, e, v in log if r == run)
        assert got[run] == (len(values), stop_rule(values, patience, sign)), run


def test_early_stop_keeps_rows_without_a_run(spark):
    df = spark.createDataFrame([(None, e, 1.0) for e in range(5)], "run int, epoch int, value double")
    assert [tuple(r) for r in W.early_stop(df, ["run"], "value", "accuracy", 2).collect()] == [(None, 5, 2)]


def test_best_epochs_sign_and_ties(spark):
    df = spark.createDataFrame([(1, 1, 0.3), (1, 2, 0.1), (1, 3, 0.1), (2, 1, 0.9)], "run int, epoch int, value double")
    loss = {(r.run, r.epoch, r.place) for r in W.best_epochs(df, ["run"], "value", "loss", 2).collect()}
    assert loss == {(1, 2, 1), (1, 3, 2), (2, 1, 1)}
    score = {(r.run, r.epoch) for r in W.best_epochs(df, ["run"], "value", "accuracy").collect()}
    assert score == {(1, 1), (2, 1)}


def test_last_metrics(spark):
    df = spark.createDataFrame([(1, 1, 0.3), (1, 7, 0.1), (1, 3, 0.5)], "run int, epoch int, value double")
    assert tuple(W.last_metrics(df, ["run"]).first()) == (1, 7, 0.1)


def test_numeric_metrics(spark):
    rows = [("val", "accuracy", "0.5"), ("val", "y_true", "[1, 2]"), ("test", "loss", None)]
    df = spark.createDataFrame(rows, "split string, metric string, value string")
    assert [tuple(r) for r in W.numeric_metrics(df).collect()] == [("val", "val_accuracy", 0.5)]


def test_log_interval():
    assert [R.log_interval(n) for n in (1, 10, 19, 55)] == [1, 1, 1, 5]


def test_nan_is_no_score(spark):
    rows = [(1, e, v) for e, v in enumerate([float("nan"), 0.9, float("nan"), 0.5, 0.7, None, 0.8])]
    df = spark.createDataFrame(rows, "run int, epoch int, value double")
    best = W.best_epochs(df, ["run"], "value", "loss", 2).collect()
    assert sorted((r.place, r.epoch) for r in best) == [(1, 3), (2, 4)]
    assert W.early_stop(df, ["run"], "value", "loss", 3).first().stop_epoch == 6
    assert W.early_stop(df.where("epoch < 6"), ["run"], "value", "loss", 3).first().stop_epoch is None
    diverged = spark.createDataFrame([(1, e, float("nan")) for e in range(5)], "run int, epoch int, value double")
    assert W.early_stop(diverged, ["run"], "value", "accuracy", 3).first().stop_epoch == 2


def event_tables(spark, path, events):
    """A folder with an events table; rows are (user, metric, value), one a minute."""
    start = dt.datetime(2024, 1, 1)
    rows = [(i, start + dt.timedelta(minutes=i), *event) for i, event in enumerate(events)]
    schema = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double"
    spark.createDataFrame(rows, schema).toPandas().to_parquet(path / "events.parquet", coerce_timestamps="us")
    return str(path)


def test_best_epochs_of_every_metric(spark, tmp_path):
    """No metric of the log is left out, and none is compared with another."""
    events = [(1, "view", 9.0), (1, "error", 0.5), (1, "view", 8.0), (1, "error", 0.1), (1, "view", 7.0), (2, "click", 3.0)]
    events += [(2, None, 4.0), (None, "error", 2.0)]
    d = event_tables(spark, tmp_path, events)
    best = QUERIES["best_epochs"](spark, d)
    assert {(r.run_id, r.metric, r.epoch, r.place) for r in best.collect()} == {
        (1, "view", 5, 1), (1, "view", 3, 2), (1, "error", 4, 1), (1, "error", 2, 2),
        (2, "click", 1, 1), (2, None, 2, 1), (None, "error", 1, 1),
    }
    with connect(d) as con:
        assert difference(spark_table(best), sql_table(con, oracle_queries()["best_epochs"])) is None


def test_early_stop_by_every_metric(spark, tmp_path):
    """All rows of the log count; patience is counted in evaluations of the metric."""
    events = [(1, "view", 9.0), (1, "error", 5.0)]
    events += [(1, metric, value) for _ in range(10) for metric, value in (("view", 1.0), ("error", 4.0), ("click", 0.0))]
    events += [(1, "error", 6.0), (2, None, 1.0), (None, "view", 2.0), (None, "view", 2.0)]
    d = event_tables(spark, tmp_path, events)
    stops = QUERIES["early_stop"](spark, d)
    assert {tuple(r) for r in stops.select("run_id", "metric", "epochs", "stop_epoch").collect()} == {
        (1, "view", 11, 30), (1, "error", 12, 31), (1, "click", 10, None), (2, None, 1, None), (None, "view", 2, None),
    }
    with connect(d) as con:
        assert difference(spark_table(stops), sql_table(con, oracle_queries()["early_stop"])) is None
