from __future__ import annotations

import logging
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortwise.operators import evaluation as E
from cohortwise.sources import sinks as SI


def predictions(spark, pairs, schema="y_true int, y_pred int"):
    return spark.createDataFrame(pairs, schema)


def brute_auc(rows):
    wins = [(1.0 if p > n else 0.5 if p == n else 0.0) for t, p in rows if t == 1 for u, n in rows if u != 1]
    return sum(wins) / len(wins)


def test_report_by_hand(spark):
    df = predictions(spark, [(0, 0), (0, 0), (0, 1), (1, 1), (2, 0)])
    got = {r.label: tuple(r)[1:] for r in E.classification_report(df).collect()}
    assert got["0"] == (pytest.approx(2 / 3), pytest.approx(2 / 3), pytest.approx(2 / 3), 3)
    assert got["1"] == (0.5, 1.0, pytest.approx(2 / 3), 1)
    assert got["2"] == (0.0, 0.0, 0.0, 1)
    assert got["accuracy"] == (pytest.approx(0.6),) * 3 + (5,)
    assert got["macro avg"][0] == pytest.approx((2 / 3 + 0.5) / 3)
    assert got["weighted avg"][1] == pytest.approx(0.6)


def test_report_with_fixed_labels(spark):
    df = predictions(spark, [(0, 0), (1, 1)])
    labels = spark.createDataFrame([(0, "no"), (1, "yes"), (2, "maybe")], "label int, name string")
    got = {r.label: tuple(r)[1:] for r in E.classification_report(df, labels, "name").collect()}
    assert got["maybe"] == (0.0, 0.0, 0.0, 0)
    assert got["macro avg"][2] == pytest.approx(2 / 3)


def test_labels_only_predicted_are_counted(spark):
    df = predictions(spark, [(0, 7), (0, 0)])
    cells = {(r.y_true, r.y_pred): r.n for r in E.confusion_matrix(df).collect()}
    assert cells == {(0, 0): 1, (0, 7): 1, (7, 0): 0, (7, 7): 0}
    assert {r.label for r in E.classification_report(df).collect()} >= {"0", "7"}


def test_confusion_with_label_axis_and_wide_form(spark):
    df = predictions(spark, [(0, 1), (1, 1)])
    axis = spark.createDataFrame([(0,), (1,), (2,)], "label int")
    matrix = E.confusion_matrix(df, axis)
    assert matrix.count() == 9
    wide = {r.y_true: (r["0"], r["1"], r["2"]) for r in E.confusion_wide(matrix, [0, 1, 2]).collect()}
    assert wide == {0: (0, 1, 0), 1: (0, 1, 0), 2: (0, 0, 0)}


@pytest.mark.parametrize("spread", [2, 9, 10_000])
def test_auc_over_ranges(spark, spread):
    rng = random.Random(spread)
    rows = [(int(rng.random() < 0.3), rng.randrange(spread) / 7) for _ in range(400)]
    df = spark.createDataFrame(rows, "y_true int, score double").repartition(5)
    got = E.roc_auc(df, "score").first().roc_auc
    assert got == pytest.approx(brute_auc(rows))


def test_auc_with_missing_scores(spark):
    rows = [(i % 2, float(i * 7 % 50)) for i in range(100)] + [(1, None)] * 5 + [(0, float("nan"))] * 3
    df = spark.createDataFrame(rows, "y_true int, score double").repartition(3)
    placed = [(t, -1.0 if s is None else math.inf if math.isnan(s) else s) for t, s in rows]
    assert E.roc_auc(df, "score").first().roc_auc == pytest.approx(brute_auc(placed))


def test_auc_with_a_hot_score(spark):
    rows = [(i % 2, 0.5) for i in range(300)] + [(i % 3 == 0, i / 600) for i in range(600)]
    rows = [(int(t), s) for t, s in rows]
    df = spark.createDataFrame(rows, "y_true int, score double")
    assert E.roc_auc(df, "score").first().roc_auc == pytest.approx(brute_auc(rows))


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.4)], "y_true int, score double")
    assert E.roc_auc(df, "score").first().roc_auc is None


def test_auc_on_hard_predictions_by_default(spark):
    rows = [(0, 0), (0, 1), (1, 1), (1, 0), (1, 1)]
    assert E.roc_auc(predictions(spark, rows)).first().roc_auc == pytest.approx(brute_auc(rows))


def test_summary_row(spark):
    rows = [(0, 0, [2.0, 0.0]), (1, 0, [1.0, 0.0]), (1, 1, [0.0, 3.0])]
    df = spark.createDataFrame(rows, "y_true int, y_pred int, logits array<double>")
    got = E.run_summary(df, "net", "logits").first()
    loss = sum(math.log(math.exp(l[0]) + math.exp(l[1])) - l[t] for t, _, l in rows) / 3
    assert got.model_name == "net"
    assert got.accuracy == pytest.approx(2 / 3)
    assert got.loss == pytest.approx(loss)
    assert got.roc_auc == pytest.approx(brute_auc([(t, p) for t, p, _ in rows]))
    without = E.run_summary(df.drop("logits"), "net").first()
    assert without.loss is None and without.f1 == pytest.approx(got.f1)


def test_epoch_metrics_equal_one_summary_per_group(spark):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), rng.randrange(3), rng.randrange(2), rng.randrange(2)) for _ in range(300)]
    rows += [("b", 9, 1, 1)]
    df = spark.createDataFrame(rows, "split string, epoch int, y_true int, y_pred int")
    got = {(r.split, r.epoch, r.metric): r.value for r in E.epoch_metrics(df, ["split", "epoch"]).collect()}
    assert not any(m == "loss" for _, _, m in got)
    assert ("b", 9, "roc_auc") not in got and got["b", 9, "accuracy"] == 1.0
    for split, epoch in (("a", 0), ("b", 2)):
        one = E.run_summary(df.where((F.col("split") == split) & (F.col("epoch") == epoch)), "m").first()
        for m in ("roc_auc", "accuracy", "precision", "recall", "f1"):
            assert got[split, epoch, m] == pytest.approx(one[m])


def test_matrix_of_too_many_labels(spark, monkeypatch):
    df = predictions(spark, [(0, 1), (2, 3)])
    monkeypatch.setattr(E, "MAX_AXIS", 3)
    with pytest.raises(Exception, match="confusion_counts"):
        E.confusion_matrix(df).collect()
    assert E.confusion_counts(df).count() == 2


def test_metrics_by_name_skips_unknown(spark, caplog):
    df = predictions(spark, [(1, 1), (1, 0), (0, 0)])
    with caplog.at_level(logging.WARNING):
        got = E.metrics_by_name(df, ["Accuracy", "Nothing", "recall"]).first()
    assert got.accuracy == pytest.approx(2 / 3) and got.recall == 0.5
    assert "Nothing" in caplog.text
    with pytest.raises(ValueError):
        E.metrics_by_name(df, ["Nothing"])
    extra = {"Bias": lambda t, p: F.avg(p - t)}
    assert E.metrics_by_name(df, ["bias"], extra=extra).first().bias == pytest.approx(-1 / 3)


def test_custom_metric_sees_each_pair_once(spark):
    rows = [("a", 1, 1)] * 500 + [("a", 1, 0)] * 500 + [("b", 0, 0)]
    df = spark.createDataFrame(rows, "split string, y_true int, y_pred int")

    def size(y_true, y_pred, weight):
        return len(weight) * 10_000 + weight.sum()

    got = {r.split: r.value for r in E.custom_metric(df, size, ["split"]).collect()}
    assert got == {"a": 21_000.0, "b": 10_001.0}


def test_custom_metric_refuses_values_that_are_no_classes(spark, monkeypatch):
    df = predictions(spark, [(i, i) for i in range(20)]).withColumn("split", F.lit("a"))
    monkeypatch.setattr(E, "MAX_PAIRS", 19)
    with pytest.raises(Exception, match="label pairs"):
        E.custom_metric(df, lambda t, p, w: 0.0, ["split"]).collect()


def test_decided_class_ties(spark):
    df = spark.createDataFrame([([0.1, 0.7, 0.7],), ([5.0],)], "s array<double>")
    assert [r.y_pred for r in E.with_prediction(df, "s").collect()] == [1, 0]


def test_null_labels_stay_in_the_matrix(spark):
    df = predictions(spark, [(0, 0), (0, None), (None, 1), (1, 1), (1, 1)])
    got = {(r.y_true, r.y_pred): r.n for r in E.confusion_matrix(df).collect()}
    assert len(got) == 9 and sum(got.values()) == 5
    assert got[0, None] == got[None, 1] == 1 and got[None, None] == 0


def test_labels_outside_a_fixed_set_are_an_error(spark):
    df = predictions(spark, [(0, 0), (1, 2), (1, 1)])
    axis = spark.createDataFrame([(0, "no"), (1, "yes")], "label int, name string")
    with pytest.raises(ValueError, match="outside"):
        E.classification_report(df, axis, "name")


def test_report_names_by_group(spark):
    df = predictions(spark, [(0, 0), (1, 1)]).withColumn("split", F.lit("a"))
    df = df.unionByName(predictions(spark, [(0, 1)]).withColumn("split", F.lit("b")))
    axis = spark.createDataFrame([(0, "no"), (1, "yes"), (2, "maybe")], "label int, name string")
    rows = E.report_from_counts(E.fitted_counts(df, ["split"]), axis, "name", ["split"]).collect()
    got = {(r.split, r.label): r.support for r in rows}
    assert got["a", "no"] == got["a", "yes"] == got["b", "no"] == 1 and got["a", "maybe"] == got["b", "maybe"] == 0
    assert len(got) == 12


def test_rows_without_a_loss_count_alike(spark):
    df = spark.createDataFrame([(0, 0, [2.0, 1.0]), (1, 0, [0.0, 1.0]), (5, 1, [1.0, 1.0])], "y_true int, y_pred int, s array<double>")
    assert E.run_summary(df, "m", "s").first().loss == pytest.approx(E.mean_loss(df, "s").first().loss)


def gaps(spark):
    """Six rows, two without a prediction and one pair of nulls."""
    rows = [(0, 0), (1, 1), (1, None), (0, None), (None, None), (2, 1)]
    return spark.createDataFrame(rows, "y_true int, y_pred int")


def test_null_rules_agree(spark):
    """A null is a label like others, by every path to the accuracy."""
    df = gaps(spark)
    want = pytest.approx(3 / 6)
    assert E.accuracy(df).first().accuracy == want
    assert E.metrics_by_name(df, ["accuracy"]).first().accuracy == want
    assert E.class_metrics_by_name(df, ["accuracy"]).first().accuracy == want
    assert E.run_summary(df, "m").first().accuracy == want
    assert {r.label: r.precision for r in E.classification_report(df).collect()}["accuracy"] == want


def test_top_k_counts_truths_without_a_score_as_misses(spark):
    rows = [(0, [0.9, 0.1, 0.0]), (7, [0.9, 0.1, 0.0]), (-2, [0.9, 0.1, 0.0]), (None, [0.5, 0.2, 0.3]),
            (1, None), (1, [0.1, float("nan"), 0.0])]
    df = spark.createDataFrame(rows, "y_true int, scores array<double>").withColumn("y_pred", F.lit(0))
    assert E.class_metrics_by_name(df, ["topk"], scores="scores", k=1).first().topk == pytest.approx(1 / 6)


def test_report_shows_a_null_label_and_names(spark):
    config = spark.createDataFrame([("k", "v")], "key string, value string")
    lines = SI.run_report(gaps(spark), "m", None, config).where("section = 2").orderBy("line_no").collect()
    assert [r.line for r in lines][1:4] == ["|  | null | 0 | 1 | 2 |", "| --- | --- | --- | --- | --- |", "| null | 1 | 0 | 0 | 0 |"]
    labels = spark.createDataFrame([(None, "none"), (0, "zero"), (1, "one"), (2, "two")], "label int, called string")
    named = SI.run_report(gaps(spark), "m", None, config, labels=labels, names="called")
    assert [r.line for r in named.where("section = 2").orderBy("line_no").collect()][1] == "|  | none | zero | one | two |"
    with pytest.raises(ValueError, match="outside the label set"):
        E.confusion_matrix(gaps(spark), labels.where("label = 0"))


def plain_auc(rows):
    p, n = [s for t, s in rows if t == 1], [s for t, s in rows if t == 0]
    return sum((a > b) + (a == b) / 2 for a in p for b in n) / (len(p) * len(n)) if p and n else None


def test_auc_by_group_equals_all_pairs(spark):
    """One group has most of the rows, one a single class; null groups are groups."""
    rnd = random.Random(2)
    rows = [("big" if rnd.random() < 0.9 else rnd.choice(["a", None]), rnd.randint(0, 1), rnd.randint(0, 60) / 7) for _ in range(900)]
    rows += [("one", 1, 0.5), ("one", 1, 0.7)]
    df = spark.createDataFrame(rows, "g string, y_true int, score double").withColumn("y_pred", F.lit(0))
    got = {r.g: r.roc_auc for r in E.roc_auc(df, "score", by=["g"]).collect()}
    want = {g: plain_auc([(t, s) for h, t, s in rows if h == g]) for g in {r[0] for r in rows}}
    assert got.keys() == want.keys() and got["one"] is None
    assert all(got[g] == pytest.approx(want[g]) for g in want if want[g] is not None)


def mean_difference():
    """Made here, so that tasks get the functions themselves."""

    def update(state, y_true, y_pred):
        known = y_true.notna() & y_pred.notna()
        return state + [known.sum(), (y_true - y_pred)[known].abs().sum()]

    return E.MergeableMetric(lambda: np.zeros(2), update, np.add, lambda s: s[1] / s[0] if s[0] else np.nan)


@pytest.mark.parametrize("groups", [1, 10_000])
def test_merged_metric_over_many_values(spark, monkeypatch, groups):
    """A metric over numbers, not classes: a group with most of the rows, far more pairs
    than a task would be given, tasks that hand on their states early, null groups."""
    monkeypatch.setattr(E, "STATE_GROUPS", groups)
    rows = spark.range(0, 30_000, 1, 7).selectExpr(
        "CASE WHEN id % 10 = 3 THEN 'few' WHEN id % 100 = 7 THEN NULL ELSE 'big' END AS g",
        "double(id) AS y_true", "id + id % 5 AS y_pred")
    got = {r.g: r.value for r in E.custom_metric_merged(rows, mean_difference(), ["g"]).collect()}
    want = {r.g: r.v for r in rows.groupBy("g").agg(F.avg(F.abs(F.col("y_true") - F.col("y_pred"))).alias("v")).collect()}
    assert got == pytest.approx(want)


def test_merged_metric_spreads_a_hot_group(spark):
    """Each task hands on one state for each group; the merging steps see no rows."""
    rows = spark.range(0, 20_000, 1, 8).selectExpr("IF(id % 10 = 0, 'b', 'a') AS g", "1 AS y_true", "1 AS y_pred")
    merged = E.custom_metric_merged(rows, mean_difference(), ["g"])
    assert {r.g: r.value for r in merged.collect()} == {"a": 0.0, "b": 0.0}
    plan = merged._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.index("MapInPandas") > plan.rindex("Exchange")  # the states are made before any shuffle


def test_merged_metric_of_the_whole_table(spark):
    rows = spark.range(100).selectExpr("id AS y_true", "id + 2 AS y_pred")
    assert E.custom_metric_merged(rows, mean_difference(), []).first().value == 2.0
    assert E.custom_metric_merged(rows.limit(0), mean_difference(), ["y_true"]).count() == 0
