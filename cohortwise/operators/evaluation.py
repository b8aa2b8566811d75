"""Evaluation of prediction tables ``(key, y_true, y_pred[, score])``.

The data is read once, into counts per (y_true, y_pred). Report, accuracy and
custom metrics follow from those at most classes x classes rows.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortwise.functions.names import base_name
from cohortwise.functions.scores import argmax, cross_entropy
from cohortwise.operators.ranks import CHUNK, GROUP, group_of, range_chunk
from cohortwise.session import fitted, materialize

logger = logging.getLogger(__name__)

# Default for the most label pairs of a group that a Python metric is given.
MAX_PAIRS = 1_000_000

# Default for the most labels of a zero-filled confusion matrix.
MAX_AXIS = 2000

# Groups that a task keeps states of at a time, and shares a group's states are merged in.
STATE_GROUPS = 10_000
STATE_SHARES = 32

MEASURES = ["roc_auc", "accuracy", "loss", "precision", "recall", "f1"]


def with_prediction(df: DataFrame, scores: str, name: str = "y_pred") -> DataFrame:
    """Predicted class: position of the largest score."""
    return df.withColumn(name, argmax(F.col(scores)))


def prediction_table(df: DataFrame, path: str, y_true: str, scores: str) -> DataFrame:
    """Truth and predicted class by file name. The name travels with its row, so
    no shuffling of the data can misalign them."""
    return df.select(
        base_name(F.col(path)).alias("key"), F.col(y_true).cast("int").alias("y_true"), argmax(F.col(scores)).alias("y_pred")
    )


def confusion_counts(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows per (y_true, y_pred) that occur."""
    return df.groupBy(*by, "y_true", "y_pred").agg(F.count(F.lit(1)).alias("n"))


def fitted_counts(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Confusion counts evaluated once, so that all that follows from them does
    not read the data again."""
    return fitted(confusion_counts(df, by))


def present_labels(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Labels that occur as truth or as prediction."""
    return counts.select(*by, F.explode(F.array("y_true", "y_pred")).alias("label")).distinct()


def confusion_matrix(df: DataFrame, labels: DataFrame | None = None, names: str | None = None) -> DataFrame:
    """Counts for every pair of labels, zeros included. ``labels`` (one column
    ``label``) sets the axes, by default the labels present; ``names`` names them."""
    return matrix_from_counts(fitted_counts(df), labels, names=names)


def check_axis(counts: DataFrame, by: Sequence[str] = (), max_axis: int | None = None) -> None:
    """Raise when a group has more labels than a zero-filled matrix may have."""
    max_axis = MAX_AXIS if max_axis is None else max_axis
    widths = present_labels(counts, by).groupBy(*by).agg(F.count(F.lit(1)).alias("_width"))
    if widths.where(F.col("_width") > max_axis).take(1):
        raise ValueError(f"over {max_axis} labels; use confusion_counts, which holds no zeros, or raise max_axis")


def matrix_from_counts(
    counts: DataFrame,
    labels: DataFrame | None = None,
    by: Sequence[str] = (),
    max_axis: int | None = None,
    names: str | None = None,
) -> DataFrame:
    """Confusion matrix from confusion counts, per group, zeros included.

    ``labels`` (a column ``label``) fixes the axes; its column ``names`` adds what each
    label is called, as ``true_name`` and ``pred_name``. It must hold every label that
    occurs, else it is an error.

    A null truth or prediction is a label like others, so no row is lost. The
    matrix has labels x labels rows, so more than ``max_axis`` labels are an error;
    `confusion_counts` holds what occurs, for any number of them.
    """
    max_axis = MAX_AXIS if max_axis is None else max_axis
    axis = present_labels(counts, by)
    if labels is not None:
        if axis.join(labels, axis["label"].eqNullSafe(labels["label"]), "left_anti").take(1):
            raise ValueError("a truth or prediction lies outside the label set")
        axis = with_every(counts.select(*by).distinct(), labels.select("label")) if by else labels.select("label")
    too_wide = F.raise_error(F.lit(f"over {max_axis} labels; use confusion_counts, which holds no zeros"))
    place = F.row_number().over(Window.partitionBy(*by).orderBy("label"))
    # One row holds all labels of a group and is opened twice: the pairs come from
    # the label list alone. A struct keeps a null label in the set.
    listed = (
        axis.withColumn("_place", place).where(F.col("_place") <= max_axis + 1)
        .groupBy(*by).agg(F.collect_set(F.struct("label")).alias("_axis"))
    )
    none = F.struct(too_wide.cast(axis.schema["label"].dataType).alias("label"))
    checked = F.when(F.size("_axis") > max_axis, F.array_repeat(none, 1))
    pairs = (
        listed.withColumn("_axis", checked.otherwise(F.col("_axis")))
        .select(*by, F.explode("_axis").alias("_t"), "_axis")
        .select(*by, "_t", F.explode("_axis").alias("_p"))
    )
    alias = lambda c: F.struct(F.col(c).alias("label"))
    found = counts.select(*by, alias("y_true").alias("_t"), alias("y_pred").alias("_p"), "n")
    filled = pairs.join(found, [*by, "_t", "_p"], "left").select(
        *by, F.col("_t.label").alias("y_true"), F.col("_p.label").alias("y_pred"), F.coalesce("n", F.lit(0)).alias("n")
    )
    if labels is None or names is None:
        return filled
    called = labels.select(F.col("label").alias("_l"), F.col(names).alias("_name"))
    for side, name in (("y_true", "true_name"), ("y_pred", "pred_name")):
        filled = filled.join(called, filled[side].eqNullSafe(called["_l"]), "left").withColumnRenamed("_name", name).drop("_l")
    return filled


def confusion_wide(matrix: DataFrame, labels: Sequence) -> DataFrame:
    """Confusion matrix with one column per predicted label."""
    return matrix.groupBy("y_true").pivot("y_pred", list(labels)).agg(F.first("n"))


def ratio(part: Column, whole: Column) -> Column:
    """Quotient, 0.0 on division by zero."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def class_scores(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, f1 and support per label from confusion counts."""
    none = F.lit(0).cast("bigint")
    truth = F.struct(F.col("y_true").alias("label"), F.col("n").alias("support"), none.alias("predicted"))
    guess = F.struct(F.col("y_pred").alias("label"), none.alias("support"), F.col("n").alias("predicted"))
    hit = F.when(F.col("y_true").eqNullSafe(F.col("y_pred")), F.col("n")).otherwise(0)
    sides = counts.select(*by, F.explode(F.array(truth, guess)).alias("s"), hit.alias("hits"))
    totals = sides.groupBy(*by, "s.label").agg(
        (F.sum("hits") / 2).alias("hits"), F.sum("s.support").alias("support"), F.sum("s.predicted").alias("predicted")
    )
    return totals.select(
        *by,
        "label",
        ratio(F.col("hits"), F.col("predicted")).alias("precision"),
        ratio(F.col("hits"), F.col("support")).alias("recall"),
        ratio(2 * F.col("hits"), F.col("predicted") + F.col("support")).alias("f1"),
        "support",
        "hits",
    )


def averages(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, macro and weighted averages of class scores, one row per group."""
    weight = F.sum("support")
    measures = ["precision", "recall", "f1"]
    return scores.groupBy(*by).agg(
        *[F.avg(m).alias(f"macro_{m}") for m in measures],
        *[ratio(F.sum(F.col(m) * F.col("support")), weight).alias(f"weighted_{m}") for m in measures],
        ratio(F.sum("hits"), weight).alias("accuracy"),
        weight.alias("support"),
    )


def classification_report(df: DataFrame, labels: DataFrame | None = None, names: str | None = None) -> DataFrame:
    """Per class scores, then accuracy, macro and weighted averages, in long form.

    ``labels`` fixes the label set and adds zero rows for absent labels; its
    column ``names`` replaces the label in the output when given.
    """
    return report_from_counts(fitted_counts(df), labels, names)


def with_every(groups: DataFrame, labels: DataFrame) -> DataFrame:
    """Each group with all labels of a fixed set. The set is one row, which every group
    opens; its size is that of one group of the result."""
    row = labels.agg(F.collect_list(F.struct(*labels.columns)).alias("_labels")).withColumn("_all", F.lit(1))
    return groups.withColumn("_all", F.lit(1)).join(F.broadcast(row), "_all").select(*groups.columns, F.inline("_labels"))


def report_from_counts(
    counts: DataFrame, labels: DataFrame | None = None, names: str | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Classification report from confusion counts, whole or per group.

    A fixed label set must hold every label that occurs, else it is an error: rows
    outside it would miss from the averages. With groups, each gets all its labels.
    """
    scores = class_scores(counts, by)
    shown = F.col("label").cast("string")
    if labels is not None:
        if scores.join(labels, "label", "left_anti").take(1):
            raise ValueError("a truth or prediction lies outside the label set")
        axis = labels
        if by:
            axis = with_every(counts.select(*by).distinct(), labels)
        scores = axis.join(scores, [*by, "label"], "left").na.fill(0, [*MEASURES[3:], "support", "hits"])
        shown = F.col(names) if names else shown
    measures = ["precision", "recall", "f1"]

    def row(label: str, values: Sequence[str]) -> Column:
        return F.struct(
            F.lit(label).alias("label"), *[F.col(v).alias(m) for v, m in zip(values, measures)], F.col("support")
        )

    summary = averages(scores, by).select(
        *by,
        F.inline(
            F.array(
                row("accuracy", ["accuracy"] * 3),
                row("macro avg", [f"macro_{m}" for m in measures]),
                row("weighted avg", [f"weighted_{m}" for m in measures]),
            )
        ),
    )
    return scores.select(*by, shown.alias("label"), *measures, "support").unionByName(summary)


def accuracy(df: DataFrame) -> DataFrame:
    """Share of rows whose prediction is the truth. As in the matrix, a null is a label
    like others: a row without a prediction is a miss unless its truth is null, too."""
    return df.agg(F.avg(F.col("y_true").eqNullSafe(F.col("y_pred")).cast("int")).alias("accuracy"))


def mean_loss(df: DataFrame, scores: str, y_true: str = "y_true") -> DataFrame:
    """Mean cross-entropy over the rows whose truth has a score; ``n`` are these rows,
    ``without_loss`` the others."""
    loss = cross_entropy(F.col(scores), F.col(y_true))
    return df.agg(F.avg(loss).alias("loss"), F.count(loss).alias("n"), F.count_if(loss.isNull()).alias("without_loss"))


def score_counts(df: DataFrame, score: str, y_true: str, positive: int, by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score, whole or per group."""
    is_positive = F.col(y_true) == positive
    return df.groupBy(*by, F.col(score).cast("double").alias("score")).agg(
        F.count_if(is_positive).alias("p"), F.count_if(~is_positive).alias("n")
    )


def auc_from_counts(placed: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """AUC from rows (p, n, _below): each positive beats the negatives below it,
    and half of those with its own score. Null unless both classes occur."""
    area = F.sum(F.col("p") * (F.col("_below").cast("double") + F.col("n") / 2.0))
    pairs = F.sum("p").cast("double") * F.sum("n").cast("double")
    return placed.groupBy(*by).agg(F.try_divide(area, pairs).alias("roc_auc"))


def negatives_below(per_score: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Running sum of the negatives over the scores, in one task per group."""
    before = Window.partitionBy(*by).orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    return per_score.withColumn("_below", F.coalesce(F.sum("n").over(before), F.lit(0)))


def negatives_below_chunked(per_score: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The same over fixed score ranges: totals of the lower ranges, plus a running
    sum inside each range. A group is spread over as many tasks as it has ranges."""
    chunked, chunk = range_chunk(per_score, ["score"])
    chunked = chunked.withColumns({GROUP: group_of(by), CHUNK: chunk})
    before = Window.partitionBy(GROUP).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    totals = chunked.groupBy(GROUP, CHUNK).agg(F.sum("n").alias("_sum"))
    starts = totals.select(GROUP, CHUNK, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(GROUP, CHUNK).orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    placed = chunked.withColumn("_inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(starts, [GROUP, CHUNK])
    return placed.withColumn("_below", F.col("_start") + F.col("_inside"))


def roc_auc(
    df: DataFrame, score: str = "y_pred", y_true: str = "y_true", positive: int = 1, by: Sequence[str] = ()
) -> DataFrame:
    """Area under the ROC curve, whole or per group (such as split and epoch); ties
    count half; null with one class only. Rows without a score rank lowest, rows
    without a truth do not count.

    Rows are first reduced to counts per distinct score, in one pass over the data;
    the counts are stored and ordered over score ranges, however many they are.
    """
    stored = materialize(score_counts(df, score, y_true, positive, by), "scores")
    return auc_from_counts(negatives_below_chunked(stored, by), by)


def loss_counts(df: DataFrame, scores: str | None, by: Sequence[str] = ()) -> DataFrame:
    """Confusion counts with the summed loss of their rows and the number of rows
    that have one, evaluated once."""
    loss = cross_entropy(F.col(scores), F.col("y_true")) if scores else F.lit(None).cast("double")
    return fitted(
        df.groupBy(*by, "y_true", "y_pred").agg(
            F.count(F.lit(1)).alias("n"), F.sum(loss).alias("loss"), F.count(loss).alias("n_loss")
        )
    )


def auc_from_predictions(counts: DataFrame, by: Sequence[str] = (), positive: int = 1) -> DataFrame:
    """AUC on hard predictions, from confusion counts."""
    is_positive = F.col("y_true") == positive
    per_score = counts.groupBy(*by, F.col("y_pred").alias("score")).agg(
        F.sum(F.when(is_positive, F.col("n")).otherwise(0)).alias("p"),
        F.sum(F.when(~is_positive, F.col("n")).otherwise(0)).alias("n"),
    )
    return auc_from_counts(negatives_below(per_score, by), by)


def summary_from_counts(counts: DataFrame, by: Sequence[str] = (), auc: DataFrame | None = None) -> DataFrame:
    """One row of `MEASURES` per group from `loss_counts`. Precision, recall and f1
    are macro averages; the AUC is that of the hard predictions unless another is given."""
    macro = [F.col(f"macro_{m}").alias(m) for m in ("precision", "recall", "f1")]
    pieces = [
        auc_from_predictions(counts, by) if auc is None else auc,
        averages(class_scores(counts, by), by).select(*by, "accuracy", *macro),
        counts.groupBy(*by).agg(F.try_divide(F.sum("loss"), F.sum("n_loss")).alias("loss")),
    ]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pieces)
    return rows.groupBy(*by).agg(*[F.max(m).alias(m) for m in MEASURES])


def run_summary(df: DataFrame, model_name: str, scores: str | None = None, auc_score: str = "y_pred") -> DataFrame:
    """One row: AUC, accuracy, loss and the macro averages of a model.

    The data is read once, unless the AUC is taken on a score column.
    """
    auc = None if auc_score == "y_pred" else roc_auc(df, auc_score)
    summary = summary_from_counts(loss_counts(df, scores), auc=auc)
    return summary.select(F.lit(model_name).alias("model_name"), *MEASURES)


def epoch_metrics(
    df: DataFrame, by: Sequence[str], scores: str | None = None, auc_score: str = "y_pred"
) -> DataFrame:
    """Metrics of every split and epoch as rows (by, metric, value), from one pass
    over all predictions, and a second one where the AUC is taken on a score column.
    Metrics without a value are left out."""
    auc = None if auc_score == "y_pred" else roc_auc(df, auc_score, by=by)
    summary = summary_from_counts(loss_counts(df, scores, by), by, auc)
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in MEASURES])
    return summary.select(*by, F.inline(pairs)).where(F.col("value").isNotNull())


# Metrics that are plain aggregates over a prediction table, by name.
METRICS: dict[str, Callable[[Column, Column], Column]] = {
    "accuracy": lambda t, p: F.avg(t.eqNullSafe(p).cast("int")),
    "precision": lambda t, p: ratio(F.count_if((t == 1) & (p == 1)), F.count_if(p == 1)),
    "recall": lambda t, p: ratio(F.count_if((t == 1) & (p == 1)), F.count_if(t == 1)),
    "f1": lambda t, p: ratio(2 * F.count_if((t == 1) & (p == 1)), F.count_if(t == 1) + F.count_if(p == 1)),
    "meanabsoluteerror": lambda t, p: F.avg(F.abs(t - p)),
    "meansquarederror": lambda t, p: F.avg((t - p) * (t - p)),
    "rootmeansquarederror": lambda t, p: F.sqrt(F.avg((t - p) * (t - p))),
}


def metrics_by_name(
    df: DataFrame,
    names: Sequence[str],
    by: Sequence[str] = (),
    scores: str | None = None,
    extra: Mapping[str, Callable[[Column, Column], Column]] | None = None,
) -> DataFrame:
    """Named metrics in one aggregate. Unknown names are warned about and skipped.
    The loss is known when a column of class scores is given."""
    table = {**METRICS, **{k.lower(): v for k, v in (extra or {}).items()}}
    if scores:
        table["loss"] = lambda t, _: F.avg(cross_entropy(F.col(scores), t))
    chosen = []
    for name in names:
        key = name.lower()
        if key in table:
            chosen.append(table[key](F.col("y_true"), F.col("y_pred")).alias(key))
        else:
            logger.warning("metric %r not found", name)
    if not chosen:
        raise ValueError("no known metric was named")
    return df.groupBy(*by).agg(*chosen)


def class_metrics_by_name(
    df: DataFrame,
    names: Sequence[str],
    by: Sequence[str] = (),
    average: str = "macro",
    scores: str | None = None,
    k: int = 5,
    positive: int = 1,
) -> DataFrame:
    """Named metrics over any number of classes, from one pass into confusion counts.

    ``precision``, ``recall`` and ``f1`` are ``macro`` or ``weighted`` averages over
    the classes that occur, ``accuracy`` is over all rows, ``roc_auc`` that of the class
    ``positive`` against all others: by its score where a column of class scores is
    given, else by the hard predictions. With class scores, ``topk`` is the share of
    rows whose truth is among the ``k`` largest scores, ties to the truth; a truth
    without a score, null, negative or beyond the last, is a miss.
    Unknown names are warned about and skipped.
    """
    if average not in ("macro", "weighted"):
        raise ValueError("average must be macro or weighted")
    counts = fitted_counts(df, by)
    summary = averages(class_scores(counts, by), by)
    known = {m: F.col(f"{average}_{m}") for m in ("precision", "recall", "f1")} | {"accuracy": F.col("accuracy")}
    parts, chosen = [], []
    for name in map(str.lower, names):
        if name in known:
            chosen.append(name)
        elif name == "roc_auc":
            if scores:
                own = df.withColumn("_own", F.get(scores, F.lit(positive)))
                parts.append(roc_auc(own, "_own", positive=positive, by=by))
            else:
                hard = counts.withColumn("y_pred", (F.col("y_pred") == positive).cast("int"))
                parts.append(auc_from_predictions(hard, by, positive))
        elif name == "topk" and scores:
            own = F.get(scores, F.col("y_true").cast("int"))
            above = F.size(F.filter(scores, lambda s: s > own))
            hit = own.isNotNull() & ~F.isnan(own) & (above < k)
            parts.append(df.groupBy(*by).agg(F.avg(F.coalesce(hit, F.lit(False)).cast("int")).alias("topk")))
        else:
            logger.warning("metric %r not found", name)
    if not chosen and not parts:
        raise ValueError("no known metric was named")
    tables = [summary.select(*by, *[known[c].alias(c) for c in chosen]), *parts]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    return rows.groupBy(*by).agg(*[F.max(c).alias(c) for c in rows.columns if c not in by])


def custom_metric(
    df: DataFrame,
    compute: Callable[[pd.Series, pd.Series, pd.Series], float],
    by: Sequence[str],
    name: str = "value",
    max_pairs: int | None = None,
) -> DataFrame:
    """A Python metric ``compute(y_true, y_pred, weight)`` per group.

    It gets each pair of labels once, with its number of rows as the weight: at
    most classes x classes rows, whatever the size of the group. Values that are
    not classes, of which a group has over ``max_pairs`` pairs, are an error: they
    need a metric written as an aggregate, see `metrics_by_name`.
    """
    max_pairs = MAX_PAIRS if max_pairs is None else max_pairs
    pairs = F.count(F.lit(1)).over(Window.partitionBy(*by))
    too_many = F.raise_error(F.lit(f"over {max_pairs} label pairs in a group")).cast("boolean")
    counts = confusion_counts(df, by).withColumn("_pairs", pairs)
    counts = counts.where(F.when(F.col("_pairs") > max_pairs, too_many).otherwise(F.lit(True))).drop("_pairs")
    fields = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in by)

    def per_group(pdf: pd.DataFrame) -> pd.DataFrame:
        value = float(compute(pdf["y_true"], pdf["y_pred"], pdf["n"]))
        return pdf[list(by)].head(1).assign(**{name: value})

    return counts.groupBy(*by).applyInPandas(per_group, f"{fields}, `{name}` double")


@dataclass(frozen=True)
class MergeableMetric:
    """A Python metric in parts, which can be summed up apart and brought together.

    A state is an array of numbers. ``update`` takes it on by some rows (truths and
    predictions), ``merge`` joins two, ``finish`` gives the value.
    """

    initial: Callable[[], np.ndarray]
    update: Callable[[np.ndarray, pd.Series, pd.Series], np.ndarray]
    merge: Callable[[np.ndarray, np.ndarray], np.ndarray]
    finish: Callable[[np.ndarray], float]


def custom_metric_merged(
    df: DataFrame, metric: MergeableMetric, by: Sequence[str], name: str = "value"
) -> DataFrame:
    """A Python metric per group, from states that tasks make of the rows they read.

    No group of rows is ever in one place: a task keeps one state per group it meets
    (of at most `STATE_GROUPS` groups at a time) and hands it on; a group's states are
    merged in `STATE_SHARES` shares and these once more. So a group with most of the
    rows takes no longer than others, and there is no limit on its distinct values.
    Null groups are groups. ``merge`` must not depend on the order.
    """
    fields = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in by]
    schema = ", ".join([*fields, "share int, state array<double>"])
    keys = list(by)

    def rows_of(states: dict[tuple, np.ndarray], share: int) -> pd.DataFrame:
        held = pd.DataFrame(list(states), columns=keys, dtype=object)
        return held.assign(share=np.int32(share), state=[s.astype(float).tolist() for s in states.values()])

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        states: dict[tuple, np.ndarray] = {}
        share = TaskContext.get().partitionId() % STATE_SHARES
        for frame in frames:
            for key, rows in frame.groupby(keys, dropna=False, sort=False) if keys else [((), frame)]:
                key = tuple(None if pd.isna(k) else k for k in key)
                state = states[key] if key in states else metric.initial()
                states[key] = metric.update(state, rows["y_true"], rows["y_pred"])
            if len(states) > STATE_GROUPS:
                yield rows_of(states, share)
                states = {}
        if states:
            yield rows_of(states, share)

    def merged(frame: pd.DataFrame) -> np.ndarray:
        return reduce(metric.merge, [np.asarray(s) for s in frame["state"]])

    def together(frame: pd.DataFrame) -> pd.DataFrame:
        return frame[[*keys, "share"]].head(1).assign(state=[merged(frame).astype(float).tolist()])

    def final(frame: pd.DataFrame) -> pd.DataFrame:
        return frame[keys].head(1).assign(**{name: [float(metric.finish(merged(frame)))]})

    states = df.select(*keys, "y_true", "y_pred").mapInPandas(partial, schema)
    shares = states.groupBy(*keys, "share").applyInPandas(together, schema)
    return shares.groupBy(*keys).applyInPandas(final, ", ".join([*fields, f"`{name}` double"]))
