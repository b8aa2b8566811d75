"""Column functions over class score arrays."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from cohortwise.functions.common import let


def argmax(scores: Column) -> Column:
    """Zero-based position of the largest score, the first one on ties."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def softmax(scores: Column) -> Column:
    """Scores as probabilities, shifted by the maximum for stability."""
    exps = let(
        F.array_max(scores).cast("double"),
        lambda top: F.transform(scores, lambda x: F.exp(x.cast("double") - top)),
    )
    return let(exps, lambda e: let(total(e), lambda t: F.transform(e, lambda x: x / t)))


def cross_entropy(scores: Column, y_true: Column) -> Column:
    """Cross-entropy of one row: log of the summed exponentials minus the true score."""
    log_sum = let(
        F.array_max(scores).cast("double"),
        lambda top: F.log(total(F.transform(scores, lambda x: F.exp(x.cast("double") - top)))) + top,
    )
    return log_sum - F.get(scores, y_true).cast("double")
