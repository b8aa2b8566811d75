"""Metric logs of runs: best epochs, early stopping, latest values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortwise.operators.ranks import CHUNK, GROUP, group_of

# Epochs per chunk in ordered scans over one run.
EPOCH_CHUNK = 4096


def signed_score(value: Column, score_name: str) -> Column:
    """Score to maximise: a loss counts negative, and no number is no score."""
    score = F.nanvl(value.cast("double"), F.lit(None).cast("double"))
    return -score if score_name == "loss" else score


def best_epochs(df: DataFrame, runs: Sequence[str], value: str, score_name: str, n_saved: int = 1) -> DataFrame:
    """The ``n_saved`` best epochs of each run, earlier epochs first on ties, and
    epochs without a score (null or NaN) last."""
    order = Window.partitionBy(*runs).orderBy(signed_score(F.col(value), score_name).desc(), F.asc("epoch"))
    return df.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n_saved)


def last_metrics(df: DataFrame, by: Sequence[str], value: str = "value") -> DataFrame:
    """Latest value of each group, by aggregation: no sort, no window."""
    return df.groupBy(*by).agg(F.max("epoch").alias("epoch"), F.max_by(value, "epoch").alias(value))


def running_before(df: DataFrame, group: str, order: str, chunk: str, totals: Mapping[str, tuple]) -> DataFrame:
    """Running aggregates over all earlier rows of the group, null for its first row.

    ``totals`` maps a new column to (value, aggregate, how to join two results).
    Results of whole chunks are carried over, so that only the inside of a chunk
    is scanned in one task.
    """
    values = df.select("*", *[value.alias(f"_v{i}") for i, (value, _, _) in enumerate(totals.values())])
    chunks = values.groupBy(group, chunk).agg(
        *[agg(f"_v{i}").alias(f"_c{i}") for i, (_, agg, _) in enumerate(totals.values())]
    )
    earlier = Window.partitionBy(group).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(group, chunk).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    aggregates = [agg for _, agg, _ in totals.values()]
    carried = chunks.select(group, chunk, *[a(f"_c{i}").over(earlier).alias(f"_b{i}") for i, a in enumerate(aggregates)])
    scanned = values.select("*", *[a(f"_v{i}").over(inside).alias(f"_i{i}") for i, a in enumerate(aggregates)])
    joined = scanned.join(carried, [group, chunk])
    results = [
        F.coalesce(both(F.col(f"_b{i}"), F.col(f"_i{i}")), f"_b{i}", f"_i{i}").alias(name)
        for i, (name, (_, _, both)) in enumerate(totals.items())
    ]
    return joined.select(*df.columns, *results)


def early_stop(
    df: DataFrame, runs: Sequence[str], value: str, score_name: str, patience: int = 10, chunk_size: int = EPOCH_CHUNK
) -> DataFrame:
    """Per run the epoch at which training stops: ``patience`` evaluations in a
    row without a new best. Null when that never happens. Epochs are integers
    and unique within a run. An epoch whose value is null or NaN is no best."""
    scored = df.select(
        group_of(runs).alias(GROUP),
        "epoch",
        signed_score(F.col(value), score_name).alias("_score"),
        F.coalesce(F.floor(F.col("epoch") / chunk_size), F.lit(-1)).alias(CHUNK),
    )
    plus = lambda a, b: a + b
    seen = running_before(
        scored, GROUP, "epoch", CHUNK,
        {"_seen": (F.lit(1), F.sum, plus), "_best": (F.col("_score"), F.max, F.greatest)},
    )
    improved = F.col("_score").isNotNull() & (F.col("_best").isNull() | (F.col("_score") > F.col("_best")))
    numbered = seen.select(
        GROUP, "epoch", CHUNK, F.coalesce("_seen", F.lit(0)).alias("_seen"), improved.alias("_improved")
    )
    last = running_before(
        numbered, GROUP, "epoch", CHUNK,
        {"_last": (F.when(F.col("_improved"), F.col("_seen")), F.max, F.greatest)},
    )
    waited = F.when(F.col("_improved"), F.lit(0)).otherwise(F.col("_seen") - F.coalesce("_last", F.lit(-1)))
    stops = last.groupBy(GROUP).agg(
        F.count(F.lit(1)).alias("epochs"), F.min(F.when(waited >= patience, F.col("epoch"))).alias("stop_epoch")
    )
    return stops.select(*[F.col(f"{GROUP}.{r}").alias(r) for r in runs], "epochs", "stop_epoch")


def numeric_metrics(df: DataFrame, split: str = "split", metric: str = "metric", value: str = "value") -> DataFrame:
    """Log rows whose value is a number, the metric name prefixed by its split."""
    number = F.col(value).try_cast("double")
    return (
        df.withColumn("_number", number)
        .where(F.col("_number").isNotNull())
        .withColumn(metric, F.concat(F.col(split), F.lit("_"), F.col(metric)))
        .withColumn(value, F.col("_number"))
        .drop("_number")
    )
