"""Sinks: cohorts, evaluation tables, metric logs, reports, batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cohortwise.operators.evaluation import (
    MEASURES,
    check_axis,
    fitted_counts,
    loss_counts,
    matrix_from_counts,
    report_from_counts,
    roc_auc,
    summary_from_counts,
)
from cohortwise.operators.ranks import ordered_rank, seeded_rank
from cohortwise.operators.runs import numeric_metrics

# Fixed values
SHUFFLED_SPLITS = ("train", "val")
NULL_LABEL = "null"
TITLE = "# Run summary"
RESULTS_HEADING = "## Test results"
METRICS_HEADING = "### Evaluation metrics"
CONFUSION_HEADING = "### Confusion matrix"
CONFIG_OPENING = ("## `config.yaml`", "```yaml", "# --config-name=config", "")


def write_parts(df: DataFrame, path: str, parts: Sequence[str], fmt: str = "parquet", max_rows: int = 0) -> None:
    """Write a table by partition columns, replacing only the partitions it has.

    A repeated write of the same split and epoch thus leaves one copy. Files end
    after ``max_rows`` rows when that is set.
    """
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_rows)
        .option("header", True)
        .partitionBy(*parts)
        .format(fmt)
        .save(path)
    )


def write_cohort(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Cohort rows, one folder per split."""
    write_parts(df, path, ["split"], fmt)


def write_eval(
    predictions: DataFrame,
    path: str,
    split: str | None = None,
    epoch: int | None = None,
    labels: DataFrame | None = None,
    names: str | None = None,
    max_axis: int | None = None,
) -> None:
    """Predictions, report and confusion matrix by split and epoch.

    Either of one split and epoch, or of all those named in the columns ``split``
    and ``epoch`` of the predictions, which are read once for all. ``labels`` fixes
    the label set of report and matrix; its column ``names`` is what the report shows
    and names the matrix's rows and columns. More labels than ``max_axis`` are an error
    before anything is written.
    """
    if split is not None:
        predictions = predictions.withColumn("split", F.lit(split))
    if epoch is not None:
        predictions = predictions.withColumn("epoch", F.lit(epoch))
    by = ["split", "epoch"]
    counts = fitted_counts(predictions, by)
    check_axis(counts, by, max_axis)
    report = report_from_counts(counts, labels, names, by)
    write_parts(predictions, f"{path}/predictions", by)
    write_parts(report, f"{path}/classification_report", by)
    write_parts(matrix_from_counts(counts, labels, by, max_axis, names), f"{path}/confusion_matrix", by)


def log_metrics(df: DataFrame, path: str, parts: Sequence[str] = ("split", "epoch")) -> None:
    """Numeric metrics with prefixed names. One folder per split and epoch suits
    a log written epoch by epoch; a whole log goes by split alone."""
    write_parts(numeric_metrics(df), path, parts)


def batches(df: DataFrame, keys: Sequence[str], order: str, batch_size: int, seed: int) -> DataFrame:
    """Position and batch number of each row within its split. Train and
    validation rows are shuffled by seed, all others follow the ``order`` column."""
    to_shuffle = F.coalesce(F.col("split").isin(*SHUFFLED_SPLITS), F.lit(False))
    ranked = seeded_rank(df.where(to_shuffle), keys, seed, ["split"], "position").unionByName(
        ordered_rank(df.where(~to_shuffle), order, keys, ["split"], "position")
    )
    return ranked.withColumn("batch_id", F.expr(f"(position - 1) div {batch_size}"))


def export_batches(df: DataFrame, path: str, keys: Sequence[str], order: str, batch_size: int, seed: int) -> None:
    """Batches written by split, each batch within one file and in order.

    Whole batches are spread over the tasks by hash, so the size of a split does
    not matter.
    """
    batched = batches(df, keys, order, batch_size, seed)
    spread = batched.repartition("split", "batch_id").sortWithinPartitions("split", "batch_id", "position")
    write_parts(spread, path, ["split"])


def markdown_row(cells: Sequence[Column]) -> Column:
    return F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))


def number_text(value: Column) -> Column:
    return F.when(value.isNull(), "nan").otherwise(F.format_string("%.6f", value.cast("double")))


def run_report(
    predictions: DataFrame,
    model_name: str,
    scores: str | None,
    config: DataFrame,
    auc_score: str = "y_pred",
    labels: DataFrame | None = None,
    names: str | None = None,
    max_axis: int | None = None,
) -> DataFrame:
    """Markdown report of a run as ordered lines (section, line_no, line).

    Metrics row, confusion matrix in label order, and the configuration, a table
    of ``key`` and ``value``. ``labels`` fixes the axes of the matrix, whose rows and
    columns its column ``names`` can name; a null label or name reads `NULL_LABEL`. The
    input of the formatting is at most classes x classes rows, ``max_axis`` classes.
    """
    counts = loss_counts(predictions, scores)
    auc = None if auc_score == "y_pred" else roc_auc(predictions, auc_score)
    summary = summary_from_counts(counts, auc=auc)
    header = ["model_name", *MEASURES[:-1], "f1-score"]
    cells = [F.lit(model_name), *[number_text(F.col(m)) for m in MEASURES]]
    metric_lines = [
        *[F.lit(t) for t in (TITLE, "", RESULTS_HEADING, METRICS_HEADING)],
        markdown_row([F.lit(h) for h in header]),
        F.lit("|" + " --- |" * len(header)),
        markdown_row(cells),
        F.lit(""),
    ]
    metrics = summary.select(F.lit(1).alias("section"), F.posexplode(F.array(*metric_lines)).alias("line_no", "line"))

    row = F.sort_array(F.collect_list(F.struct("y_pred", "n")))
    full = matrix_from_counts(counts.drop("loss", "n_loss"), labels, (), max_axis, names)
    called = F.col("true_name") if "true_name" in full.columns else F.col("y_true")
    shown = F.coalesce(called.cast("string"), F.lit(NULL_LABEL))
    matrix = full.withColumn("shown", shown).groupBy("y_true", "shown").agg(row.alias("cells"))
    table = F.sort_array(F.collect_list(F.struct("y_true", "shown", "cells")))
    lines = F.transform(
        "table",
        lambda r: F.concat(
            F.lit("| "),
            r["shown"],
            F.lit(" | "),
            F.array_join(F.transform(r["cells"], lambda c: c["n"].cast("string")), " | "),
            F.lit(" |"),
        ),
    )
    names = F.array_join(F.transform("table", lambda r: r["shown"]), " | ")
    rule = F.concat(F.lit("| --- |"), F.repeat(F.lit(" --- |"), F.size("table")))
    confusion = matrix.agg(table.alias("table")).select(
        F.lit(2).alias("section"),
        F.posexplode(
            F.concat(
                F.array(F.lit(CONFUSION_HEADING), F.concat(F.lit("|  | "), names, F.lit(" |")), rule),
                lines,
                F.array(F.lit("")),
            )
        ).alias("line_no", "line"),
    )

    entries = F.sort_array(F.collect_list(F.concat_ws(": ", "key", "value")))
    settings = config.agg(entries.alias("entries")).select(
        F.lit(3).alias("section"),
        F.posexplode(
            F.concat(F.array(*[F.lit(t) for t in CONFIG_OPENING]), F.col("entries"), F.array(F.lit("```")))
        ).alias("line_no", "line"),
    )
    return metrics.unionByName(confusion).unionByName(settings)


def write_report(report: DataFrame, path: str) -> None:
    """Report lines as one text file; a report is as small as its tables."""
    ordered = report.coalesce(1).sortWithinPartitions("section", "line_no")
    ordered.select("line").write.mode("overwrite").text(path)
