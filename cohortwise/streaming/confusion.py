"""Confusion counts of predictions as they arrive, per epoch of event time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery


def event_time(df: DataFrame, ts: str) -> Column:
    """Event time as an instant. Times without a zone are read as UTC, whatever
    the zone of the session."""
    time = F.col(ts).cast("timestamp")
    zoneless = df.schema[ts].dataType == T.TimestampNTZType()
    return F.from_utc_timestamp(time, F.current_timezone()) if zoneless else time


def epoch_confusion(predictions: DataFrame, ts: str = "ts", epoch: str = "1 day", late: str = "1 day") -> DataFrame:
    """Rows per (epoch start in UTC, y_true, y_pred); for batch and streaming input.

    Each epoch is a tumbling window. Its counts leave the state once the
    watermark has passed it; rows that come later than that are not counted here, but
    in `epoch_arrivals`.
    """
    timed = predictions.withColumn(ts, event_time(predictions, ts)).withWatermark(ts, late)
    return (
        timed.groupBy(F.window(ts, epoch).alias("w"), "y_true", "y_pred")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(epoch_name("w.start").alias("epoch"), "y_true", "y_pred", "n")
    )


def epoch_name(start: str) -> Column:
    """Start of an epoch as a text in UTC."""
    return F.date_format(F.to_utc_timestamp(start, F.current_timezone()), "yyyy-MM-dd HH:mm:ss")


def epoch_arrivals(predictions: DataFrame, ts: str = "ts", epoch: str = "1 day") -> DataFrame:
    """All rows of each epoch, however late they come: ``(epoch, arrived, last)`` with
    the latest event time seen. No watermark ends an epoch here, so the state keeps one
    row for each, three numbers whatever the number of rows."""
    timed = predictions.withColumn(ts, event_time(predictions, ts))
    return (
        timed.groupBy(F.window(ts, epoch).alias("w"))
        .agg(F.count(F.lit(1)).alias("arrived"), F.max(ts).alias("last"))
        .select(epoch_name("w.start").alias("epoch"), "arrived", "last")
    )


def epoch_accuracy(counts: DataFrame) -> DataFrame:
    """Accuracy per epoch from its counts."""
    hits = F.sum(F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(0))
    return counts.groupBy("epoch").agg(
        F.sum("n").cast("bigint").alias("n"), (hits / F.sum("n")).alias("accuracy")
    )


def start_confusion(counts: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Write the changed counts (or arrivals) of every micro-batch as a folder of its own.

    The folder name is the batch id, so a batch replayed after a failure replaces
    its earlier output.
    """

    def write_batch(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = counts.writeStream.outputMode("update").foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def latest_arrivals(written: DataFrame) -> DataFrame:
    """Arrivals of each epoch from the folders of all batches."""
    return written.groupBy("epoch").agg(F.max_by("arrived", "batch").alias("arrived"), F.max("last").alias("last"))


def running_state(counts: DataFrame, arrivals: DataFrame) -> DataFrame:
    """Per epoch ``(epoch, counted, accuracy, late, arrived)`` out of the latest counts
    and arrivals: every row that arrived was counted or is late.

    Both streams read the same source to the same end; where one is ahead of the other,
    ``late`` holds for the part that both have read once the next batch is through.
    """
    scored = epoch_accuracy(counts).withColumnRenamed("n", "counted")
    joined = arrivals.select("epoch", "arrived").join(scored, "epoch", "full_outer")
    counted, arrived = (F.coalesce(c, F.lit(0)).cast("bigint") for c in ("counted", "arrived"))
    late = F.greatest(arrived - counted, F.lit(0)).cast("bigint")
    return joined.select("epoch", counted.alias("counted"), "accuracy", late.alias("late"), arrived.alias("arrived"))


def latest_counts(written: DataFrame) -> DataFrame:
    """Current counts from the folders of all batches: the last value of each cell."""
    return written.groupBy("epoch", "y_true", "y_pred").agg(F.max_by("n", "batch").alias("n"))
