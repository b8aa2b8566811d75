"""Class lists: fitting, encoding, decoding."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from cohortwise.functions.labels import one_hot
from cohortwise.operators.ranks import ordered_rank
from cohortwise.session import fitted_or_stored

# Widest one-hot table; more classes stay in long form (`one_hot_long`).
MAX_WIDTH = 500


def sorted_classes(df: DataFrame, label: str) -> DataFrame:
    """Distinct labels in order."""
    return df.select(label).where(F.col(label).isNotNull()).distinct().orderBy(label)


def class_codes(df: DataFrame, label: str, code: str = "code") -> DataFrame:
    """Dense codes from 0 in label order. Ranks distinct labels only: few of them
    in one task, many over ranges of labels."""
    distinct = df.select(label).where(F.col(label).isNotNull()).distinct()
    classes, small = fitted_or_stored(distinct)
    if not small:
        return ordered_rank(classes, label, [], name=code).withColumn(code, (F.col(code) - 1).cast("int"))
    position = F.row_number().over(Window.orderBy(label)) - 1
    return F.broadcast(classes.select(label, position.cast("int").alias(code)))


def encode(df: DataFrame, label: str, code: str) -> DataFrame:
    """Label replaced by its dense code, or kept beside it under another name."""
    codes = class_codes(df.select(F.col(label).alias("_label")), "_label", "_code")
    joined = df.join(codes, F.col(label) == F.col("_label"), "left")
    return joined.withColumn(code, F.col("_code")).drop("_label", "_code")


def encoding_table(spark: SparkSession, encoding: Mapping[str, int]) -> DataFrame:
    """A fixed name to code map as a table."""
    columns = {"name": pa.array(encoding.keys(), pa.string()), "code": pa.array(encoding.values(), pa.int32())}
    return spark.createDataFrame(pa.table(columns))


def encoding_labels(encoding: Column) -> Column:
    """Names of an encoding map, in code order."""
    entries = F.map_entries(encoding)
    by_code = F.array_sort(F.transform(entries, lambda e: F.struct(e["value"].alias("c"), e["key"].alias("n"))))
    return F.transform(by_code, lambda e: e["n"])


def labels_or_encoding(labels: Sequence[str] | None, encoding: Mapping[str, int]) -> list[str]:
    """Given label names, or the names of the encoding when none is set."""
    return list(labels) if labels and any(labels) else list(encoding)


def decode(df: DataFrame, code: str, encoding: Mapping[str, int], name: str) -> DataFrame:
    """Class name of a code, also in place of the code; null for codes outside the
    encoding. Of several names for one code the last counts, so no row is doubled.

    The encoding lies on the driver, so its table is as small as that.
    """
    last = {c: n for n, c in encoding.items()}
    names = encoding_table(df.sparkSession, {n: c for c, n in last.items()})
    names = F.broadcast(names.select(F.col("name").alias("_name"), F.col("code").alias("_known")))
    found = df.withColumn("_code", F.col(code)).join(names, F.col("_code") == F.col("_known"), "left")
    return found.withColumn(name, F.col("_name")).drop("_code", "_known", "_name")


def fit_labels(df: DataFrame, labels: str) -> list[str]:
    """Sorted distinct labels of an array column, at most `MAX_WIDTH`."""
    rows = (
        df.select(F.explode(labels).alias("label")).where("label is not null").distinct().orderBy("label")
        .take(MAX_WIDTH + 1)
    )
    if len(rows) > MAX_WIDTH:
        raise ValueError(f"more than {MAX_WIDTH} classes; use one_hot_long")
    return [r.label for r in rows]


def binarize(df: DataFrame, labels: str, classes: Sequence[str] | None = None, keep: Sequence[str] | None = None) -> DataFrame:
    """One 0/1 column per class beside the kept columns; a projection, no shuffle."""
    classes = fit_labels(df, labels) if classes is None else classes
    return df.select(*(df.columns if keep is None else keep), *one_hot(F.col(labels), classes))


def one_hot_long(df: DataFrame, key: str, labels: str) -> DataFrame:
    """The ones of the one-hot matrix as (key, label) rows, for any number of classes."""
    return df.select(key, F.explode(F.array_distinct(labels)).alias("label"))
