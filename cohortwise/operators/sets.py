"""Unions, differences and replication."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def union_parts(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of all parts, columns matched by name."""
    return reduce(DataFrame.unionByName, others, first)


def combine_datasets(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """Several datasets with a ``split`` column as one, with a ``source`` column."""
    return union_parts(*[df.withColumn("source", F.lit(name)) for name, df in datasets.items()])


def label_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Labels of the first table that the second one lacks."""
    return left.subtract(right)


def replicate_class(df: DataFrame, label: str, value: int, times: int) -> DataFrame:
    """Rows of one class repeated, each copy numbered from 1 in ``copy``."""
    copies = F.when(F.col(label) == value, F.lit(max(times, 1))).otherwise(F.lit(1))
    return df.withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
