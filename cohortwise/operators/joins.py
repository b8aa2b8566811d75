"""Joins. Sides are never forced to broadcast: Spark picks by size, and splits
skewed partitions at run time."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from cohortwise.functions.labels import int_target
from cohortwise.functions.names import base_name, scan_number
from cohortwise.operators.sets import union_parts


def join_scans(metadata: DataFrame, scans: DataFrame, on: str) -> DataFrame:
    """Metadata with the scan files of the same key."""
    return metadata.join(scans, on, "inner")


def select_keys(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key is listed."""
    return df.join(keys.select(on), on, "left_semi")


def without_keys(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key is not listed; rows without a key stay."""
    return df.join(keys.select(on), on, "left_anti")


def missing_keys(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Listed keys that match no row."""
    return keys.select(on).distinct().join(df.select(on), on, "left_anti")


def bind_columns(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Columns of both tables side by side, aligned on the key."""
    return left.join(right, on, "full_outer")


def list_membership(lists: Mapping[str, DataFrame], on: str) -> DataFrame:
    """Split lists as one table: each key with the sorted lists that name it."""
    names = sorted(lists)
    listed = union_parts(*[lists[n].select(F.col(lists[n].columns[0]).alias(on), F.lit(n).alias("_part")) for n in names])
    flags = [F.max(F.col("_part") == n).alias(f"_in_{i}") for i, n in enumerate(names)]
    found = F.array(*[F.when(F.col(f"_in_{i}"), F.lit(n)) for i, n in enumerate(names)])
    return listed.groupBy(on).agg(*flags).select(on, F.array_compact(found).alias("parts"))


def split_by_lists(df: DataFrame, lists: Mapping[str, DataFrame], on: str) -> DataFrame:
    """Rows named by a list, once per list, with its name in ``split``. All lists
    are matched in one join."""
    return df.join(list_membership(lists, on), on).withColumn("split", F.explode("parts")).drop("parts")


def scan_lookup(scans: DataFrame, path: str, patients: DataFrame, id_column: str, target: str) -> DataFrame:
    """Patients with their target and the scan file with the highest path.

    One row per scan number, with the number of scans and a ``status``: ``ok``,
    ``missing`` (no such patient), ``bad_target`` (no integer), ``bad_id`` (no
    number in the name). Scans are reduced per number before the join, so a
    patient with very many scans costs one row. Patient ids that occur twice
    are an error; rows without an id match nothing.
    """
    numbered = scans.select(scan_number(F.col(path)).alias("patient"), F.col(path).alias("_path"))
    latest = numbered.groupBy("patient").agg(F.max("_path").alias("_path"), F.count(F.lit(1)).alias("scans"))
    known = patients.select(
        F.col(id_column).cast("int").alias("patient"), int_target(F.col(target)).alias("target"), F.lit(1).alias("_known")
    ).where(F.col("patient").isNotNull())
    check_unique(known, "patient")
    status = (
        F.when(F.col("patient").isNull(), "bad_id")
        .when(F.col("_known").isNull(), "missing")
        .when(F.col("target").isNull(), "bad_target")
        .otherwise("ok")
    )
    return (
        latest.join(known, "patient", "left")
        .select("patient", base_name(F.col("_path")).alias("filename"), "target", "scans", status.alias("status"))
    )


def check_unique(df: DataFrame, key: str) -> None:
    """Raise when a key occurs twice."""
    if df.groupBy(key).count().where("count > 1").take(1):
        raise ValueError(f"{key} is not unique")
