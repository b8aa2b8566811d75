"""Counts and label distributions. Every summary is one pass with partial
aggregation, so hot classes are reduced before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cohortwise.functions.labels import split_mixed

# Fixed values
TOTAL = "Total"
SPLIT_HEADERS = {"train": "Train split", "val": "Validation split", "test": "Test split"}


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def target_counts(df: DataFrame, target: str) -> DataFrame:
    """Occurrences of each label in a multi-label string column."""
    return value_counts(df.select(F.explode(split_mixed(F.col(target))).alias("label")), "label")


def n_unique(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct(column) if approximate else F.count_distinct(column)
    return df.agg(count.alias("n_unique"))


def zero_one_counts(df: DataFrame, classes: Sequence[str]) -> DataFrame:
    """Zeros and ones of each class column, all in one aggregate."""
    ones = [F.sum(F.col(f"`{c}`")).cast("bigint").alias(f"_{i}") for i, c in enumerate(classes)]
    counted = df.agg(F.count(F.lit(1)).alias("_all"), *ones)
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("label"),
                (F.col("_all") - F.coalesce(f"_{i}", F.lit(0))).alias("zeros"),
                F.coalesce(f"_{i}", F.lit(0)).alias("ones"),
            )
            for i, c in enumerate(classes)
        ]
    )
    return counted.select(F.inline(rows))


def share(part: Column, whole: Column) -> Column:
    """Percentage; null for an empty whole."""
    return F.try_divide(part * 100.0, whole)


def percent_text(percent: Column) -> Column:
    """Percentage with four decimals, null for none."""
    return F.when(percent.isNotNull(), F.format_string("%.4f%%", percent))


def prevalence(df: DataFrame, positive: Column) -> DataFrame:
    """Positives among all rows: counts, percentage, and the percentage as text."""
    counts = df.agg(F.count_if(positive).alias("n_positive"), F.count(F.lit(1)).alias("n"))
    percent = share(F.col("n_positive"), F.col("n"))
    return counts.select("n_positive", "n", F.round(percent, 6).alias("percent"), percent_text(percent).alias("percent_text"))


def threshold_counts(df: DataFrame, target: str, part: str, column: str, limits: Sequence[float]) -> DataFrame:
    """Rows whose target contains a part: how many, and how many below each limit."""
    below = [F.count_if(F.col(column) < limit).alias(f"below_{limit:g}") for limit in limits]
    return df.where(F.col(target).contains(part)).agg(F.count(F.lit(1)).alias("n"), *below)


def target_breakdown(
    df: DataFrame, label: str, split: str = "split", headers: Mapping[str, str] = SPLIT_HEADERS
) -> DataFrame:
    """Label by split counts with totals on both sides.

    The data is counted once per (label, split); the totals are built from those
    few counts. A label without rows in a split shows null there.
    """
    known = df.where(F.col(split).isin(list(headers)))
    counts = known.groupBy(F.col(label).alias("label"), F.col(split).alias("split")).agg(F.count(F.lit(1)).alias("n"))
    cubed = counts.cube("label", "split").agg(
        F.sum("n").alias("n"), F.grouping("label").alias("_all_labels"), F.grouping("split").alias("_all_splits")
    )
    cells = cubed.select(
        F.when(F.col("_all_labels") == 1, TOTAL).otherwise(F.col("label").cast("string")).alias("label"),
        F.when(F.col("_all_splits") == 1, TOTAL).otherwise(F.col("split")).alias("split"),
        "_all_labels",
        "n",
    )
    table = cells.groupBy("_all_labels", "label").pivot("split", [*headers, TOTAL]).agg(F.first("n"))
    names = [F.col(k).alias(h) for k, h in headers.items()]
    return table.select("label", *names, TOTAL)


def samples_per_class(df: DataFrame, label: str) -> DataFrame:
    """Class sizes as one array in class order."""
    entries = F.sort_array(F.collect_list(F.struct(F.col(label), F.col("n"))))
    return value_counts(df, label).agg(F.transform(entries, lambda e: e["n"]).alias("samples_per_class"))


def status_counts(lookup: DataFrame) -> DataFrame:
    """Scans per lookup status."""
    return lookup.groupBy("status").agg(F.sum("scans").cast("bigint").alias("n"))


def partition_check(df: DataFrame, parts: Mapping[str, Column]) -> DataFrame:
    """Whether the parts cover the table without overlap, in one aggregate."""
    member = {name: F.coalesce(cond, F.lit(False)).cast("int") for name, cond in parts.items()}
    hits = sum(member.values(), F.lit(0))
    counted = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.coalesce(F.sum(m), F.lit(0)).cast("bigint").alias(f"n_{name}") for name, m in member.items()],
        F.count_if(hits > 1).alias("overlap"),
        F.count_if(hits == 0).alias("unmatched"),
    )
    return counted.withColumn("complete", ((F.col("overlap") == 0) & (F.col("unmatched") == 0)).cast("int"))
