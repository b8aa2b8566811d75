"""Projections and row filters."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cohortwise.functions import labels as L
from cohortwise.functions.names import join_path

# Fixed values
IMAGE, LABEL = "image_files", "labels"
EXCLUDED_SCANS = ("_mask.nii.gz",)
CLASS_CONDITIONED = "class_conditioned_labels"
DIFFUSION = "diffusion"


def with_path(df: DataFrame, base: str, name: str, path: str = IMAGE) -> DataFrame:
    """Full path from a base folder and a file name column."""
    return df.withColumn(path, join_path(F.lit(base), F.col(name).cast("string")))


def sample_pair(df: DataFrame, image: str = IMAGE, label: str = LABEL) -> DataFrame:
    """Path and label alone."""
    return df.select(F.col(image).alias(IMAGE), F.col(label).alias(LABEL))


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Without the named columns; an unknown name is an error."""
    unknown = [c for c in columns if c not in df.columns]
    if unknown:
        raise ValueError(f"no such columns: {unknown}")
    return df.drop(*columns)


def subset_to_class(df: DataFrame, label: str, wanted: Sequence) -> DataFrame:
    """Rows whose label is in the list; all rows for an empty list."""
    return df.where(F.col(label).isin(list(wanted))) if len(wanted) else df


def create_subset(df: DataFrame, target: str, wanted: Sequence[str] = ()) -> DataFrame:
    """Rows whose label string contains, or whose label array holds, any wanted label.
    All rows when no wanted label is set."""
    if not any(wanted):
        return df
    if df.schema[target].dataType.typeName() == "array":
        return df.where(F.arrays_overlap(F.col(target), F.array(*[F.lit(w) for w in wanted])))
    return df.where(L.contains_any(F.col(target), wanted))


def filter_paths(
    df: DataFrame,
    path: str,
    keep: Callable[[Column], Column] | None = None,
    exclude: Sequence[str] = EXCLUDED_SCANS,
) -> DataFrame:
    """Paths that satisfy the predicate and contain none of the excluded parts."""
    wanted = ~L.contains_any(F.col(path), exclude)
    return df.where(wanted if keep is None else keep(F.col(path)) & wanted)


def positives_only(df: DataFrame, positive: Column, target: str, mode: str) -> DataFrame:
    """Positive rows alone in diffusion mode, unless labels condition the classes."""
    if target == CLASS_CONDITIONED or DIFFUSION not in mode:
        return df
    return df.where(positive == 1)


def parts_by_column(df: DataFrame, column: str, names: Mapping[str, str]) -> DataFrame:
    """Rows of the named parts, with the part name in ``split``."""
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return df.where(F.col(column).isin(list(names))).withColumn("split", F.element_at(table, F.col(column)))


def restrict_to_subset(df: DataFrame, labels: str, allowed: Sequence[str]) -> DataFrame:
    """Rows all of whose labels are allowed."""
    return df.where(L.within(F.col(labels), allowed))


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(subset=list(subset) if subset else None)


def int_targets(df: DataFrame, target: str, name: str = "target") -> DataFrame:
    """Rows with an integer target; others are skipped."""
    return df.withColumn(name, L.int_target(F.col(target))).where(F.col(name).isNotNull())


def to_metaclass(
    df: DataFrame, target: str, positive: str, negative: str | None = None, drop: bool = True
) -> DataFrame:
    """Target replaced by its two-way label; the old one is kept on request."""
    changed = df.withColumn(f"old_{target}", F.col(target)).withColumn(
        target, L.metaclass(F.col(target), positive, negative)
    )
    return changed.drop(f"old_{target}") if drop else changed


def label_any(df: DataFrame, labels: str, positive: str, name: str = LABEL) -> DataFrame:
    """Label 1 for rows having the class, 0 for all others."""
    return df.withColumn(name, L.label_any(F.col(labels), positive))


def label_exclusive(df: DataFrame, labels: str, positive: str, name: str = LABEL) -> DataFrame:
    """As `label_any`, without the rows that mix the class with another one."""
    return label_any(df.where(~L.mixed_positive(F.col(labels), positive)), labels, positive, name)


def log_interval(max_epochs: int) -> int:
    """Default distance between logged epochs: ten logs per run."""
    return max(max_epochs // 10, 1)


def every_kth(df: DataFrame, column: str, k: int) -> DataFrame:
    """Every k-th epoch."""
    return df.where(F.col(column) % k == 0)
