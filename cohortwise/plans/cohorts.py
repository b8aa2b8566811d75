"""Cohort loaders and whole preparation flows, composed from the operators.

Every loader gives one table of samples with ``image_files``, ``labels`` and a
``split`` column, next to the columns of its source.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from cohortwise.functions import labels as L
from cohortwise.functions.names import base_name, join_path
from cohortwise.operators.classes import class_codes
from cohortwise.operators.joins import check_unique, list_membership, scan_lookup, split_by_lists
from cohortwise.operators.rows import (
    EXCLUDED_SCANS,
    IMAGE,
    LABEL,
    drop_nulls,
    filter_paths,
    parts_by_column,
    positives_only,
    sample_pair,
    subset_to_class,
    with_path,
)
from cohortwise.operators.sampling import SAMPLE_TO_VALUE, TEST_SIZE, prepare_splits
from cohortwise.operators.sets import combine_datasets, replicate_class
from cohortwise.operators.summary import percent_text, share
from cohortwise.session import materialize
from cohortwise.sources.files import list_tree
from cohortwise.sources.scans import class_dir_files
from cohortwise.sources.sinks import batches, export_batches

# Fixed values
TEST_LIST = "test"
COLUMN_PARTS = {"train": "train", "validate": "val", "test": "test"}


@dataclass(frozen=True)
class CohortSpec:
    """How to read a cohort from its patient table."""

    key: str
    target: str
    scan_folder: str = ""
    positive: Column | None = None
    mode: str = "train"


def cohort_by_list(metadata: DataFrame, lists: Mapping[str, DataFrame], spec: CohortSpec) -> DataFrame:
    """Cohort whose splits are given as lists of keys; the key is the file name."""
    kept = metadata if spec.positive is None else positives_only(metadata, spec.positive, spec.target, spec.mode)
    parts = split_by_lists(kept, lists, spec.key)
    return with_path(parts, spec.scan_folder, spec.key).withColumn(LABEL, F.col(spec.target))


def cohort_by_column(metadata: DataFrame, spec: CohortSpec, column: str = "split", image: str = IMAGE) -> DataFrame:
    """Cohort whose splits are named in a column train / validate / test."""
    kept = metadata if spec.positive is None else positives_only(metadata, spec.positive, spec.target, spec.mode)
    parts = parts_by_column(kept, column, COLUMN_PARTS)
    return with_path(parts, spec.scan_folder, image).withColumn(LABEL, F.col(spec.target))


def cohort_by_dirs(
    train: DataFrame, test: DataFrame, times: int = 1, classes: DataFrame | None = None
) -> DataFrame:
    """Cohort from listings of class-per-folder trees. The first class is
    repeated in the train part; ``copy`` numbers the repeats.

    Both parts share one code per class: its place among the class names of both
    listings, or among those of ``classes`` (a column ``class_name``), where folders
    without files are known.
    """
    parts = class_dir_files(train).withColumn("split", F.lit("train"))
    parts = parts.unionByName(class_dir_files(test).withColumn("split", F.lit("test")))
    codes = class_codes((parts if classes is None else classes).select(F.col("class_name").alias("_name")), "_name", LABEL)
    coded = parts.join(codes, F.col("class_name") == F.col("_name"), "left").select(IMAGE, "class_name", LABEL, "split")
    return (
        replicate_class(coded.where("split = 'train'").drop("split"), LABEL, 0, times)
        .withColumn("split", F.lit("train"))
        .unionByName(coded.where("split = 'test'").withColumn("copy", F.lit(1)))
    )


def cohort_from_tree(spark, root: str, times: int = 1) -> DataFrame:
    """`cohort_by_dirs` over the folders ``train`` and ``test`` of a tree, listed once;
    class folders without files count as classes."""
    folders = [f"{root.rstrip('/')}/{part}" for part in ("train", "test")]
    entries = {f: list_tree(spark, f) for f in folders}
    files = [e.where(~F.col("is_folder")).select("path") for e in entries.values()]
    named = [e.where("is_folder AND depth = 1").select(base_name(F.col("path")).alias("class_name")) for e in entries.values()]
    return cohort_by_dirs(*files, times, named[0].unionByName(named[1]))


def cohort_by_lookup(
    listing: DataFrame,
    patients: DataFrame,
    folder: str,
    id_column: str,
    target: str,
    keep: Callable[[Column], Column] | None = None,
    exclude: Sequence[str] = EXCLUDED_SCANS,
) -> DataFrame:
    """Cohort of scans whose number is found in a patient table; one row per patient."""
    check_unique(patients, id_column)
    wanted = filter_paths(listing, "path", keep or (lambda p: base_name(p) != ""), exclude)
    found = scan_lookup(wanted, "path", patients, id_column, target).where("status = 'ok'")
    samples = drop_nulls(found.select("patient", "filename", "target"))
    return samples.select(
        "patient", join_path(F.lit(folder), F.col("filename")).alias(IMAGE), F.col("target").alias(LABEL)
    )


def preprocess(samples: DataFrame, classes: Sequence = (), use_subset: bool = True) -> DataFrame:
    """Samples of the wanted classes as a stored table of path and label."""
    pairs = sample_pair(samples)
    return materialize(subset_to_class(pairs, LABEL, classes) if use_subset else pairs, "preprocessed")


Loader = Callable[[], DataFrame]


def load_cohort(name: str, loaders: Mapping[str, Loader], extras: Mapping[str, Loader] | None = None) -> DataFrame:
    """Samples of the named cohort, extended split by split by extra cohorts.

    ``loaders`` is the registry; user loaders are further entries. Extras must
    have the columns of the cohort.
    """
    if name not in loaders:
        raise ValueError(f"no cohort {name!r}; known are {sorted(loaders)}")
    return combine_datasets({name: loaders[name](), **{n: load() for n, load in (extras or {}).items()}})


def explore(
    metadata: DataFrame,
    lists: Mapping[str, DataFrame],
    key: str,
    labels: str,
    positive: str,
    allowed: Sequence[str],
) -> DataFrame:
    """Size and positive share of both label versions, whole and by split list,
    and of the test part restricted to the allowed labels.

    Version 1 takes every row; version 2 leaves out rows that mix the positive
    class with others. ``percent`` is the positive share; ``unlisted`` counts
    rows that no list names and ``overlap`` those in several. All figures come
    from one grouped pass over the joined table.
    """
    arrays = metadata.select(key, L.split_labels(F.col(labels)).alias("_labels"))
    listed = arrays.join(list_membership(lists, key), key, "left")
    flags = listed.select(
        F.coalesce("parts", F.array().cast("array<string>")).alias("parts"),
        L.label_any(F.col("_labels"), positive).alias("positive"),
        L.mixed_positive(F.col("_labels"), positive).alias("mixed"),
        L.within(F.col("_labels"), allowed).alias("allowed"),
    )
    counted = flags.groupBy("parts", "positive", "mixed", "allowed").agg(F.count(F.lit(1)).alias("n"))

    # From here on at most (list combinations x 8) rows.
    versions = counted.withColumn(
        "version", F.explode(F.when(F.col("mixed"), F.array(F.lit(1))).otherwise(F.array(F.lit(1), F.lit(2))))
    )
    in_test = F.array_contains("parts", TEST_LIST)
    restricted = F.when(in_test & F.col("allowed"), F.array(F.lit("restricted_test")))
    parts = F.concat(F.array(F.lit("all")), F.col("parts"), F.coalesce(restricted, F.array().cast("array<string>")))
    rows = versions.withColumn("part", F.explode(parts))
    is_all = F.col("part") == "all"
    summed = rows.groupBy("version", "part").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("positive") == 1, F.col("n")).otherwise(0)).alias("n_positive"),
        F.sum(F.when(is_all & (F.size("parts") == 0), F.col("n")).otherwise(0)).alias("unlisted"),
        F.sum(F.when(is_all & (F.size("parts") > 1), F.col("n")).otherwise(0)).alias("overlap"),
    )
    percent = share(F.col("n_positive"), F.col("n"))
    return summed.select(
        "version", "part", "n", "n_positive", (F.col("n") - F.col("n_positive")).alias("n_negative"),
        F.round(percent, 6).alias("percent"), percent_text(percent).alias("percent_text"), "unlisted", "overlap",
    )


def dealt_job(
    samples: DataFrame,
    keys: Sequence[str],
    seed: int,
    test_size: float = TEST_SIZE,
    sampling: str | None = None,
    value: int = SAMPLE_TO_VALUE,
    generated: DataFrame | None = None,
) -> DataFrame:
    """A cohort with train and test rows dealt into train, val and test. The cohort and
    the dealt rows are written once each, by split, as the fitted steps read them
    several times. Drawn rows have a ``draw`` number, all others null."""
    stored = materialize(samples, "samples", ["split"])
    train = stored.where("split = 'train'").drop("split")
    parts = prepare_splits(train, LABEL, keys, seed, test_size, generated, sampling=sampling, value=value)
    test = stored.where("split = 'test'").withColumn("draw", F.lit(None).cast("bigint"))
    return materialize(parts.unionByName(test.select(parts.columns)), "dealt", ["split"])


def prepare_job(
    samples: DataFrame,
    keys: Sequence[str],
    order: str,
    seed: int,
    batch_size: int,
    test_size: float = TEST_SIZE,
    sampling: str | None = None,
    value: int = SAMPLE_TO_VALUE,
    generated: DataFrame | None = None,
) -> DataFrame:
    """From a cohort to numbered batches of train, val and test; see `dealt_job`."""
    dealt = dealt_job(samples, keys, seed, test_size, sampling, value, generated)
    return batches(dealt, [*keys, "draw"], order, batch_size, seed)


def export_job(
    samples: DataFrame,
    path: str,
    keys: Sequence[str],
    order: str,
    seed: int,
    batch_size: int,
    test_size: float = TEST_SIZE,
    sampling: str | None = None,
    value: int = SAMPLE_TO_VALUE,
    generated: DataFrame | None = None,
) -> None:
    """The whole job: from a cohort to written batches, each within one file."""
    dealt = dealt_job(samples, keys, seed, test_size, sampling, value, generated)
    export_batches(dealt, path, [*keys, "draw"], order, batch_size, seed)
