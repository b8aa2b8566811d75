"""Sources: metadata tables, split lists, file listings."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from cohortwise.functions.names import base_name, parent_name, zero_pad
from cohortwise.operators.classes import encode
from cohortwise.operators.rows import IMAGE, LABEL
from cohortwise.sources.files import list_tree

Reader = Callable[[SparkSession, str], DataFrame]

# Fixed values
IGNORED_FILE = ".DS_Store"
SHARD_COUNT = 12
SHARD_FOLDER = "images"
LATEST = "latest"
# Beginnings of names below a version: the folder of a copy, and the mark of a whole one.
COPY = "copy-"
MARK = "_whole-"


def csv_reader(schema: StructType | str) -> Reader:
    """Reader for CSV files with a header and a known schema."""
    return lambda spark, path: spark.read.schema(schema).option("header", True).csv(path)


def scan_metadata(spark: SparkSession, path: str, reader: Reader) -> DataFrame:
    return reader(spark, path)


def cached_table(
    spark: SparkSession,
    root: str,
    name: str,
    version: str,
    fetch: Callable[[], DataFrame],
    fmt: str = "parquet",
    schema: StructType | str | None = None,
) -> DataFrame:
    """The stored copy of ``name`` at ``version``; fetched and stored when absent.

    ``latest`` means the highest stored version, numbers in it compared by value;
    a version without a number counts only where none has one. When nothing is
    stored yet, the fetched copy is stored under that name.
    Formats without a schema of their own, such as CSV, need ``schema``.

    Each writer fills a folder of its own and, once that is whole, sets an empty mark
    beside it. A version is present when a copy has its mark, so a broken write counts
    as absent and does no harm. Of several writers the first mark wins; the others take
    back their copies and read the winner's.
    """
    base = f"{root.rstrip('/')}/name={name}"
    if version == LATEST:
        version = latest_version(spark, base) or LATEST
    path = f"{base}/version={version}"
    if not committed_copies(spark, path):
        _store_copy(spark, path, fetch(), fmt)
    reader = spark.read.format(fmt).option("header", True)
    return (reader.schema(schema) if schema else reader).load(f"{path}/{COPY}{committed_copies(spark, path)[0]}")


def _store_copy(spark: SparkSession, path: str, df: DataFrame, fmt: str) -> None:
    own = uuid.uuid4().hex
    folder = f"{path}/{COPY}{own}"
    df.write.format(fmt).option("header", True).save(folder)
    system, mark = _hadoop(spark, f"{path}/{MARK}{own}")
    system.createNewFile(mark)
    if committed_copies(spark, path)[0] != own:
        system.delete(mark, False)
        system.delete(_hadoop(spark, folder)[1], True)


def committed_copies(spark: SparkSession, path: str) -> list[str]:
    """Ids of a version's whole copies, the one marked first in front."""
    system, folder = _hadoop(spark, path)
    if not system.exists(folder):
        return []
    marks = [(f.getModificationTime(), f.getPath().getName()) for f in system.listStatus(folder)]
    return [name.removeprefix(MARK) for _, name in sorted(marks) if name.startswith(MARK)]


def latest_version(spark: SparkSession, base: str) -> str | None:
    """Highest version folder that holds a whole copy; None when there is none."""
    names = [n.removeprefix("version=") for n in folder_names(spark, base) if n.startswith("version=")]
    parts = lambda v: [int(t) if t.isdigit() else t for t in re.split(r"(\d+)", v)]
    numbered = [n for n in names if re.search(r"\d", n)]
    for name in [*sorted(numbered, key=parts, reverse=True), *sorted(set(names) - set(numbered), reverse=True)]:
        if committed_copies(spark, f"{base}/version={name}"):
            return name
    return None


def _hadoop(spark: SparkSession, path: str):
    """The file system of a path, and the path as it takes it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the version folders right below a path, on the driver."""
    system, folder = _hadoop(spark, path)
    if not system.exists(folder):
        return []
    return [f.getPath().getName() for f in system.listStatus(folder) if f.isDirectory()]


def scan_id_list(spark: SparkSession, path: str, name: str = "id") -> DataFrame:
    """One id per line, white space around it stripped."""
    return spark.read.text(path).select(F.regexp_replace("value", r"^\s+|\s+$", "").alias(name))


def list_files(spark: SparkSession, path: str | Sequence[str], levels: int | None = None) -> DataFrame:
    """Paths of all files below one or several folders, whatever their names and sizes.
    Tasks list the folders; see `files.list_tree`."""
    return list_tree(spark, path, levels).where(~F.col("is_folder")).select("path")


def class_dir_files(listing: DataFrame, path: str = "path") -> DataFrame:
    """Path and class name of the files of a class-per-folder tree."""
    return listing.where(base_name(F.col(path)) != IGNORED_FILE).select(
        F.col(path).alias(IMAGE), parent_name(F.col(path)).alias("class_name")
    )


def class_dir_samples(listing: DataFrame, path: str = "path") -> DataFrame:
    """Samples of a class-per-folder tree: path, class name, dense class code."""
    return encode(class_dir_files(listing, path), "class_name", LABEL)


def scan_class_dirs(spark: SparkSession, root: str) -> DataFrame:
    return class_dir_samples(list_files(spark, root))


def shard_folders(count: int = SHARD_COUNT) -> list[str]:
    """Folder names of the numbered shards."""
    return [f"{SHARD_FOLDER}_{i:03d}" for i in range(1, count + 1)]


def shard_path(shard, name):
    """Path of a file in its numbered shard."""
    return F.concat_ws("/", F.concat(F.lit(f"{SHARD_FOLDER}_"), zero_pad(shard, 3)), F.lit(SHARD_FOLDER), name)


def shard_files(listing: DataFrame, path: str = "path", count: int = SHARD_COUNT) -> DataFrame:
    """File name and path of the files that lie in one of the numbered shards."""
    shard = F.regexp_extract(path, rf"(?:^|/)({SHARD_FOLDER}_\d{{3}})/{SHARD_FOLDER}/[^/]+$", 1)
    return listing.where(shard.isin(shard_folders(count))).select(
        base_name(F.col(path)).alias("name"), F.col(path).alias(IMAGE)
    )


def scan_shards(spark: SparkSession, root: str, count: int = SHARD_COUNT) -> DataFrame:
    """Files of the numbered shards; each shard folder is listed by its name, and shards
    that are missing are empty."""
    folders = [f"{root.rstrip('/')}/{name}/{SHARD_FOLDER}" for name in shard_folders(count)]
    return shard_files(list_files(spark, folders, 1), count=count)


def flat_files(listing: DataFrame, path: str = "path") -> DataFrame:
    """Name and path of each listed file."""
    return listing.select(base_name(F.col(path)).alias("name"), F.col(path))


def scan_flat_dir(spark: SparkSession, root: str) -> DataFrame:
    """Files of a folder, without those of folders in it."""
    return flat_files(list_files(spark, root, 1))
