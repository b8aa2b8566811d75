"""Folders listed and files written in tasks, one folder or file after the other.

A tree is listed level by level: a table of folders becomes a table of their entries,
whose folders are the next level. Entries never pass through the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortwise.session import materialize

ENTRIES = "path string, folder string, is_folder boolean, size bigint, depth int"
Entry = tuple[str, bool, int | None]
Lister = Callable[[str], Iterator[Entry]]

# Entries that a task hands on at once.
ENTRY_BATCH = 50_000


def open_system(path: str) -> tuple[fs.FileSystem, str, str]:
    """The file system of a path or address, the path there, and what stands before it."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    system, inner = fs.FileSystem.from_uri(path)
    return system, inner, path[: len(path) - len(inner)] if path.endswith(inner) else ""


def folder_entries(folder: str) -> Iterator[Entry]:
    """Paths of all entries of a folder, whether each is a folder, and sizes; nothing
    for a folder that is missing."""
    system, inner, before = open_system(folder)
    for info in system.get_file_info(fs.FileSelector(inner, allow_not_found=True)):
        yield before + info.path, info.type == fs.FileType.Directory, info.size


def _listed(lister: Lister):
    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder, depth in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held: list[Entry] = []
                for entry in lister(folder):
                    held.append(entry)
                    if len(held) >= ENTRY_BATCH:
                        yield _batch(folder, depth, held)
                        held = []
                yield _batch(folder, depth, held)

    return entries


def _batch(folder: str, depth: int, held: list[Entry]) -> pa.RecordBatch:
    n = len(held)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([e[0] for e in held], pa.string()),
            pa.array([folder] * n, pa.string()),
            pa.array([e[1] for e in held], pa.bool_()),
            pa.array([e[2] for e in held], pa.int64()),
            pa.array([depth + 1] * n, pa.int32()),
        ],
        [c.split()[0] for c in ENTRIES.split(", ")],
    )


def list_tree(
    spark: SparkSession, roots: str | Sequence[str], levels: int | None = None, lister: Lister = folder_entries
) -> DataFrame:
    """Every entry below the roots: ``path, folder, is_folder, size, depth``.

    All names count, also those that begin with a dot or underscore, and empty files
    and folders. ``levels`` limits the depth, from 1 for the entries of the roots
    themselves. Missing roots have no entries. Each level is one stored table, listed
    by tasks that all see the folders: a path on a shared file system that Arrow knows,
    or whatever ``lister`` can open. A folder is listed by one task; links are followed.
    """
    roots = [roots] if isinstance(roots, str) else list(roots)
    folders = spark.createDataFrame([(r.rstrip("/") or "/", 0) for r in roots], "folder string, depth int")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = None
    while levels is None or levels > 0:
        # The number of tasks is given, so that small folders are not gathered into one.
        level = materialize(folders.repartition(tasks, "folder").mapInArrow(_listed(lister), ENTRIES), "listing")
        found = level if found is None else found.unionByName(level)
        levels = None if levels is None else levels - 1
        folders = level.where("is_folder").select(F.col("path").alias("folder"), "depth")
        if folders.isEmpty():
            break
    return spark.createDataFrame([], ENTRIES) if found is None else found


def _written(root: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, inner, _ = open_system(root)
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                target = f"{inner.rstrip('/')}/{name}"
                if content is None:
                    system.create_dir(target, recursive=True)
                    continue
                system.create_dir(target.rsplit("/", 1)[0], recursive=True)
                draft = f"{inner.rstrip('/')}.{uuid.uuid4().hex}"
                with system.open_output_stream(draft) as out:
                    out.write(content)
                system.move(draft, target)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    return write


def write_files(df: DataFrame, root: str, name: str = "name", content: str = "content") -> None:
    """One file per row below a root, written by tasks; a row without content is a folder.

    Files appear whole, and a task that runs again writes the same. Names must differ
    and stay below the root.
    """
    inside = ~F.col(name).rlike(r"(^|/)\.\.(/|$)|^/")
    safe = F.when(inside, F.col(name)).otherwise(F.raise_error(F.concat(F.lit("not below the root: "), F.col(name))))
    rows = df.select(safe.alias("name"), F.col(content).cast("binary").alias("content"))
    rows.mapInArrow(_written(root), "n bigint").write.format("noop").mode("overwrite").save()
