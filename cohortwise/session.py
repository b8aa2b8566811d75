"""Session settings, the scratch folder, and small fitted tables."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JError
from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession, functions as F

# Largest fitted table (class lists, quotas, cut values) brought to the driver
# and broadcast. Beyond it the same table stays a distributed DataFrame.
FIT_ROWS = 10_000
FIT_BYTES = 8_000_000

# Scratch folders, each with the file system settings it was made under.
_scratch: dict[str, object] = {}
_own_folders: list[str] = []


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session with the settings the engine expects; on a cluster use
    the session the cluster hands out."""
    return (
        SparkSession.builder.master(master)
        .appName("cohortwise")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written intermediate table, which is removed when the
    driver ends, or by `remove_scratch`.

    The shared folder is the session's ``spark.checkpoint.dir``. Only a local
    session without that setting gets a folder of its own; on a cluster a
    machine-local folder would be lost with its executor, so that is an error.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        _own_folders.append(tempfile.mkdtemp(prefix="cohortwise-"))
        context.setCheckpointDir(_own_folders[-1])
        root = context.getCheckpointDir()
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _scratch[path] = _settings()
    return path


def fitted_or_stored(df: DataFrame, limit: int | None = None) -> tuple[DataFrame, bool]:
    """Evaluate a fit result once: ready to broadcast, and True, if it is small.

    At most ``limit + 1`` rows reach the driver. A result of more rows, or of more than
    `FIT_BYTES`, is stored instead and comes back without a hint, so that Spark joins
    it by its own size rules and nothing reads the data behind it again.
    """
    limit = FIT_ROWS if limit is None else limit
    held = df.persist()  # for the look at its size and, if that is large, the copy
    try:
        table = held.limit(limit + 1).toArrow()
        if table.num_rows > limit or table.nbytes > FIT_BYTES:
            return materialize(held, "fit"), False
    finally:
        held.unpersist()
    return F.broadcast(df.sparkSession.createDataFrame(table, schema=df.schema)), True


def fitted(df: DataFrame, limit: int | None = None) -> DataFrame:
    """The result of `fitted_or_stored`, whichever it is."""
    return fitted_or_stored(df, limit)[0]


def delete_path(path: str) -> None:
    """Delete a folder of any file system. The JVM outlives the sessions in it, so this
    works after ``spark.stop()``, too."""
    target = SparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(_scratch.get(path) or _settings()).delete(target, True)


def _settings():
    context = SparkContext._active_spark_context
    if context is not None and context._jsc is not None:
        return context._jsc.hadoopConfiguration()
    return SparkContext._jvm.org.apache.hadoop.conf.Configuration()


def drop_scratch(path: str) -> None:
    """Remove one scratch table or folder before its time."""
    delete_path(path)
    _scratch.pop(path, None)


def remove_scratch(spark: SparkSession | None = None) -> None:
    """Remove the scratch tables made so far, those that a frame still reads too."""
    for path in list(_scratch):
        drop_scratch(path)


def _remove_at_exit() -> None:
    if SparkContext._jvm is None:  # nothing was ever written
        return
    try:
        remove_scratch()
        for folder in _own_folders:
            delete_path(f"file:{folder}")
    except (Py4JError, OSError):  # the JVM went down before its driver
        pass


atexit.register(_remove_at_exit)


def materialize(df: DataFrame, name: str = "table", by: Sequence[str] = ()) -> DataFrame:
    """The table written to the shared scratch folder and read back. Cuts the
    lineage, and the copy outlives the executors that wrote it. Columns ``by``
    are its folders, so that a part is read without the others."""
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
