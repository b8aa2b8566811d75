"""What the operators share: tables, working copies, words and sorted groups."""

from __future__ import annotations

import gc
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cohortwise.session import delete_path, drop_scratch, scratch_path

# Words remembered by a task; the memory is emptied when full.
WORD_MEMORY = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Workspace:
    """Working copies of one run, in one folder of the shared checkpoint folder.

    Frames that read them stay valid until ``remove`` or the end of the driver, which
    removes them also where the session was stopped before.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.count = spark, scratch_path(spark, name), 0

    def keep(self, df: DataFrame, name: str) -> tuple[DataFrame, str]:
        """The frame written and read again, and where it lies."""
        self.count += 1
        path = f"{self.root}/{self.count:03d}-{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), path

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        return self.keep(df, name)[0]

    def drop(self, *paths: str) -> None:
        for path in paths:
            delete_path(path)

    def release(self) -> None:
        """Shuffle files of finished steps go once the driver's JVM has found that
        nothing reads them; this makes it look now, before the next large step."""
        gc.collect()
        self.spark._jvm.System.gc()

    def remove(self) -> None:
        drop_scratch(self.root)


def bucket(key: Column, n: int) -> Column:
    """crc32 of a key's text, modulo n; a null key counts as the text 'null'."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("null"))) % n


class WordHashes(dict):
    """64-bit hash of a token (bytes), remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_MEMORY:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: Sequence[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


# The separators of words, an odd factor and its inverse modulo 2^64.
SEPARATOR = np.isin(np.arange(256), [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
FACTOR = 0xD6E8FEB86659FD93
INVERSE = pow(FACTOR, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((FACTOR, INVERSE)):
            steps = np.full(2 * n, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=np.uint64)
    return _powers


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` of a whole text, A-Z in
    lower case, in order.

    A word's hash is a polynomial in its UTF-8 bytes, modulo 2^64, spread by
    ``mix``; all words come from one running sum over the text. The separators are
    single bytes that occur in no other character, and ``lower`` of bytes changes
    A-Z alone.
    """
    if not text:
        return np.zeros(0, np.uint64)
    data = np.frombuffer(text.encode().lower(), np.uint8)
    space = SEPARATOR[data]
    edges = np.flatnonzero(np.diff(space, prepend=True, append=True))
    starts, ends = edges[::2], edges[1::2]
    power, inverse = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data + np.uint64(1)) * power[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values (finalizer of a public hash function)."""
    values = values.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        values ^= values >> np.uint64(33)
        values *= np.uint64(0xFF51AFD7ED558CCD)
        values ^= values >> np.uint64(33)
        values *= np.uint64(0xC4CEB9FE1A85EC53)
        values ^= values >> np.uint64(33)
    return values


def sorted_groups(batches: Iterable[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal integer keys, out of batches sorted by them.

    One group is held at a time, so groups must be of bounded size.
    """
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        if rest:
            last = [rest[-1].column(rest[-1].schema.get_field_index(k))[-1].as_py() for k in keys]
            change[0] = any(c[0] != v for c, v in zip(cols, last))
        starts = np.flatnonzero(change)
        if rest and len(starts) and starts[0] == 0:
            yield pa.Table.from_batches(rest)
            rest = []
        cuts = [0, *[int(s) for s in starts if s > 0], batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            part = batch.slice(a, b - a)
            if a == 0:
                rest.append(part)
            else:
                yield pa.Table.from_batches(rest)
                rest = [part]
    if rest:
        yield pa.Table.from_batches(rest)


def matrix(column: pa.ChunkedArray | pa.Array, dtype) -> np.ndarray:
    """A list column whose lists are of one length, as rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(dtype, copy=False)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A few rows of numbers known to the driver, ready to broadcast."""
    names, types = zip(*(c.split() for c in schema.split(", ")))
    values = ", ".join("(" + ", ".join(f"CAST({v!r} AS {t})" for v, t in zip(row, types)) + ")" for row in rows)
    return F.broadcast(spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(names)})"))
