"""Row positions in a fixed order, for groups of any size.

A plain ``row_number`` sorts each group in one task. Here every group is cut
into chunks that follow the order; the rows before a chunk are known from the
chunk sizes, and only the inside of a chunk is sorted. A class with a third of
all rows is thus spread over thousands of chunks.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from cohortwise.session import fitted, materialize

# Chunks of a group per shuffle partition, at least.
CHUNKS_PER_PARTITION = 4

# Most ranges a numeric sort is cut into.
MAX_RANGES = 4096

# Most equal values a chunk may hold by estimate.
MAX_EQUAL = 1_000_000

GROUP, CHUNK, HASH = "_group", "_chunk", "_hash"


def group_of(by: Sequence[str]) -> Column:
    """Group columns as one struct, so that null group values join too."""
    return F.struct(*[F.col(c).alias(c) for c in by]) if by else F.struct(F.lit(0).alias("all"))


def seeded_hash(seed: int | str, keys: Sequence[str]) -> Column:
    """Order key of a row: md5 of seed and key. It does not depend on
    partitioning, so every draw can be repeated."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def wanted_chunks(spark: SparkSession) -> int:
    """Chunks to cut a group into: some per shuffle partition, so that a chunk
    stays small on a cluster that is set up for more data."""
    return CHUNKS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))


def hash_chunk(spark: SparkSession, hashed: Column) -> Column:
    """Leading hex digits of the hash: 256 chunks per group or more. The hash is
    evenly spread, so chunks of a group are of equal size."""
    digits = math.ceil(math.log(wanted_chunks(spark), 16))
    return F.substring(hashed, 1, max(2, min(5, digits)))


def chunk_sizes(chunked: DataFrame) -> DataFrame:
    """Rows per group and chunk."""
    return chunked.groupBy(GROUP, CHUNK).agg(F.count(F.lit(1)).alias("_size"))


def chunk_starts(sizes: DataFrame) -> DataFrame:
    """Chunk sizes with the number of rows of the group before each chunk."""
    before = Window.partitionBy(GROUP).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("_start", F.coalesce(F.sum("_size").over(before), F.lit(0)))


def rank_in_chunks(
    df: DataFrame, chunk: Column, order: Sequence[str | Column], by: Sequence[str] = (), name: str = "rank"
) -> DataFrame:
    """Row number from 1 within ``by`` in the given order.

    ``chunk`` must not fall while the order rises, nor be null. One shuffle of the rows, by
    group and chunk; the join with the chunk starts keeps that partitioning.
    """
    chunked = df.withColumn(GROUP, group_of(by)).withColumn(CHUNK, chunk)
    starts = chunk_starts(chunk_sizes(chunked.select(GROUP, CHUNK))).drop("_size")
    inside = Window.partitionBy(GROUP, CHUNK).orderBy(*order)
    return (
        chunked.withColumn("_inside", F.row_number().over(inside))
        .join(starts, [GROUP, CHUNK])
        .withColumn(name, (F.col("_start") + F.col("_inside")).cast("bigint"))
        .drop(GROUP, CHUNK, "_inside", "_start")
    )


def seeded_rank(
    df: DataFrame, keys: Sequence[str], seed: int | str, by: Sequence[str] = (), name: str = "rank"
) -> DataFrame:
    """Row number within ``by`` in seeded random order. ``keys`` must be unique."""
    hashed = df.withColumn(HASH, seeded_hash(seed, keys))
    return rank_in_chunks(hashed, hash_chunk(df.sparkSession, F.col(HASH)), [HASH, *keys], by, name).drop(HASH)


def rows_at(
    df: DataFrame,
    positions: DataFrame,
    count: int,
    chunks: int,
    keys: Sequence[str],
    seed: int | str,
    by: Sequence[str] = (),
) -> DataFrame:
    """Rows at given places of the seeded order, a row as often as it is named.

    ``positions`` has the ``by`` columns, ``rank`` and further columns that are
    kept; ``count`` is its number of rows, which must be few. The chunk sizes tell
    in which chunk each place lies, and only rows of those chunks are shuffled and
    ranked. About ``chunks`` chunks are made of each group.
    """
    digits = max(2, min(5, round(math.log(max(chunks, 1), 16))))
    hashed = df.withColumn(HASH, seeded_hash(seed, keys)).withColumns(
        {GROUP: group_of(by), CHUNK: F.substring(HASH, 1, digits)}
    )
    starts = chunk_starts(chunk_sizes(hashed.select(GROUP, CHUNK)))
    kept = [c for c in positions.columns if c not in (*by, "rank")]
    marks = starts.select(GROUP, (F.col("_start") + 1).alias("rank"), CHUNK, "_start")
    asked = positions.select(group_of(by).alias(GROUP), "rank", *kept, F.lit(True).alias("_asked"))
    along = Window.partitionBy(GROUP).orderBy("rank", F.col("_asked").asc_nulls_first())
    located = (
        marks.unionByName(asked, allowMissingColumns=True)
        .withColumns({c: F.last(c, ignorenulls=True).over(along) for c in (CHUNK, "_start")})
        .where("_asked")
        .select(GROUP, CHUNK, (F.col("rank") - F.col("_start")).cast("int").alias("_inside"), *kept)
    )
    located = fitted(located, count)
    inside = F.row_number().over(Window.partitionBy(GROUP, CHUNK).orderBy(HASH, *keys))
    return (
        hashed.join(F.broadcast(located.select(GROUP, CHUNK).distinct()), [GROUP, CHUNK], "left_semi")
        .withColumn("_inside", inside)
        .join(located, [GROUP, CHUNK, "_inside"])
        .select(*df.columns, *kept)
    )


def range_chunk(df: DataFrame, order: Sequence[str]) -> tuple[DataFrame, Column]:
    """``df`` with a chunk column that follows the order of the given columns.

    A numeric first column is cut at approximate percentiles, fitted once and then
    fixed, so that a repeated task chunks its rows the same way. Where that leaves
    very many equal values in a chunk, and for other types, Spark sorts the rows
    into ranges over all order columns and stores them with the range number.
    """
    column = order[0]
    splits = _range_splits(df, column) if isinstance(df.schema[column].dataType, T.NumericType) else None
    if splits is None:
        ranged = df.repartitionByRange(wanted_chunks(df.sparkSession), *order).withColumn("_range", F.spark_partition_id())
        return materialize(ranged, "ranges"), F.col("_range")
    cutter = Bucketizer(splits=splits, inputCol="_value", outputCol="_range", handleInvalid="keep")
    ranged = cutter.transform(df.withColumn("_value", F.col(column).cast("double"))).drop("_value")
    # Nulls come first and have a range of their own.
    return ranged, F.coalesce("_range", F.lit(-1.0))


def _range_splits(df: DataFrame, column: str) -> list[float] | None:
    """Cut values of a numeric column; None when one value repeats too often."""
    chunks = max(64, min(MAX_RANGES, wanted_chunks(df.sparkSession)))
    shares = [i / chunks for i in range(1, chunks)]
    value = F.col(column).cast("double")
    fit = df.agg(F.percentile_approx(value, shares, 10 * chunks).alias("cuts"), F.count(F.lit(1)).alias("n")).first()
    repeats = Counter(fit.cuts or [])
    if repeats and max(repeats.values()) / chunks * fit.n > MAX_EQUAL:
        return None
    inner = sorted(c for c in repeats if math.isfinite(c)) or [0.0]
    return [-math.inf, *inner, math.inf]


def ordered_rank(df: DataFrame, column: str, keys: Sequence[str], by: Sequence[str] = (), name: str = "rank") -> DataFrame:
    """Row number within ``by`` in ascending order of a column, ties by key."""
    order = [column, *keys]
    chunked, chunk = range_chunk(df, order)
    return rank_in_chunks(chunked, chunk, order, by, name).drop("_range")


def assign_parts(
    df: DataFrame,
    quota_of: Callable[[DataFrame], DataFrame],
    parts: Sequence[str],
    keys: Sequence[str],
    seed: int | str,
    by: Sequence[str] = (),
    rest: str | None = None,
    name: str = "part",
) -> DataFrame:
    """Deal the rows of each group out to parts, in seeded order.

    The first rows of a group go to the first part, as many as its quota says,
    the next ones to the second part, and so on; what is left gets ``rest``.
    ``quota_of`` is given the group sizes (the ``by`` columns and ``n``) and adds
    one quota column per part; a quota beyond the group takes what is there.
    ``keys`` must be unique.

    The rows are never shuffled. The chunk sizes tell in which chunk a part ends;
    only that chunk, a small share of the group, is ranked. Its row at the end
    of the part becomes the cut value that all rows are compared with.
    """
    hashed = df.withColumn(HASH, seeded_hash(seed, keys))
    # Without groups the group is an empty text, but not a literal: Spark would
    # turn a join on literals into a cross join.
    group = group_of(by) if by else F.struct(F.substring(HASH, 1, 0).alias("all"))
    narrow = hashed.select(group.alias(GROUP), HASH, hash_chunk(df.sparkSession, F.col(HASH)).alias(CHUNK), *keys)
    sizes = chunk_sizes(narrow.select(GROUP, CHUNK))

    counts = sizes.groupBy(GROUP).agg(F.sum("_size").alias("n"))
    quotas = quota_of(counts.select(GROUP, *[F.col(f"{GROUP}.{c}").alias(c) for c in by], "n"))
    upto, stops = F.lit(0), []
    for i, part in enumerate(parts):
        upto = upto + F.col(part)
        stops.append(F.struct(F.lit(i).alias("_part"), F.least(upto, F.col("n")).cast("bigint").alias("_upto")))
    stops = quotas.select(GROUP, F.inline(F.array(*stops)))
    ends = (
        chunk_starts(sizes)
        .join(stops, GROUP)
        .withColumn("_need", F.col("_upto") - F.col("_start"))
        .where((F.col("_need") > 0) & (F.col("_need") <= F.col("_size")))
        .select(GROUP, CHUNK, "_part", "_need")
    )

    in_order = Window.partitionBy(GROUP, "_part").orderBy(HASH, *keys)
    row = F.struct(HASH, *keys)
    twice = F.raise_error(F.lit(f"{list(keys)} must be unique; a part ends at a repeated key")).cast("boolean")
    at_end = (
        narrow.join(fitted(ends), [GROUP, CHUNK])
        .withColumns({"_position": F.row_number().over(in_order), "_next": F.lead(row).over(in_order)})
        .where(F.col("_position") == F.col("_need"))
        .where(F.when(F.col("_next") == row, twice).otherwise(F.lit(True)))
    )
    cuts = at_end.groupBy(GROUP).agg(
        *[F.max(F.when(F.col("_part") == i, row)).alias(f"_cut_{i}") for i in range(len(parts))]
    )
    if by:
        placed = df.withColumn(GROUP, group_of(by)).join(fitted(cuts), GROUP, "left")
    else:
        placed = with_constants(df, cuts.drop(GROUP))
    own = F.struct(seeded_hash(seed, keys).alias(HASH), *[F.col(k) for k in keys])
    choice = F.when(F.lit(False), F.lit(None).cast("string"))
    for i, part in enumerate(parts):
        choice = choice.when(own <= F.col(f"_cut_{i}"), F.lit(part))
    return placed.select(*df.columns, choice.otherwise(F.lit(rest).cast("string")).alias(name))


def with_constants(df: DataFrame, values: DataFrame) -> DataFrame:
    """The struct columns of a table of at most one row, as constant columns."""
    row = values.first()

    def constant(field: T.StructField) -> Column:
        value = row[field.name] if row else None
        if value is None:
            return F.lit(None).cast(field.dataType)
        return F.struct(*[F.lit(value[f.name]).cast(f.dataType).alias(f.name) for f in field.dataType.fields])

    return df.withColumns({f.name: constant(f) for f in values.schema.fields})


def pick_first(
    df: DataFrame, quota_of: Callable[[DataFrame], DataFrame], keys: Sequence[str], seed: int | str, by: Sequence[str] = ()
) -> DataFrame:
    """The first ``quota`` rows of each group in seeded order."""
    dealt = assign_parts(df, quota_of, ["quota"], keys, seed, by, name="_part")
    return dealt.where(F.col("_part").isNotNull()).drop("_part")
