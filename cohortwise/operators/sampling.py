"""Splitting, sampling and rebalancing. All draws are exact and seeded."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortwise.functions.names import join_path
from cohortwise.operators.classes import encode
from cohortwise.operators.ranks import GROUP, assign_parts, group_of, pick_first, rows_at, seeded_hash, seeded_rank
from cohortwise.session import fitted, materialize

# Fixed values
SAMPLE_TO_VALUE = 3500
TEST_SIZE = 0.1

# Draw tables up to this many rows are broadcast; their size is known exactly.
BROADCAST_DRAWS = 200_000

# Rows per draw from which on draws count as few.
FEW_DRAWS = 64

# Draws made at a time.
DRAW_BLOCK = 65_536


def shuffled(df: DataFrame, keys: Sequence[str], seed: int, by: Sequence[str] = (), name: str = "position") -> DataFrame:
    """Position of each row in seeded random order, from 1."""
    return seeded_rank(df, keys, seed, by, name)


def preview(df: DataFrame, key: str, rows: int = 5) -> DataFrame:
    """First rows in key order."""
    return df.orderBy(key).limit(rows)


def sample_rows(df: DataFrame, k: int, keys: Sequence[str], seed: int) -> DataFrame:
    """Exactly ``min(k, rows)`` random rows without replacement."""
    return pick_first(df, lambda counts: counts.withColumn("quota", F.least("n", F.lit(k))), keys, seed)


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """Rows per class; evaluated at once as long as there are few classes."""
    return fitted(df.groupBy(label).agg(F.count(F.lit(1)).alias("n")))


def apportioned(counts: DataFrame, label: str, size: Column, wanted: Column, name: str) -> DataFrame:
    """Units of each class out of ``wanted`` in all, as a column: the shares of ``size``
    rounded down, the missing units to the largest fractions, ties to the smaller label."""
    everything = Window.partitionBy()
    exact = "decimal(19,0)"
    shares = (
        counts.withColumn("_size", size.cast("bigint"))
        .withColumn("_total", F.sum("_size").over(everything))
        .withColumn("_wanted", wanted.cast("bigint"))
        .withColumn("_scaled", F.col("_size").cast(exact) * F.col("_wanted").cast(exact))
        .withColumn("_fraction", F.try_mod(F.col("_scaled"), F.col("_total").cast(exact)).cast("bigint"))
        .withColumn("_whole", F.try_divide(F.col("_scaled") - F.col("_fraction"), F.col("_total").cast(exact)).cast("bigint"))
    )
    place = F.row_number().over(everything.orderBy(F.desc("_fraction"), F.asc(label)))
    return (
        shares.withColumn("_missing", F.col("_wanted") - F.sum("_whole").over(everything))
        .withColumn("_extra", (place <= F.col("_missing")).cast("bigint"))
        .withColumn(name, F.coalesce(F.col("_whole") + F.col("_extra"), F.lit(0)))
        .select(*counts.columns, name)
    )


def part_size(size: float | int, rows: Column, up: bool) -> Column:
    """Rows of a part given as a number or, if it is no integer, as a share of all."""
    if isinstance(size, int):
        return F.lit(size).cast("bigint")
    scaled = F.lit(float(size)) * rows
    return (F.ceil(scaled) if up else F.floor(scaled)).cast("bigint")


def with_test_quota(
    counts: DataFrame,
    label: str,
    test_size: float | int | None,
    name: str,
    n: str = "n",
    train_size: float | int | None = None,
    train: str | None = None,
) -> DataFrame:
    """Test rows per class for a stratified split, as a column; with ``train`` the train
    rows, too.

    The test part has ``ceil(test_size * n)`` rows in all, or ``test_size`` rows when
    that is an integer; the train part ``floor(train_size * n)`` or ``train_size``. One
    of them not given is the rest; with both, rows may be left for neither. Train quotas
    are the class shares, see `apportioned`; the test rows come from what is left of
    each class. A class of one row, a part with fewer rows than there are classes, and
    parts of more rows than there are, cannot be split and are errors.
    """
    if test_size is None and train_size is None:
        raise ValueError("a split needs the size of a part")
    size = F.col(n)
    everything = Window.partitionBy()
    sized = counts.withColumn("_all", F.sum(size).over(everything)).withColumn("_classes", F.count(F.lit(1)).over(everything))
    rows = F.col("_all")
    test = rows - part_size(train_size, rows, False) if test_size is None else part_size(test_size, rows, True)
    kept = rows - test if train_size is None else part_size(train_size, rows, False)
    sized = sized.withColumn("_test", test).withColumn("_kept", F.greatest(kept, F.lit(0)))
    dealt = apportioned(sized, label, size, F.col("_kept"), "_first")
    if train_size is not None and test_size is not None:
        dealt = apportioned(dealt, label, size - F.col("_first"), F.col("_test"), "_second")
    else:
        dealt = dealt.withColumn("_second", size - F.col("_first"))
    fewest = F.least("_test", "_kept")
    wrong = (
        F.when(size < 2, f"a class of {label} has under two rows and cannot be split")
        .when(F.col("_test") + F.col("_kept") > rows, "the parts have more rows than there are")
        .when(fewest < F.col("_classes"), f"a part has fewer rows than {label} has classes")
    )
    checked = lambda c: F.when(wrong.isNotNull(), F.raise_error(wrong).cast("bigint")).otherwise(F.col(c))
    found = [checked("_second").alias(name), *([checked("_first").alias(train)] if train else [])]
    return dealt.select(*counts.columns, *found)


def stratified_split(
    df: DataFrame,
    label: str,
    keys: Sequence[str],
    seed: int,
    test_size: float | int | None = TEST_SIZE,
    names: tuple[str, str] = ("train", "test"),
    name: str = "split",
    train_size: float | int | None = None,
) -> DataFrame:
    """Two-way split column with the class shares kept in both parts; a null label is a
    class. With both sizes given, rows of neither part have a null there."""
    train, test = names
    if train_size is None or test_size is None:
        quota_of = lambda counts: with_test_quota(counts, label, test_size, test, train_size=train_size)
        return assign_parts(df, quota_of, [test], keys, seed, [label], train, name)
    both = lambda counts: with_test_quota(counts, label, test_size, test, "n", train_size, train)
    return assign_parts(df, both, [test, train], keys, seed, [label], None, name)


def uniform(keys: Sequence[str], seed: int) -> Column:
    """A number from 0 to 1 that seed and key of a row decide."""
    return F.conv(F.substring(seeded_hash(seed, keys), 1, 8), 16, 10).cast("bigint") / F.lit(float(1 << 32))


def share_split(
    df: DataFrame,
    keys: Sequence[str],
    seed: int,
    test_size: float = TEST_SIZE,
    names: tuple[str, str] = ("train", "test"),
    name: str = "split",
) -> DataFrame:
    """Split column by share alone: each row by its own hash. Parts and classes have
    their shares up to chance, which evens out with the rows; nothing is counted,
    ranked or moved, and rows that come later leave the others where they are."""
    train, test = names
    return df.withColumn(name, F.when(uniform(keys, seed) < test_size, test).otherwise(train))


def share_sample(df: DataFrame, label: str, shares: Mapping, keys: Sequence[str], seed: int, rest: float = 1.0) -> DataFrame:
    """Rows of each class kept with its share of ``shares``, others with ``rest``, each
    by its own hash: undersampling without counting or moving rows."""
    share = F.lit(float(rest))
    for value, part in shares.items():
        share = F.when(F.col(label).eqNullSafe(F.lit(value)), float(part)).otherwise(share)
    return df.where(uniform(keys, seed) < share)


def stratified_split3(
    df: DataFrame,
    label: str,
    keys: Sequence[str],
    seed: int,
    test_size: float = TEST_SIZE,
    perform_validation: bool = True,
    code: str | None = None,
) -> DataFrame:
    """Labels as dense codes, then test rows split off, then validation rows
    from the remaining ones.

    Both steps follow the same seeded order, so one pass finds all cuts: the
    validation rows are those that come next after the test rows.
    """
    coded = encode(df, label, code or label)
    label = code or label
    if not perform_validation:
        return stratified_split(coded, label, keys, seed, test_size)

    def quota_of(counts: DataFrame) -> DataFrame:
        first = with_test_quota(counts, label, test_size, "test")
        left = first.withColumn("_left", F.col("n") - F.col("test"))
        return with_test_quota(left, label, test_size, "val", "_left")

    return assign_parts(coded, quota_of, ["test", "val"], keys, seed, [label], "train", "split")


def draws(wanted: DataFrame, label: str, total: int, seed: int) -> DataFrame:
    """Rows ``(label, draw, rank)``: ``_need`` draws for each class of ``n`` rows,
    each naming a row by its rank in the class. Made in blocks, so that no task
    holds the draws of a class."""
    blocks = wanted.withColumn("_block", F.explode(F.sequence(F.lit(0), F.expr(f"(_need - 1) div {DRAW_BLOCK}"))))
    if total > DRAW_BLOCK:
        blocks = blocks.repartition(label, "_block")
    last = F.least(F.col("_need"), (F.col("_block") + 1) * DRAW_BLOCK) - 1
    drawn = blocks.withColumn("draw", F.explode(F.sequence(F.col("_block") * DRAW_BLOCK, last)))
    hashed = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(label).cast("string"), F.col("draw").cast("string")))
    number = F.conv(F.substring(hashed, 1, 15), 16, 10).cast("bigint")
    return drawn.select(label, F.col("draw").cast("bigint").alias("draw"), (number % F.col("n") + 1).alias("rank"))


def draw_rows(df: DataFrame, counts: DataFrame, label: str, need: Column, keys: Sequence[str], seed: int) -> DataFrame:
    """Rows drawn with replacement, ``need`` per class, all columns kept, with a
    ``draw`` number. As in splits, a null label is a class like others.

    Few draws from many rows look up their rows by place and leave the others
    where they are. Many draws are joined with the ranked rows on (class, rank),
    so that a hot class spreads out.
    """
    wanted = counts.select(label, "n", need.cast("bigint").alias("_need"))
    wanted = wanted.where(F.col("_need") > 0)
    sums = wanted.agg(F.sum("_need").alias("need"), F.sum("n").alias("n"), F.count("n").alias("classes")).first()
    total, rows = sums.need or 0, sums.n or 0
    drawn = draws(wanted, label, total, seed)
    if 0 < total <= BROADCAST_DRAWS and total * FEW_DRAWS <= rows:
        # As many chunks to count as rows to shuffle.
        chunks = math.isqrt(total * rows) // sums.classes
        return rows_at(df, drawn, total, chunks, keys, seed, [label]).select(*df.columns, "draw")
    ranked = seeded_rank(df, keys, seed, [label], "rank")
    hint = "broadcast" if total <= BROADCAST_DRAWS else "merge"
    drawn = drawn.select(group_of([label]).alias(GROUP), "draw", "rank")
    return ranked.withColumn(GROUP, group_of([label])).join(drawn.hint(hint), [GROUP, "rank"]).select(*df.columns, "draw")


def bootstrap_per_class(df: DataFrame, label: str, keys: Sequence[str], value: int, seed: int) -> DataFrame:
    """Exactly ``value`` rows of each class, drawn with replacement."""
    return draw_rows(df, class_counts(df, label), label, F.lit(value), keys, seed)


def resample_to_value(
    df: DataFrame, label: str, keys: Sequence[str], seed: int, value: int = SAMPLE_TO_VALUE
) -> DataFrame:
    """All rows plus draws with replacement until each class has ``value`` rows.
    Classes that are larger stay as they are. Original rows have a null ``draw``."""
    extra = draw_rows(df, class_counts(df, label), label, F.lit(value) - F.col("n"), keys, seed)
    return df.withColumn("draw", F.lit(None).cast("bigint")).unionByName(extra)


def undersample(df: DataFrame, label: str, keys: Sequence[str], seed: int) -> DataFrame:
    """Every class cut to the size of the smallest, without replacement."""
    smallest = F.min("n").over(Window.partitionBy())
    return pick_first(df, lambda counts: counts.withColumn("quota", smallest), keys, seed, [label])


def mix_generated(
    train: DataFrame, generated: DataFrame, label: str, positive: int, keys: Sequence[str], seed: int
) -> DataFrame:
    """Train rows plus as many generated rows as the absolute difference between
    the positives and the generated rows, at most all of them."""
    positives = train.where(F.col(label) == positive).count()
    sampled = sample_rows(generated, abs(positives - generated.count()), keys, seed)
    return train.unionByName(sampled.withColumn(label, F.lit(positive).cast(train.schema[label].dataType)))


def generated_rows(listing: DataFrame, folder: str, code: int) -> DataFrame:
    """Every listed file of the folder as a sample of one fixed class."""
    return listing.select(
        join_path(F.lit(folder), F.col("name")).alias("image_files"), F.lit(code).cast("int").alias("labels")
    )


def prepare_splits(
    df: DataFrame,
    label: str,
    keys: Sequence[str],
    seed: int,
    test_size: float = TEST_SIZE,
    generated: DataFrame | None = None,
    positive: int = 1,
    sampling: str | None = None,
    value: int = SAMPLE_TO_VALUE,
    perform_validation: bool = True,
) -> DataFrame:
    """Train and validation rows ready for training, in a ``split`` column.

    Split, then mix in generated rows, then rebalance the train part:
    ``sampling`` is ``None``, ``"bootstrap"`` or ``"undersample"``. Give a stored
    table; the fitted steps read it several times. Rows from a bootstrap have a
    ``draw`` number, all others null. Without validation the rows split off are
    left out.
    """
    if not perform_validation:
        both = prepare_splits(df, label, keys, seed, test_size, generated, positive, sampling, value)
        return both.where("split = 'train'")
    if sampling not in (None, "bootstrap", "undersample"):
        raise ValueError(f"sampling {sampling!r} is not 'bootstrap' or 'undersample'")
    no_draw = F.lit(None).cast("bigint")
    if sampling == "undersample" and generated is None:
        return _split_and_undersample(df, label, keys, seed, test_size).withColumn("draw", no_draw)
    parts = stratified_split(df, label, keys, seed, test_size, ("train", "val"))
    if sampling is not None or generated is not None:  # further steps read the train part again
        parts = materialize(parts, "parts", ["split"])
    train, val = (parts.where(F.col("split") == p).drop("split") for p in ("train", "val"))
    if generated is not None:
        train = mix_generated(train, generated, label, positive, keys, seed)
    if sampling == "bootstrap":
        train = bootstrap_per_class(train, label, keys, value, seed)
    else:
        train = (undersample(train, label, keys, seed) if sampling else train).withColumn("draw", no_draw)
    return train.withColumn("split", F.lit("train")).unionByName(
        val.withColumn("draw", no_draw).withColumn("split", F.lit("val"))
    )


def _split_and_undersample(df: DataFrame, label: str, keys: Sequence[str], seed: int, test_size: float) -> DataFrame:
    """Validation rows, then equally many train rows of each class, in one pass."""

    def quota_of(counts: DataFrame) -> DataFrame:
        split = with_test_quota(counts, label, test_size, "val")
        left = (F.col("n") - F.col("val")).alias("_left")
        return split.select("*", left).withColumn("train", F.min("_left").over(Window.partitionBy()))

    dealt = assign_parts(df, quota_of, ["val", "train"], keys, seed, [label], None, "split")
    return dealt.where(F.col("split").isNotNull())
