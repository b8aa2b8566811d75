"""Comparison of sets of vectors."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from cohortwise.functions.scores import softmax, total
from cohortwise.operators.ranks import seeded_hash, seeded_rank
from cohortwise.session import materialize

# Default for the largest vector width whose moments (width x width sums) are brought together.
MAX_WIDTH = 4096

# Columns of a tile of such a matrix.
TILE = 256
TILES = "set string, width int, a int, b int, tile array<double>"

# Vectors multiplied at a time within a task.
BLOCK_ROWS = 1024

# Fixed values of the structural similarity formula
SSIM_K1, SSIM_K2 = 0.01, 0.03
# Fixed value: folds of the inception score
INCEPTION_FOLDS = 10


def gram_tiles(df: DataFrame, vector: str, by: str, tile: int | None = None, max_width: int | None = None) -> DataFrame:
    """Gram matrix of each set in tiles of its upper triangle: rows ``(set, width, a, b,
    tile)``, tile (a, b) holding the products of column blocks a and b, row by row.

    A column of ones is appended to the vectors, so the matrix holds sums of products,
    plain sums and the count. A row of a null set has none, one of a null vector only
    counts: it appears as tile (-1, -1), a single number.

    There are no more tasks than the cluster runs at a time, each of which reads its
    share of the splits and adds up one matrix per set. So what they write grows with
    the cores and the square of the width, not with the data; tiles are added up apart
    from each other, partly before the shuffle.
    """
    tile = TILE if tile is None else tile
    max_width = MAX_WIDTH if max_width is None else max_width

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: dict[str, np.ndarray] = {}
        missing: dict[str, int] = {}
        width = None
        for batch in batches:
            sets, vectors = batch.column(1), batch.column(0)
            for name in pc.filter(sets, pc.is_null(vectors)).to_pylist():
                missing[name] = missing.get(name, 0) + 1
            known = pc.is_valid(vectors)
            vectors, sets = vectors.filter(known), sets.filter(known).dictionary_encode()
            widths = {width, *pc.unique(pc.list_value_length(vectors)).to_pylist()} - {None}
            if len(widths) > 1 or max(widths, default=0) > max_width:
                raise ValueError(f"vectors must share one width of at most {max_width}: {sorted(widths)}")
            if not widths:
                continue
            (width,) = widths
            values = vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            codes = sets.indices.to_numpy(zero_copy_only=False)
            for start in range(0, len(values), BLOCK_ROWS):
                block, part = values[start : start + BLOCK_ROWS], codes[start : start + BLOCK_ROWS]
                for code in np.unique(part):
                    rows = block[part == code].astype(np.float64)
                    rows = np.hstack([rows, np.ones((len(rows), 1))])
                    name = sets.dictionary[int(code)].as_py()
                    grams[name] = grams.get(name, 0.0) + rows.T @ rows
        for name, n in missing.items():
            yield _tile_batch(name, 0, -1, -1, np.array([float(n)]))
        for name, gram in grams.items():
            starts = range(0, len(gram), tile)
            for a, i in enumerate(starts):
                for b, j in enumerate(starts[a:], a):
                    yield _tile_batch(name, len(gram), a, b, gram[i : i + tile, j : j + tile].ravel())

    tasks = df.sparkSession.sparkContext.defaultParallelism
    rows = df.where(F.col(by).isNotNull()).select(F.col(vector).alias("v"), F.col(by).cast("string").alias("s"))
    parts = rows.coalesce(tasks).mapInArrow(partial, TILES)
    summed = parts.groupBy("set", "width", "a", "b").agg(Summarizer.sum(array_to_vector("tile")).alias("tile"))
    return summed.withColumn("tile", vector_to_array("tile"))


def _tile_batch(name: str, width: int, a: int, b: int, values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {
            "set": [name],
            "width": pa.array([width], pa.int32()),
            "a": pa.array([a], pa.int32()),
            "b": pa.array([b], pa.int32()),
            "tile": pa.array([values], pa.list_(pa.float64())),
        }
    )


def vector_moments(
    df: DataFrame, vector: str, by: str, tile: int | None = None, max_width: int | None = None
) -> DataFrame:
    """Mean and covariance of each set of vectors, in long form: ``(set, i, j, mean_i,
    mean_j, covariance, n, skipped)`` for all i <= j from 0.

    ``n`` vectors were used, ``skipped`` are null ones. The covariance is that of a
    sample, null under two vectors. All vectors must have one width. The closing step
    works on tiles: each meets the tiles with the sums of its own rows and columns.
    """
    tile = TILE if tile is None else tile
    tiles = materialize(gram_tiles(df, vector, by, tile, max_width), "tiles")
    known = tiles.where("a >= 0")
    wide = F.least(F.col("width") - F.col("b") * tile, F.lit(tile))  # the last block is smaller
    cells = known.select("set", "width", "a", "b", wide.alias("_wide"), F.posexplode("tile").alias("p", "value"))
    row = (F.col("a") * tile + F.floor(F.col("p") / F.col("_wide"))).cast("int")
    column = (F.col("b") * tile + F.col("p") % F.col("_wide")).cast("int")
    cells = cells.select("set", "width", row.alias("i"), column.alias("j"), "value").where("i <= j")
    last = F.col("width") - 1
    sums = cells.where(F.col("j") == last).select("set", "i", F.col("value").alias("sum"))
    count = cells.where((F.col("i") == last) & (F.col("j") == last)).select("set", F.col("value").alias("n"))
    skipped = tiles.where("a < 0").select("set", F.element_at("tile", 1).cast("bigint").alias("skipped"))
    means = sums.join(count, "set").select("set", "i", (F.col("sum") / F.col("n")).alias("mean"), "n")
    inner = cells.where(F.col("j") < last)
    joined = inner.join(means.withColumnRenamed("mean", "mean_i"), ["set", "i"]).join(
        means.select("set", F.col("i").alias("j"), F.col("mean").alias("mean_j")), ["set", "j"]
    )
    spread = (F.col("value") - F.col("n") * F.col("mean_i") * F.col("mean_j")) / (F.col("n") - 1)
    return joined.join(skipped, "set", "left").select(
        "set", "i", "j", "mean_i", "mean_j",
        F.when(F.col("n") > 1, spread).alias("covariance"),
        F.col("n").cast("bigint").alias("n"),
        F.coalesce("skipped", F.lit(0)).alias("skipped"),
    )


def frechet_distance(
    df: DataFrame, vector: str, by: str, real: str, fake: str, max_width: int | None = None
) -> DataFrame:
    """Fréchet distance between the normal fits of two sets of vectors, with the number
    of vectors used of each and of null ones, which are skipped.

    All vectors must have one width, of at most ``max_width``. Spark adds up the
    moments; the closing eigenvalue step works on two width x width matrices.
    """
    sides = df.where(F.col(by).cast("string").isin([real, fake]))
    table = gram_tiles(sides, vector, by, max_width=max_width).toArrow().to_pandas()
    skipped = int(sum(t[0] for t in table.loc[table["a"] < 0, "tile"]))

    def fit(name: str) -> tuple[np.ndarray, np.ndarray, int]:
        rows = table.loc[(table["set"] == name) & (table["a"] >= 0)]
        widths = rows["width"].unique()
        if len(widths) > 1:
            raise ValueError(f"vectors must share one width: {sorted(w - 1 for w in widths)}")
        width = int(widths[0]) if len(widths) else 0
        gram = np.zeros((width, width))
        for a, b, values in zip(rows["a"], rows["b"], rows["tile"]):
            block = gram[a * TILE : (a + 1) * TILE, b * TILE : (b + 1) * TILE]
            block[:] = np.asarray(values).reshape(block.shape)
        if not width or gram[-1, -1] < 2:
            raise ValueError(f"set {name!r} has under two vectors")
        gram = np.triu(gram) + np.triu(gram, 1).T
        n, mean = gram[-1, -1], gram[-1, :-1] / gram[-1, -1]
        return mean, (gram[:-1, :-1] - n * np.outer(mean, mean)) / (n - 1), int(n)

    (mean_r, cov_r, n_r), (mean_f, cov_f, n_f) = fit(real), fit(fake)
    if len(mean_r) != len(mean_f):
        raise ValueError(f"vectors must share one width: {len(mean_r)} and {len(mean_f)}")
    roots = np.sqrt(np.clip(np.linalg.eigvals(cov_r @ cov_f).real, 0.0, None))
    distance = float(((mean_r - mean_f) ** 2).sum() + np.trace(cov_r) + np.trace(cov_f) - 2.0 * roots.sum())
    found = {"frechet_distance": [distance], "n_real": [n_r], "n_fake": [n_f], "skipped": [skipped]}
    return df.sparkSession.createDataFrame(pa.table(found))


def inception_score(
    df: DataFrame, scores: str, keys: Sequence[str], seed: int, folds: int = INCEPTION_FOLDS
) -> DataFrame:
    """Mean and spread over folds of exp(mean KL(p(y|x) || p(y))).

    One pass: the mean divergence of a fold equals the mean of sum(p log p) minus
    sum(m log m) of its mean distribution m, so rows never meet their fold mean.
    """
    fold = F.conv(F.substring(seeded_hash(seed, keys), 1, 8), 16, 10).cast("bigint") % folds
    probabilities = df.select(fold.alias("fold"), softmax(F.col(scores)).alias("p"))

    def neg_entropy(p: str) -> Column:
        return total(F.transform(p, lambda x: F.when(x > 0, x * F.log(x)).otherwise(F.lit(0.0))))

    per_fold = probabilities.groupBy("fold").agg(
        F.avg(neg_entropy("p")).alias("own"), vector_to_array(Summarizer.mean(array_to_vector("p"))).alias("mean")
    )
    scored = per_fold.select(F.exp(F.col("own") - neg_entropy("mean")).alias("score"))
    return scored.agg(F.avg("score").alias("inception_mean"), F.stddev_samp("score").alias("inception_std"))


def ssim(pairs: DataFrame, x: str, y: str, data_range: float, name: str = "ssim") -> DataFrame:
    """Structural similarity of two vector columns, each vector as one window."""

    def products(a: str, b: str) -> Column:
        return total(F.zip_with(a, b, lambda u, v: u.cast("double") * v.cast("double")))

    def values(a: str) -> Column:
        return total(F.transform(a, lambda u: u.cast("double")))

    sums = pairs.withColumns(
        {"_n": F.size(x), "_x": values(x), "_y": values(y), "_xx": products(x, x), "_yy": products(y, y), "_xy": products(x, y)}
    )
    n, c1, c2 = F.col("_n"), (SSIM_K1 * data_range) ** 2, (SSIM_K2 * data_range) ** 2
    mx, my = F.col("_x") / n, F.col("_y") / n
    vx, vy, cov = F.col("_xx") / n - mx * mx, F.col("_yy") / n - my * my, F.col("_xy") / n - mx * my
    similarity = ((2 * mx * my + c1) * (2 * cov + c2)) / ((mx * mx + my * my + c1) * (vx + vy + c2))
    return sums.withColumn(name, similarity).drop("_n", "_x", "_y", "_xx", "_yy", "_xy")


def pair_ssim(fake: DataFrame, real: DataFrame, vector: str, keys: Sequence[str], seed: int) -> DataFrame:
    """Mean structural similarity of two sets, paired by seeded rank.

    ``pairs`` were compared, ``unpaired`` is the longer set's surplus, ``skipped``
    are pairs with a missing or empty vector. Vectors of unequal width are an
    error. The value range is that of the wider set.
    """
    spread = F.max(F.array_max(vector)).cast("double") - F.min(F.array_min(vector)).cast("double")
    ranges = [side.agg(spread.alias("r")).first().r or 0.0 for side in (fake, real)]
    left, right = (
        seeded_rank(side, keys, seed).select("rank", F.col(vector).alias(name), F.lit(True).alias(f"_in_{name}"))
        for side, name in ((fake, "x"), (real, "y"))
    )
    both = F.col("_in_x") & F.col("_in_y")
    unequal = F.raise_error(F.lit("vectors must share one width")).cast("double")
    scored = ssim(left.join(right, "rank", "full_outer"), "x", "y", float(max(ranges)))
    checked = F.when(F.size("x") != F.size("y"), unequal).otherwise(F.col("ssim"))
    scored = scored.withColumn("ssim", F.when(both & F.col("x").isNotNull() & F.col("y").isNotNull(), checked))
    return scored.agg(
        F.avg("ssim").alias("ssim"),
        F.count("ssim").alias("pairs"),
        F.count_if(~F.coalesce(both, F.lit(False))).alias("unpaired"),
        F.count_if(both & F.col("ssim").isNull()).alias("skipped"),
    )
