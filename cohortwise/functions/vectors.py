"""Column functions over vector columns, and pipelines made of them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

Step = Callable[[Column], Column]

# Fixed value: half the width of the scaled range
SCALED_LIMIT = 1024.0


def out_of_range(vector: Column, maxval: float = 255.0) -> Column:
    """Whether a value exceeds maxval, so that `scale` gives null."""
    return F.array_max(vector) > maxval


def scale(vector: Column, maxval: float = 255.0) -> Column:
    """Map 0..maxval to -1024..1024; null where a value exceeds maxval, which
    `out_of_range` flags."""
    scaled = F.transform(vector, lambda x: (x.cast("double") * 2.0 / F.lit(maxval) - 1.0) * SCALED_LIMIT)
    return F.when(F.array_max(vector) <= maxval, scaled)


def channel_mean(vector: Column, channels: int = 3) -> Column:
    """Mean over each run of ``channels`` neighbouring values.

    The vector is pixel-major: the channels of one pixel lie side by side. A
    last incomplete run is averaged over the values it has.
    """
    starts = F.sequence(F.lit(1), F.size(vector), F.lit(channels))

    def mean_at(start: Column) -> Column:
        part = F.slice(vector, start, F.lit(channels))
        return F.aggregate(part, F.lit(0.0), lambda a, x: a + x.cast("double")) / F.size(part)

    return F.when(F.size(vector) > 0, F.transform(starts, mean_at)).otherwise(F.array().cast("array<double>"))


def channel_repeat(vector: Column, channels: int = 3) -> Column:
    """Each value ``channels`` times in a row."""
    return F.flatten(F.transform(vector, lambda x: F.array_repeat(x, channels)))


def to_tensor(vector: Column) -> Column:
    """Closing step of every pipeline: a float array."""
    return vector.cast("array<float>")


def pipeline_steps(load: Sequence[Step], train: Sequence[Step] = (), use_train: bool = False) -> list[Step]:
    """Load steps, train steps if asked for, then the closing cast."""
    return [*load, *(train if use_train else ()), to_tensor]


def apply_steps(df: DataFrame, column: str, steps: Sequence[Step]) -> DataFrame:
    """The column after all steps; each step is a projection of its own, so a
    step that uses its input several times does not repeat the earlier ones."""
    return reduce(lambda d, step: d.withColumn(column, step(F.col(column))), steps, df)
