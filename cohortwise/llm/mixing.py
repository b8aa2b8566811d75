"""Mixing sources to target weights by iterative proportional fitting.

Token sums of the cells of a contingency table (source, language, topic) are raked
until their margins meet the targets. A document is then drawn with its cell's
rate, the raked weight over the tokens that are there. Cells, margins and targets
stay distributed tables, so their number is free.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortwise.llm.common import Workspace, word_hashes

# Classes of the default topic.
TOPICS = 8
ROUNDS = 25
TOLERANCE = 5e-3
SEED = 17


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tokens, topics = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int32)
        for i, text in enumerate(batch.column(0)):
            words = word_hashes(text.as_py())
            tokens[i] = len(words)
            if len(words):
                topics[i] = np.bincount((words % np.uint64(TOPICS)).astype(np.int64), minlength=TOPICS).argmax()
        rest = [batch.column(i) for i in range(1, batch.num_columns)]
        names = [batch.schema.names[i] for i in range(1, batch.num_columns)]
        yield pa.RecordBatch.from_arrays([*rest, pa.array(tokens), pa.array(topics)], [*names, "n_tokens", "topic"])


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text", dims: Sequence[str] = ("source", "lang")):
    """``doc_id``, ``dims``, the words of the whole text, and a topic: the hash class
    that most of its words fall into, ties to the smaller, 0 without words."""
    kept = [F.col(text).cast("string").alias("_text"), F.col(key).cast("bigint").alias("doc_id")]
    kept += [F.col(c).cast("string").alias(c) for c in dims]
    schema = "doc_id bigint, " + "".join(f"{c} string, " for c in dims) + "n_tokens bigint, topic int"
    return docs.select(*kept).mapInArrow(_measured, schema)


def tempered(cells: DataFrame, dim: str, power: float) -> DataFrame:
    """Target shares ``(value, share)`` in proportion to a power of the tokens."""
    sums = cells.groupBy(F.col(dim).alias("value")).agg(F.sum("tokens").alias("_t"))
    return sums.select("value", F.pow(F.col("_t").cast("double"), F.lit(power)).alias("share"))


def filled(goal: DataFrame, total: float) -> DataFrame:
    """``goal`` with ``goal``, the part of ``total`` that each value gets: in proportion to
    its share, but at most its tokens; what is over goes to the other values."""
    factor = 0.0
    while True:
        full = F.col("share") * factor >= F.col("held")
        taken, free = goal.agg(
            F.coalesce(F.sum(F.when(full, F.col("held"))), F.lit(0.0)), F.sum(F.when(~full, F.col("share")))
        ).first()
        after = (total - taken) / free if free else factor
        if after <= factor * (1 + 1e-12):
            return goal.withColumn("goal", F.least("held", F.col("share") * factor))
        factor = after


def _factor(dim: str, axes: Sequence[str]) -> Column:
    """What the weights of a value are multiplied by so that they, each cut to the cell's
    tokens, add up to its goal. With the cells ordered by when they fill up, every
    guess of which are full gives at most this factor, so it is the largest."""
    filling = F.when(F.col("weight") > 0, F.col("tokens") / F.col("weight"))
    order = Window.partitionBy(dim).orderBy(filling, *axes)
    full = F.when(F.col("weight") > 0, F.col("tokens")).otherwise(0)
    before = F.coalesce(F.sum(full).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    free = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    return F.when(free > 0, (F.col(f"_goal_{dim}") - before) / free)


def raked(
    cells: DataFrame,
    targets: dict[str, DataFrame],
    work: Workspace,
    rounds: int = ROUNDS,
    share: float | None = None,
) -> DataFrame:
    """``cells`` (dimensions, ``tokens``) with ``weight``, whose margins meet the
    targets' shares of all tokens.

    A target names some values and their shares (of any sum). Values without a
    target, or with one of zero or less, get no weight; targets of values that no
    cell has are left out. Stops when all margins are within ``TOLERANCE``, or
    after ``rounds``: targets that contradict each other have no solution.

    With ``share``, weights are the tokens that are taken of each cell, never more than it
    has, and ``share`` of all together. Where cells are full, the others of the same
    values take their part. A value whose goal is beyond all its tokens is taken
    whole, and the other values of that dimension share what is left by their targets.

    A round is one job with one shuffle of the cells per dimension. A task sees all
    cells of a value: sums, as many as the other dimensions have combinations.
    """
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    here = cells.withColumn("weight", F.col("tokens").cast("double"))
    for dim, target in targets.items():
        goal = target.filter("share > 0").select(F.struct(F.col("value").alias(dim)).alias("_value"), "share")
        there = cells.filter("tokens > 0").groupBy(F.struct(dim).alias("_value"))
        there = there.agg(F.sum("tokens").cast("double").alias("held"))
        goal = work.stored(goal.join(there, "_value"), f"goal-{dim}")
        if share is None:
            all_shares = goal.agg(F.sum("share")).first()[0] or 1.0
            goal = goal.withColumn("goal", F.col("share") * (total / all_shares))
        else:
            goal = filled(goal, share * total)
        goal = goal.select("_value", F.col("goal").alias(f"_goal_{dim}"))
        here = here.withColumn("_value", F.struct(dim)).join(goal, "_value", "left").drop("_value")
        here = here.withColumn("weight", F.when(F.col(f"_goal_{dim}").isNull(), 0.0).otherwise(F.col("weight")))
    state, path = work.keep(here, "cells")
    for _ in range(rounds):
        after, off = state, F.lit(0.0)
        for dim in targets:
            taken = F.col("weight") if share is None else F.least("weight", "tokens")
            whole = F.sum(taken).over(Window.partitionBy(dim))
            after = after.withColumn("_f", F.when(whole > 0, F.col(f"_goal_{dim}") / whole))
            change = F.coalesce("_f", F.lit(1.0))
            after = after.withColumn(f"_off_{dim}", F.abs(change - 1))
            if share is not None:
                after = after.withColumn("_g", _factor(dim, list(targets)))
                change = F.coalesce(F.max("_g").over(Window.partitionBy(dim)), F.lit(1.0))
            after = after.withColumn("weight", F.col("weight") * change)
            off = F.greatest(off, F.col(f"_off_{dim}"))
        moved = F.when(F.col("weight") > 0, off).alias("_off")
        stored, new_path = work.keep(after.select(*state.columns, moved), "cells")
        worst = stored.agg(F.max("_off")).first()[0]
        state = stored.drop("_off")
        work.drop(path)
        path = new_path
        if worst is None or worst <= TOLERANCE:
            break
    taken = F.col("weight") if share is None else F.least("weight", F.col("tokens").cast("double"))
    return state.select(*cells.columns, taken.alias("weight"))


def uniform(key: Column, seed: int) -> Column:
    """A number from 0 to 1 that a document's id decides."""
    return F.shiftrightunsigned(F.xxhash64(key, F.lit(seed)), 11) / F.lit(float(1 << 53))


def mix_to_targets(
    docs: DataFrame,
    power: float = 0.5,
    share: float = 0.5,
    dims: Sequence[str] = ("source", "lang"),
    targets: dict[str, DataFrame] | None = None,
    once: bool = False,
    key: str = "doc_id",
    text: str = "text",
    seed: int = SEED,
    work: Workspace | None = None,
) -> DataFrame:
    """The drawn documents: ``(doc_id, n_tokens, topic, rate, copies)``.

    The margins of ``dims`` and of the topic are raked to ``targets`` (tables of
    ``value`` and ``share``), or to the ``power`` of each value's tokens. Rates are
    scaled to ``share`` of all tokens; a rate of 2.3 draws two copies and a third
    with probability 0.3. With ``once`` no rate is above 1 (see ``raked``). A document's
    draw depends on its id alone, so repeated rows are drawn together.

    Null dimensions are values of their own, null ids draw as one id. Texts
    without words count no tokens; they follow the rate of their cell, or none if
    the whole cell has no tokens. An empty table draws nothing. Further columns
    are not read.
    """
    spark = docs.sparkSession
    work = work or Workspace(spark, "mixing")
    rows = work.stored(measured(docs, key, text, dims), "measured")
    axes = [*dims, "topic"]
    cells = work.stored(rows.groupBy(*axes).agg(F.sum("n_tokens").alias("tokens")), "sums")
    if targets is None:
        targets = {d: tempered(cells, d, power) for d in axes}
    solved = raked(cells, targets, work, share=share if once else None).withColumn("_cell", F.struct(*axes))
    all_weight = solved.agg(F.sum("weight"), F.sum("tokens")).first()
    scale = 1.0 if once else share * (all_weight[1] or 0) / all_weight[0] if all_weight[0] else 0.0
    rates = solved.select(
        "_cell", F.coalesce(F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")), F.lit(0.0)).alias("_r")
    )
    placed = rows.withColumn("_cell", F.struct(*axes)).join(rates, "_cell")
    rate = (F.col("_r") * scale).alias("rate")
    placed = placed.select("doc_id", "n_tokens", "topic", rate)
    whole = F.floor("rate")
    more = (uniform(F.col("doc_id"), seed) < F.col("rate") - whole).cast("bigint")
    return placed.withColumn("copies", whole + more).filter("copies > 0")
