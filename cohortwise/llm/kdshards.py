"""Sharding by a K-d tree over document metadata.

The tree is cut top down. A node that still owes several shards is split along
its widest metadata dimension, at the weighted median (or at the share of the
bytes that its left shards are due), found from distributed sums. Equal texts
share one point, so that a group of copies stays in one shard; a group that is
large against a shard is first dealt into pieces by document, since no cut could
balance it otherwise.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from cohortwise.llm.common import Workspace, partitions, small_table
from cohortwise.operators.ranks import rank_in_chunks

# Bytes that each document adds to its text.
OVERHEAD = 16
# Coordinates and tie ranks are integers below this.
SPAN = 1 << 16
# Groups above 1/GROUP_SHARE of a shard are dealt into pieces of half that.
GROUP_SHARE = 8


def _points(docs: DataFrame, key: str, text: str, dims: Sequence[str], shards, target_bytes, work) -> tuple:
    """One row per document with coordinates, and the number of shards."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = work.stored(
        docs.select(
            F.col(key).alias("doc_id"),
            (F.octet_length(body) + OVERHEAD).cast("bigint").alias("size"),
            F.crc32(body).alias("text_crc32"),
            F.xxhash64(body).alias("_h"),
            *[F.col(c).cast("string").alias(f"_m{i}") for i, c in enumerate(dims)],
        ),
        "rows",
    )
    total = rows.agg(F.sum("size")).first()[0] or 0
    if shards is None:
        shards = max(1, math.ceil(total / target_bytes))
    limit = max(1, total // shards // GROUP_SHARE)
    groups = rows.groupBy("_h", "text_crc32", "size").agg(
        F.count(F.lit(1)).alias("_n"), *[F.min(f"_m{i}").alias(f"_g{i}") for i in range(len(dims))]
    )
    spread = F.col("_n") * F.col("size") * 2 / F.lit(limit)
    pieces = F.when(spread > 2, F.least(F.ceil(spread), F.col("_n"))).otherwise(F.lit(1)).cast("bigint")
    piece = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(7)), pieces)
    coordinates = [(F.least(F.log2("size") * 2048, F.lit(SPAN - 1))).cast("int")] + [
        F.shiftright(F.crc32(F.coalesce(F.col(f"_g{i}"), F.lit(""))), 16).cast("int") for i in range(len(dims))
    ]
    points = rows.join(groups, ["_h", "text_crc32", "size"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.pmod(F.xxhash64("_h", "text_crc32", "size", piece), F.lit(SPAN)).cast("int").alias("_tie"),
        F.array(*coordinates).alias("_at"),
        F.lit(0).cast("bigint").alias("_node"),
    )
    return work.stored(points, "points"), shards, total


def _cuts(points: DataFrame, owed: dict[int, int], scale: list[int] | None) -> tuple[list[tuple], list[int]]:
    """One cut per node that owes several shards: (node, dimension, value, tie,
    shards on the left).

    Of every node and dimension the bytes per coordinate are summed; their running
    sums give range and weighted median at once. Coordinates are below ``SPAN``, so
    these sums are few. A second sum finds where to cut among equal coordinates.
    """
    spark = points.sparkSession
    shares = small_table(
        spark, [(n, k // 2 / k) for n, k in owed.items() if k > 1], "_node bigint, _share double"
    )
    here = points.join(shares, "_node")
    sums = here.select("_node", "_share", "size", F.posexplode("_at").alias("_dim", "_c"))
    sums = sums.groupBy("_node", "_dim", "_c").agg(F.sum("size").alias("_w"), F.first("_share").alias("_share"))
    whole = Window.partitionBy("_node", "_dim")
    along = whole.orderBy("_c").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumn("_upto", F.sum("_w").over(along)).withColumn(
        "_goal", F.sum("_w").over(whole) * F.col("_share")
    )
    reached = F.when(F.col("_upto") >= F.col("_goal"), F.struct("_c", (F.col("_upto") - F.col("_w")).alias("before")))
    medians = sums.groupBy("_node", "_dim").agg(
        F.min("_c").alias("lo"), F.max("_c").alias("hi"), F.first("_goal").alias("goal"), F.min(reached).alias("cut")
    )
    found: dict[int, list] = {}
    for r in sorted(medians.collect(), key=lambda r: (r["_node"], r["_dim"])):
        found.setdefault(r["_node"], []).append(r)
    if scale is None:
        scale = [max(1, r["hi"] - r["lo"]) for r in found[0]]
    plan = []
    for n, rows in found.items():
        r = max(rows, key=lambda r: ((r["hi"] - r["lo"]) / scale[r["_dim"]], -r["_dim"]))
        plan.append((n, r["_dim"], r["cut"]["_c"], r["goal"] - r["cut"]["before"]))
    at = small_table(spark, plan, "_node bigint, _dim int, _value int, _goal double")
    tied = points.join(at, "_node").filter(F.element_at("_at", F.col("_dim") + 1) == F.col("_value"))
    ties = tied.groupBy("_node", "_tie").agg(F.sum("size").alias("_w"), F.first("_goal").alias("_goal"))
    along = Window.partitionBy("_node").orderBy("_tie").rowsBetween(Window.unboundedPreceding, 0)
    upto = ties.withColumn("_upto", F.sum("_w").over(along))
    off = F.min(F.struct(F.abs(F.col("_upto") - F.col("_goal")).alias("off"), F.col("_tie").alias("tie")))
    nearest = {r["_node"]: r["best"] for r in upto.groupBy("_node").agg(off.alias("best")).collect()}
    return [
        (n, d, v, -1 if goal <= nearest[n]["off"] else nearest[n]["tie"], owed[n] // 2) for n, d, v, goal in plan
    ], scale


def kd_shards(
    docs: DataFrame,
    shards: int | None = None,
    target_bytes: int | None = None,
    key: str = "doc_id",
    text: str = "text",
    dims: Sequence[str] = ("lang", "source"),
    work: Workspace | None = None,
) -> DataFrame:
    """Shards of near equal bytes: ``doc_id, size, text_crc32, shard, slot``.

    Splits until each leaf is one of ``shards`` shards, or (with ``target_bytes``)
    until leaves come down to that size. The dimensions are the logarithm of the
    size and the columns ``dims`` of the group of equal texts.

    Null texts are empty ones (crc 0); null keys and metadata are values like
    others; repeated rows each get a slot; an empty table gives no rows. Further
    columns of the input are not read.
    """
    if (shards is None) == (target_bytes is None):
        raise ValueError("give either shards or target_bytes")
    work = work or Workspace(docs.sparkSession, "kd-shards")
    points, shards, total = _points(docs, key, text, dims, shards, target_bytes, work)
    owed, scale, first = {0: shards}, None, {0: 0}
    spark = docs.sparkSession
    while total and any(k > 1 for k in owed.values()):
        cuts, scale = _cuts(points, owed, scale)
        moves, after_owed, after_first = [], {}, {}
        seen = {c[0] for c in cuts}
        for n, dim, value, tie, left in cuts:
            a, b = 2 * n + 1, 2 * n + 2
            moves.append((n, dim, value, tie, a, b))
            after_owed |= {a: left, b: owed[n] - left}
            after_first |= {a: first[n], b: first[n] + left}
        for n in set(owed) - seen:  # done, or without rows
            after_owed[n], after_first[n] = 1, first[n]
        schema = "_node bigint, _dim int, _value int, _cut int, _a bigint, _b bigint"
        table = small_table(spark, moves, schema)
        c = F.element_at("_at", F.col("_dim") + 1)
        goes_left = (c < F.col("_value")) | ((c == F.col("_value")) & (F.col("_tie") <= F.col("_cut")))
        child = F.when(F.col("_dim").isNull(), F.col("_node")).when(goes_left, F.col("_a")).otherwise(F.col("_b"))
        points = points.join(table, "_node", "left").withColumn("_node", child)
        points = points.drop("_dim", "_value", "_cut", "_a", "_b")
        owed, first = after_owed, after_first
    leaf = small_table(spark, sorted(first.items()), "_node bigint, shard int")
    placed = points.join(leaf, "_node").select("doc_id", "size", "text_crc32", "shard")
    chunk = F.pmod(F.xxhash64("doc_id"), F.lit(4 * partitions(spark)))
    ranked = rank_in_chunks(placed, chunk, ["doc_id", "text_crc32", "size"], ["shard"], "_rank")
    return ranked.select("doc_id", "size", "text_crc32", "shard", (F.col("_rank") - 1).alias("slot"))
