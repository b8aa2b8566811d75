"""Exact search for the largest inner products by the threshold algorithm.

Candidates are dealt into blocks of bounded size. A block sorts its rows along
every dimension; each query walks all lists in step, from the end that its sign
makes large, scores the rows it meets for the first time, and stops when the best
score that an unmet row could have is below its k-th score. The k best of all
blocks are then merged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortwise.llm.common import matrix, partitions, sorted_groups

# Rows of a block of candidates, and queries that meet it in one task.
BLOCK_ROWS = 8192
BLOCK_QUERIES = 1024
# Depth of the first look into the lists, and its growth from look to look.
FIRST_DEPTH = 8
GROWTH = 4
# Integers below this are exact in double precision.
EXACT = 2**53
# Scores are 64-bit integers below this.
LARGEST = 2**63


class SortedLists:
    """A block's rows with one sorted list per dimension."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.values = ids[order], values[order]
        self.order = np.argsort(self.values, axis=0, kind="stable")  # rising, one column per dimension
        self.sorted = np.take_along_axis(self.values, self.order, axis=0)
        self.largest = max(int(self.values.max(initial=0)), -int(self.values.min(initial=0)))

    def _scored(self, query: np.ndarray):
        """Values and query in a type whose sums are exact: doubles, 64-bit integers or,
        where these could overflow, Python's."""
        most = self.largest * max(int(query.max(initial=0)), -int(query.min(initial=0))) * max(1, len(query))
        if most < EXACT:
            return self.floats, query.astype(np.float64)
        return (self.values, query) if most < LARGEST else (self.values.astype(object), query.astype(object))

    @property
    def floats(self) -> np.ndarray:
        if not hasattr(self, "_floats"):
            self._floats = self.values.astype(np.float64)
        return self._floats

    def best(self, query: np.ndarray, own: int | None, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Ids and scores of the k best rows, ties to smaller ids, without the
        rows of id ``own``; and how deep the lists were read."""
        n = len(self.ids)
        values, q = self._scored(query)
        used = np.flatnonzero(query)
        up = query[used] > 0
        met = np.zeros(n, bool)
        if own is not None:
            met[np.searchsorted(self.ids, own) : np.searchsorted(self.ids, own, "right")] = True
        if not len(used):  # every score is zero
            rows = np.flatnonzero(~met)[:k]
            return self.ids[rows], np.zeros(len(rows), np.int64), 0
        rows, scores = np.zeros(0, np.int64), np.zeros(0, values.dtype)
        low, depth = 0, min(n, FIRST_DEPTH)
        while True:
            new = np.zeros(n, bool)
            new[self.order[n - depth : n - low][:, used[up]].ravel()] = True
            new[self.order[low:depth][:, used[~up]].ravel()] = True
            fresh = np.flatnonzero(new & ~met)
            met[fresh] = True
            rows = np.concatenate([rows, fresh])
            scores = np.concatenate([scores, values[fresh] @ q])
            if scores.dtype == object:
                top = np.array(sorted(range(len(rows)), key=lambda t: (-scores[t], rows[t]))[:k], np.int64)
            else:
                top = np.lexsort((rows, -scores))[:k]  # rows are in order of ids
            rows, scores = rows[top], scores[top]
            if depth == n:
                break
            ends = np.where(up, self.sorted[n - depth, used], self.sorted[depth - 1, used])
            bound = ends.astype(values.dtype) @ q[used]
            if len(rows) == k and scores[-1] > bound:
                break
            low, depth = depth, min(n, depth * GROWTH)
        if scores.dtype == object and any(not -LARGEST <= s < LARGEST for s in scores):
            raise OverflowError("an inner product does not fit 64 bits")
        return self.ids[rows], scores.astype(np.int64), depth


def _search(k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["_block", "_queries", "_width"]):
            asks = group.column("_ask").to_numpy()
            if asks.all() or not asks.any():
                continue
            ids, vectors = group.column("vec_id").to_numpy(), matrix(group.column("_v"), np.int64)
            lists = SortedLists(ids[~asks], vectors[~asks])
            out = [(i, *lists.best(v, i, k)[:2]) for i, v in zip(ids[asks], vectors[asks])]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat([o[0] for o in out], [len(o[1]) for o in out]).astype(np.int64)),
                    pa.array(np.concatenate([o[1] for o in out]).astype(np.int64)),
                    pa.array(np.concatenate([o[2] for o in out]).astype(np.int64)),
                ],
                ["query_id", "vec_id", "score"],
            )

    return search


def whole_numbers(vector: Column, factor: int = 256) -> Column:
    """``floor(factor * x)`` of each component, as bigint; null for vectors that are
    null or hold a null or a value that is not finite."""
    x = F.transform(vector, lambda v: v.cast("double"))
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.when(fine, F.transform(x, lambda v: F.floor(v * factor).cast("bigint")))


def top_inner_products(
    vectors: DataFrame, queries: Column, k: int = 5, key: str = "vec_id", vector: str = "vector"
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k largest integer inner products of
    each row that ``queries`` selects, with all rows but its own.

    ``vector`` is an array of bigint. Null vectors and null ids take no part. Only
    vectors of equal length meet. Ties go to the smaller id; rows that share an id
    count as one row each, but never meet their own id. Sums are exact; a score among
    the k largest that does not fit a bigint is an error. Fewer rows than k give
    them all; an empty table none. Other columns are not read.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(key).alias("vec_id"), F.col(vector).alias("_v"), queries.alias("_q"))
    rows = rows.dropna(subset=["vec_id", "_v"]).withColumn("_width", F.size("_v"))
    n, asked = rows.agg(F.count(F.lit(1)), F.count_if("_q")).first()
    blocks = max(1, math.ceil(n / BLOCK_ROWS))
    shares = max(1, math.ceil(asked / BLOCK_QUERIES))
    place = lambda parts: F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int")
    each = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    held = rows.select("vec_id", "_v", "_width", F.lit(False).alias("_ask"), place(blocks).alias("_block"))
    held = held.withColumn("_queries", each(shares))
    asks = rows.filter("_q").select("vec_id", "_v", "_width", F.lit(True).alias("_ask"), place(shares).alias("_queries"))
    asks = asks.withColumn("_block", each(blocks)).select(*held.columns[:-1], "_queries")
    keys = ["_block", "_queries", "_width"]
    met = held.unionByName(asks).repartition(max(partitions(spark), blocks * shares), *keys).sortWithinPartitions(*keys)
    found = met.mapInArrow(_search(k), "query_id bigint, vec_id bigint, score bigint")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
