"""Near duplicates among vectors by random hyperplanes.

Vectors of one label are hashed by the signs of random projections in several
tables. Vectors that share a table's bucket are compared by exact cosine; a pair
counts in the first table that it shares. Buckets of any size are worked off in
blocks, whole; nothing is capped. The links of a block leave it as a forest, not
as pairs, and components are joined over all blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cohortwise.llm.common import Workspace, matrix, partitions, sorted_groups
from cohortwise.llm.graph import components

# Rows that a bucket should hold, and rows of a block within a bucket.
BUCKET_ROWS = 64
# Lengths whose squares are well within doubles; other vectors are scaled first.
IN_RANGE = (1e-140, 1e140)
BLOCK_ROWS = 512
# Chance that a pair at the threshold shares no bucket.
MISS = 0.002
SEED = 20240817


def table_plan(rows_per_label: float, threshold: float) -> tuple[int, int]:
    """Signs per table and number of tables: as many signs as bring buckets down to
    ``BUCKET_ROWS`` of unrelated rows, and tables enough for ``MISS``."""
    bits = min(30, max(4, math.ceil(math.log2(max(2.0, rows_per_label / BUCKET_ROWS)))))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(MISS) / math.log1p(-same))


def planes(width: int, bits: int, tables: int) -> np.ndarray:
    return np.random.default_rng([SEED, width]).standard_normal((width, bits * tables))


def _sign(bits: int, tables: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = (1 << np.arange(bits)).astype(np.int64)
        for batch in batches:
            flat = batch.column(2).flatten().to_numpy(zero_copy_only=False)
            widths = np.diff(np.asarray(batch.column(2).offsets))
            starts = np.concatenate([[0], np.cumsum(widths)])
            codes = np.zeros((batch.num_rows, tables), np.int64)
            for w in np.unique(widths):
                rows = np.flatnonzero(widths == w)
                values = flat[starts[rows][:, None] + np.arange(w)]
                signs = (values @ planes(int(w), bits, tables) >= 0).reshape(len(rows), tables, bits)
                codes[rows] = signs @ weights
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * tables)
            lists = pa.ListArray.from_arrays(offsets, pa.array(codes.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "codes"])

    return sign


def _compare(threshold: float):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["_bucket", "_i", "_j"]):
            ids = group.column("id").to_numpy()
            if len(ids) < 2:
                continue
            block, i, j, t = (group.column(c).to_numpy() for c in ("_block", "_i", "_j", "_table"))
            if i[0] == j[0]:
                left = right = np.arange(len(ids))
            else:
                left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
            if not len(left) or not len(right):
                continue
            unit, codes = matrix(group.column("unit"), np.float64), matrix(group.column("codes"), np.int64)
            copies = group.column("copies").to_numpy()
            for a in range(0, len(left), BLOCK_ROWS):
                rows = left[a : a + BLOCK_ROWS]
                linked = unit[rows] @ unit[right].T >= threshold - 1e-9
                x, y = np.nonzero(linked)
                x, y = rows[x], right[y]
                # Once per pair, and in its first common table.
                keep = (x < y) if i[0] == j[0] else np.ones(len(x), bool)
                x, y = x[keep], y[keep]
                first = (codes[x] == codes[y]).argmax(axis=1) == t[0]
                x, y = x[first], y[first]
                exact = _cosines(unit, x, y) >= threshold
                x, y = x[exact], y[exact]
                if not len(x):
                    continue
                label = np.arange(len(ids))
                while True:  # smallest place reachable inside the block
                    before = label.copy()
                    np.minimum.at(label, x, label[y])
                    np.minimum.at(label, y, label[x])
                    label = label[label]
                    if (label == before).all():
                        break
                links = np.zeros(len(ids), np.int64)
                np.add.at(links, x, copies[y])
                np.add.at(links, y, copies[x])
                at = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at]), pa.array(links[at]), pa.array(ids[label[at]])], ["id", "links", "root"]
                )

    return compare


def _cosines(unit: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    out = np.empty(len(x))
    for a in range(0, len(x), 65536):
        out[a : a + 65536] = np.einsum("ij,ij->i", unit[x[a : a + 65536]], unit[y[a : a + 65536]])
    return out


def near_duplicates(
    vectors: DataFrame,
    threshold: float = 0.93,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    work: Workspace | None = None,
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row.

    Two rows link when their labels are equal and not null and their cosine in
    double precision is at least ``threshold``. ``n_links`` counts the other rows
    linked directly, ``component_id`` is the smallest id reachable, ``kept`` marks
    that row. A pair at the threshold is missed with probability ``MISS``.

    Vectors that are null, of length zero, or hold a null or a value that is not
    finite link with nothing, nor do vectors of different widths. Equal vectors
    are compared once and counted as often as they occur. Rows that repeat an id
    link as rows of their own and share the component. A row with a null id keeps
    null as its component unless it has links. Other columns are not read.
    """
    spark = vectors.sparkSession
    work = work or Workspace(spark, "near-duplicates")
    doubles = F.transform(F.col(vector), lambda v: v.cast("double"))
    fine = F.forall(doubles, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    size = F.sqrt(F.aggregate("_x", F.lit(0.0), lambda s, v: s + v * v))
    rows = vectors.select(F.col(key).alias("vec_id"), F.col(label).alias("_label"), F.when(fine, doubles).alias("_x"))
    # Squares of very small or large values leave the range of doubles.
    largest = F.array_max(F.transform("_x", lambda v: F.abs(v)))
    rows = rows.withColumn("_size", size).withColumn("_largest", largest)
    far = (F.col("_largest") > 0) & ~F.col("_size").between(*IN_RANGE)
    rows = rows.withColumn("_x", F.when(far, F.transform("_x", lambda v: v / F.col("_largest"))).otherwise(F.col("_x")))
    rows = rows.withColumn("_size", size)
    usable = F.col("_label").isNotNull() & F.col("_x").isNotNull() & (F.col("_size") > 0)
    unit = F.when(usable, F.transform("_x", lambda v: v / F.col("_size")))
    rows = work.stored(rows.select("vec_id", "_label", unit.alias("unit")), "rows")
    found = rows.dropna(subset=["unit", "vec_id"])
    classes = found.groupBy("_label", "unit").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies"))
    n = classes.groupBy("_label").count().agg(F.avg("count")).first()[0] or 0
    bits, tables = table_plan(n, threshold)
    schema = "label string, id bigint, unit array<double>, copies bigint, codes array<bigint>"
    classes = classes.select(F.col("_label").cast("string").alias("label"), "id", "unit", "copies")
    signed = classes.mapInArrow(_sign(bits, tables), schema)
    signed = work.stored(signed, "signed")
    by_table = signed.select("*", F.posexplode("codes").alias("_table", "_code"))
    by_table = by_table.withColumn("_bucket", F.xxhash64("label", F.size("unit"), "_table", "_code"))
    sizes = by_table.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    blocks = F.ceil(F.col("_n") / F.lit(BLOCK_ROWS)).cast("int")
    dealt = by_table.join(sizes, "_bucket").withColumn("_block", F.pmod(F.xxhash64("id"), blocks).cast("int"))
    # A block meets itself and every other block of its bucket, once.
    others = F.transform(
        F.sequence(F.lit(0), blocks - 1),
        lambda b: F.struct(F.least(b, F.col("_block")).alias("_i"), F.greatest(b, F.col("_block")).alias("_j")),
    )
    met = dealt.select("_bucket", "_table", "_block", "id", "unit", "copies", "codes", F.inline(others))
    met = met.repartition(partitions(spark), "_bucket", "_i", "_j").sortWithinPartitions("_bucket", "_i", "_j")
    linked = work.stored(met.mapInArrow(_compare(threshold), "id bigint, links bigint, root bigint"), "links")
    counts = linked.groupBy("id").agg(F.sum("links").alias("links"))
    edges = linked.filter("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b"))
    joined = components(edges, work)
    per_class = (
        signed.select("label", "unit", "id", "copies")
        .join(counts, "id", "left")
        .join(joined, "id", "left")
        .select(
            F.col("label").alias("_label"),
            "unit",
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        )
    )
    out = rows.withColumn("_label", F.col("_label").cast("string")).join(per_class, ["_label", "unit"], "left")
    named = F.col("vec_id").isNotNull()
    component = F.when(named, F.coalesce("component_id", "vec_id"))
    return out.select(
        "vec_id",
        F.coalesce(F.when(named, F.col("n_links")), F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
