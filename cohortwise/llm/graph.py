"""Connected components of a large graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortwise.llm.common import Workspace


def components(edges: DataFrame, work: Workspace) -> DataFrame:
    """``edges(a, b)`` to ``(id, component)``: the smallest id reachable from each
    id that occurs. Null ends are left out.

    Each round points every id at its smallest neighbour, follows that pointer once
    more, and contracts the graph to what the pointers lead to. The smallest id of
    a component is never contracted away. Edges inside a contracted group go, so
    the graph shrinks by half or more each time and the rounds are few, whatever
    the length of its paths. An id with very many edges is pre-summed before the
    shuffle.
    """
    ends = edges.dropna(subset=["a", "b"]).filter("a <> b").select("a", "b")
    left, left_path = work.keep(ends.union(ends.select("b", "a")).distinct().toDF("a", "b"), "edges")
    alone = edges.dropna(subset=["a", "b"]).filter("a = b").select(F.col("a").alias("id")).distinct()
    labels, labels_path = None, None
    while labels is None or left.limit(1).count():
        low = left.groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("p"))
        low, low_path = work.keep(low, "pointers")
        far = low.select(F.col("a").alias("p"), F.col("p").alias("to"))
        to, to_path = work.keep(low.join(far, "p").select("a", "to"), "pointers")
        work.drop(low_path)
        if labels is None:
            after = to.select(F.col("a").alias("id"), F.col("to").alias("label"))
        else:
            moved = labels.join(to.withColumnRenamed("a", "label"), "label", "left")
            after = moved.select("id", F.coalesce("to", "label").alias("label"))
        after, after_path = work.keep(after, "labels")
        one = left.join(to, "a").select("b", F.col("to").alias("a2"))
        two = one.join(to.withColumnRenamed("a", "b"), "b").select("a2", F.col("to").alias("b2"))
        rest, rest_path = work.keep(two.filter("a2 <> b2").distinct().toDF("a", "b"), "edges")
        for path in (left_path, to_path, labels_path):
            if path:
                work.drop(path)
        left, left_path, labels, labels_path = rest, rest_path, after, after_path
    found = labels.withColumnRenamed("label", "component")
    single = alone.join(found, "id", "left_anti").withColumn("component", F.col("id"))
    return found.unionByName(single)
