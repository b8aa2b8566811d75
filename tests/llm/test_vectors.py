from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortwise.llm import neardup, topk

SCHEMA = "vec_id bigint, embedding array<float>, label int, links int, score int"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA)


def top(df, queries, k=5):
    whole = df.select("vec_id", "score", topk.whole_numbers(F.col("embedding")).alias("vector"))
    out = topk.top_inner_products(whole, queries, k).collect()
    return {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in out}


def brute_top(rows, k, query):
    fine = [(i, [math.floor(256 * x) for x in np.array(v, np.float32).astype(float)]) for i, v, _ in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for i, v in fine:
        if query(i):
            scores = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in fine if j != i and len(w) == len(v))
            out |= {(i, rank + 1, j, -s) for rank, (s, j) in enumerate(scores[:k])}
    return out


@pytest.mark.parametrize("block", [7, 100, 8192])
def test_top_k_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK_ROWS", block)
    rng = np.random.default_rng(block)
    rows = [(i, [float(x) for x in np.round(rng.standard_normal(6), 1 if i % 3 else 0)], 0) for i in range(300)]
    rows += [(300 + i, rows[i][1], 0) for i in range(40)]  # ties
    got = top(vectors(spark, rows), F.col("vec_id") % 50 == 0)
    assert got == brute_top(rows, 5, lambda i: i % 50 == 0)


def test_threshold_stops_early():
    values = np.zeros((1000, 3), np.int64)
    values[:5] = [[100, 100, 100]] * 5
    ids, scores, depth = topk.SortedLists(np.arange(1000), values).best(np.array([1, 2, 3]), None, 3)
    assert ids.tolist() == [0, 1, 2] and scores.tolist() == [600] * 3 and depth < 100


def test_awkward_vectors_in_search(spark):
    rows = [
        (0, [1.0, 2.0], 0), (1, [0.5, 0.5], 0), (1, [0.25, 0.5], 0), (2, None, 0), (3, [float("nan"), 1.0], 0),
        (4, [float("inf"), 1.0], 0), (5, [None, 1.0], 0), (None, [1.0, 1.0], 0), (6, [1.0, 2.0, 3.0], 0), (50, [0.0, 0.0], 0),
        (7, [], 0), (100, [3e6, 3e6], 0), (8, [-3e6, 2e6], 0),
    ]
    got = top(vectors(spark, rows), F.col("vec_id") % 50 == 0)
    assert got == brute_top(rows, 5, lambda i: i % 50 == 0)
    assert top(vectors(spark, rows).limit(0), F.col("vec_id") % 50 == 0) == set()


def brute_links(rows, threshold):
    units = {}
    for n, (i, v, label) in enumerate(rows):
        ok = i is not None and v and label is not None and all(x is not None and math.isfinite(x) for x in v)
        x = np.array(v, np.float32).astype(float) if ok else None
        if ok and np.linalg.norm(x) > 0:
            units[n] = (x / np.linalg.norm(x), label)
    links, up = {n: 0 for n in range(len(rows))}, {r[0]: r[0] for r in rows}

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    keys = list(units)
    for k, a in enumerate(keys):
        for b in keys[k + 1 :]:
            (x, la), (y, lb) = units[a], units[b]
            if la == lb and len(x) == len(y) and x @ y >= threshold:
                links[a] += 1
                links[b] += 1
                one, two = sorted((find(rows[a][0]), find(rows[b][0])))
                up[two] = one
    return sorted((str(r[0]), links[n], str(find(r[0]))) for n, r in enumerate(rows))


def clusters(seed, n, width=16):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(n):
        base = rng.standard_normal(width)
        for _ in range(int(rng.choice([1, 2, 5, 30]))):
            noise = rng.standard_normal(width) * rng.choice([0.0, 0.1, 0.25])
            rows.append((len(rows), [float(x) for x in base + noise], int(c % 3)))
    return rows


@pytest.mark.parametrize("block", [4, 512])
def test_near_vectors_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK_ROWS", block)
    rows = clusters(block, 60)
    out = neardup.near_duplicates(vectors(spark, rows)).collect()
    got = sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"])) for r in out)
    want = brute_links(rows, 0.93)
    missed = sum(a[1] for a in want) - sum(a[1] for a in got)
    assert 0 <= missed <= 0.02 * sum(a[1] for a in want)
    if not missed:
        assert got == want
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in out)


def test_awkward_vectors(spark):
    rows = [
        (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [1.0, 0.01], 2), (4, [1.0, 0.0], None), (5, None, 1),
        (6, [0.0, 0.0], 1), (7, [float("nan"), 1.0], 1), (8, [None, 1.0], 1), (9, [], 1), (10, [2.0, 0.0], 1), (11, [1.0, 0.0, 0.0], 1),
        (None, [1.0, 0.0], 1),
    ]
    out = neardup.near_duplicates(vectors(spark, rows)).collect()
    got = sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"])) for r in out)
    assert got == brute_links(rows, 0.93)
    assert [r["kept"] for r in out if r["vec_id"] is None] == [False]
    assert neardup.near_duplicates(vectors(spark, rows).limit(0)).collect() == []


def test_equal_vectors_without_pairs(spark):
    out = neardup.near_duplicates(vectors(spark, [(i, [1.0, 2.0, 3.0], 1) for i in range(500)])).collect()
    assert {(r["n_links"], r["component_id"]) for r in out} == {(499, 0)}


@pytest.mark.parametrize("scale", [1e-320, 1e-200, 1.0, 1e200, 1e307])
def test_lengths_out_of_range_link(spark, scale):
    """Squares of such values are zero or infinite in doubles; the cosine is not."""
    rows = [(1, [scale, scale], 3), (2, [2 * scale, 2 * scale], 3), (3, [scale, -scale], 3), (4, [0.0, 0.0], 3)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in neardup.near_duplicates(df).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (0, 3), 4: (0, 4)}


def test_products_beyond_64_bits(spark):
    """Exact where the score fits, and an error, never a wrapped number, where not."""
    big = 3 * 10**9
    rows = [(0, [big, 10**9]), (1, [big, -9 * 10**9]), (2, [2, 1]), (3, [-big, 0]), (4, [big, -8 * 10**9])]
    df = spark.createDataFrame(rows, "vec_id bigint, vector array<bigint>")
    asked = topk.top_inner_products(df, F.col("vec_id") == 0, 3).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in asked] == [(4, 10**18), (2, 7 * 10**9), (1, 0)]
    over = df.unionByName(spark.createDataFrame([(5, [big * 10, big])], df.schema))
    with pytest.raises(Exception, match="does not fit 64 bits"):
        topk.top_inner_products(over, F.col("vec_id") == 0, 3).collect()
