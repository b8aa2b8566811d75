from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from cohortwise.llm import mixing
from cohortwise.llm.common import Workspace
from support import awkward, documents


def cells(spark, rows):
    return spark.createDataFrame(rows, "source string, lang string, topic int, tokens bigint")


def fitted(table, goals, rounds=200):
    """Plain iterative proportional fitting of an array."""
    w = table.astype(float)
    for _ in range(rounds):
        for axis, goal in enumerate(goals):
            sums = w.sum(axis=tuple(a for a in range(w.ndim) if a != axis))
            factor = np.where(sums > 0, goal / np.where(sums > 0, sums, 1), 1)
            w *= factor.reshape([-1 if a == axis else 1 for a in range(w.ndim)])
    return w


def test_raked_margins_equal_plain_fitting(spark):
    rng = np.random.default_rng(1)
    table = rng.integers(1, 1000, (4, 3, 2))
    rows = [(f"s{i}", f"l{j}", k, int(table[i, j, k])) for i in range(4) for j in range(3) for k in range(2)]
    shares = [np.array([4, 3, 2, 1]), np.array([1, 1, 2]), np.array([3, 1])]
    goals = [table.sum() * s / s.sum() for s in shares]
    names = (("source", "s"), ("lang", "l"), ("topic", ""))
    targets = {}
    for (dim, mark), s in zip(names, shares):
        values = [(f"{mark}{i}" if mark else i, float(v)) for i, v in enumerate(s)]
        targets[dim] = spark.createDataFrame(values, f"value {'int' if dim == 'topic' else 'string'}, share double")
    got = mixing.raked(cells(spark, rows), targets, Workspace(spark, "t")).collect()
    want = fitted(table, goals)
    for r in got:
        i, j, k = int(r["source"][1:]), int(r["lang"][1:]), r["topic"]
        assert abs(r["weight"] / want[i, j, k] - 1) < 0.02


def test_values_without_target_get_nothing(spark):
    rows = [("a", "en", 0, 10), ("b", "en", 0, 30), (None, "en", 0, 20), ("c", "en", 0, 40)]
    target = spark.createDataFrame([("a", 1.0), (None, 3.0), ("b", 0.0), ("z", 5.0)], "value string, share double")
    got = {r["source"]: r["weight"] for r in mixing.raked(cells(spark, rows), {"source": target}, Workspace(spark, "t")).collect()}
    assert got == {"a": 25.0, "b": 0.0, None: 75.0, "c": 0.0}


def test_draws_follow_the_rates(spark):
    rows = [(i, f"word{i % 13} two three", "en" if i % 4 else "de", f"s{i % 3 if i % 2 else 0}") for i in range(4000)]
    out = mixing.mix_to_targets(documents(spark, rows), power=0.5, share=0.5).collect()
    tokens = sum(r["copies"] * r["n_tokens"] for r in out)
    assert abs(tokens / (0.5 * 4000 * 3) - 1) < 0.06
    assert all(r["copies"] in (int(r["rate"]), int(r["rate"]) + 1) for r in out)
    lang = {r[0]: r[2] for r in rows}
    german = sum(r["copies"] for r in out if lang[r["doc_id"]] == "de") / sum(r["copies"] for r in out)
    assert abs(german - 1 / (1 + 3**0.5)) < 0.05


def test_awkward_rows(spark):
    out = mixing.mix_to_targets(awkward(spark), power=0.5, share=1.0)
    assert out.columns == ["doc_id", "n_tokens", "topic", "rate", "copies"]
    assert out.filter(F.col("copies") < 1).count() == 0
    assert mixing.mix_to_targets(awkward(spark).limit(0)).collect() == []
    only_empty = documents(spark, [(1, None), (2, "")])
    assert mixing.mix_to_targets(only_empty).collect() == []
