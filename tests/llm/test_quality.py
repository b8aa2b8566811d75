from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from cohortwise.llm import quality
from support import awkward, documents


def corpus(n):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice("the of and cat dog house runs sleeps under over".split()) for _ in range(rng.randint(20, 80))]
        bad = i % 4 == 0
        if bad:
            words = [w.upper() + "!!" for w in words] if i % 8 else [w + rng.choice(["$$$", "%%%"]) for w in words]
        rows.append((i, " ".join(words)))
        labels.append((i, int(not bad)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus(600)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int")
    out = quality.quality_scores(documents(spark, rows), marks, F.col("doc_id") % 5 != 0).collect()
    truth = dict(labels)
    held = [r for r in out if r["doc_id"] % 5 == 0]
    assert np.mean([(r["score"] >= 0.3) == truth[r["doc_id"]] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in out) and len(out) == 600


def test_context_sums_equal_plain_ones(spark):
    rows = [(1, "a b c a"), (2, "b c"), (3, None)]
    table = quality.word_vectors(documents(spark, rows))
    want = np.zeros((quality.ROWS, quality.WIDTH))
    hashes = quality.WordHashes()
    for _, text in rows:
        tokens = quality.tokens_of(text)
        if not tokens:
            continue
        h = hashes.of(tokens)
        place, sign = quality.index_entries(h)
        for i in range(len(h)):
            for j in range(max(0, i - quality.REACH), min(len(h), i + quality.REACH + 1)):
                if i != j:
                    np.add.at(want[quality.row_of(h)[i]], place[j], sign[j])
    size = np.linalg.norm(want, axis=1, keepdims=True)
    assert np.allclose(table, want / np.where(size > 0, size, 1), atol=1e-6)


def test_temperature_calibrates():
    rng = np.random.default_rng(1)
    logits = rng.standard_normal(20_000) * 3
    y = (rng.random(20_000) < 1 / (1 + np.exp(-logits / 2))).astype(float)
    assert abs(quality.Network._calibrated(logits, y) - 2) < 0.2


def test_awkward_rows(spark):
    docs = awkward(spark)
    marks = spark.createDataFrame([(1, 1), (2, None), (3, 0), (3, 0), (None, 1), (99, 1), (8, 5)], "doc_id bigint, quality int")
    out = quality.quality_scores(docs, marks, F.lit(True)).collect()
    assert len(out) == docs.count() and all(0 <= r["score"] <= 1 for r in out)
    nothing = quality.quality_scores(docs, marks.limit(0), F.lit(True)).collect()
    assert len(nothing) == docs.count()
    assert quality.quality_scores(docs.limit(0), marks, F.lit(True)).collect() == []
