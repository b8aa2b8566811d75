from __future__ import annotations

import math
import os
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortwise.llm import recurrent
from support import awkward, documents

SENTENCE = "the cat sat on the mat and the dog sat on the rug".split()


def numbers(model, ids, name, place, step=1e-3):
    v = getattr(model, name)
    old = v[place]
    out = []
    for side in (step, -step):
        v[place] = old + side
        out.append(-recurrent.log_scores(model, [ids])[0])
    v[place] = old
    return (out[0] - out[1]) / (2 * step)


def test_gradients_equal_differences(monkeypatch):
    """The step that training takes is that of the slope of the loss."""
    model = recurrent.Model(np.array([9, 7, 5, 3, 1] * 20), 10)
    for name in model.NAMES:
        setattr(model, name, getattr(model, name).astype(np.float64))
    rng = np.random.default_rng(3)
    model.wc += 0.3 * rng.standard_normal(model.wc.shape)
    model.wi += 0.3 * rng.standard_normal(model.wi.shape)
    ids = rng.integers(0, 101, 20).astype(np.int32)
    before = {n: getattr(model, n).copy() for n in model.NAMES}
    slopes = {n: [(p, numbers(model, ids, n, p)) for p in places(rng, getattr(model, n), n, ids)] for n in model.NAMES}
    monkeypatch.setattr(recurrent, "LARGEST_WEIGHT", 100.0)
    memory = [np.full_like(v, 1e12) for v in model.values()]  # a plain step, scaled by 1e6
    recurrent.train(model, [ids], memory, rate=1e6)
    pairs = [((before[n][p] - getattr(model, n)[p]), s) for n in model.NAMES for p, s in slopes[n] if abs(s) > 1e-3]
    ratio = [a / b for a, b in pairs]
    assert len(pairs) > 12 and np.std(ratio) < 0.02 * abs(np.mean(ratio)) and np.mean(ratio) > 0


def places(rng, values, name, ids):
    for _ in range(6):
        p = tuple(int(rng.integers(0, n)) for n in values.shape)
        yield (int(rng.choice(np.append(ids[:-1], 0))), *p[1:]) if name == "x" else p


def test_probabilities_sum_to_one():
    model = recurrent.Model(np.arange(200, 0, -1), 50)
    rng = np.random.default_rng(4)
    model.wc += rng.standard_normal(model.wc.shape).astype(np.float32)
    model.wi += rng.standard_normal(model.wi.shape).astype(np.float32)
    for start in ([], [3], [7, 150, 0]):
        base = recurrent.log_scores(model, [np.array(start, np.int32)])[0] if start else 0.0
        rest = [np.array([*start, w], np.int32) for w in range(201)]
        total = np.exp(recurrent.log_scores(model, rest) - base).sum()
        assert abs(total - 1) < 1e-3


def test_state_goes_through_whole_texts():
    model = recurrent.Model(np.arange(50, 0, -1), 5)
    model.wc += np.random.default_rng(5).standard_normal(model.wc.shape).astype(np.float32)
    tail = np.tile(np.arange(1, 40, dtype=np.int32), 20)
    a, b = (np.concatenate([[first], tail]).astype(np.int32) for first in (1, 2))
    one, two = recurrent.log_scores(model, [a, b])
    again = recurrent.log_scores(model, [b, a[:5], a])
    assert again[0] == pytest.approx(two, rel=1e-5) and again[2] == pytest.approx(one, rel=1e-5)


def test_base_counts_and_learning(spark, monkeypatch):
    monkeypatch.setattr(recurrent, "MODEL_WORDS", 12)
    monkeypatch.setattr(recurrent, "COMMON_WORDS", 14)
    monkeypatch.setattr(recurrent, "SHARES", 2)
    rng = random.Random(7)
    rows = []
    for i in range(400):
        text = SENTENCE * rng.randint(1, 6) + ([f"rare{rng.randrange(60)}"] if i % 3 == 0 else [])
        rows.append((i, " ".join(text).capitalize()))
    rows.append((400, "never seen words"))
    learn = F.col("doc_id") % 7 != 2
    out = {r["doc_id"]: r for r in recurrent.model_scores(documents(spark, rows), learn).collect()}
    tokens = {i: [*t.lower().split(), None] for i, t in rows}
    counts = Counter(w for i, t in tokens.items() if i % 7 != 2 for w in t)
    n, v = sum(counts.values()), len(counts)
    for i, words in tokens.items():
        r = out[i]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        assert (r["n_tokens"], r["train_tokens"]) == (len(words), n)
        assert r["n_known"] == sum(counts[w] > 0 for w in words)
        assert r["base_score"] == pytest.approx(base)
    held = [i for i in tokens if i % 7 == 2]
    assert sum(out[i]["score"] for i in held) > 0.8 * sum(out[i]["base_score"] for i in held)


def test_awkward_rows(spark):
    docs = awkward(spark)
    out = recurrent.model_scores(docs, F.col("doc_id") > 1).collect()
    assert len(out) == docs.count()
    by = {r["doc_id"]: r for r in out}
    assert all(by[i]["n_tokens"] == 1 for i in (3, 4, 5)) and by[None]["n_tokens"] == 6
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in out)
    assert recurrent.model_scores(docs.limit(0), F.col("doc_id") > 1).collect() == []
    untrained = recurrent.model_scores(docs, F.lit(False)).collect()
    assert {r["n_known"] for r in untrained} == {0} and all(r["base_score"] == 0 for r in untrained)


def test_rounds_learn_from_every_document(spark, tmp_path, monkeypatch):
    """Every training text goes through a learner once, with the query's own numbers."""
    plain = recurrent._learner

    def noted(model, vocabulary):
        learn, folder = plain(model, vocabulary), str(tmp_path)

        def go(batches):
            def passed():
                for batch in batches:
                    with open(f"{folder}/{os.getpid()}", "a") as seen:
                        seen.writelines(f"{text}\n" for text in batch.column(0))
                    yield batch

            yield from learn(passed())

        return go

    monkeypatch.setattr(recurrent, "_learner", noted)
    rows = [(i, f"text number {i}") for i in range(90)]
    recurrent.model_scores(documents(spark, rows), F.col("doc_id") % 3 != 0).count()
    seen = sorted(line for f in tmp_path.iterdir() for line in f.read_text().splitlines())
    assert seen == sorted(t for i, t in rows if i % 3)
