"""Vector set measures against numpy."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest

from cohortwise.operators import vectorsets as X


@pytest.fixture(scope="module")
def sets():
    rng = np.random.default_rng(4)
    mix = rng.normal(size=(8, 8))
    real = rng.normal(size=(300, 8)) @ mix
    fake = rng.normal(loc=0.4, size=(170, 8)) @ mix * 1.2
    return real, fake


def frame(spark, sets, parts=5):
    rows = [(i, "real", v.tolist()) for i, v in enumerate(sets[0])]
    rows += [(1000 + i, "fake", v.tolist()) for i, v in enumerate(sets[1])]
    return spark.createDataFrame(rows, "id int, side string, v array<double>").repartition(parts)


def frechet(a, b):
    """Through the symmetric root of the first covariance."""
    ca, cb = np.cov(a.T), np.cov(b.T)
    w, q = np.linalg.eigh(ca)
    root = q @ np.diag(np.sqrt(np.clip(w, 0, None))) @ q.T
    cross = np.sqrt(np.clip(np.linalg.eigvalsh(root @ cb @ root), 0, None)).sum()
    return ((a.mean(0) - b.mean(0)) ** 2).sum() + np.trace(ca) + np.trace(cb) - 2 * cross


@pytest.mark.parametrize("parts", [1, 7])
def test_frechet_distance(spark, sets, parts):
    got = X.frechet_distance(frame(spark, sets, parts), "v", "side", "real", "fake").first()[0]
    assert got == pytest.approx(frechet(*sets), rel=1e-9)


def test_frechet_distance_of_a_set_to_itself_is_zero(spark, sets):
    got = X.frechet_distance(frame(spark, (sets[0], sets[0])), "v", "side", "real", "fake").first()[0]
    assert got == pytest.approx(0, abs=1e-6)


@pytest.mark.parametrize("parts", [1, 4])
def test_frechet_distance_rejects_mixed_widths(spark, parts):
    rows = [("real", [1.0]), ("real", [2.0]), ("fake", [1.0, 2.0]), ("fake", [2.0, 2.0])]
    df = spark.createDataFrame(rows, "side string, v array<double>").repartition(parts)
    with pytest.raises(Exception, match="share one width"):
        X.frechet_distance(df, "v", "side", "real", "fake")
    mixed = spark.createDataFrame([("real", [1.0]), ("real", [2.0, 1.0])], "side string, v array<double>")
    with pytest.raises(Exception):
        X.frechet_distance(mixed.repartition(parts), "v", "side", "real", "fake")


def test_frechet_distance_needs_two_vectors_a_side(spark):
    df = spark.createDataFrame([("real", [1.0]), ("real", [2.0]), ("fake", [1.0]), ("fake", None)], "side string, v array<double>")
    with pytest.raises(ValueError, match="fake"):
        X.frechet_distance(df, "v", "side", "real", "fake")


def test_blocks_of_vectors(spark, sets, monkeypatch):
    whole = X.frechet_distance(frame(spark, sets), "v", "side", "real", "fake").first()[0]
    monkeypatch.setattr(X, "BLOCK_ROWS", 7)
    assert X.frechet_distance(frame(spark, sets), "v", "side", "real", "fake").first()[0] == pytest.approx(whole)

def test_inception_score(spark):
    rng = np.random.default_rng(9)
    logits = rng.normal(size=(500, 6)) * 2
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(logits)], "id int, s array<double>")
    got = X.inception_score(df, "s", ["id"], 1, folds=4).first()
    p = np.exp(logits - logits.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    fold = np.array([int(hashlib.md5(f"1|{i}".encode()).hexdigest()[:8], 16) % 4 for i in range(500)])
    scores = []
    for f in range(4):
        part = p[fold == f]
        scores.append(np.exp((part * (np.log(part) - np.log(part.mean(0)))).sum(1).mean()))
    assert got.inception_mean == pytest.approx(np.mean(scores))
    assert got.inception_std == pytest.approx(np.std(scores, ddof=1))


def test_pair_ssim(spark, sets):
    df = frame(spark, sets)
    got = X.pair_ssim(df.where("side = 'fake'"), df.where("side = 'real'"), "v", ["id"], 2).first()

    def ranked(vectors, first):
        return sorted(range(len(vectors)), key=lambda i: hashlib.md5(f"2|{first + i}".encode()).hexdigest())

    real, fake = sets
    r = max(real.max() - real.min(), fake.max() - fake.min())
    c1, c2 = (0.01 * r) ** 2, (0.03 * r) ** 2
    values = []
    for i, j in zip(ranked(fake, 1000), ranked(real, 0)):
        x, y = fake[i], real[j]
        cov = (x * y).mean() - x.mean() * y.mean()
        values.append((2 * x.mean() * y.mean() + c1) * (2 * cov + c2)
                      / ((x.mean() ** 2 + y.mean() ** 2 + c1) * (x.var() + y.var() + c2)))
    assert got.pairs == len(fake)
    assert got.ssim == pytest.approx(np.mean(values))


def test_ssim_of_equal_vectors_is_one(spark):
    df = spark.createDataFrame([([1.0, 2.0, 5.0], [1.0, 2.0, 5.0])], "x array<double>, y array<double>")
    assert X.ssim(df, "x", "y", 4.0).first().ssim == pytest.approx(1.0)


@pytest.mark.parametrize("tile", [1, 3, 8, 9, 100])
def test_moments_equal_numpy(spark, sets, tile):
    """Whatever the tiles; null vectors are counted, also of a set that has no others."""
    df = frame(spark, sets).select("v", "side")
    more = [(None, "real"), (None, "real"), (None, "empty"), ([1.0] * len(sets[0][0]), None)]
    df = df.unionByName(spark.createDataFrame(more, df.schema))
    rows = X.vector_moments(df, "v", "side", tile=tile).collect()
    for name, vectors, skipped in (("real", sets[0], 2), ("fake", sets[1], 0)):
        mean, covariance = np.mean(vectors, axis=0), np.cov(np.asarray(vectors).T)
        own = [r for r in rows if r["set"] == name]
        assert len(own) == len(mean) * (len(mean) + 1) // 2
        assert {(r.n, r.skipped) for r in own} == {(len(vectors), skipped)}
        for r in own:
            assert (r.mean_i, r.mean_j) == pytest.approx((mean[r.i], mean[r.j]))
            assert r.covariance == pytest.approx(covariance[r.i, r.j])
    assert {r["set"] for r in rows} == {"real", "fake"}


def test_partial_moments_do_not_grow_with_the_splits(spark, sets):
    """Tasks are as many as run at a time, however many splits the vectors have."""
    tiles = X.gram_tiles(frame(spark, sets, 200), "v", "side")
    written = tiles._jdf.queryExecution().toRdd().getNumPartitions()
    assert written <= spark.sparkContext.defaultParallelism
    plan = tiles._jdf.queryExecution().executedPlan().toString()
    assert f"Coalesce {spark.sparkContext.defaultParallelism}" in plan


def test_distance_counts_what_it_skips(spark, sets):
    df = frame(spark, sets).select("v", "side")
    df = df.unionByName(spark.createDataFrame([(None, "real")] * 3, df.schema))
    row = X.frechet_distance(df, "v", "side", "real", "fake").first()
    assert (row.n_real, row.n_fake, row.skipped) == (len(sets[0]), len(sets[1]), 3)
    with pytest.raises(Exception, match="at most 2"):
        X.frechet_distance(df, "v", "side", "real", "fake", max_width=2)
