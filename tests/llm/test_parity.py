from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest

from cohortwise.llm import parity
from support import awkward, documents


def shingles(text, words):
    w = (text or "").encode().lower().split()
    if len(w) < words:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i : i + words]) for i in range(len(w) - words + 1))


def brute(rows, words, percent):
    """Every pair, in plain Python."""
    sets = {i: shingles(t, words) for i, t in rows}
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            common = len(sets[a] & sets[b])
            if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                one, two = sorted((find(a), find(b)))
                up[two] = one
    return {i: (len(sets[i]), find(i)) for i in sets}


def near_copies(seed, groups, copies, edits):
    """Texts and copies with a few words changed, so that similarities lie around
    the limit, in groups and in chains."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(groups):
        base = rng.choices(words, k=rng.choice([3, 8, 20, 60, 150, 400]))
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randint(0, edits)):
                text[rng.randrange(len(text))] = rng.choice(words) + "x"
            if rng.random() < 0.3:
                text = text[: max(1, len(text) - rng.randint(0, 6))]
            rows.append((len(rows), " ".join(text).title() if rng.random() < 0.2 else "\n".join(text)))
            if rng.random() < 0.3:
                base = text
    return rows


@pytest.mark.parametrize(("seed", "words", "percent"), [(1, 3, 90), (2, 5, 80), (3, 2, 60)])
def test_components_equal_brute_force(spark, seed, words, percent):
    rows = near_copies(seed, 25, 14, 8)
    out = parity.jaccard_components(documents(spark, rows), words=words, percent=percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out} == brute(rows, words, percent)


def test_a_large_group_of_near_copies(spark):
    rng = random.Random(4)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(900):
        text = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 6, 9])):
            text[rng.randrange(120)] = f"e{rng.randrange(10_000)}"
        rows.append((i, " ".join(text)))
    out = parity.jaccard_components(documents(spark, rows), words=3, percent=90).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out} == brute(rows, 3, 90)


def test_linked_sets_share_a_key():
    rng = np.random.default_rng(5)
    for percent in (60, 80, 90):
        limit = parity.Limit(percent)
        for _ in range(400):
            n = int(rng.integers(1, 300))
            a = np.unique(rng.integers(0, 2**64, n, np.uint64))
            drop = int(rng.integers(0, max(1, len(a) // 3) + 1))
            b = np.unique(np.concatenate([rng.permutation(a)[drop:], rng.integers(0, 2**64, drop // 2, np.uint64)]))
            common = len(np.intersect1d(a, b))
            if len(b) and limit.links(common, len(a), len(b)):
                assert set(parity.bucket_keys(a, limit)) & set(parity.bucket_keys(b, limit))


def test_hamming_distance_bounds_the_difference():
    rng = np.random.default_rng(6)
    for _ in range(100):
        a = np.unique(rng.integers(0, 2**64, 200, np.uint64))
        b = np.unique(np.concatenate([a[: int(rng.integers(100, 200))], rng.integers(0, 2**64, 20, np.uint64)]))
        bits = []
        for s in (a, b):
            full = np.zeros(parity.SKETCH_WORDS, np.uint64)
            place, word = parity.sketch(s, parity.SKETCH_WORDS, parity.one_bit(s))
            full[place] = word
            bits.append(full)
        assert np.bitwise_count(bits[0] ^ bits[1]).sum() <= len(np.setxor1d(a, b))


def test_folded_sketches_are_narrower_ones():
    rng = np.random.default_rng(7)
    for n in (1, 500, 513, 3000, 40_000):
        s = np.unique(rng.integers(0, 2**64, n, np.uint64))
        wide = parity.pair_sketch(s)
        assert len(wide) * parity.SKETCH_LOAD >= len(s) or len(wide) == parity.SKETCH_WORDS
        narrow = np.zeros(parity.SKETCH_WORDS, np.uint64)
        place, word = parity.sketch(s, parity.SKETCH_WORDS, parity.one_bit(s))
        narrow[place] = word
        assert (parity.folded(wide, parity.SKETCH_WORDS) == narrow).all()
        other = np.unique(np.concatenate([s[n // 20 :], rng.integers(0, 2**64, n // 20, np.uint64)]))
        if len(other):
            assert not parity.far_apart(wide.tobytes(), parity.pair_sketch(other).tobytes(), len(np.setxor1d(s, other)))


def test_awkward_rows(spark):
    out = sorted(
        (r["doc_id"] or -1, r["n_shingles"], r["component_id"])
        for r in parity.jaccard_components(awkward(spark)).collect()
    )
    assert out == [
        (-1, 3, None),
        (1, 5, 1),
        (2, 5, 1),
        (2, 5, 1),
        (3, 0, 3),
        (4, 0, 4),
        (5, 0, 5),
        (6, 977, 6),
        (7, 978, 6),
        (8, 1, 8),
        (9, 1, 9),
        (10, 4, 10),
    ]


def test_empty_table_and_limits(spark):
    assert parity.jaccard_components(awkward(spark).limit(0)).collect() == []
    with pytest.raises(ValueError):
        parity.Limit(40)


def test_components_of_chains_and_stars(spark):
    from cohortwise.llm.common import Workspace
    from cohortwise.llm.graph import components

    chain = [(i * 7919 % 500, (i + 1) * 7919 % 500) for i in range(499)]
    edges = chain + [(1000, 1000 + i) for i in range(1, 300)] + [(2000, 2000), (3001, 3000), (None, 5)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r["id"]: r["component"] for r in components(df, Workspace(spark, "t")).collect()}
    assert got == {**{i: 0 for i in range(500)}, **{1000 + i: 1000 for i in range(300)}, 2000: 2000, 3000: 3000, 3001: 3000}
    assert components(df.limit(0), Workspace(spark, "t")).collect() == []


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_an_id_with_several_texts_keeps_the_links_of_its_copies(spark, parts):
    """Id 1 has texts x and y, id 2 x, and id 3 nearly x: whatever row comes first, and
    whichever text stands for id 1, ids 2 and 3 are linked."""
    rnd = random.Random(4)
    x = [f"w{rnd.random()}" for _ in range(200)]
    y = [f"v{rnd.random()}" for _ in range(50)]
    rows = [(1, " ".join(x)), (1, " ".join(y)), (2, " ".join(x)), (3, " ".join([*x, "end"]))]
    for order in (rows, rows[::-1]):
        docs = documents(spark, order).coalesce(1).repartition(parts)
        got = {r["doc_id"]: r["component_id"] for r in parity.jaccard_components(docs).collect()}
        assert got[2] == got[3]
        assert got[2] in (1, 2) and got[1] == 1
