from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import pytest

from cohortwise.llm import kdshards
from support import awkward, documents


def shards_of(df):
    return [r.asDict() for r in df.collect()]


def check(rows, shards):
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
    assert set(by) <= set(range(shards))
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_bytes_are_even_and_copies_stay_together(spark):
    texts = [f"text {i} " + "x" * (i * 37 % 900) for i in range(600)]
    rows = [(i, t, ("en", "de", "fr")[i % 3], f"s{i % 7}") for i, t in enumerate(texts)]
    rows += [(1000 + i, t, "es", "other") for i, t in enumerate(texts[:100])]
    out = shards_of(kdshards.kd_shards(documents(spark, rows), shards=8))
    check(out, 8)
    assert len(out) == 700
    sizes = Counter()
    for r in out:
        sizes[r["shard"]] += r["size"]
    mean = sum(sizes.values()) / 8
    assert max(sizes.values()) < 1.1 * mean and min(sizes.values()) > 0.9 * mean
    where = {r["doc_id"]: r["shard"] for r in out}
    assert all(where[i] == where[1000 + i] for i in range(100))


def test_a_hot_group_is_dealt(spark):
    rows = [(i, "the same text " * 20) for i in range(400)] + [(1000 + i, f"other {i} " * 20) for i in range(400)]
    out = shards_of(kdshards.kd_shards(documents(spark, rows), shards=10))
    check(out, 10)
    sizes = Counter()
    for r in out:
        sizes[r["shard"]] += r["size"]
    mean = sum(sizes.values()) / 10
    assert len(sizes) == 10 and max(sizes.values()) < 1.25 * mean


def test_target_bytes(spark):
    rows = [(i, f"{i} " + "y" * 84) for i in range(256)]
    out = shards_of(kdshards.kd_shards(documents(spark, rows), target_bytes=4096))
    assert len({r["shard"] for r in out}) == -(-sum(r["size"] for r in out) // 4096)


def test_awkward_rows(spark):
    docs = awkward(spark)
    out = shards_of(kdshards.kd_shards(docs, shards=3))
    check(out, 3)
    expected = Counter()
    for r in docs.collect():
        raw = (r["text"] or "").encode()
        expected[(r["doc_id"], len(raw) + 16, zlib.crc32(raw))] += 1
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == expected


def test_empty_and_wrong_arguments(spark):
    assert kdshards.kd_shards(documents(spark, [(1, "x")]).limit(0), shards=40).collect() == []
    with pytest.raises(ValueError):
        kdshards.kd_shards(documents(spark, [(1, "x")]))
