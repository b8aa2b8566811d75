"""Exactness of splits and draws, whatever the partitioning and the skew."""

from __future__ import annotations

import hashlib
import math
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import cohortwise.operators.ranks as ranks
import cohortwise.operators.sampling as sampling
import cohortwise.session as session
from cohortwise.operators.ranks import assign_parts, ordered_rank, pick_first, seeded_rank
from cohortwise.operators.sampling import (
    bootstrap_per_class,
    mix_generated,
    prepare_splits,
    resample_to_value,
    sample_rows,
    stratified_split,
    stratified_split3,
    undersample,
    with_test_quota,
)
from cohortwise.plans.cohorts import export_job

SEED = 5


def md5(seed, *keys):
    return hashlib.md5("|".join([str(seed), *[str(k) for k in keys]]).encode()).hexdigest()


def order(rows):
    return sorted(rows, key=lambda r: (md5(SEED, r[0]), r[0]))


@pytest.fixture(scope="module")
def skewed():
    """A class with over a third of the rows, small ones, and one of two rows."""
    return [(i, 0 if i % 5 < 2 else 1 + i % 4) for i in range(3000)] + [(3000, 9), (3001, 9)]


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, "key bigint, label int").repartition(parts)


def expected_quotas(counts: dict, size: float) -> dict:
    n = sum(counts.values())
    n_train = n - math.ceil(size * n)
    whole = {c: k * n_train // n for c, k in counts.items()}
    missing = n_train - sum(whole.values())
    by_fraction = sorted(counts, key=lambda c: (-(counts[c] * n_train % n), c))
    extra = set(by_fraction[:missing])
    return {c: counts[c] - whole[c] - (c in extra) for c in counts}


def by_class(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    return groups


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(2, 400), min_size=1, max_size=6), st.sampled_from([0.1, 0.2, 0.25, 1 / 3, 0.5]))
def test_quotas(spark, sizes, share):
    counts = dict(enumerate(sizes))
    df = spark.createDataFrame(list(counts.items()), "label int, n bigint")
    got = {r.label: r.test for r in with_test_quota(df, "label", share, "test").collect()}
    assert got == expected_quotas(counts, share)
    assert sum(got.values()) == math.ceil(share * sum(sizes))


@pytest.mark.parametrize("rows,expected", [(2, {0: 1, 1: 1}), (10, {0: 7, 1: 3}), (97, {0: 68, 1: 29})])
def test_quotas_of_a_number_of_rows(spark, rows, expected):
    df = spark.createDataFrame([(0, 70), (1, 30)], "label int, n bigint")
    assert {r.label: r.test for r in with_test_quota(df, "label", rows, "test").collect()} == expected


def test_quotas_beyond_64_bits(spark):
    counts = {0: 7 * 10**12, 1: 3 * 10**12 + 1}
    df = spark.createDataFrame(list(counts.items()), "label int, n bigint")
    got = {r.label: r.test for r in with_test_quota(df, "label", 0.1, "test").collect()}
    assert got == expected_quotas(counts, 0.1)


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_stratified_split(spark, skewed, parts):
    got = {r.key: r.split for r in stratified_split(frame(spark, skewed, parts), "label", ["key"], SEED).collect()}
    quotas = expected_quotas(Counter(l for _, l in skewed), 0.1)
    test = {r[0] for c, rows in by_class(skewed).items() for r in order(rows)[: quotas[c]]}
    assert got == {k: "test" if k in test else "train" for k, _ in skewed}


@pytest.mark.parametrize("parts", [1, 8])
def test_split3_val_comes_after_test(spark, skewed, parts):
    skewed = [r for r in skewed if r[1] != 9]
    df = frame(spark, skewed, parts).withColumn("name", F.concat(F.lit("c"), F.col("label")))
    got = {r.key: (r.code, r.split) for r in stratified_split3(df, "name", ["key"], SEED, 0.2, code="code").collect()}
    codes = {c: i for i, c in enumerate(sorted({l for _, l in skewed}))}
    rows = [(k, codes[l]) for k, l in skewed]
    counts = Counter(c for _, c in rows)
    first = expected_quotas(counts, 0.2)
    second = expected_quotas({c: counts[c] - first[c] for c in counts}, 0.2)
    expected = {}
    for c, members in by_class(rows).items():
        for i, r in enumerate(order(members)):
            expected[r[0]] = (c, "test" if i < first[c] else "val" if i < first[c] + second[c] else "train")
    assert got == expected


def test_split3_without_validation(spark, skewed):
    df = frame(spark, skewed)
    parts = {r.split for r in stratified_split3(df, "label", ["key"], SEED, perform_validation=False).collect()}
    assert parts == {"train", "test"}


def test_class_of_one_row_cannot_be_split(spark):
    with pytest.raises(Exception, match="under two rows"):
        stratified_split(frame(spark, [(1, 0), (2, 0), (3, 1)]), "label", ["key"], SEED).collect()


def test_second_split_needs_two_rows_per_class_too(spark, skewed):
    with pytest.raises(Exception, match="under two rows"):
        stratified_split3(frame(spark, skewed), "label", ["key"], SEED, 0.4).collect()


def test_null_labels_form_a_class(spark):
    rows = [(i, None if i % 3 == 0 else 1) for i in range(90)]
    got = stratified_split(frame(spark, rows), "label", ["key"], SEED).collect()
    assert len(got) == 90
    assert Counter((r.label, r.split) for r in got) == {
        (None, "train"): 27, (None, "test"): 3, (1, "train"): 54, (1, "test"): 6}


def test_more_classes_than_the_fit_limit(spark, skewed, monkeypatch):
    """Beyond the limit nothing is brought to the driver, the result is the same."""
    expected = {r.key: r.split for r in stratified_split(frame(spark, skewed), "label", ["key"], SEED).collect()}
    monkeypatch.setattr(session, "FIT_ROWS", 1)
    got = stratified_split(frame(spark, skewed), "label", ["key"], SEED)
    assert {r.key: r.split for r in got.collect()} == expected
    draws = bootstrap_per_class(frame(spark, skewed), "label", ["key"], 20, SEED)
    assert Counter(r.label for r in draws.collect()) == {c: 20 for c in {l for _, l in skewed}}


@pytest.mark.parametrize("k", [0, 1, 700, 3002, 10_000])
def test_sample_rows(spark, skewed, k):
    got = {r.key for r in sample_rows(frame(spark, skewed), k, ["key"], SEED).collect()}
    assert got == {r[0] for r in order(skewed)[:k]}


def test_part_that_ends_at_a_repeated_key(spark):
    rows = [(i // 2, 0) for i in range(40)]
    assert sample_rows(frame(spark, rows), 4, ["key"], SEED).count() == 4
    with pytest.raises(Exception, match="must be unique"):
        sample_rows(frame(spark, rows), 5, ["key"], SEED).count()


def test_empty_input(spark):
    df = frame(spark, [])
    assert sample_rows(df, 5, ["key"], SEED).count() == 0
    assert undersample(df, "label", ["key"], SEED).count() == 0
    assert stratified_split(df, "label", ["key"], SEED).count() == 0
    assert bootstrap_per_class(df, "label", ["key"], 5, SEED).count() == 0


def test_composite_keys_with_nulls(spark):
    rows = [(i // 2, None if i % 2 else 1) for i in range(200)]
    df = spark.createDataFrame(rows, "a bigint, b int")
    got = pick_first(df, lambda c: c.withColumn("quota", F.lit(50)), ["a", "b"], SEED).collect()
    assert len(got) == len(set(got)) == 50


def test_parts_ending_in_the_same_chunk(spark, skewed):
    quota = lambda c: c.withColumns({"x": F.lit(1), "y": F.lit(0), "z": F.lit(1)})
    dealt = assign_parts(frame(spark, skewed), quota, ["x", "y", "z"], ["key"], SEED, ["label"], "rest", "part")
    got = {r.key: r.part for r in dealt.collect()}
    for rows in by_class(skewed).values():
        parts = [got[r[0]] for r in order(rows)]
        assert parts == ["x", "z"] + ["rest"] * (len(rows) - 2)


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_seeded_rank(spark, skewed, parts):
    got = {r.key: r["rank"] for r in seeded_rank(frame(spark, skewed, parts), ["key"], SEED, ["label"]).collect()}
    expected = {r[0]: i + 1 for rows in by_class(skewed).values() for i, r in enumerate(order(rows))}
    assert got == expected


def test_ordered_rank(spark, skewed):
    df = frame(spark, skewed).withColumn("price", (F.col("key") * 7919 % 1000).cast("double"))
    got = {r.key: r["rank"] for r in ordered_rank(df, "price", ["key"], ["label"]).collect()}
    expected = {}
    for rows in by_class(skewed).values():
        for i, r in enumerate(sorted(rows, key=lambda r: (r[0] * 7919 % 1000, r[0]))):
            expected[r[0]] = i + 1
    assert got == expected


@pytest.mark.parametrize("limit", [1_000_000, 1])
def test_ordered_rank_puts_nulls_first(spark, monkeypatch, limit):
    monkeypatch.setattr(ranks, "MAX_EQUAL", limit)
    rows = [(i, None if i % 10 == 0 else i % 7) for i in range(100)]
    df = spark.createDataFrame(rows, "key int, x int").repartition(3)
    in_order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[0]))
    got = {r.key: r["rank"] for r in ordered_rank(df, "x", ["key"]).collect()}
    assert got == {r[0]: i + 1 for i, r in enumerate(in_order)}


@pytest.mark.parametrize("limit", [1_000_000, 100])
def test_ordered_rank_of_a_hot_value(spark, skewed, monkeypatch, limit):
    """A value in a third of the rows; over the limit its rows are cut by key."""
    monkeypatch.setattr(ranks, "MAX_EQUAL", limit)
    df = frame(spark, skewed).withColumn("x", F.when(F.col("key") % 3 == 0, 500).otherwise(F.col("key") % 1000))
    ranged = ranks.range_chunk(df, ["x", "key"])[0]
    hot = ranged.where("x = 500").select("_range").distinct().count()
    assert (hot > 1) == (limit == 100)
    got = {r.key: r["rank"] for r in ordered_rank(df, "x", ["key"]).collect()}
    in_order = sorted((k for k, _ in skewed), key=lambda k: (500 if k % 3 == 0 else k % 1000, k))
    assert got == {k: i + 1 for i, k in enumerate(in_order)}


def test_ordered_rank_of_one_value_and_of_names(spark, skewed):
    df = frame(spark, skewed).withColumn("same", F.lit(1))
    got = sorted(r["rank"] for r in ordered_rank(df, "same", ["key"]).collect())
    assert got == list(range(1, len(skewed) + 1))
    named = df.withColumn("name", F.format_string("scan-%d", F.col("key") * 7919 % 1000))
    ranked = {r.key: r["rank"] for r in ordered_rank(named, "name", ["key"], ["label"]).collect()}
    for rows in by_class(skewed).values():
        in_order = sorted(rows, key=lambda r: (f"scan-{r[0] * 7919 % 1000}", r[0]))
        assert [ranked[r[0]] for r in in_order] == list(range(1, len(rows) + 1))


def drawn(rows, need):
    """Brute force: draw i of a class names the row at md5(seed, class, i) mod n."""
    out = Counter()
    for c, members in by_class(rows).items():
        ranked = order(members)
        for i in range(need(len(members))):
            out[(ranked[int(md5(SEED, c, i)[:15], 16) % len(members)][0], c, i)] += 1
    return out


@pytest.mark.parametrize("parts", [1, 3, 8])
@pytest.mark.parametrize("broadcast_limit,block,few", [(200_000, 65_536, 64), (0, 64, 64), (200_000, 64, 0)])
def test_bootstrap(spark, skewed, monkeypatch, parts, broadcast_limit, block, few):
    """Draws broadcast, merged, and looked up by place."""
    monkeypatch.setattr(sampling, "BROADCAST_DRAWS", broadcast_limit)
    monkeypatch.setattr(sampling, "DRAW_BLOCK", block)
    monkeypatch.setattr(sampling, "FEW_DRAWS", few)
    got = bootstrap_per_class(frame(spark, skewed, parts), "label", ["key"], 250, SEED)
    assert Counter(tuple(r) for r in got.collect()) == drawn(skewed, lambda n: 250)


@pytest.mark.parametrize("few", [64, 0])
def test_draws_take_a_null_label_as_a_class(spark, monkeypatch, few):
    monkeypatch.setattr(sampling, "FEW_DRAWS", few)
    rows = [(i, None if i % 2 else 1) for i in range(100)]
    got = bootstrap_per_class(frame(spark, rows), "label", ["key"], 7, SEED).collect()
    assert Counter(r.label for r in got) == {1: 7, None: 7}


@pytest.mark.parametrize("chunks", [0, 5000, 10**9])
def test_rows_at_places(spark, skewed, chunks):
    places = [(0, 1, "first"), (0, 1, "again"), (0, 1203, "x"), (9, 2, "last"), (2, 600, "y")]
    asked = spark.createDataFrame(places, "label int, rank bigint, tag string")
    found = ranks.rows_at(frame(spark, skewed), asked, 5, chunks, ["key"], SEED, ["label"])
    got = {(r.key, r.tag) for r in found.collect()}
    ordered = {c: order(rows) for c, rows in by_class(skewed).items()}
    expected = {(ordered[c][p - 1][0], t) for c, p, t in places if p <= len(ordered[c])}
    assert got == expected


def test_resample_keeps_all_rows_and_tops_up(spark, skewed):
    got = resample_to_value(frame(spark, skewed), "label", ["key"], SEED, 700).collect()
    originals = [tuple(r)[:2] for r in got if r.draw is None]
    assert sorted(originals) == sorted(skewed)
    extra = Counter(tuple(r) for r in got if r.draw is not None)
    assert extra == drawn(skewed, lambda n: max(700 - n, 0))
    sizes, before = Counter(r.label for r in got), Counter(l for _, l in skewed)
    assert sizes == {c: max(n, 700) for c, n in before.items()}


def test_undersample(spark, skewed):
    got = {r.key for r in undersample(frame(spark, skewed), "label", ["key"], SEED).collect()}
    smallest = min(Counter(l for _, l in skewed).values())
    assert got == {r[0] for rows in by_class(skewed).values() for r in order(rows)[:smallest]}


def test_mix_generated(spark):
    train = spark.createDataFrame([(f"t{i}", i % 2) for i in range(40)], "image_files string, labels int")
    generated = spark.createDataFrame([(f"g{i}", 0) for i in range(50)], "image_files string, labels int")
    mixed = mix_generated(train, generated, "labels", 1, ["image_files"], SEED).collect()
    added = [r for r in mixed if r.image_files.startswith("g")]
    assert len(added) == abs(20 - 50) and {r.labels for r in added} == {1}
    few = mix_generated(train, generated.limit(3), "labels", 1, ["image_files"], SEED)
    assert few.count() == 40 + 3


def test_prepare_splits_forms_agree(spark, skewed):
    """The one-pass form for undersampling equals split followed by undersampling."""
    rows = [r for r in skewed if r[1] != 9]
    df = frame(spark, rows)
    got = {(r.key, r.split) for r in prepare_splits(df, "label", ["key"], SEED, sampling="undersample").collect()}
    parts = stratified_split(df, "label", ["key"], SEED, names=("train", "val"))
    train = undersample(parts.where("split = 'train'"), "label", ["key"], SEED)
    expected = {(r.key, r.split) for r in train.unionByName(parts.where("split = 'val'")).collect()}
    assert got == expected


def test_prepare_splits_with_generated_rows(spark):
    df = spark.createDataFrame([(f"t{i}", i % 3 % 2) for i in range(300)], "image_files string, labels int")
    generated = spark.createDataFrame([(f"g{i}", 1) for i in range(150)], "image_files string, labels int")
    got = prepare_splits(df, "labels", ["image_files"], SEED, generated=generated, sampling="undersample").collect()
    train = Counter(r.labels for r in got if r.split == "train")
    assert train[0] == train[1]
    assert sum(r.split == "val" for r in got) == 30
    assert not any(r.image_files.startswith("g") for r in got if r.split == "val")


def test_prepare_splits_without_validation(spark, skewed):
    df = frame(spark, skewed)
    got = {r.key for r in prepare_splits(df, "label", ["key"], SEED, perform_validation=False).collect()}
    expected = stratified_split(df, "label", ["key"], SEED).where("split = 'train'")
    assert got == {r.key for r in expected.collect()}


def test_prepare_splits_bootstrap_size(spark, skewed):
    got = prepare_splits(frame(spark, skewed), "label", ["key"], SEED, sampling="bootstrap", value=40).collect()
    assert Counter(r.label for r in got if r.split == "train") == {c: 40 for c in {l for _, l in skewed}}
    with pytest.raises(ValueError, match="bootstrap"):
        prepare_splits(frame(spark, skewed), "label", ["key"], SEED, sampling="smote")


R_OPERATORS = {
    "seeded_order": lambda df: sampling.shuffled(df, ["key"], SEED, ["label"]),
    "stratified_split": lambda df: stratified_split(df, "label", ["key"], SEED),
    "stratified_split3": lambda df: stratified_split3(df, "label", ["key"], SEED),
    "bootstrap_per_class": lambda df: bootstrap_per_class(df, "label", ["key"], 30, SEED),
    "resample_to_value": lambda df: resample_to_value(df, "label", ["key"], SEED, 500),
    "undersample": lambda df: undersample(df, "label", ["key"], SEED),
    "sample_rows": lambda df: sample_rows(df, 99, ["key"], SEED),
    "mix_generated": lambda df: mix_generated(df, df.withColumn("key", F.col("key") + 10_000), "label", 1, ["key"], SEED),
    "prepare_splits": lambda df: prepare_splits(df, "label", ["key"], SEED, sampling="bootstrap", value=25),
}


@pytest.mark.parametrize("name", R_OPERATORS)
def test_same_rows_at_any_partitioning(spark, skewed, name):
    rows = [r for r in skewed if r[1] != 9]
    results = [
        Counter(map(tuple, R_OPERATORS[name](frame(spark, rows, parts).orderBy(F.rand(parts))).collect()))
        for parts in (1, 3, 8)
    ]
    assert results[0] == results[1] == results[2]


@pytest.mark.parametrize("name", R_OPERATORS)
def test_same_rows_at_any_number_of_chunks(spark, skewed, name, monkeypatch):
    rows = [r for r in skewed if r[1] != 9]
    expected = Counter(map(tuple, R_OPERATORS[name](frame(spark, rows)).collect()))
    monkeypatch.setattr(ranks, "CHUNKS_PER_PARTITION", 1000)
    assert Counter(map(tuple, R_OPERATORS[name](frame(spark, rows)).collect())) == expected


@settings(max_examples=12, deadline=None)
@given(
    st.lists(st.tuples(st.integers(0, 10**6), st.sampled_from([None, "", "a", "b", "c d"])), max_size=120,
             unique_by=lambda r: r[0]),
    st.dictionaries(st.sampled_from(["", "a", "b", "c d"]), st.tuples(st.integers(0, 40), st.integers(0, 40))),
    st.integers(0, 99),
)
def test_parts_of_any_table(spark, rows, quotas, seed):
    """Each part takes its quota from the seeded order; absent classes have none."""
    df = spark.createDataFrame(rows, "key bigint, label string").repartition(3)
    table = spark.createDataFrame([(k, *v) for k, v in quotas.items()], "label string, x int, y int")
    quota_of = lambda counts: counts.join(F.broadcast(table), "label")
    got = {r.key: r.part for r in assign_parts(df, quota_of, ["x", "y"], ["key"], seed, ["label"], "rest", "part").collect()}
    assert got.keys() == {k for k, _ in rows}
    groups = defaultdict(list)
    for key, label in rows:
        groups[label].append(key)
    for label, members in groups.items():
        in_order = sorted(members, key=lambda k: (md5(seed, k), k))
        x, y = quotas.get(label, (0, 0))
        expected = (["x"] * x + ["y"] * y + ["rest"] * len(members))[: len(members)]
        assert [got[k] for k in in_order] == expected


def labelled(spark, sizes):
    rows = [(f"{label}-{i}", label) for label, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, "key string, label int")


def sizes_of(df):
    return {(r.label, r.split): r["count"] for r in df.groupBy("label", "split").count().collect()}


def test_a_null_label_is_a_class_in_every_step(spark, monkeypatch):
    df = labelled(spark, {0: 40, 1: 20, None: 10})
    split = sizes_of(stratified_split(df, "label", ["key"], 1, 0.3))
    assert split == {(0, "test"): 12, (0, "train"): 28, (1, "test"): 6, (1, "train"): 14, (None, "test"): 3, (None, "train"): 7}
    classes = lambda out: {r.label: r["count"] for r in out.groupBy("label").count().collect()}
    assert classes(undersample(df, "label", ["key"], 1)) == {0: 10, 1: 10, None: 10}
    for few in (0, 64):  # by place and by rank
        monkeypatch.setattr(sampling, "FEW_DRAWS", few)
        assert classes(bootstrap_per_class(df, "label", ["key"], 25, 1)) == {0: 25, 1: 25, None: 25}
        assert classes(resample_to_value(df, "label", ["key"], 1, 30)) == {0: 40, 1: 30, None: 30}


def test_sizes_of_both_parts(spark):
    df = labelled(spark, {0: 60, 1: 40})
    assert sizes_of(stratified_split(df, "label", ["key"], 1, None, train_size=0.25)) == {
        (0, "train"): 15, (1, "train"): 10, (0, "test"): 45, (1, "test"): 30}
    assert sizes_of(stratified_split(df, "label", ["key"], 1, 20, train_size=30)) == {
        (0, "train"): 18, (1, "train"): 12, (0, "test"): 12, (1, "test"): 8, (0, None): 30, (1, None): 20}


@pytest.mark.parametrize(
    "test_size,train_size,message",
    [(2, None, "fewer rows"), (0.02, None, "fewer rows"), (28, None, "fewer rows"), (None, 2, "fewer rows"), (20, 20, "more rows")],
)
def test_impossible_parts_are_errors(spark, test_size, train_size, message):
    df = labelled(spark, {0: 10, 1: 10, 2: 10})
    with pytest.raises(Exception, match=message):
        stratified_split(df, "label", ["key"], 1, test_size, train_size=train_size).collect()


def test_a_split_needs_a_size(spark):
    with pytest.raises(ValueError, match="size"):
        stratified_split(labelled(spark, {0: 4}), "label", ["key"], 1, None)


def test_shares_move_no_rows(spark):
    """By hash alone: no shuffle, no fit, and further rows leave the others in place."""
    df = labelled(spark, {0: 3000, 1: 600, None: 400})
    split = sampling.share_split(df, ["key"], 7, 0.2)
    sample = sampling.share_sample(df, "label", {0: 0.2, None: 0.5}, ["key"], 7)
    for out in (split, sample):
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    test = sizes_of(split)
    assert all(0.12 * n < test[label, "test"] < 0.28 * n for label, n in {0: 3000, 1: 600, None: 400}.items())
    kept = {r.label: r["count"] for r in sample.groupBy("label").count().collect()}
    assert 500 < kept[0] < 700 and kept[1] == 600 and 150 < kept[None] < 250
    more = sampling.share_split(df.unionByName(labelled(spark, {5: 100})), ["key"], 7, 0.2)
    assert split.exceptAll(more).count() == 0


def test_exported_job_holds_every_row_once(spark, tmp_path):
    """Batches of the written job: as many rows as value x classes in the train part,
    each batch whole and in one file."""
    df = labelled(spark, {0: 60, 1: 30}).withColumnRenamed("label", "labels")
    part = F.when(F.substring("key", 3, 9).cast("int") % 5 == 0, "test").otherwise("train")
    samples = df.withColumn("split", part).withColumn("image_files", F.col("key"))
    path = str(tmp_path / "job")
    export_job(samples, path, ["key"], "key", 1, 8, test_size=0.25, sampling="bootstrap", value=40)
    out = spark.read.parquet(path).withColumn("file", F.input_file_name())
    counts = {r.split: r["count"] for r in out.groupBy("split").count().collect()}
    assert counts == {"train": 80, "val": 18, "test": 18}
    per_batch = out.groupBy("split", "batch_id").agg(F.countDistinct("file").alias("files"), F.count("*").alias("n"))
    assert {r.files for r in per_batch.collect()} == {1}
    assert out.groupBy("split", "position").count().where("count > 1").count() == 0
