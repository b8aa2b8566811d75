"""Row operators, joins, classes, summaries and cohort loaders on small tables."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

import cohortwise.session as session
from cohortwise.operators import classes as C, joins as J, rows as R, sets as U, summary as A
from cohortwise.plans import cohorts as CO


@pytest.fixture(scope="module")
def patients(spark):
    rows = [(1, "A|B", 10), (2, "B", 30), (3, "C,A", 17), (4, "No Finding", 50), (5, None, 20)]
    return spark.createDataFrame(rows, "key int, labels string, age int")


def keys(df, name="key"):
    return sorted(r[name] for r in df.collect())


def test_subsets(patients):
    assert R.subset_to_class(patients, "labels", []) is patients
    assert keys(R.subset_to_class(patients, "labels", ["B"])) == [2]
    assert R.create_subset(patients, "labels", ["", ""]) is patients
    assert keys(R.create_subset(patients, "labels", ["A", "No"])) == [1, 3, 4]
    arrays = patients.withColumn("labels", F.split("labels", r"\|"))
    assert keys(R.create_subset(arrays, "labels", ["A", "No"])) == [1]


def test_drop_columns_checks_names(patients):
    assert R.drop_columns(patients, ["age"]).columns == ["key", "labels"]
    with pytest.raises(ValueError, match="weight"):
        R.drop_columns(patients, ["weight"])


def test_filter_paths_default_exclusion(spark):
    df = spark.createDataFrame([("a.nii.gz",), ("a_mask.nii.gz",), ("b.txt",)], ["path"])
    assert keys(R.filter_paths(df, "path"), "path") == ["a.nii.gz", "b.txt"]
    assert keys(R.filter_paths(df, "path", lambda p: p.endswith(".gz")), "path") == ["a.nii.gz"]


def test_positives_only_has_two_switches(patients):
    positive = F.col("labels").contains("A").cast("int")
    assert R.positives_only(patients, positive, "class_conditioned_labels", "diffusion") is patients
    assert R.positives_only(patients, positive, "labels", "train") is patients
    assert keys(R.positives_only(patients, positive, "labels", "diffusion")) == [1, 3]


def test_keys_and_nulls_in_joins(spark, patients):
    rows = spark.createDataFrame([(1,), (None,), (9,)], "key int")
    listed = spark.createDataFrame([(1,), (1,), (None,)], "key int")
    assert [r.key for r in J.select_keys(rows, listed, "key").collect()] == [1]
    assert sorted(str(r.key) for r in J.without_keys(rows, listed, "key").collect()) == ["9", "None"]
    assert keys(J.missing_keys(patients, spark.createDataFrame([(1,), (77,)], "key int"), "key")) == [77]


def test_split_lists_overlap_and_repeat(spark, patients):
    lists = {"train": spark.createDataFrame([(1,), (2,), (2,)], "id int"), "test": spark.createDataFrame([(2,), (8,)], "id int")}
    got = sorted((r.key, r.split) for r in J.split_by_lists(patients, lists, "key").collect())
    assert got == [(1, "train"), (2, "test"), (2, "train")]
    listed = patients.join(J.list_membership(lists, "key"), "key", "left")
    check = A.partition_check(listed, {p: F.array_contains("parts", p) for p in lists}).first()
    assert (check.total, check.n_train, check.n_test, check.overlap, check.unmatched, check.complete) == (5, 2, 1, 1, 3, 0)


def test_bind_columns_is_an_outer_join(spark):
    left = spark.createDataFrame([(1, "a")], "key int, x string")
    right = spark.createDataFrame([(2, "b")], "key int, y string")
    assert sorted(map(tuple, J.bind_columns(left, right, "key").collect())) == [(1, "a", None), (2, None, "b")]


def test_lookup_statuses(spark):
    scans = spark.createDataFrame([("/s/SUB001-a.nii",), ("/s/SUB001-b.nii",), ("/s/SUB002.nii",), ("/s/SUB003.nii",),
                                   ("/s/SUB004.nii",), ("/s/readme",)], ["path"])
    people = spark.createDataFrame([(1, "5.0"), (2, None), (3, "x")], "id int, target string")
    got = {r.patient: (r.filename, r.target, r.scans, r.status) for r in J.scan_lookup(scans, "path", people, "id", "target").collect()}
    assert got == {
        1: ("SUB001-b.nii", 5, 2, "ok"), 2: ("SUB002.nii", None, 1, "bad_target"), 3: ("SUB003.nii", None, 1, "bad_target"),
        4: ("SUB004.nii", None, 1, "missing"), None: ("readme", None, 1, "bad_id")}
    cohort = CO.cohort_by_lookup(scans, people, "/s", "id", "target")
    assert [tuple(r) for r in cohort.collect()] == [(1, "/s/SUB001-b.nii", 5)]
    with pytest.raises(ValueError, match="unique"):
        CO.cohort_by_lookup(scans, people.union(people), "/s", "id", "target")


def test_encoding(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], ["c"])
    got = sorted(((r.c, r.code) for r in C.encode(df, "c", "code").collect()), key=str)
    assert got == [("a", 0), ("b", 1), ("b", 1), (None, None)]
    assert [r.c for r in C.encode(df, "c", "c").where("c IS NOT NULL").orderBy("c").collect()] == [0, 1, 1]
    assert C.labels_or_encoding([], {"x": 0, "y": 1}) == ["x", "y"]
    assert C.labels_or_encoding(["", ""], {"x": 0}) == ["x"]
    assert C.labels_or_encoding(["z"], {"x": 0}) == ["z"]


@pytest.mark.parametrize("kind", ["string", "double", "int"])
def test_encoding_of_many_classes(spark, monkeypatch, kind):
    df = spark.range(300).select((F.col("id") * 37 % 101).cast(kind).alias("c"))
    expected = {(r.c, r.code) for r in C.encode(df, "c", "code").collect()}
    assert sorted(c for _, c in expected) == list(range(101))
    monkeypatch.setattr(session, "FIT_ROWS", 50)
    assert {(r.c, r.code) for r in C.encode(df, "c", "code").collect()} == expected


def test_decode_unknown_codes(spark):
    df = spark.createDataFrame([(0,), (5,), (None,)], "code int")
    assert [r.n for r in C.decode(df, "code", {"zero": 0}, "n").collect()] == ["zero", None, None]
    assert [r.n for r in C.decode(df, "code", {}, "n").collect()] == [None, None, None]


def test_decode_with_a_long_encoding(spark):
    encoding = {f"class {i}": i for i in range(300)}
    df = spark.createDataFrame([(7,), (299,), (300,), (None,)], "code int")
    assert {r.code: r.n for r in C.decode(df, "code", encoding, "n").collect()} == {
        7: "class 7", 299: "class 299", 300: None, None: None}


def test_binarize_wide_and_long(spark, monkeypatch):
    df = spark.createDataFrame([(1, ["b", "a", "b"]), (2, []), (3, None)], "key int, l array<string>")
    got = C.binarize(df, "l", keep=["key"])
    assert got.columns == ["key", "a", "b"]
    assert [tuple(r) for r in got.orderBy("key").collect()] == [(1, 1, 1), (2, 0, 0), (3, 0, 0)]
    monkeypatch.setattr(C, "MAX_WIDTH", 1)
    with pytest.raises(ValueError, match="one_hot_long"):
        C.binarize(df, "l")
    assert sorted(tuple(r) for r in C.one_hot_long(df, "key", "l").collect()) == [(1, "a"), (1, "b")]


def test_zero_one_counts_of_an_empty_table(spark):
    df = spark.createDataFrame([], "a int, b int")
    assert [tuple(r) for r in A.zero_one_counts(df, ["a", "b"]).collect()] == [("a", 0, 0), ("b", 0, 0)]


def test_target_counts_split_both_ways(patients):
    assert {r.label: r.n for r in A.target_counts(patients, "labels").collect()} == {
        "A": 2, "B": 2, "C": 1, "No Finding": 1}


def test_threshold_counts(patients):
    assert tuple(A.threshold_counts(patients, "labels", "A", "age", [11, 18]).first()) == (2, 1, 2)


def test_prevalence_of_nothing(spark):
    got = A.prevalence(spark.createDataFrame([], "x int"), F.col("x") == 1).first()
    assert (got.n, got.percent, got.percent_text) == (0, None, None)


@pytest.mark.parametrize("splits", [["train", "test"], ["train", "val", "test"]])
def test_target_breakdown(spark, splits):
    rows = [("a", "train")] * 3 + [("b", "train"), ("b", "test")] + ([("a", "val")] if "val" in splits else [])
    df = spark.createDataFrame(rows + [(None, "train")], "label string, split string")
    headers = {s: A.SPLIT_HEADERS[s] for s in splits}
    got = {r.label: r.asDict() for r in A.target_breakdown(df, "label", headers=headers).collect()}
    assert got["a"]["Train split"] == 3 and got["a"]["Test split"] is None
    assert got["Total"]["Train split"] == 5 and got["Total"]["Total"] == len(rows) + 1
    assert got[None]["Total"] == 1
    assert ("Validation split" in got["a"]) == ("val" in splits)


def test_replicate_and_combine(spark):
    df = spark.createDataFrame([("x", 0, "train"), ("y", 1, "train")], "f string, labels int, split string")
    assert Counter(r.f for r in U.replicate_class(df, "labels", 0, 4).collect()) == {"x": 4, "y": 1}
    assert Counter(r.f for r in U.replicate_class(df, "labels", 0, 1).collect()) == {"x": 1, "y": 1}
    both = U.combine_datasets({"a": df, "b": df.select("split", "labels", "f")})
    assert Counter(r.source for r in both.collect()) == {"a": 2, "b": 2}


def test_load_cohort_by_name(spark):
    df = spark.createDataFrame([("x", 0, "train")], "image_files string, labels int, split string")
    loaders = {"main": lambda: df}
    assert CO.load_cohort("main", loaders).count() == 1
    assert CO.load_cohort("main", loaders, {"own": lambda: df}).count() == 2
    with pytest.raises(ValueError, match="other"):
        CO.load_cohort("other", loaders)


def test_explore_by_hand(spark):
    rows = [(1, "P"), (2, "P|A"), (3, "A"), (4, "A|X"), (5, "P|X"), (6, "A")]
    df = spark.createDataFrame(rows, "key int, labels string")
    lists = {"train": spark.createDataFrame([(1,), (2,), (3,)], "id int"),
             "test": spark.createDataFrame([(3,), (4,), (5,)], "id int")}
    got = {(r.version, r.part): (r.n, r.n_positive, r.unlisted, r.overlap) for r in
           CO.explore(df, lists, "key", "labels", "P", ["P", "A"]).collect()}
    assert got == {
        (1, "all"): (6, 3, 1, 1), (2, "all"): (4, 1, 1, 1),
        (1, "train"): (3, 2, 0, 0), (2, "train"): (2, 1, 0, 0),
        (1, "test"): (3, 1, 0, 0), (2, "test"): (2, 0, 0, 0),
        (1, "restricted_test"): (1, 0, 0, 0), (2, "restricted_test"): (1, 0, 0, 0)}


def test_prepare_job_sizes(spark):
    df = spark.range(400).select(
        "id", F.format_string("f%d", "id").alias("image_files"), (F.col("id") % 4 == 0).cast("int").alias("labels"),
        F.when(F.col("id") < 300, "train").otherwise("test").alias("split"))
    got = CO.prepare_job(df, ["id"], "id", 3, 32, 0.2, "bootstrap", 100).collect()
    assert Counter(r.split for r in got) == {"train": 200, "val": 60, "test": 100}
    assert Counter(r.labels for r in got if r.split == "train") == {0: 100, 1: 100}
    for split, n in (("train", 200), ("val", 60), ("test", 100)):
        assert sorted(r.position for r in got if r.split == split) == list(range(1, n + 1))


@pytest.mark.parametrize("n", [3, 80])
def test_decode_is_the_same_for_any_length(spark, n):
    """In place, and with two names for one code: the last counts, no row doubles."""
    encoding = {f"name{i}": i for i in range(n)} | {"again": 1}
    df = spark.createDataFrame([(0,), (1,), (1,), (999,), (None,)], "code int")
    got = C.decode(df, "code", encoding, "code")
    assert got.columns == ["code"]
    assert sorted(str(r.code) for r in got.collect()) == ["None", "None", "again", "again", "name0"]


def test_lookup_refuses_ids_that_occur_twice(spark):
    scans = spark.createDataFrame([("a/x001-1.png",)], "path string")
    patients = spark.createDataFrame([(1, "2"), (1, "3")], "id int, target string")
    with pytest.raises(ValueError, match="unique"):
        J.scan_lookup(scans, "path", patients, "id", "target")
