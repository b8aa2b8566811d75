"""Sources and sinks on real files."""

from __future__ import annotations

import os
import subprocess
import sys
import time
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

import cohortwise.session as session
from cohortwise.operators.evaluation import confusion_counts, run_summary
from cohortwise.plans.cohorts import cohort_from_tree
from cohortwise.session import fitted, materialize, scratch_path
from cohortwise.sources import scans as SC, sinks as SI
from cohortwise.sources.files import list_tree, write_files


@pytest.fixture
def tree(tmp_path):
    """A class-per-folder tree with stray files."""
    for split, classes in {"train": {"normal": 3, "bad": 2}, "test": {"normal": 1, "bad": 1}}.items():
        for name, count in classes.items():
            folder = tmp_path / split / name
            folder.mkdir(parents=True)
            for i in range(count):
                (folder / f"{name}-{i}.png").write_bytes(b"x")
            (folder / ".DS_Store").write_bytes(b"x")
        (tmp_path / split / ".DS_Store").write_bytes(b"x")
    return tmp_path


def test_metadata_csv_with_schema(spark, tmp_path):
    (tmp_path / "p.csv").write_text('id,label,age\n007,"A|B",12\n008,,\n')
    df = SC.scan_metadata(spark, str(tmp_path), SC.csv_reader("id string, label string, age int"))
    assert [tuple(r) for r in df.orderBy("id").collect()] == [("007", "A|B", 12), ("008", None, None)]


def test_own_reader(spark, tmp_path):
    spark.range(3).write.orc(str(tmp_path / "t"))
    assert SC.scan_metadata(spark, str(tmp_path / "t"), lambda s, p: s.read.orc(p)).count() == 3


def test_cached_table_fetches_once(spark, tmp_path):
    calls = []

    def fetch(n):
        calls.append(n)
        return spark.range(n)

    root = str(tmp_path)
    assert SC.cached_table(spark, root, "t", "1", lambda: fetch(3)).count() == 3
    assert SC.cached_table(spark, root, "t", "1", lambda: fetch(9)).count() == 3
    assert SC.cached_table(spark, root, "t", "2", lambda: fetch(5)).count() == 5
    assert SC.cached_table(spark, root, "t", "latest", lambda: fetch(9)).count() == 5
    assert calls == [3, 5]


def test_cached_table_latest_without_a_copy(spark, tmp_path):
    assert SC.cached_table(spark, str(tmp_path), "t", "latest", lambda: spark.range(4)).count() == 4
    assert SC.cached_table(spark, str(tmp_path), "t", "latest", lambda: spark.range(1)).count() == 4


@pytest.mark.parametrize("versions,expected", [(["9", "10"], 10), (["v1", "v2"], 2)])
def test_latest_is_the_highest_version(spark, tmp_path, versions, expected):
    for v in versions:
        SC.cached_table(spark, str(tmp_path), "t", v, lambda n=int(v.strip("v")): spark.range(n))
    assert SC.cached_table(spark, str(tmp_path), "t", "latest", lambda: spark.range(0)).count() == expected


@pytest.mark.parametrize("fmt,schema", [("parquet", None), ("csv", "id bigint")])
def test_cached_table_after_a_failed_write(spark, tmp_path, fmt, schema):
    """A folder without data, as a broken write leaves it, counts as absent."""
    (tmp_path / "name=t" / "version=1" / "_temporary").mkdir(parents=True)
    assert SC.cached_table(spark, str(tmp_path), "t", "1", lambda: spark.range(2), fmt, schema).count() == 2
    assert SC.cached_table(spark, str(tmp_path), "t", "latest", lambda: spark.range(9), fmt, schema).count() == 2


def test_half_written_copy_beside_whole_ones(spark, tmp_path):
    """Data without a mark is no copy, whatever it holds; it is not read or touched."""
    half = tmp_path / "name=t" / "version=1" / "copy-broken"
    spark.range(100).write.parquet(str(half))
    assert SC.cached_table(spark, str(tmp_path), "t", "1", lambda: spark.range(2)).count() == 2
    assert SC.cached_table(spark, str(tmp_path), "t", "latest", lambda: spark.range(7)).count() == 2
    assert spark.read.parquet(str(half)).count() == 100


def test_one_of_two_writers_wins(spark, tmp_path):
    """Both find nothing and write; the second gives its copy up and reads the first's,
    and nobody's rows are mixed or lost."""
    inner = []

    def slow():
        inner.append(SC.cached_table(spark, str(tmp_path), "t", "1", lambda: spark.range(3)))
        time.sleep(1.1)  # marks differ in time, also where it is kept in seconds
        return spark.range(50)

    outer = SC.cached_table(spark, str(tmp_path), "t", "1", slow)
    assert outer.count() == inner[0].count() == 3
    folder = tmp_path / "name=t" / "version=1"
    assert len([p for p in folder.iterdir() if p.name.startswith("copy-")]) == 1
    assert len(SC.committed_copies(spark, str(folder))) == 1


def test_writers_at_once_agree(spark, tmp_path):
    with ThreadPoolExecutor(4) as pool:
        jobs = [pool.submit(SC.cached_table, spark, str(tmp_path), "t", "1", lambda n=n: spark.range(n)) for n in range(1, 5)]
        counts = {job.result().count() for job in jobs}
    again = SC.cached_table(spark, str(tmp_path), "t", "1", lambda: spark.range(99)).count()
    assert again in counts and again in range(1, 5)


def test_cached_empty_table(spark, tmp_path):
    empty = spark.range(0)
    assert SC.cached_table(spark, str(tmp_path), "t", "1", lambda: empty).count() == 0
    assert SC.cached_table(spark, str(tmp_path), "t", "1", lambda: empty).columns == ["id"]


def test_id_list_is_stripped(spark, tmp_path):
    (tmp_path / "list.txt").write_text(" a.png\t\nb.png  \n\tc d.png\n")
    got = {r.id for r in SC.scan_id_list(spark, str(tmp_path / "list.txt")).collect()}
    assert got == {"a.png", "b.png", "c d.png"}


def test_class_dirs(spark, tree):
    got = {(r.image_files.rsplit("/", 1)[1], r.class_name, r.labels) for r in SC.scan_class_dirs(spark, str(tree / "train")).collect()}
    assert got == {("bad-0.png", "bad", 0), ("bad-1.png", "bad", 0),
                   ("normal-0.png", "normal", 1), ("normal-1.png", "normal", 1), ("normal-2.png", "normal", 1)}


def test_every_name_and_empty_files_are_listed(spark, tmp_path):
    names = ["_a", ".b", "c d", "é", "x=1/_SUCCESS", "x=1/deep/er/e"]
    for name in names:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"")
    (tmp_path / "none").mkdir()
    got = {r.path for r in SC.list_files(spark, str(tmp_path)).collect()}
    assert got == {str(tmp_path / n) for n in names}
    assert {r.path for r in SC.list_files(spark, f"file://{tmp_path}", 1).collect()} == {str(tmp_path / n) for n in names[:4]}
    entries = {(r.path, r.is_folder, r.depth) for r in list_tree(spark, str(tmp_path)).collect()}
    assert (str(tmp_path / "none"), True, 1) in entries and (str(tmp_path / "x=1" / "deep" / "er"), True, 3) in entries
    assert SC.list_files(spark, str(tmp_path / "missing")).count() == 0


def test_folders_are_listed_by_tasks(spark, tmp_path):
    """No folder of the tree is listed by the driver, and folders go to several tasks."""
    for i in range(30):
        (tmp_path / f"f{i}").mkdir()
        (tmp_path / f"f{i}" / "x").write_bytes(b"")
    driver = os.getpid()

    def lister(folder):
        yield f"{folder}/{os.getpid() == driver}-{TaskContext.get().partitionId()}", False, 0

    seen = list_tree(spark, [str(tmp_path / f"f{i}") for i in range(30)], lister=lister)
    names = {r.path.rsplit("/", 1)[1] for r in seen.collect()}
    assert len(names) > 1 and all(n.startswith("False-") for n in names)


def test_files_are_written_by_tasks(spark, tmp_path):
    root = str(tmp_path / "out")
    rows = [("a/b.txt", "text"), ("a/empty", ""), ("only/folder", None)]
    for _ in range(2):  # a second write leaves the same
        write_files(spark.createDataFrame(rows, "name string, content string"), root)
    assert sorted(p.relative_to(root).as_posix() for p in Path(root).rglob("*")) == [
        "a", "a/b.txt", "a/empty", "only", "only/folder"]
    assert Path(root, "a/b.txt").read_text() == "text" and os.listdir(tmp_path) == ["out"]
    for bad in ("../x", "/etc/x", "a/../../x"):
        with pytest.raises(Exception, match="not below the root"):
            write_files(spark.createDataFrame([(bad, "")], "name string, content string"), root)


def test_cohort_from_tree(spark, tree):
    rows = cohort_from_tree(spark, str(tree), times=3).collect()
    assert sum(r.split == "train" and r.labels == 0 for r in rows) == 6
    assert sum(r.split == "train" and r.labels == 1 for r in rows) == 3
    assert sum(r.split == "test" for r in rows) == 2


def test_train_and_test_share_their_codes(spark, tmp_path):
    for name in ("train/A", "train/B", "train/C", "test/A", "test/B", "test/C"):
        (tmp_path / name).mkdir(parents=True)
        (tmp_path / name / "x.png").write_bytes(b"" if name == "test/A" else b"x")
    rows = cohort_from_tree(spark, str(tmp_path)).collect()
    assert {(r.split, r.class_name, r.labels) for r in rows} == {
        ("train", "A", 0), ("train", "B", 1), ("train", "C", 2), ("test", "A", 0), ("test", "B", 1), ("test", "C", 2)}


def test_shards(spark, tmp_path):
    for shard in ("images_001", "images_012", "images_013", "other"):
        folder = tmp_path / shard / "images"
        folder.mkdir(parents=True)
        (folder / f"{shard}.png").write_bytes(b"x")
    got = {r.name: r.image_files for r in SC.scan_shards(spark, str(tmp_path)).collect()}
    assert set(got) == {"images_001.png", "images_012.png"}
    assert got["images_012.png"] == str(tmp_path / "images_012" / "images" / "images_012.png")
    assert SC.shard_folders()[0] == "images_001" and len(SC.shard_folders()) == 12


def test_flat_dir(spark, tmp_path):
    (tmp_path / "a.nii.gz").write_bytes(b"x")
    got = [tuple(r) for r in SC.scan_flat_dir(spark, str(tmp_path)).collect()]
    assert got == [("a.nii.gz", str(tmp_path / "a.nii.gz"))]


def test_writing_a_split_again_replaces_it(spark, tmp_path):
    path = str(tmp_path / "cohort")
    first = spark.createDataFrame([(1, "train"), (2, "test")], "k int, split string")
    SI.write_cohort(first, path)
    SI.write_cohort(spark.createDataFrame([(3, "test")], "k int, split string"), path)
    got = {(r.k, r.split) for r in spark.read.schema("k int, split string").option("header", True).csv(path).collect()}
    assert got == {(1, "train"), (3, "test")}


def test_eval_tables(spark, tmp_path):
    df = spark.createDataFrame([("a", 0, 0), ("b", 1, 0)], "key string, y_true int, y_pred int")
    for epoch in (1, 2, 2):
        SI.write_eval(df, str(tmp_path), "val", epoch)
    assert spark.read.parquet(str(tmp_path / "predictions")).count() == 4
    assert spark.read.parquet(str(tmp_path / "confusion_matrix")).where("epoch = 2").count() == 4
    assert spark.read.parquet(str(tmp_path / "classification_report")).where("epoch = 1").count() == 5


def test_eval_tables_of_all_epochs(spark, tmp_path):
    rows = [("val", 1, 0, 0), ("val", 1, 1, 0), ("val", 2, 2, 2), ("test", 1, 0, 2)]
    df = spark.createDataFrame(rows, "split string, epoch int, y_true int, y_pred int")
    SI.write_eval(df, str(tmp_path))
    matrix = spark.read.parquet(str(tmp_path / "confusion_matrix"))
    got = {(r.split, r.epoch, r.y_true, r.y_pred): r.n for r in matrix.collect()}
    assert got == {
        ("val", 1, 0, 0): 1, ("val", 1, 0, 1): 0, ("val", 1, 1, 0): 1, ("val", 1, 1, 1): 0,
        ("val", 2, 2, 2): 1, ("test", 1, 0, 0): 0, ("test", 1, 0, 2): 1, ("test", 1, 2, 0): 0, ("test", 1, 2, 2): 0}
    report = spark.read.parquet(str(tmp_path / "classification_report"))
    assert report.where("split = 'val' AND epoch = 2 AND label = 'accuracy'").first().f1 == 1.0
    assert report.where("split = 'val' AND epoch = 1").count() == 5


def test_report_text(spark, tmp_path):
    df = spark.createDataFrame([(0, 0), (1, 0), (1, 1), (1, 1)], "y_true int, y_pred int")
    config = spark.createDataFrame([("seed", "1"), ("lr", "0.1")], "key string, value string")
    SI.write_report(SI.run_report(df, "net", None, config), str(tmp_path / "report"))
    (file,) = (tmp_path / "report").glob("part-*")
    score = run_summary(df, "net").first()
    assert file.read_text().splitlines() == [
        "# Run summary",
        "",
        "## Test results",
        "### Evaluation metrics",
        "| model_name | roc_auc | accuracy | loss | precision | recall | f1-score |",
        "| --- | --- | --- | --- | --- | --- | --- |",
        f"| net | {score.roc_auc:.6f} | 0.750000 | nan | {score.precision:.6f} | {score.recall:.6f} | {score.f1:.6f} |",
        "",
        "### Confusion matrix",
        "|  | 0 | 1 |",
        "| --- | --- | --- |",
        "| 0 | 1 | 0 |",
        "| 1 | 1 | 2 |",
        "",
        "## `config.yaml`",
        "```yaml",
        "# --config-name=config",
        "",
        "lr: 0.1",
        "seed: 1",
        "```",
    ]


def test_batches(spark, tmp_path):
    df = spark.range(100).select("id", F.when(F.col("id") < 70, "train").otherwise("test").alias("split"))
    SI.export_batches(df, str(tmp_path / "b"), ["id"], "id", 16, 1)
    got = spark.read.parquet(str(tmp_path / "b")).withColumn("file", F.input_file_name()).collect()
    for split, n in (("train", 70), ("test", 30)):
        rows = sorted((r for r in got if r.split == split), key=lambda r: r.position)
        assert [r.position for r in rows] == list(range(1, n + 1))
        assert [r.batch_id for r in rows] == [i // 16 for i in range(n)]
        files = {}
        for r in rows:
            files.setdefault(r.batch_id, set()).add(r.file)
        assert all(len(f) == 1 for f in files.values())
    in_order = [r.id for r in sorted((r for r in got if r.split == "test"), key=lambda r: r.position)]
    assert in_order == list(range(70, 100))


def test_batches_keep_rows_without_a_split(spark):
    df = spark.createDataFrame([(1, None), (2, "train"), (3, None)], "id int, split string")
    got = {(r.id, r.position) for r in SI.batches(df, ["id"], "id", 2, 1).collect()}
    assert got == {(1, 1), (3, 2), (2, 1)}


def test_materialize_cuts_the_lineage(spark):
    stored = materialize(spark.range(10).selectExpr("id", "id % 3 AS m"))
    assert "Range" not in stored._jdf.queryExecution().optimizedPlan().toString()
    assert stored.count() == 10


def test_scratch_folder_is_the_sessions(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


class Conf:
    def get(self, key, default=None):
        return default


class Context:
    def __init__(self, master):
        self.master = master
        self.folder = None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = f"file:{folder}"


class Bare:
    """A session without a scratch folder."""

    conf = Conf()

    def __init__(self, master):
        self.sparkContext = Context(master)


def test_no_machine_local_scratch_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(Bare("yarn"), "x")
    assert scratch_path(Bare("local[2]"), "x").startswith("file:")


def test_large_fits_are_stored(spark, monkeypatch):
    """Beyond a number of rows or bytes a fit is a stored table; below, it is local."""
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation" in plan(fitted(spark.range(5), 5))
    big = spark.range(6)
    stored = fitted(big, 5)
    assert "parquet" in plan(stored) and sorted(r.id for r in stored.collect()) == list(range(6))
    monkeypatch.setattr(session, "FIT_ROWS", 3)
    assert "parquet" in plan(fitted(big))
    monkeypatch.setattr(session, "FIT_BYTES", 20)
    assert "parquet" in plan(fitted(spark.range(3)))
    assert not spark._jsc.sc().getPersistentRDDs().size()


def test_large_counts_read_the_predictions_once(spark, tmp_path):
    """20,000 label pairs, twice what a fit brings to the driver."""
    read = spark.sparkContext.accumulator(0)

    def seen(frames):
        for frame in frames:
            read.add(len(frame))
            yield frame

    rows = spark.range(40_000).selectExpr("cast(id % 150 as int) AS y_true", "cast(id % 20000 % 137 as int) AS y_pred")
    predictions = rows.mapInPandas(seen, "y_true int, y_pred int")
    config = spark.createDataFrame([("k", "v")], "key string, value string")
    report = SI.run_report(predictions, "net", None, config)
    assert confusion_counts(rows).count() > 10_000
    assert report.count() > 150 and read.value == 40_000


def test_a_number_is_later_than_a_word(spark, tmp_path):
    root = str(tmp_path)
    assert SC.cached_table(spark, root, "t", "latest", lambda: spark.range(3)).count() == 3
    SC.cached_table(spark, root, "t", "7", lambda: spark.range(7))
    SC.cached_table(spark, root, "t", "12", lambda: spark.range(12))
    assert SC.cached_table(spark, root, "t", "latest", lambda: spark.range(0)).count() == 12


def test_scratch_tables_can_be_removed(spark, monkeypatch):
    monkeypatch.setattr(session, "_scratch", {})
    session.materialize(spark.range(3), "gone")
    paths = [p.removeprefix("file:") for p in session._scratch]
    assert os.path.isdir(paths[-1])
    session.remove_scratch(spark)
    assert not any(os.path.exists(p) for p in paths) and not session._scratch


@pytest.mark.parametrize("given", [True, False])
def test_nothing_is_left_after_the_session_was_stopped(tmp_path, given):
    """Scratch tables go when the driver ends, also where it stopped its session before."""
    code = f"""
import sys, tempfile
sys.path.insert(0, {str(Path(session.__file__).resolve().parents[1])!r})
tempfile.tempdir = {str(tmp_path)!r}
from cohortwise import session
spark = session.build_session("local[1]", 1, "1g")
if {given}:
    spark.sparkContext.setCheckpointDir({str(tmp_path / "shared")!r})
held = session.materialize(spark.range(5))
assert held.count() == 5
spark.stop()
"""
    env = dict(os.environ, SPARK_LOCAL_DIRS=str(tmp_path / "spark"))
    subprocess.run([sys.executable, "-c", code], check=True, capture_output=True, env=env, timeout=120)
    left = [p for p in tmp_path.rglob("*") if p.is_file() and "spark" not in p.relative_to(tmp_path).parts[0]]
    assert not left
    assert not list(tmp_path.glob("cohortwise-*"))
