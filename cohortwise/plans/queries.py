"""One query per operator over the given tables, by name.

Each takes a session and the folder of the tables and gives a DataFrame of plain
columns. Every query reads its tables whole.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cohortwise.functions import labels as L, names as N, params as P, vectors as VEC
from cohortwise.operators import (
    classes as C,
    evaluation as E,
    joins as J,
    rows as R,
    runs as W,
    sampling as S,
    sets as U,
    summary as A,
    vectorsets as X,
)
from cohortwise.plans import cohorts as CO, views as V
from cohortwise.session import materialize as stored, scratch_path
from cohortwise.sources import files as FI, scans as SC, sinks as SI
from cohortwise.streaming import confusion as ST

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SEED = 42
ARRIVALS = 4
# Longer than the events' range, so that no order of arrival loses rows.
LATE = "4000 days"
ENCODING = {"large": 0, "small": 1, "medium": 2}
FINDING_SCHEMA = "order_key bigint, finding_labels string, total double, priority string"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def text(values: Column) -> Column:
    """An array as one string."""
    return F.array_join(values, ",")


def values_of(df: DataFrame, vector: Column) -> DataFrame:
    """One row per vector value; a missing vector keeps one row."""
    return df.select("vec_id", F.posexplode_outer(vector).alias("position", "value"))


def entries_text(params: Column) -> Column:
    pairs = F.transform(F.map_entries(params), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return text(F.array_sort(pairs))


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), 6) for c in columns})


def label_arrays(spark: SparkSession, d: str) -> DataFrame:
    return V.findings(spark, d).select("order_key", L.split_labels(F.col("finding_labels")).alias("labels"))


# --- sources and sinks ---------------------------------------------------


@query
def scan_metadata_csv(spark, d):
    path = scratch_path(spark, "metadata")
    V.findings(spark, d).write.option("header", True).csv(path)
    return SC.scan_metadata(spark, path, SC.csv_reader(FINDING_SCHEMA))


@query
def versioned_cache(spark, d):
    def refuse() -> DataFrame:
        raise RuntimeError("the stored copy should have been found")

    root = scratch_path(spark, "cache")
    SC.cached_table(spark, root, "samples", "3", lambda: V.samples(spark, d))
    return SC.cached_table(spark, root, "samples", SC.LATEST, refuse)


@query
def scan_id_list(spark, d):
    path = scratch_path(spark, "ids")
    listed = V.split_list(spark, d)
    listed.select(F.concat(F.lit(" \t"), F.col("id").cast("string"), F.lit("\t "))).write.text(path)
    return SC.scan_id_list(spark, path)


def written_tree(spark, d, name: Column, strays: dict[str, str | None]) -> str:
    """Root of a tree of files with these names, and of stray files (no content: folders)."""
    root = scratch_path(spark, "tree")
    files = V.tree(spark, d).select(name.alias("name"), "content")
    more = spark.createDataFrame(list(strays.items()), "name string, content string")
    FI.write_files(files.unionByName(more), root)
    return root


def below(path: Column, root: str) -> Column:
    """A listed path without the root it was listed from."""
    plain = "/" + root.removeprefix("file:").lstrip("/") if root.startswith("file:") else root
    return F.substr(path, F.lit(len(plain) + 2))


@query
def scan_class_dirs(spark, d):
    strays = {".DS_Store": "x", "en/.DS_Store": "x", "empty": None}
    root = written_tree(spark, d, F.concat_ws("/", "class", "name"), strays)
    return SC.scan_class_dirs(spark, root).withColumn("image_files", below(F.col("image_files"), root))


@query
def scan_shards(spark, d):
    shard = (F.col("place") % (SC.SHARD_COUNT + 1) + 1).cast("int")
    root = written_tree(spark, d, SC.shard_path(shard, F.col("name")), {"images_001/list.txt": "x", "other/images/a": ""})
    return SC.scan_shards(spark, root).withColumn("image_files", below(F.col("image_files"), root))


@query
def scan_flat_dir(spark, d):
    root = written_tree(spark, d, F.col("name"), {"inner/a.png": "", "folder": None})
    return SC.scan_flat_dir(spark, root).withColumn("path", below(F.col("path"), root))


@query
def scan_generated(spark, d):
    root = written_tree(spark, d, F.col("name"), {})
    return S.generated_rows(SC.scan_flat_dir(spark, root), "/generated", 1)


@query
def write_cohort(spark, d):
    path = scratch_path(spark, "cohort")
    cohort = CO.cohort_by_column(V.split_column(spark, d), CO.CohortSpec("order_key", "finding_labels", "/scans"))
    SI.write_cohort(cohort.select("order_key", "image_files", "labels", "split"), path)
    schema = "order_key bigint, image_files string, labels string, split string"
    return SC.scan_metadata(spark, path, SC.csv_reader(schema))


@query
def write_eval(spark, d):
    path = scratch_path(spark, "eval")
    SI.write_eval(V.pred_lines(spark, d).select("l_orderkey", "l_linenumber", "y_true", "y_pred"), path, "test", 3)
    stored = spark.read.parquet(f"{path}/predictions")
    counted = stored.groupBy("split", "epoch", "y_true", "y_pred").agg(F.count(F.lit(1)).alias("rows"))
    matrix = spark.read.parquet(f"{path}/confusion_matrix")
    return matrix.join(counted, ["split", "epoch", "y_true", "y_pred"], "left")


@query
def write_eval_epochs(spark, d):
    path = scratch_path(spark, "eval")
    SI.write_eval(V.pred_lines(spark, d).select("l_orderkey", "split", "epoch", "y_true", "y_pred"), path)
    return rounded(spark.read.parquet(f"{path}/classification_report"), "precision", "recall", "f1")


@query
def run_report(spark, d):
    config = V.table(spark, d, "nation").select(
        F.col("n_name").alias("key"), F.col("n_regionkey").cast("string").alias("value")
    )
    return SI.run_report(V.pred_lines(spark, d), "densenet", "logits", config)


@query
def materialize(spark, d):
    return stored(V.findings(spark, d), "findings")


@query
def metric_log(spark, d):
    value = F.when(F.col("metric") == "signup", "n/a").otherwise(F.col("value").cast("string"))
    path = scratch_path(spark, "metrics")
    SI.log_metrics(V.metric_log(spark, d).withColumn("value", value), path, ["split"])
    return spark.read.parquet(path).select("run_id", "epoch", "split", "metric", "value")


def split_samples(spark, d):
    place = V.bucket(F.col("key"))
    return V.samples(spark, d).withColumn(
        "split", F.when(place < 70, "train").when(place < 85, "val").otherwise("test")
    )


@query
def batch_export(spark, d):
    path = scratch_path(spark, "batches")
    SI.export_batches(split_samples(spark, d), path, ["key"], "key", 64, SEED)
    return spark.read.parquet(path).select("key", "labels", "split", "position", "batch_id")


# --- projections and filters ---------------------------------------------


@query
def path_join(spark, d):
    name, path = N.base_name(F.col("path")), F.col("path")
    return V.scans(spark, d).select(
        "page_id",
        N.join_path(F.lit("/data/scans"), name).alias("plain"),
        N.join_path(F.lit("/data/scans/"), name).alias("closed"),
        N.join_path(F.lit(""), name).alias("no_base"),
        N.join_path(F.lit("/data/scans"), path).alias("absolute"),
    )


@query
def sample_pair(spark, d):
    return R.sample_pair(V.split_column(spark, d), "image_files", "finding_labels")


@query
def drop_columns(spark, d):
    return R.drop_columns(V.findings(spark, d), ["total", "priority"])


@query
def subset_to_class(spark, d):
    return R.subset_to_class(V.samples(spark, d), "labels", [1, 2])


@query
def create_subset(spark, d):
    return R.create_subset(V.findings(spark, d), "finding_labels", ["PROMO", "ECO"])


@query
def filter_paths(spark, d):
    long_name = lambda p: F.length(N.base_name(p)) >= 3
    return R.filter_paths(V.scans(spark, d), "path", long_name, [".html", "spam-"])


@query
def positives_only(spark, d):
    positive = L.label_any(L.split_labels(F.col("finding_labels")), V.POSITIVE)
    return R.positives_only(V.findings(spark, d), positive, "finding_labels", "train-diffusion")


@query
def preprocess_dataset(spark, d):
    return CO.preprocess(V.samples(spark, d), [0, 2])


@query
def split_by_column(spark, d):
    return R.parts_by_column(V.split_column(spark, d), "split", CO.COLUMN_PARTS).select("order_key", "split")


@query
def threshold_counts(spark, d):
    return A.threshold_counts(V.findings(spark, d), "finding_labels", V.POSITIVE, "total", [18000, 210000])


@query
def restrict_to_subset(spark, d):
    kept = R.restrict_to_subset(label_arrays(spark, d), "labels", V.ALLOWED)
    return kept.select("order_key", text(F.col("labels")).alias("labels"))


@query
def drop_nulls(spark, d):
    return R.drop_nulls(V.patients(spark, d), ["target"])


@query
def safe_int_target(spark, d):
    return R.int_targets(V.patients(spark, d), "target", "code").select("id", "code")


@query
def metaclass(spark, d):
    return R.to_metaclass(V.findings(spark, d), "finding_labels", V.POSITIVE, drop=False).select(
        "order_key", "finding_labels", "old_finding_labels"
    )


@query
def label_any(spark, d):
    return R.label_any(label_arrays(spark, d), "labels", V.POSITIVE, "label").select("order_key", "label")


@query
def label_exclusive(spark, d):
    return R.label_exclusive(label_arrays(spark, d), "labels", V.POSITIVE, "label").select("order_key", "label")


@query
def params_clean(spark, d):
    return V.run_params(spark, d).select("run_id", entries_text(P.clean(F.col("params"))).alias("params"))


@query
def every_k(spark, d):
    return R.every_kth(V.metric_log(spark, d), "epoch", 5)


# --- joins -----------------------------------------------------------------


@query
def join_scans(spark, d):
    lines = V.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("order_key"), "l_linenumber", "l_partkey")
    return J.join_scans(V.findings(spark, d), lines, "order_key").select(
        "order_key", "finding_labels", "l_linenumber", "l_partkey"
    )


@query
def split_by_list(spark, d):
    return J.split_by_lists(V.findings(spark, d), V.split_lists(spark, d), "order_key").select(
        "order_key", "finding_labels", "split"
    )


def promo_keys(spark, d):
    parts = V.table(spark, d, "part").where("p_type = 'PROMO'").select("p_partkey")
    lines = V.table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    return lines.join(parts, lines.l_partkey == parts.p_partkey, "left_semi").select(
        F.col("l_orderkey").alias("o_orderkey")
    )


@query
def anti_rows(spark, d):
    orders = V.table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return J.without_keys(orders, promo_keys(spark, d), "o_orderkey")


@query
def select_keys(spark, d):
    orders = V.table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return J.select_keys(orders, promo_keys(spark, d), "o_orderkey")


@query
def missing_keys(spark, d):
    listed = V.table(spark, d, "documents").select("doc_id")
    return J.missing_keys(V.table(spark, d, "labels"), listed, "doc_id")


@query
def bind_columns(spark, d):
    docs = V.table(spark, d, "documents").select("doc_id", "lang", "n_chars")
    return J.bind_columns(docs, V.table(spark, d, "labels"), "doc_id")


@query
def patient_lookup(spark, d):
    return J.scan_lookup(V.scans(spark, d), "path", V.patients(spark, d), "id", "target")


@query
def decode_labels(spark, d):
    return C.decode(V.samples(spark, d), "labels", {"small": 1, "medium": 2}, "name").select("key", "labels", "name")


# --- aggregations ------------------------------------------------------------


@query
def value_counts(spark, d):
    return A.value_counts(V.findings(spark, d), "finding_labels")


@query
def target_counts(spark, d):
    return A.target_counts(V.findings(spark, d), "finding_labels")


@query
def n_unique(spark, d):
    return A.n_unique(V.findings(spark, d), "finding_labels")


@query
def class_zero_one(spark, d):
    arrays = label_arrays(spark, d)
    classes = part_types(spark, d)
    return A.zero_one_counts(C.binarize(arrays, "labels", classes, ["order_key"]), classes)


def part_types(spark, d):
    """Class list fitted on the types of the parts."""
    types = V.table(spark, d, "part").select(F.array("p_type").alias("labels"))
    return sorted([*C.fit_labels(types, "labels"), L.NO_FINDING])


@query
def prevalence(spark, d):
    return A.prevalence(label_arrays(spark, d), L.has_label(F.col("labels"), V.POSITIVE))


@query
def target_breakdown(spark, d):
    named = C.decode(split_samples(spark, d), "labels", ENCODING, "class_name")
    headers = {"train": "train_split", "val": "validation_split", "test": "test_split"}
    return A.target_breakdown(named, "class_name", headers=headers)


@query
def target_breakdown_two(spark, d):
    named = C.decode(split_samples(spark, d), "labels", {"small": 1, "large": 0}, "class_name")
    return A.target_breakdown(named, "class_name", headers={"train": "train_split", "test": "test_split"})


@query
def samples_per_class(spark, d):
    return A.samples_per_class(V.samples(spark, d), "labels").select(
        text(F.col("samples_per_class").cast("array<string>")).alias("samples_per_class")
    )


@query
def lookup_status(spark, d):
    return A.status_counts(patient_lookup(spark, d))


@query
def partition_check(spark, d):
    listed = V.findings(spark, d).join(
        J.list_membership(V.split_lists(spark, d), "order_key"), "order_key", "left"
    )
    return A.partition_check(
        listed, {p: F.array_contains("parts", p) for p in ("train", "test")}
    )


@query
def argmax_predict(spark, d):
    return E.with_prediction(V.pred10(spark, d), "logits").select("vec_id", "y_true", "y_pred")


@query
def prediction_table(spark, d):
    path = F.concat(F.lit("/scans/files/"), F.col("vec_id").cast("string"), F.lit(".png"))
    return E.prediction_table(V.pred10(spark, d).withColumn("path", path), "path", "y_true", "logits")


@query
def confusion_matrix(spark, d):
    return E.confusion_matrix(argmax_predict(spark, d))


@query
def confusion_matrix_lines(spark, d):
    return E.confusion_wide(E.confusion_matrix(V.pred_lines(spark, d)), [0, 1]).select(
        "y_true", F.col("0").alias("pred_0"), F.col("1").alias("pred_1")
    )


@query
def classification_report(spark, d):
    return rounded(E.classification_report(argmax_predict(spark, d)), "precision", "recall", "f1")


@query
def classification_report_lines(spark, d):
    names = C.encoding_table(spark, {"other": 0, "returned": 1, "absent": 2}).select(
        F.col("code").alias("label"), "name"
    )
    return rounded(E.classification_report(V.pred_lines(spark, d), names, "name"), "precision", "recall", "f1")


@query
def run_summary(spark, d):
    summary = E.run_summary(V.pred_lines(spark, d), "densenet", "logits")
    return rounded(summary, "roc_auc", "accuracy", "loss", "precision", "recall", "f1")


@query
def roc_auc(spark, d):
    return rounded(E.roc_auc(V.pred2(spark, d), "score"), "roc_auc")


@query
def roc_auc_lines(spark, d):
    return rounded(E.roc_auc(V.pred_lines(spark, d), "score"), "roc_auc")


@query
def roc_auc_hard(spark, d):
    return rounded(E.roc_auc(V.pred_lines(spark, d)), "roc_auc")


@query
def mean_loss(spark, d):
    return rounded(E.mean_loss(V.pred10(spark, d), "logits"), "loss")


@query
def mean_loss_lines(spark, d):
    return rounded(E.mean_loss(V.pred_lines(spark, d), "logits"), "loss")


@query
def accuracy(spark, d):
    return rounded(E.accuracy(V.pred_lines(spark, d)), "accuracy")


@query
def accuracy_gaps(spark, d):
    """Null truths and predictions are labels like others, by every path to the accuracy."""
    gaps = V.pred_gaps(spark, d)
    named = E.metrics_by_name(gaps, ["Accuracy"]).withColumn("path", F.lit("named"))
    classes = E.class_metrics_by_name(gaps, ["Accuracy"]).withColumn("path", F.lit("classes"))
    plain = E.accuracy(gaps).withColumn("path", F.lit("plain"))
    return rounded(plain.unionByName(named).unionByName(classes), "accuracy")


@query
def topk_gaps(spark, d):
    """Truths without a score are misses."""
    return rounded(E.class_metrics_by_name(V.pred_gaps(spark, d), ["TopK"], scores="logits", k=3), "topk")


@query
def confusion_matrix_gaps(spark, d):
    return E.confusion_matrix(V.pred_gaps(spark, d))


@query
def run_report_gaps(spark, d):
    """The lines of the matrix, null labels among them."""
    report = SI.run_report(V.pred_gaps(spark, d), "net", None, spark.createDataFrame([("k", "v")], "key string, value string"))
    return report.where("section = 2").select("line_no", "line")


@query
def write_eval_names(spark, d):
    """The matrix of a fixed label set, with the names of its rows and columns."""
    path, lines = scratch_path(spark, "eval"), V.pred_lines(spark, d).select("split", "epoch", "y_true", "y_pred")
    labels = spark.createDataFrame([(0, "kept"), (1, "returned"), (2, "lost")], "label int, called string")
    SI.write_eval(lines, path, labels=labels, names="called")
    return spark.read.parquet(f"{path}/confusion_matrix")


@query
def roc_auc_epochs(spark, d):
    """AUC on real scores, by split and epoch."""
    return rounded(E.roc_auc(V.pred_lines(spark, d), "score", by=["split", "epoch"]), "roc_auc")


@query
def epoch_metrics_scores(spark, d):
    table = E.epoch_metrics(V.pred_lines(spark, d), ["split", "epoch"], "logits", auc_score="score")
    return rounded(table.where(F.col("metric").isin("roc_auc", "accuracy", "loss")), "value")


@query
def roc_auc_classes(spark, d):
    """One class against all others, by its score."""
    scored = E.with_prediction(V.pred10(spark, d), "logits")
    parts = [
        E.class_metrics_by_name(scored, ["ROC_AUC"], scores="logits", positive=c).withColumn("positive", F.lit(c))
        for c in range(3)
    ]
    return rounded(parts[0].unionByName(parts[1]).unionByName(parts[2]), "roc_auc")


def recall_state(state, y_true, y_pred):
    """Rows and hits of classes 0 and 1."""
    hit = (y_true == y_pred).to_numpy()
    return state + [n for c in (0, 1) for n in ((y_true == c).sum(), (hit & (y_true == c).to_numpy()).sum())]


def mean_recall(state) -> float:
    return float(np.mean([hits / n for n, hits in zip(state[::2], state[1::2]) if n]))


RECALL = E.MergeableMetric(lambda: np.zeros(4), recall_state, np.add, mean_recall)


@query
def custom_metric_merged(spark, d):
    scored = E.custom_metric_merged(V.pred_lines(spark, d), RECALL, ["split", "epoch"], "balanced_accuracy")
    return rounded(scored, "balanced_accuracy")


def balanced_accuracy(y_true: pd.Series, y_pred: pd.Series, weight: pd.Series) -> float:
    """Mean recall over the classes that occur."""
    hits = (weight * (y_true == y_pred)).groupby(y_true).sum()
    return float((hits / weight.groupby(y_true).sum()).mean())


@query
def custom_metric(spark, d):
    scored = E.custom_metric(V.pred_lines(spark, d), balanced_accuracy, ["split", "epoch"], "balanced_accuracy")
    return rounded(scored, "balanced_accuracy")


@query
def metrics_by_name(spark, d):
    names = ["Accuracy", "Precision", "Recall", "F1", "Loss", "MeanSquaredError", "NoSuchMetric"]
    scored = E.metrics_by_name(V.pred_lines(spark, d), names, ["split"], "logits")
    return rounded(scored, "accuracy", "precision", "recall", "f1", "loss", "meansquarederror")


@query
def metrics_by_name_classes(spark, d):
    scored = E.with_prediction(V.pred10(spark, d), "logits")
    macro = E.class_metrics_by_name(scored, ["Accuracy", "Precision", "Recall", "F1", "TopK"], scores="logits", k=5)
    weighted = E.class_metrics_by_name(scored, ["Precision", "Recall", "F1"], average="weighted")
    rows = macro.withColumn("average", F.lit("macro")).unionByName(
        weighted.withColumn("average", F.lit("weighted")), allowMissingColumns=True
    )
    return rounded(rows, "accuracy", "precision", "recall", "f1", "topk")


@query
def epoch_metrics(spark, d):
    """Metrics of every second epoch, named by split."""
    table = E.epoch_metrics(V.pred_lines(spark, d), ["split", "epoch"], "logits")
    return rounded(W.numeric_metrics(R.every_kth(table, "epoch", 2)), "value")


# --- run logs ------------------------------------------------------------


@query
def best_epochs(spark, d):
    """Of every metric of a run, each as a score of its own."""
    return W.best_epochs(V.metric_log(spark, d), ["run_id", "metric"], "value", "loss", 2).select(
        "run_id", "metric", "epoch", "value", "place"
    )


@query
def early_stop(spark, d):
    """By every metric of a run, each as a score of its own."""
    log = stored(V.metric_log(spark, d), "metric-log")
    return W.early_stop(log, ["run_id", "metric"], "value", "accuracy", 10, chunk_size=16)


@query
def last_metrics(spark, d):
    return W.last_metrics(V.metric_log(spark, d), ["run_id", "split", "metric"])


# --- sorts and top-k -------------------------------------------------------


@query
def sorted_classes(spark, d):
    return C.sorted_classes(V.findings(spark, d), "finding_labels")


@query
def preview(spark, d):
    return S.preview(V.findings(spark, d), "order_key", 5)


@query
def sample_k(spark, d):
    return S.sample_rows(V.samples(spark, d), 500, ["key"], SEED)


# --- unions and replication ------------------------------------------------


@query
def union_parts(spark, d):
    arrays = label_arrays(spark, d)
    has = L.has_label(F.col("labels"), V.POSITIVE)
    parts = [arrays.where(c).select("order_key", F.lit(v).alias("label")) for v, c in ((1, has), (0, ~has))]
    return U.union_parts(*parts)


def page_samples(spark, d):
    return SC.class_dir_samples(V.scans(spark, d)).select("image_files", "labels").withColumn(
        "split", F.when(V.bucket(F.col("image_files")) < 80, "train").otherwise("test")
    )


@query
def combine_datasets(spark, d):
    main = split_samples(spark, d).select("image_files", "labels", "split")
    return U.combine_datasets({"main": main, "pages": page_samples(spark, d)})


@query
def label_difference(spark, d):
    types = V.table(spark, d, "part").select(F.col("p_type").alias("label"))
    used = label_arrays(spark, d).select(F.explode("labels").alias("label"))
    return U.label_difference(used, types)


@query
def replicate_class(spark, d):
    return U.replicate_class(V.samples(spark, d), "labels", 1, 3).select("key", "labels", "copy")


# --- scalar functions --------------------------------------------------------


@query
def basename(spark, d):
    return V.scans(spark, d).select("page_id", N.base_name(F.col("path")).alias("name"))


@query
def patient_id(spark, d):
    return V.scans(spark, d).select("page_id", N.patient_id(F.col("path")).alias("patient_id"))


@query
def scan_number(spark, d):
    return V.scans(spark, d).select("page_id", N.scan_number(F.col("path")).alias("number"))


@query
def split_labels(spark, d):
    return label_arrays(spark, d).select(
        "order_key",
        F.size("labels").alias("n_labels"),
        F.element_at("labels", 1).alias("first_label"),
        F.element_at("labels", -1).alias("last_label"),
    )


@query
def label_encode(spark, d):
    labelled = stored(V.findings(spark, d).select("order_key", "finding_labels"), "findings")
    return C.encode(labelled, "finding_labels", "code")


@query
def multilabel_binarize(spark, d):
    return C.binarize(label_arrays(spark, d), "labels", part_types(spark, d), ["order_key"])


@query
def one_hot_long(spark, d):
    return C.one_hot_long(label_arrays(spark, d), "order_key", "labels")


@query
def labels_from_encoding(spark, d):
    codes = C.class_codes(V.findings(spark, d), "finding_labels", "code")
    pairs = F.sort_array(F.collect_list(F.struct("finding_labels", "code")))
    encoding = codes.agg(F.map_from_entries(pairs).alias("encoding"))
    return encoding.select(text(C.encoding_labels(F.col("encoding"))).alias("labels"))


@query
def text_prompt(spark, d):
    return label_arrays(spark, d).select("order_key", L.text_prompt(F.col("labels")).alias("prompt"))


@query
def text_prompt_one_hot(spark, d):
    classes = part_types(spark, d)
    table = C.binarize(label_arrays(spark, d), "labels", classes, ["order_key"])
    return table.select("order_key", L.prompt_from_one_hot(classes, "An X-ray").alias("prompt"))


@query
def zero_pad(spark, d):
    return V.table(spark, d, "orders").select(
        "o_orderkey",
        N.zero_pad(F.col("o_orderkey"), 3).alias("three"),
        F.concat(N.zero_pad(F.col("o_orderkey") + 1, 4), F.lit(".png")).alias("four"),
    )


@query
def short_name(spark, d):
    target = F.concat(F.lit("models.nets."), F.regexp_replace("p_name", " ", "."), F.lit(".Dense_"), F.col("p_type"))
    loader = F.when(F.col("p_size") % 2 == 0, "diffusers.Pipeline.from_pretrained").otherwise(target)
    return V.table(spark, d, "part").select(
        "p_partkey",
        N.short_name(target).alias("short"),
        N.short_name(target, lower=True).alias("lowered"),
        N.model_name(loader, F.concat(F.lit("hub/"), F.col("p_brand"))).alias("model"),
    )


@query
def run_name(spark, d):
    params = P.merge(F.col("params"), F.col("override"))
    model = N.model_name(F.col("params")["_target_"], F.lit(""))
    return V.run_params(spark, d).select("run_id", P.run_name(params, model).alias("run_name"))


@query
def collect_params(spark, d):
    c = V.table(spark, d, "customer")
    entry = lambda **kv: F.create_map(*[x for k, v in kv.items() for x in (F.lit(k), v)])
    hub = F.col("c_custkey") % 2 == 0
    params = P.collect(
        P.base_params(F.lit("2024-01-01"), F.lower("c_mktsegment"), F.col("c_custkey"), F.lit("00-00-00"), F.lit(True)),
        entry(
            _target_=F.when(hub, "hub.UNet.from_pretrained").otherwise("nets.DenseNet121"),
            pretrained_model_name_or_path=F.concat(F.lit("models/"), F.col("c_mktsegment")),
        ),
        entry(_target_=F.lit("torch.nn.CrossEntropyLoss"), reduction=F.lit("mean")),
        entry(_target_=F.lit("torch.optim.AdamW"), lr=F.concat(F.lit("0.0"), F.col("c_nationkey").cast("string"))),
        F.lit("chest"),
        entry(
            use_sampling=F.when(F.col("c_nationkey") < 10, "false").otherwise("true"),
            sampling_method=F.lit("resample"), positive_class=F.lit("PROMO"),
        ),
    )
    return c.select(F.col("c_custkey").alias("run_id"), entries_text(params).alias("params"))


@query
def merge_params(spark, d):
    return V.run_params(spark, d).select(
        "run_id", entries_text(P.merge(F.col("params"), F.col("override"))).alias("params")
    )


@query
def rename_metrics(spark, d):
    renames = {"Purchase": "FID", "View": "Inception", "Click": "SSIM"}
    return V.table(spark, d, "events").select(
        "event_id", P.rename_metric(F.initcap("event_type"), renames).alias("metric")
    )


# --- splitting, sampling, rebalancing ----------------------------------------


@query
def seeded_order(spark, d):
    return S.shuffled(V.samples(spark, d), ["key"], SEED).select("key", "position")


@query
def seeded_order_by_class(spark, d):
    return S.shuffled(V.samples(spark, d), ["key"], SEED, ["labels"]).select("key", "labels", "position")


@query
def stratified_split(spark, d):
    return S.stratified_split(V.samples(spark, d), "labels", ["key"], SEED).select("key", "labels", "split")


@query
def stratified_split_sizes(spark, d):
    """Both parts given, so that some rows are in neither."""
    return S.stratified_split(V.samples(spark, d), "labels", ["key"], SEED, 0.2, train_size=0.5).select("key", "labels", "split")


@query
def share_split(spark, d):
    return S.share_split(V.samples(spark, d), ["key"], SEED, 0.1).select("key", "labels", "split")


@query
def share_sample(spark, d):
    return S.share_sample(V.samples(spark, d), "labels", {0: 0.25, 2: 0.5}, ["key"], SEED).select("key", "labels")


@query
def stratified_split3(spark, d):
    named = C.decode(V.samples(spark, d), "labels", ENCODING, "class_name")
    return S.stratified_split3(named, "class_name", ["key"], SEED, code="code").select(
        "key", "class_name", "code", "split"
    )


@query
def bootstrap_per_class(spark, d):
    return S.bootstrap_per_class(V.samples(spark, d), "labels", ["key"], S.SAMPLE_TO_VALUE, SEED).select(
        "key", "labels", "draw"
    )


@query
def resample_to_value(spark, d):
    return S.resample_to_value(V.samples(spark, d), "labels", ["key"], SEED).select("key", "labels", "draw")


@query
def undersample(spark, d):
    return S.undersample(V.samples(spark, d), "labels", ["key"], SEED).select("key", "labels")


@query
def mix_generated(spark, d):
    train = V.samples(spark, d).select("image_files", "labels")
    generated = S.generated_rows(SC.flat_files(V.table(spark, d, "customer").select(
        F.concat(F.lit("/out/"), F.col("c_name"), F.lit(".png")).alias("path"))), "/generated", 2)
    return S.mix_generated(train, generated, "labels", 2, ["image_files"], SEED)


@query
def prepare_splits(spark, d):
    samples = V.samples(spark, d)
    return S.prepare_splits(samples, "labels", ["key"], SEED, sampling="undersample").select("key", "labels", "split")


@query
def prepare_splits_bootstrap(spark, d):
    samples = V.samples(spark, d)
    prepared = S.prepare_splits(samples, "labels", ["key"], SEED, sampling="bootstrap", value=1000)
    return prepared.select("key", "labels", "split", "draw")


@query
def prepare_splits_generated(spark, d):
    samples = V.samples(spark, d).select("image_files", "labels")
    generated = S.generated_rows(SC.flat_files(V.table(spark, d, "customer").select(
        F.concat(F.lit("/out/"), F.col("c_name"), F.lit(".png")).alias("path"))), "/generated", 2)
    return S.prepare_splits(
        samples, "labels", ["image_files"], SEED, generated=generated, positive=2, sampling="undersample"
    ).select("image_files", "labels", "split")


# --- cohorts -----------------------------------------------------------------


@query
def cohort_by_list(spark, d):
    positive = L.label_any(L.split_labels(F.col("finding_labels")), V.POSITIVE)
    spec = CO.CohortSpec("order_key", "finding_labels", "/scans", positive, "diffusion")
    return CO.cohort_by_list(V.findings(spark, d), V.split_lists(spark, d), spec).select(
        "order_key", "image_files", "labels", "split"
    )


@query
def cohort_by_column(spark, d):
    spec = CO.CohortSpec("order_key", "finding_labels", "/scans")
    return CO.cohort_by_column(V.split_column(spark, d), spec).select("order_key", "image_files", "labels", "split")


@query
def cohort_by_dirs(spark, d):
    part = F.when(F.col("place") < 80, "train").otherwise("test")
    root = written_tree(spark, d, F.concat_ws("/", part, "class", "name"), {"train/.DS_Store": "x", "test/el": None})
    return CO.cohort_from_tree(spark, root, 3).withColumn("image_files", below(F.col("image_files"), root))


@query
def cohort_by_lookup(spark, d):
    return CO.cohort_by_lookup(
        V.scans(spark, d), V.patients(spark, d), "/scans", "id", "target", exclude=[".html"]
    )


@query
def load_cohort(spark, d):
    loaders = {
        "samples": lambda: split_samples(spark, d).select("image_files", "labels", "split"),
        "pages": lambda: page_samples(spark, d),
    }
    return CO.load_cohort("samples", loaders, {"pages": loaders["pages"]})


@query
def explore_flow(spark, d):
    return CO.explore(
        V.findings(spark, d), V.split_lists(spark, d), "order_key", "finding_labels", V.POSITIVE, V.ALLOWED
    )


def job_samples(spark, d):
    spec = CO.CohortSpec("order_key", "label", "/scans")
    labelled = V.findings(spark, d).select(
        "order_key", L.label_any(L.split_labels(F.col("finding_labels")), V.POSITIVE).alias("label")
    )
    return CO.cohort_by_list(labelled, V.split_lists(spark, d), spec).drop("label")


@query
def prepare_job(spark, d):
    job = CO.prepare_job(job_samples(spark, d), ["order_key"], "order_key", SEED, 64, sampling="undersample")
    return job.select("order_key", "image_files", "labels", "split", "position", "batch_id")


@query
def prepare_job_bootstrap(spark, d):
    """The train part drawn with replacement, 1,000 rows of each class."""
    job = CO.prepare_job(job_samples(spark, d), ["order_key"], "order_key", SEED, 64, sampling="bootstrap", value=1000)
    return job.select("order_key", "labels", "split", "draw", "position", "batch_id")


@query
def prepare_job_export(spark, d):
    """The whole job to its written batches."""
    path = scratch_path(spark, "job")
    CO.export_job(job_samples(spark, d), path, ["order_key"], "order_key", SEED, 64, sampling="undersample")
    return spark.read.parquet(path).select("order_key", "labels", "split", "position", "batch_id")


# --- vectors -----------------------------------------------------------------


@query
def vec_normalize(spark, d):
    vectors = V.vectors(spark, d)
    largest = vectors.agg(F.max(F.array_max("embedding")).cast("double")).first()[0]
    return values_of(vectors, VEC.scale(F.col("embedding"), largest))


@query
def vec_out_of_range(spark, d):
    vector = F.col("embedding")
    scaled = F.when(VEC.scale(vector, 0.35).isNotNull(), F.size(VEC.scale(vector, 0.35)))
    return V.vectors(spark, d).select("vec_id", VEC.out_of_range(vector, 0.35).cast("int").alias("out_of_range"), scaled.alias("scaled"))


@query
def vec_channel_mean(spark, d):
    return values_of(V.vectors(spark, d), VEC.channel_mean(F.col("embedding")))


@query
def vec_channel_repeat(spark, d):
    return values_of(V.vectors(spark, d), VEC.channel_repeat(F.col("embedding").cast("array<double>")))


@query
def vec_steps(spark, d):
    load = [VEC.channel_repeat, lambda v: VEC.scale(v, 1.0)]
    steps = VEC.pipeline_steps(load, [VEC.channel_mean], use_train=True)
    tensors = values_of(VEC.apply_steps(V.vectors(spark, d), "embedding", steps), F.col("embedding"))
    return tensors.withColumn("value", F.col("value").cast("double")).withColumn("steps", F.lit(len(steps)))


def vector_sides(spark, d):
    return V.vectors(spark, d).withColumn("side", F.when(F.col("label") < 5, "real").otherwise("fake"))


@query
def frechet_distance(spark, d):
    return rounded(X.frechet_distance(vector_sides(spark, d), "embedding", "side", "real", "fake"), "frechet_distance")


@query
def vector_moments(spark, d):
    """Means and covariances of both sets; every 50th vector is missing and counted."""
    gaps = F.when(F.col("vec_id") % 50 != 0, F.col("embedding")).alias("embedding")
    found = X.vector_moments(vector_sides(spark, d).select("side", gaps), "embedding", "side", tile=24)
    return rounded(found, "mean_i", "mean_j", "covariance")


@query
def inception_score(spark, d):
    scored = X.inception_score(V.pred10(spark, d), "logits", ["vec_id"], SEED)
    return rounded(scored, "inception_mean", "inception_std")


@query
def pair_ssim(spark, d):
    sides = vector_sides(spark, d)
    fake, real = (sides.where(F.col("side") == s) for s in ("fake", "real"))
    return rounded(X.pair_ssim(fake, real, "embedding", ["vec_id"], SEED), "ssim")


# --- streaming ---------------------------------------------------------------


@query
def stream_confusion(spark, d):
    """Events that arrive in several files, one at a time and in any order."""
    path, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "stream-state")
    arriving, table = scratch_path(spark, "stream-in"), V.table(spark, d, "events")
    table.repartition(ARRIVALS, "event_id").write.parquet(arriving)
    events = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(arriving)
    counts = ST.epoch_confusion(V.pred_stream(events), late=LATE)
    ST.start_confusion(counts, path, checkpoint).awaitTermination()
    return ST.latest_counts(spark.read.parquet(path))


@query
def stream_late_rows(spark, d):
    """Events in three arrivals: up to day 20, the days after it, and then every tenth
    event of the first ten days, which comes after its epoch was closed. The streams are
    stopped before the last arrival and go on from their checkpoints."""
    root, table = scratch_path(spark, "stream"), V.table(spark, d, "events")
    behind = (F.col("event_id") % 10 == 0) & (F.dayofmonth("ts") <= 10)
    early = F.dayofmonth("ts") <= 20
    for arrivals in ((~behind & early, ~behind & ~early), (behind,)):
        for part in arrivals:
            table.where(part).coalesce(1).write.mode("append").parquet(f"{root}/in")
        events = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
        rows = V.pred_stream(events)
        streams = {"counts": ST.epoch_confusion(rows), "arrivals": ST.epoch_arrivals(rows)}
        for name, stream in streams.items():
            ST.start_confusion(stream, f"{root}/{name}", f"{root}/{name}-state").awaitTermination()
    counts = ST.latest_counts(spark.read.parquet(f"{root}/counts"))
    state = ST.running_state(counts, ST.latest_arrivals(spark.read.parquet(f"{root}/arrivals")))
    return rounded(state, "accuracy")


@query
def batch_confusion(spark, d):
    counts = ST.epoch_confusion(V.pred_stream(V.table(spark, d, "events")))
    return rounded(ST.epoch_accuracy(counts), "accuracy")
