"""The physical plans that matter at scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from cohortwise.operators import classes as C, evaluation as E, joins as J, runs as W, sampling as S
import cohortwise.operators.ranks as ranks
from cohortwise.operators.ranks import seeded_rank
from cohortwise.plans import queries as Q, views as V


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_binarize_adds_no_shuffle(spark, sf_dir):
    source = V.table(spark, sf_dir, "part").select("p_partkey", F.array("p_type").alias("l"))
    assert "Exchange" not in plan(C.binarize(source, "l", ["PROMO", "SMALL"]))


def test_split_rows_are_not_shuffled(spark, sf_dir):
    text = plan(S.stratified_split(V.samples(spark, sf_dir), "labels", ["key"], 1))
    assert "Exchange hashpartitioning" not in text
    assert "Window" not in text
    assert "BroadcastHashJoin" in text


@pytest.mark.parametrize("grouped", [True, False])
def test_quotas_read_the_data_once_and_join_by_key(spark, sf_dir, monkeypatch, grouped):
    seen = []
    fitted = ranks.fitted
    monkeypatch.setattr(ranks, "fitted", lambda df: seen.append(df) or fitted(df))
    samples = V.samples(spark, sf_dir)
    if grouped:
        S.stratified_split(samples, "labels", ["key"], 1)
    else:
        S.sample_rows(samples, 10, ["key"], 1)
    for df in seen:
        df.collect()
        final = plan(df).split("== Initial Plan ==")[0]
        assert "CartesianProduct" not in final and "BroadcastNestedLoopJoin" not in final
        assert final.count("FileScan") == 1
    assert "ReusedExchange" in plan(seen[0])


def test_undersample_rows_are_not_shuffled(spark, sf_dir):
    assert "Exchange hashpartitioning" not in plan(S.undersample(V.samples(spark, sf_dir), "labels", ["key"], 1))


def test_rank_shuffles_rows_once_by_group_and_chunk(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(seeded_rank(V.samples(spark, sf_dir), ["key"], 1, ["labels"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    by_chunk = re.findall(r"Exchange hashpartitioning\(_group#\d+, _chunk#\d+, \d+\)", text)
    # One for the rows, one for the chunk counts, one for the few starts.
    assert len(by_chunk) <= 3
    assert not re.search(r"Window \[row_number\(\)[^\]]*\], \[_group#\d+\], ", text)


def test_large_draw_tables_are_not_broadcast(spark, sf_dir, monkeypatch):
    samples = V.samples(spark, sf_dir)
    monkeypatch.setattr(S, "BROADCAST_DRAWS", 10)
    text = plan(S.bootstrap_per_class(samples, "labels", ["key"], 5000, 1))
    assert "SortMergeJoin [_group" in text


def test_draws_are_made_in_blocks(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(S, "DRAW_BLOCK", 100)
    counts = S.class_counts(V.samples(spark, sf_dir), "labels").withColumn("_need", F.lit(1000))
    text = plan(S.draws(counts, "labels", 3000, 1))
    assert len(re.findall(r"Generate explode\(sequence", text)) == 2
    assert "Exchange" in text


def test_few_draws_shuffle_few_rows(spark, sf_dir, monkeypatch):
    """The rows are filtered by chunk before they are shuffled."""
    monkeypatch.setattr(S, "FEW_DRAWS", 0)
    text = plan(S.bootstrap_per_class(V.samples(spark, sf_dir), "labels", ["key"], 2, 1))
    exchange = text.index("Exchange hashpartitioning(_group")
    assert "LeftSemi" in text[exchange:]
    assert "SortMergeJoin" not in text


def test_small_list_is_broadcast_as_semi_join(spark, sf_dir):
    orders = V.table(spark, sf_dir, "orders").select("o_orderkey")
    ids = V.table(spark, sf_dir, "orders").where("o_totalprice < 1000").select("o_orderkey")
    text = plan(J.select_keys(orders, ids, "o_orderkey"))
    assert "BroadcastHashJoin" in text and "LeftSemi" in text


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(J.select_keys(V.table(spark, sf_dir, "orders").where("o_totalprice > 5"), V.table(
        spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey").select("o_orderkey"))
    assert "GreaterThan(o_totalprice,5.0)" in text
    assert "ReadSchema: struct<l_orderkey:bigint>" in text


def test_top_n_per_run_is_limited_before_the_shuffle(spark, sf_dir):
    log = spark.createDataFrame([(1, 1, 0.5)], "run int, epoch int, value double")
    assert "WindowGroupLimit" in plan(W.best_epochs(log, ["run"], "value", "loss", 2))


def test_preview_keeps_a_top_list(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(S.preview(V.table(spark, sf_dir, "orders"), "o_orderkey"))


def test_report_does_not_read_the_data_again(spark, sf_dir):
    assert "FileScan" not in plan(E.classification_report(V.pred_lines(spark, sf_dir)))


PYTHON = ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "PythonMapInArrow", "FlatMapGroupsInPandas")
WITH_PYTHON = {"custom_metric", "custom_metric_merged"}


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_queries_stay_in_the_jvm_and_join_by_key(spark, sf_dir, name):
    text = plan(Q.QUERIES[name](spark, sf_dir))
    assert any(p in text for p in PYTHON) == (name in WITH_PYTHON)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
