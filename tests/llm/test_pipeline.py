from __future__ import annotations

import random

import __spark_entry__ as entry_module
import corpus_pipeline as pipeline
import pytest
from compare import connect, difference, spark_table, sql_table
from pyspark.sql import functions as F

from cohortwise.llm import queries
from support import awkward, documents

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", "label", "component", "size"]


def test_registered():
    names = entry_module.queries()
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= set(names)
    assert set(queries.ORACLES) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_gives_every_row(spark, sf_dir, name):
    out = queries.QUERIES[name](spark, sf_dir)
    rows = out.count()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    if name not in queries.ORACLES and name not in ("op4_raked_mixture", "op8_near_vectors"):  # rows of their own
        assert rows == docs
    assert rows > 0
    if name in queries.ORACLES:
        with connect(sf_dir) as con:
            assert difference(spark_table(out), sql_table(con, queries.ORACLES[name])) is None


def labels(spark, tmp_path, rows):
    folder = str(tmp_path)
    spark.createDataFrame(rows, "doc_id bigint, quality int").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_quality_stage_drops_what_is_rejected(spark, tmp_path):
    rng = random.Random(1)
    rows = []
    for i in range(300):
        words = rng.choices("the of and cat dog house runs".split(), k=40)
        rows.append((i, " ".join(w.upper() + "!!" for w in words) if i % 4 == 0 else " ".join(words)))
    folder = labels(spark, tmp_path, [(i, int(i % 4 != 0)) for i in range(300)])
    out = pipeline.good_quality(spark, documents(spark, rows), folder)
    assert out.columns == COLUMNS
    assert {r["doc_id"] for r in out.collect()} == {i for i in range(300) if i % 4}


def test_copies_stage_keeps_one_of_each_group(spark):
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join([*base, f"end{i}"])) for i in range(30)]
    rows += [(100 + i, " ".join(f"x{i}-{k}" for k in range(50))) for i in range(5)]
    rows += [(200, ""), (201, None), (203, "own words"), (203, "own words")]
    out = pipeline.first_of_copies(spark, documents(spark, rows), "")
    assert out.columns == COLUMNS
    assert sorted(r["doc_id"] for r in out.collect()) == [0, *range(100, 105), 200, 201, 203]


def test_secrets_stage_replaces_them(spark):
    rows = [(1, "é token=abcdef and é"), (2, "clean"), (3, None), (4, "token=" + "ab" * 12 + " AKIA" + "A" * 16), (None, "clean")]
    out = pipeline.without_secrets(spark, documents(spark, rows), "")
    assert out.columns == COLUMNS
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in out.collect()}
    assert got == {
        1: ("é [secret] and é", 16),
        2: ("clean", 5),
        3: (None, 0),
        4: ("[secret] [secret]", 17),
        None: ("clean", 5),
    }


def test_mixing_stage_keeps_rows_as_they_are(spark):
    docs = documents(spark, [(i, f"text {i}", "en", f"s{i % 3}") for i in range(300)])
    out = pipeline.mixed(spark, docs, "")
    assert out.columns == COLUMNS and 200 < out.count() <= 300
    assert out.exceptAll(docs).count() == 0


def shares(docs, column):
    sums = docs.groupBy(column).agg(F.sum(F.size(F.split("text", " ")))).collect()
    return {r[0]: r[1] / sum(x[1] for x in sums) for r in sums}


def wanted(docs, column):
    powers = {k: v**0.8 for k, v in shares(docs, column).items()}
    return {k: v / sum(powers.values()) for k, v in powers.items()}


def test_mixing_stage_meets_targets_where_cells_are_full(spark):
    """Both small values lift their common cell above its documents."""
    rows = [(i, "same few words", "en" if i % 50 < 33 else "de", f"s{int(i // 50 % 50 >= 33)}") for i in range(7500)]
    docs = documents(spark, rows)
    out = pipeline.mixed(spark, docs, "").cache()
    for column in ("lang", "source"):
        assert shares(out, column) == pytest.approx(wanted(docs, column), abs=0.004)
    assert out.count() / 7500 == pytest.approx(0.9, abs=0.01)


def test_mixing_stage_takes_rare_values_whole(spark):
    """A target beyond all documents of a value: what it cannot take, the others do."""
    rows = [(i, "same few words", "en", "rare" if i % 20 == 0 else f"s{i % 3}") for i in range(6000)]
    docs = documents(spark, rows)
    out = pipeline.mixed(spark, docs, "").cache()
    assert out.filter("source = 'rare'").count() == 300
    assert out.count() / 6000 == pytest.approx(0.9, abs=0.006)


def test_stages_take_awkward_and_empty_tables(spark, tmp_path):
    folder = labels(spark, tmp_path, [(1, 1), (8, 0), (None, 1)])
    docs = awkward(spark)
    for rows in (docs, docs.limit(0)):
        for name, stage in pipeline.STAGES:
            out = stage(spark, rows, folder)
            assert out.count() <= docs.count()
            assert name == pipeline.STAGES[-1][0] or out.columns == COLUMNS


def test_run_passes_stage_to_stage(spark, sf_dir):
    out = pipeline.run(spark, sf_dir)
    assert 0 < out.count() < spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert out.filter(~F.col("decoded")).count() == 0
