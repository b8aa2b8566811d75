"""Every query against its SQL on the small tables."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry_module
import bench
from compare import connect, difference, spark_table, sql_table

QUERIES = entry_module.queries()
ORACLES = entry_module.oracle_sql()
ARROW_TYPES = {"boolean": "BOOLEAN", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    with connect(sf_dir) as con:
        yield con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    assert difference(spark_table(df), sql_table(duck, ORACLES[name])) is None
    declared = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {ORACLES[name]}").fetchall()}
    assert {c: ARROW_TYPES[t] for c, t in df.dtypes} == declared


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
    own = {name for name in QUERIES if name != "pipeline" and not re.match(r"op\d+_", name)}
    assert own - set(ORACLES) == {"frechet_distance"}


def test_entry_has_rows(spark):
    df = entry_module.entry(spark)
    assert df.count() == 8
    assert df.columns[:3] == ["version", "part", "n"]


def test_bench_names_are_queries():
    assert set(bench.HEADLINE) <= set(QUERIES)
