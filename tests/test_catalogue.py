"""Every registered query against its SQL twin, and what the others must satisfy."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from terrasift.registry import DatasetSpec

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def _plain(rows):
    def cell(x):
        return "" if x is None or (isinstance(x, float) and math.isnan(x)) else repr(x + 0.0) if isinstance(x, float) else str(x)
    return sorted(tuple(cell(x) for x in row) for row in rows)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, sql, name):
    df = contract.queries()[name](spark, FOLDER)
    relation = sql.sql(contract.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(relation.columns)
    got = _plain(df.select(*[f"`{c}`" for c in columns]).collect())
    want = _plain(relation.project(", ".join(f'"{c}"' for c in columns)).fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(contract.oracle_sql())))
def test_query_without_sql_has_rows(spark, name):
    assert contract.queries()[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 5000


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_forest_beats_the_mean_on_rows_it_saw(spark):
    df = contract.queries()["train_and_score_all"](spark, FOLDER)
    row = df.filter("split = 'train'").selectExpr(
        "sqrt(avg(pow(o_totalprice - prediction, 2))) AS rmse", "stddev_pop(o_totalprice) AS spread").first()
    assert row["rmse"] < row["spread"]
    assert isinstance(DatasetSpec("a", ["b"], "c").required, list)
