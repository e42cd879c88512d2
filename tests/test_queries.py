"""Every registered query against its SQL twin, on the smallest tables."""

import pytest

import __spark_entry__ as spark_entry
from tests.compare import compare, duck

QUERIES = spark_entry.queries()
SQL = spark_entry.oracle_sql()
FORESTS = {"rf_predict", "feature_importance", "rf_grid"}
# The corpus queries have tests of their own, where they are present.
QUERIES = {n: q for n, q in QUERIES.items() if n != "pipeline" and not n.startswith("op")}
SQL = {n: s for n, s in SQL.items() if n in QUERIES}


@pytest.fixture(scope="module")
def connection(small):
    return duck(small)


def test_entry_counts_by_side_and_stratum(spark):
    df = spark_entry.entry(spark)
    assert df.columns == ["split", "o_orderpriority", "n"]
    assert df.count() == 10


def test_only_forests_lack_a_twin():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) - set(SQL) == FORESTS


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_twin(spark, connection, small, name):
    problems, _, _ = compare(spark, connection, small, QUERIES[name], SQL[name])
    assert not problems


def test_forest_queries_give_rows(spark, small):
    predicted = QUERIES["rf_predict"](spark, small)
    assert predicted.columns == ["id", "price", "prediction"] and predicted.count() > 100
    assert QUERIES["rf_grid"](spark, small).count() == 3
    assert QUERIES["feature_importance"](spark, small).count() == 11
