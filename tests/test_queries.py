"""Every query at the smallest scale: against DuckDB where it has an oracle, else its rows."""

import pytest

import __spark_entry__ as contract
from checks.compare import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_oracle(spark, duck, name):
    assert compare(QUERIES[name](spark, SF).toArrow(), duck.sql(ORACLES[name]).to_arrow_table()) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_oracle_has_rows(spark, name):
    found = QUERIES[name](spark, SF)
    assert len(set(found.columns)) == len(found.columns) and found.count() > 0


@pytest.mark.parametrize("name", ["train_forest", "train_gbt", "train_extra_trees", "train_linear_svr"])
def test_trained_models_beat_the_mean(spark, name):
    """The rows are the hold-out, predictions stay near its range, and errors are below the mean predictor's."""
    rows = QUERIES[name](spark, "/root/testdata/sf0.01").toPandas()
    error, spread = (rows["discount_pct"] - rows["prediction"]).abs().mean(), (rows["discount_pct"] - rows["discount_pct"].mean()).abs().mean()
    assert rows["prediction"].between(-0.5, 1.5).all() and error < spread


def test_entry(spark):
    assert contract.entry(spark).limit(1).count() == 1


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
