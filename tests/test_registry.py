"""Every registered query with SQL must agree with it; the others must run."""

import pytest

import __spark_entry__ as contract
from tests.oracle_check import compare, connect

SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def con(small_folder):
    return connect(small_folder)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, con, small_folder, name):
    assert compare(spark, con, contract.queries()[name], SQL[name], small_folder) is None


def test_flagship(spark, small_folder):
    table = contract.entry(spark)
    assert table.columns == ["country", "transactions", "fraud_cases", "fraud_rate_pct"]
    assert table.count() > 0


def test_tree_attributions_add_up_to_scores(spark, small_folder):
    rows = contract.queries()["tree_shap"](spark, small_folder).collect()
    assert len(rows) == 200
    assert all(r["explained"] == pytest.approx(r["score"], abs=1e-9) for r in rows)


@pytest.mark.parametrize("name", ["feature_importance", "coefficient_extremes", "sampled_shap"])
def test_model_queries_run(spark, small_folder, name):
    assert contract.queries()[name](spark, small_folder).count() > 0
