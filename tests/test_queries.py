"""Every query against its SQL, and the driver's entry points."""

import pytest
from compare import differences, duck

import __spark_entry__ as entry
from oracles import queries as checks
from stayline.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
ORACLES = checks.oracle_sql()
# Models need more rows than the smallest tables hold.
MODELS = {"train_gbt_a", "train_gbt_b", "train_gbt_c", "feature_importance", "score",
          "write_importance", "model_rounds"}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_keys():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(set(ORACLES) - MODELS))
def test_query(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(MODELS))
def test_models(spark, name):
    sf_dir = "/root/testdata/sf0.01"
    assert differences(QUERIES[name](spark, sf_dir), duck(sf_dir), ORACLES[name]) == []


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.count() > 0 and frame.columns[0] == "snapshot_date"
