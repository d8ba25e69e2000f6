"""Every catalogued query without a model against its SQL, on the small tables."""

import pytest

import __spark_entry__ as entry
from compare import differences, open_duckdb

MODELS = ("rf_", "gbt_", "mlp_", "model_", "learning_", "shap_long", "shap_additivity", "shap_boosting",
          "shap_network", "stream_scoring", "onehot")
NAMES = [name for name in entry.oracle_sql() if not name.startswith(MODELS)]


@pytest.fixture(scope="module")
def connection(sf_dir):
    return open_duckdb(sf_dir)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, sf_dir, connection, name):
    assert differences(entry.queries()[name](spark, sf_dir), connection, entry.oracle_sql()[name]) is None


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["estado", "total_focos", "frp_medio"]
