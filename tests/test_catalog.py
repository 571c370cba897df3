"""Every registered query with SQL equals DuckDB on the smallest test tables."""

import pytest

from lotwise.catalog.registry import ENTRIES
from tests.compare import difference, duck

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", [n for n, e in ENTRIES.items() if e.body is not None])
def test_equals_sql(spark, con, name):
    entry = ENTRIES[name]
    assert difference(entry.run(spark, FOLDER), con, entry.sql()) is None


@pytest.mark.parametrize("name", ["supervised_windows", "minmax_per_timestep", "fit_linear", "linear_window_residuals",
                                  "predict_long"])
def test_samples_equal_sql(spark, name):
    """The smallest tables have no 24 hours without a gap, so that samples are checked on larger ones."""
    folder = "/root/testdata/sf0.01"
    entry = ENTRIES[name]
    df = entry.run(spark, folder)
    assert not df.isEmpty()
    assert difference(df, duck(folder), entry.sql()) is None


def test_entry_contract(spark):
    import __spark_entry__ as contract
    assert set(contract.oracle_sql()) <= set(contract.queries())
    df = contract.entry(spark)
    assert df.columns == ["parking_lot_id", "hour_timestamp", "avg_free_spaces", "min_free_spaces",
                          "max_free_spaces", "free_spaces_range"]
    assert df.count() > 0
