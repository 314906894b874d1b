"""Every registered query against its DuckDB twin on the driver tables."""

import pytest

import __spark_entry__ as E
from oracle_compare import compare, duck
from runtally import registry

NAMES = sorted(registry.QUERIES)


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_sql():
    assert set(registry.SQL) == set(registry.QUERIES)
    assert set(registry.QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, sf_dir, name):
    ok, msg = compare(spark, con, name, registry.QUERIES[name], registry.SQL[name], sf_dir)
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["dummy_date", "species", "median_percentcomplete", "min_percentcomplete",
                          "max_percentcomplete"]
    assert df.count() > 0
