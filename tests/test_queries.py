"""Every registered query against its SQL twin."""

import pytest
from __spark_entry__ import entry
from compare import difference

from layerspark.plans import oracles
from layerspark.plans import queries as registered


@pytest.mark.parametrize("name", sorted(registered.registry()))
def test_query_matches_sql(spark, sf, name):
    assert difference(spark, sf, registered.registry()[name], oracles.registry()[name]) is None


def test_every_query_has_sql():
    assert set(registered.registry()) == set(oracles.registry())


def test_entry_runs(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "feature_id"
