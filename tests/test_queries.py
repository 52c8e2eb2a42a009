"""Every registered query against its DuckDB counterpart on the whole small tables."""

import pytest

import __spark_entry__ as driver
from checks.compare import differences, duck
from checks.oracles import oracles
from checks.queries import registered


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_an_oracle():
    assert set(registered()) == set(oracles()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(registered()))
def test_query_equals_oracle(spark, con, sf_dir, name):
    assert differences(spark, con, sf_dir, name) == []


def test_entry_is_the_flagship(spark):
    df = driver.entry(spark)
    assert df.columns[3:] == [
        "NAME", "LATITUDE", "LONGITUDE", "COUNTRY", "REGION", "CITY", "REMARKS", "CONTENT",
    ]
    assert df.count() > 0
