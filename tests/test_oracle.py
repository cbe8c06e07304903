"""Every query against its SQL."""

import pytest

import __spark_entry__ as driver
from acerto.plans.oracle import all_oracles
from acerto.plans.queries import all_queries
from check_oracle import difference, open_tables


@pytest.fixture(scope="module")
def database(sf_dir):
    return open_tables(sf_dir)


def test_every_query_has_sql():
    assert all_queries().keys() == all_oracles().keys()


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_same_as_sql(spark, database, sf_dir, name):
    assert difference(spark, database, sf_dir, name) is None


def test_entry(spark):
    rows = driver.entry(spark).collect()
    assert len(rows) == 365
    assert sum(r.nb_mismatch_tx_pix_in for r in rows) == 39
    assert sum(r.nb_mismatch_tx_pix_out for r in rows) == 44
