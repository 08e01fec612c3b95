"""Every registered query against its SQL twin, on whole tables."""

import pytest

import __spark_entry__ as entry
import oracle

from ledgerlake.plans import catalog

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return oracle.connect(sf_dir)


def test_every_ledger_query_has_a_twin():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, duck, sf_dir, name):
    difference = oracle.compare(spark, duck, QUERIES[name], SQL[name], sf_dir)
    # At the smallest scale a one-day slice may hold nothing.
    assert difference in (None, "empty")


def test_entry(spark):
    assert entry.entry(spark).columns == ["value_num", "token_address", "transaction_date"]
