"""Every registered query beside its SQL, and the entry contract."""

import pytest

import __spark_entry__ as entry_module
from check_oracle import compare, duck
from conftest import SMALL


@pytest.fixture(scope="module")
def connection():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(entry_module.oracle_sql()))
def test_query_equals_sql(spark, connection, name):
    verdict = compare(spark, connection, name, SMALL)
    assert verdict.startswith("ok"), verdict


def test_entry(spark):
    rows = entry_module.entry(spark).collect()
    assert 0 < len(rows) <= 10
    assert entry_module.entry(spark).columns == ["user_id", "n_shared"]


def test_every_oracle_has_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
