"""Every SQL-expressible query against DuckDB, and the driver contract."""

import pytest

import __spark_entry__ as entry_module
from slyglot.plans.oracles import ORACLES
from slyglot.plans.queries import QUERIES
from tests.compare import connect, differences


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_oracle_has_a_query():
    assert not entry_module.oracle_sql().keys() - entry_module.queries().keys()


def test_entry_runs(spark):
    assert entry_module.entry(spark).columns == ["post_id", "labels"]


@pytest.mark.parametrize("name", sorted(entry_module.oracle_sql()))
def test_query_matches_oracle(spark, con, sf_dir, name):
    frame = entry_module.queries()[name](spark, sf_dir)
    assert differences(frame, con, entry_module.oracle_sql()[name]) == ""


def test_every_library_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()
