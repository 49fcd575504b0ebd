"""Every registered key with an oracle matches DuckDB at sf0.01; every key runs."""

import os

import pytest

from tests.conftest import SF_ORACLE as _DEFAULT_SF
from tests.oracle import compare, duck

import __spark_entry__ as E

# TABLELAB_ORACLE_SF=/root/testdata/sf0.1 re-runs the parity check on more data.
SF_ORACLE = os.environ.get("TABLELAB_ORACLE_SF", _DEFAULT_SF)
_SQL = E.oracle_sql()
_QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


@pytest.mark.parametrize("key", sorted(_SQL))
def test_matches_oracle(spark, con, key):
    ok, msg = compare(_QUERIES[key](spark, SF_ORACLE), con, _SQL[key])
    assert ok, msg


@pytest.mark.parametrize("key", sorted(set(_QUERIES) - set(_SQL)))
def test_rows_only_keys_run(spark, key):
    df = _QUERIES[key](spark, SF_ORACLE)
    rows = df.collect()
    assert rows and all(len(r) == len(df.columns) for r in rows)


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["user_id", "n", "share", "rank", "ratio_to_mean"]
