"""Every query of the catalog against DuckDB's answer to its SQL."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from compare import duck, duck_rows, rows_of  # noqa: E402

from marlstone.plans import catalog  # noqa: E402


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, sf_dir, con, name):
    rows, columns = rows_of(catalog.QUERIES[name](spark, sf_dir))
    if name in catalog.ORACLES:
        want, names = duck_rows(con, catalog.ORACLES[name])
        assert columns == names
        assert rows == want
    else:
        assert rows


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
