"""Every registered query against its SQL, on the smallest test tables."""

import os

import pytest

import __spark_entry__ as contract
from compare import compare, connect
from snaplake import catalog

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, con, name):
    got, want, _ = compare(
        spark, con, contract.queries()[name], contract.oracle_sql()[name], SF_DIR
    )
    assert got == want
    assert got[1] or name in ("missing_snapshots", "category_path_filter", "resume_anti")


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["seq", "creator_name", "creator_link"]
    assert not df.isEmpty()
