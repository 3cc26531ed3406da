"""Every registered query beside its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from checks.compare import connect, difference

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, name):
    found = difference(entry.queries()[name](spark, SF), connect(SF), entry.oracle_sql()[name])
    assert found is None


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "split" in df.columns
