"""Every registered query against its SQL on the smallest given tables."""

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from __spark_entry__ import entry, oracle_sql, queries
from tillmart.plans.catalogue import QUERIES
from tillmart.plans.oracle import ORACLE
from tools.check_oracle import database, expected, normal_rows

SF_DIR = os.environ.get("TILLMART_TESTDATA", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no test tables here")


@pytest.fixture(scope="module")
def db():
    return database(SF_DIR)


def test_every_query_of_this_library_has_its_sql():
    assert set(QUERIES) == set(ORACLE) and set(ORACLE) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = queries()[name](spark, SF_DIR)
    names, rows = expected(db, name)
    assert sorted(df.columns) == names
    assert normal_rows(df.columns, df.collect()) == rows


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["store_id", "sales_person_id", "full_name", "sales_month", "total_sales", "incentive"]
    assert df.count() > 0
