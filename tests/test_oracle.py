"""Every query of the catalogue against its SQL."""

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry

from compare import duck, spark_rows, sql_rows

from keyedflow.plans.oracle import ORACLE
from keyedflow.plans.queries import QUERIES

SF = os.environ.get("KEYEDFLOW_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    columns, rows = spark_rows(entry.queries()[name](spark, SF))
    assert (columns, rows) == sql_rows(con, ORACLE[name])
    assert rows


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() == 150
