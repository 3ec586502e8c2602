import pytest
from compare import duck, spark_rows, sql_rows

import __spark_entry__ as entry
from keyedflow.llm import quality
from keyedflow.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, name):
    columns, rows = spark_rows(QUERIES[name](spark, sf_dir))
    assert (columns, rows) == sql_rows(duck(sf_dir), ORACLE[name]) and rows


def test_registered():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
    assert sorted(QUERIES) == sorted([*(q for q in QUERIES if q.startswith("op")), "pipeline"])
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)} | {"pipeline"}


def test_rule_names(spark):
    assert tuple(quality.rules()) == quality.RULE_NAMES
