import pytest

import __spark_entry__ as entry
from panelforge import queries as panel
from panelforge import queries_runs  # noqa: F401

from twins import compare, connection

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connection(SF)


@pytest.mark.parametrize("name", sorted(panel.ORACLE_SQL))
def test_query_equals_sql(spark, con, name):
    compare(panel.QUERIES[name](spark, SF), con, panel.ORACLE_SQL[name])


def test_entry_has_rows_and_stable_schema(spark):
    df = entry.entry(spark)
    assert df.columns == ["eval_type", "group_id", "metric", "value"] and df.count() > 0


def test_sql_only_for_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
