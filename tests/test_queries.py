"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import compare, connect

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


# Nothing to report in the smallest tables.
EMPTY_ALLOWED = {"consecutive_failures", "chunk_skew", "schema_rejects"}


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, connection, name):
    problem = compare(spark, connection, name, SF)
    assert problem == "" or (name in EMPTY_ALLOWED and problem == "both sides are empty")


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_query_without_sql_returns_rows(spark, name):
    assert queries()[name](spark, SF).count() > 0


def test_entry_is_a_report_per_day(spark):
    report = entry(spark)
    assert {"dt", "total_records", "quality_check"} <= set(report.columns)
    assert report.count() > 0


def test_sql_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())
