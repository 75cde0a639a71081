import pytest

import __spark_entry__ as entry
from tests.oracle_check import compare

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_agrees_with_sql(spark, name):
    assert compare(spark, SMALL, entry.queries()[name], entry.oracle_sql()[name]) == ""


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_query_gives_rows(spark, name):
    assert entry.queries()[name](spark, SMALL).count() > 0


def test_entry(spark):
    rows = {r.lang: r.records for r in entry.entry(spark).collect()}
    assert sum(rows.values()) > 0


def test_every_oracle_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
