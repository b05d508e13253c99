"""Every registered table query beside its SQL, on the smallest tables."""

import pytest
from conftest import DATA, same_rows

from leafmill.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_sql(spark, duck, name):
    n, rows = same_rows(duck, catalog.QUERIES[name](spark, DATA), catalog.SQL[name])
    assert n == 0
    assert rows > 0 or name in ("cross_page_pairs", "regression_gate", "page_sets")


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_rows_only(spark, name):
    assert catalog.QUERIES[name](spark, DATA).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 3
    assert set(e.oracle_sql()) <= set(e.queries())
