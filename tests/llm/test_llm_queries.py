"""Every query on training data runs; those with SQL give the rows of their SQL."""

import pytest

from quire.llm.queries import oracle_sql, queries
from tests.compare import assert_same
from tests.conftest import DATA

COLUMNS = {"p1_found": "item_table item_id", "p3_found": "block_id kind", "p5_found": "first_id copy_id", "p7_found": "doc_id item_id", "p9_found": "doc_id segment_no lang"}


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_equals_sql(spark, duck, name):
    assert_same(queries()[name](spark, DATA), duck.sql(oracle_sql()[name]))


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_runs(spark, name):
    df = queries()[name](spark, DATA)
    assert df.count() > 0
    if name in COLUMNS:
        assert df.columns == COLUMNS[name].split() and df.count() == df.distinct().count()


def test_names_are_new():
    from quire.plans.queries import queries as core

    assert not set(queries()) & set(core())
