"""Every core query with SQL gives the rows of its SQL; those without SQL run."""

import pytest

from quire.plans.queries import oracle_sql, queries
from tests.compare import assert_same
from tests.conftest import DATA, LARGER_DATA, duck_of

SQL = oracle_sql()
#: A few documents per release are too few to tell renamed fields.
LARGER = {"p4_elements"}


@pytest.mark.parametrize("name", sorted(set(SQL) - LARGER))
def test_equals_sql(spark, duck, name):
    assert_same(queries()[name](spark, DATA), duck.sql(SQL[name]))


@pytest.mark.parametrize("name", sorted(LARGER))
def test_equals_sql_on_more_data(spark, name):
    assert_same(queries()[name](spark, LARGER_DATA), duck_of(LARGER_DATA).sql(SQL[name]))


@pytest.mark.parametrize("name", sorted(set(queries()) - set(SQL)))
def test_runs(spark, name):
    assert queries()[name](spark, DATA).count() >= 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_core_without_the_llm_package(monkeypatch):
    import __spark_entry__ as entry

    def gone(name):
        raise ModuleNotFoundError(name=name)

    monkeypatch.setattr(entry, "import_module", gone)
    assert set(entry.queries()) == set(queries())
