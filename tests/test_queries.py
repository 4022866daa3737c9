import pytest

from corundum.plans import registry
from tests.conftest import TESTDATA


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_equals_sql(name, same):
    same(registry.QUERIES[name], registry.SQL[name])


# Its SQL adds charges as doubles in no fixed order, so a sum of exactly one half falls on either side of the tie;
# assembled_records adds them exactly on both sides.
TIES = pytest.mark.xfail(reason="sums of doubles at a tie", strict=False)


@pytest.mark.parametrize("name", [pytest.param(n, marks=TIES) if n == "assemble_left_join" else n for n in sorted(registry.SQL)])
def test_query_equals_sql_on_more_rows(name, same_larger):
    same_larger(registry.QUERIES[name], registry.SQL[name])


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL)))
def test_query_without_sql_runs(name, spark):
    # Few rows of the smallest tables have an id divisible by 20.
    assert registry.QUERIES[name](spark, TESTDATA).count() >= (name != "nearest_structures")


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["table_name", "zinc_id", "period", "kind"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
