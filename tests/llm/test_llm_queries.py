import pytest

from corundum.llm import registry
from tests.conftest import TESTDATA


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_equals_sql(name, same):
    same(registry.QUERIES[name], registry.SQL[name])


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL)))
def test_query_without_sql_runs(name, spark):
    assert registry.QUERIES[name](spark, TESTDATA).count() > 0


def test_columns_of_found_queries(spark):
    want = {"p1_found": ["row_seq", "compound_id"], "p5_found": ["compound_id", "field_name", "row_seq"], "p6_ids": ["doc_id", "ids"], "p8_found": ["doc_id"]}
    assert {n: registry.QUERIES[n](spark, TESTDATA).columns for n in want} == want
