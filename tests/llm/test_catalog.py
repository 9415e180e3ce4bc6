import pytest

from entrygraph.llm import catalog
from tests.oracle import PRESENT, agree


@pytest.mark.skipif(not PRESENT, reason="needs the driver's tables")
@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_agrees_with_its_sql(spark, name):
    assert agree(spark, catalog.queries()[name], catalog.oracle_sql()[name])


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in catalog.queries()) == list(range(1, 14))
