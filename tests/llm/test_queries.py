import pytest

from silverlane.llm.queries import ORACLES, QUERIES
from tests.oracle import compare, connect


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, name):
    assert compare(spark, connect(sf_dir), sf_dir, QUERIES[name], ORACLES[name]) is None


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 1 + len(QUERIES)))
