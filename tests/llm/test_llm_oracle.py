"""The training-data queries that SQL can express, on the smallest tables."""

import pytest
from oracle import same

from notewarden.llm import queries


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_oracle(spark, name):
    assert same(spark, queries.queries()[name], queries.oracle_sql()[name]) > 0
