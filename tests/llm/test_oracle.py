"""Registered text queries against their SQL."""

import pytest
from compare import connect, differences

from starmart.llm.oracle import ORACLE
from starmart.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLE[name]) == []
