"""Queries of this subpackage that SQL can express, against their SQL on the smallest tables."""

from __future__ import annotations

import pytest

from orderflume.llm.queries import ORACLE_SQL, QUERIES
from tests.compare import difference, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_query(spark, name):
    ours = QUERIES[name](spark, SF).toPandas()
    assert difference(ours, duck(SF).execute(ORACLE_SQL[name]).df()) is None
