"""Plans of the operators that SQL cannot say; the others' are inspected beside their SQL."""

from __future__ import annotations

import pytest

from docflow.llm import oracles, queries
from tests.test_registered import inspect


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(oracles.ORACLE)))
def test_plan(spark, name):
    inspect(queries.QUERIES[name](spark, "/root/testdata/sf0.001"))
