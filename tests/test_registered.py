"""Every registered query beside its SQL, on the smallest of the given data."""

import re
from pathlib import Path

import pytest

import __spark_entry__ as entry
from docflow.checks.compare import differences

SF = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="the given tables are not here")


# plans that do not hold at scale: all pairs, row-at-a-time Python (and, below, windows over a whole table)
BARRED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


def inspect(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [b for b in BARRED if b in plan]
    for first in re.findall(r"windowspecdefinition\(([^,]*),", plan):
        assert not re.search(r" (ASC|DESC)\b", first), f"a window over the whole table, by {first}"


@pytest.mark.parametrize("name", sorted(q for q in QUERIES if not re.match(r"op\d+_|pipeline$", q) or q in SQL))
def test_query(spark, name):
    n, problem = differences(spark, QUERIES[name], SQL.get(name), SF, inspect)
    assert problem is None and n > 0


def test_names():
    assert set(SQL) <= set(QUERIES)
    text_operators = re.compile(r"op\d+_|pipeline$")  # they have tests of their own where SQL cannot say them
    assert [q for q in set(QUERIES) - set(SQL) if not text_operators.match(q)] == ["vector_index_topk"]  # its recall is tested


def test_entry(spark):
    assert entry.entry(spark).count() == 3
