"""Cells of tables are dealt once, by block of rows."""

import re

from docflow.operators.tables import table_html

SCHEMA = "doc string, row_index int, column_index int, kind string, column_span int, row_span int, content string"


def cells():
    out = [("a", r, c, "columnHeader" if r < 2 else None, 2 if c == 1 else None, 1, f"{r}<{c}") for r in range(7) for c in (2, 0, 1)]
    return out + [(None, 3, 0, None, None, 3, None), ("b", 0, 0, "rowHeader", 1, 1, "x"), ("b", None, 1, None, None, None, "nowhere")]


def test_cells_are_shuffled_once_and_not_sorted_before(spark):
    df = spark.createDataFrame(cells(), SCHEMA).repartition(3)
    for block in (1000, 2, 1):
        made = table_html(df, ["doc"], block=block)
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall("Exchange hashpartitioning", plan)) == 2  # cells by block, blocks by table
        # the tree is printed from the last step down: nothing is aggregated below the exchange of cells
        assert "Aggregate" not in plan[plan.rindex("Exchange hashpartitioning"):]
        html = {r["doc"]: r["html"] for r in made.collect()}
        head = "".join(f"<tr><th>{r}&lt;0</th><th colSpan=2>{r}&lt;1</th><th>{r}&lt;2</th></tr>" for r in range(2))
        body = "".join(f"<tr><td>{r}&lt;0</td><td colSpan=2>{r}&lt;1</td><td>{r}&lt;2</td></tr>" for r in range(2, 7))
        assert html["a"] == f"<table><thead>{head}</thead>{body}</table>"
        assert html[None] == "<table><tr><td rowSpan=3></td></tr></table>"
        assert set(html) == {"a", "b", None}
