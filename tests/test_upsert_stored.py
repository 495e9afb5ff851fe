"""Upserts of written tables: what is shuffled, and that it changes nothing."""

import re

import pytest

from docflow.operators.upsert import latest_fields, latest_stored, read_table, upsert_table
from docflow.session import write_once

SCHEMA = "id string, part long, n long, a string, v array<float>"


def rows():
    lone = [(f"k{k}", k % 3, 0, None if k % 5 == 0 else f"a{k}", [float(k)]) for k in range(40)]
    twice = [("k1", 1, 1, "later", None), ("k1", 1, 0, "a1", [1.0]), ("k2", 2, 0, "tie", [7.0]), (None, 1, 0, "x", None), (None, 1, 2, None, [2.0])]
    return lone + twice + [(None, None, 0, "lone", [3.0]), ("k3", None, 0, "other", None)]


def whole(df):
    return sorted(map(repr, df.select("id", "part", "a", "v").collect()))


@pytest.mark.parametrize("most", [0, 2, 100])
def test_latest_stored_equals_latest(spark, most):
    """Keys that are null, repeated or both; with ties; where few hashes may be sent, where none may."""
    changes = write_once(spark.createDataFrame(rows(), SCHEMA).repartition(3))
    assert whole(latest_stored(changes, ["id", "part"], "n", most=most)) == whole(latest_fields(changes, ["id", "part"], "n"))


def test_rows_of_lone_keys_are_not_shuffled(spark, tmp_path):
    """No exchange but that of repeated keys; without repeated keys none at all."""
    changes = write_once(spark.createDataFrame(rows(), SCHEMA))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    exchanges = lambda df: len(re.findall(r"Exchange hashpartitioning", plan(df)))
    assert "LeftAnti" in plan(latest_stored(changes, ["id", "part"], "n")) and exchanges(latest_stored(changes, ["id", "part"], "n")) == 1
    lone = write_once(changes.filter("id > 'k30'").dropDuplicates(["id"]))
    assert exchanges(latest_stored(lone, ["id", "part"], "n")) == 0
    assert latest_stored(lone.limit(0), ["id", "part"], "n").count() == 0
    path = str(tmp_path / "index")
    upsert_table(spark, path, changes, ["id", "part"], "n", stored=True)
    upsert_table(spark, path, write_once(spark.createDataFrame([("k7", 1, 0, "new", None)], SCHEMA)), ["id", "part"], "n", stored=True)
    got = {(r["id"], r["part"]): (r["a"], r["v"]) for r in read_table(spark, path, ["id", "part"]).collect()}
    assert got["k7", 1] == ("new", [7.0]) and got["k1", 1] == ("later", [1.0]) and got[None, 1] == ("x", [2.0]) and len(got) == 43
