"""Target means without leakage, and trials that go on from their table."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from docflow.operators import automl as A
from docflow.operators import encoding as E
from docflow.session import fresh_path


def test_means_of_the_other_folds(spark):
    rng = random.Random(1)
    rows = [(f"k{i}", rng.choice(["hot", "hot", "hot", "a", "b", "", None, f"own{i}"]), rng.choice([None, *map(float, range(9))]), 5) for i in range(300)]
    df = spark.createDataFrame(rows, "key string, c string, y double, _n int").drop("_n")
    fold = lambda k: int(hashlib.md5(f"42_{k}".encode()).hexdigest()[:8], 16) % 5
    sums = E.target_sums(df, ["c"], "y", "key")
    found = {r["key"]: r["c__mean"] for r in E.encode(df, sums, ["c"], "key", learnt=True).collect()}
    for key, c, _, _ in rows:
        others = [(v, y) for k, v, y, _ in rows if y is not None and fold(k) != fold(key)]
        mean, mine = sum(y for _, y in others) / len(others), [y for v, y in others if v == c]
        assert abs(found[key] - (sum(mine) + 10 * mean) / (len(mine) + 10)) < 1e-9
    fresh = spark.createDataFrame([("n1", "hot"), ("n2", "never seen"), ("n3", None)], "key string, c string")
    new = {r["key"]: r["c__mean"] for r in E.encode(fresh, sums, ["c"], "key", learnt=False).collect()}
    every = [y for _, _, y, _ in rows if y is not None]
    hot, none = ([y for _, v, y, _ in rows if y is not None and v == c] for c in ("hot", None))
    mean = sum(every) / len(every)
    assert abs(new["n1"] - (sum(hot) + 10 * mean) / (len(hot) + 10)) < 1e-9 and abs(new["n2"] - mean) < 1e-9
    assert abs(new["n3"] - (sum(none) + 10 * mean) / (len(none) + 10)) < 1e-9
    assert E.encode(df.limit(0), sums, ["c"], "key", learnt=True).count() == 0


def test_a_rows_own_target_does_not_reach_it(spark):
    rows = [(f"k{i}", f"v{i % 40}", float(i % 17)) for i in range(200)]
    schema = "key string, c string, y double"

    def means(given):
        df = spark.createDataFrame(given, schema)
        return {r["key"]: r["c__mean"] for r in E.encode(df, E.target_sums(df, ["c"], "y", "key"), ["c"], "key", learnt=True).collect()}

    changed = [(k, c, 1e6 if k == "k7" else y) for k, c, y in rows]
    assert means(rows)["k7"] == means(changed)["k7"]


def test_a_stopped_run_ends_with_the_same_choice(spark, tmp_path, monkeypatch):
    x = F.col("id") % 40
    df = spark.range(900).select("id", x.cast("double").alias("x"), ((x - 20) * (x - 20) + F.col("id") % 3).cast("double").alias("y"))
    train, check = df.filter("id % 5 <> 0"), df.filter("id % 5 = 0").drop("id")
    whole, best = A.halving_trials(train, check, "y", "id", str(tmp_path / "whole"))
    assert sorted((r["rung"], r["status"]) for r in whole.collect()) == [(0, "finished")] * 5 + [(1, "finished")] * 2 + [(2, "finished")]
    rows = {r["rung"]: r["n_rows"] for r in whole.collect()}
    assert rows[0] < rows[1] < rows[2] == train.count() and "linear" not in best.name and best.r2 > 0.8

    fitted = []
    real = A.r2

    def stopping(df, target, *rest):
        fitted.append(1)
        if len(fitted) == 4:
            raise KeyboardInterrupt
        return real(df, target, *rest)

    monkeypatch.setattr(A, "r2", stopping)
    store = str(tmp_path / "stopped")
    with pytest.raises(KeyboardInterrupt):
        A.halving_trials(train, check, "y", "id", store)
    assert spark.read.parquet(store).count() == 3
    again, same = A.halving_trials(train, check, "y", "id", store)
    assert len(fitted) == 4 + 5 and again.count() == 8  # the three that were there are not fitted again
    assert same.name == best.name and abs(same.r2 - best.r2) < 1e-9
    assert A.r2 is stopping and {"prediction"} <= set(same.model.transform(check).columns)


def test_a_whole_table_of_trials_needs_no_fit(spark, tmp_path, monkeypatch):
    """With all trials there, the second call makes no features and loads the winner; a rung's candidates pass over its sample only."""
    x = F.col("id") % 40
    df = spark.range(900).select("id", x.cast("double").alias("x"), ((x - 20) * (x - 20) + F.col("id") % 3).cast("double").alias("y"))
    train, check, store = df.filter("id % 5 <> 0"), df.filter("id % 5 = 0").drop("id"), str(tmp_path / "trials")
    written, real = [], A.write_features
    monkeypatch.setattr(A, "write_features", lambda ready: written.append(real(ready)) or written[-1])
    trials, best = A.halving_trials(train, check, "y", "id", store)
    rows = {r["rung"]: r["n_rows"] for r in trials.collect()}
    assert [w.count() for w in written] == [rows[2], 180, rows[0], rows[1]]
    monkeypatch.setattr(A, "column_profile", None)
    again, same = A.halving_trials(train, check, "y", "id", store)
    assert again.count() == 8 and len(written) == 4 and (same.name, same.r2) == (best.name, best.r2)
    assert abs(A.r2(same.model.transform(check), "y").first()["r2"] - best.r2) < 1e-9


def test_a_task_of_a_fit_has_bounded_rows(spark, monkeypatch):
    """Features that are small on disk are many bytes in a fit, so rows are counted and not what a file takes."""
    parts = []

    class Seen:
        def fit(self, ready):
            parts.append(ready.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect())
            raise ValueError("seen")

    monkeypatch.setattr(A, "candidates", lambda *_: [("seen", Seen())])
    monkeypatch.setattr(A, "FILE_BYTES", 100 * 1032, raising=False)  # two numbers are a vector
    rows = spark.range(1000).select((F.col("id") % 7).alias("a"), (F.col("id") % 5).alias("b"), (F.col("id") * 1.0).alias("y"), "id")
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    assert A.run_trials(rows.drop("id"), rows.drop("id"), "y")[0].status == "failed: ValueError"
    with pytest.raises(RuntimeError):
        A.halving_trials(rows, rows, "y", "id", fresh_path(spark, "trials"))
    assert [sum(p) for p in parts] == [1000, 1000] and max(max(p) for p in parts) <= 100
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before


def test_hot_values_are_known_from_sums(spark, monkeypatch):
    """Means are the same whether values are spread or not, and only the others' rows and those of hot values meet copies."""
    rows = spark.range(400).select(F.col("id").cast("string").alias("key"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 != 0, (F.col("id") % 50).cast("string")).alias("c"), (F.col("id") % 11 * 1.0).alias("y"))
    sums = E.target_sums(rows, ["c"], "y", "key")
    means = lambda: {r["key"]: r["c__mean"] for r in E.encode(rows, sums, ["c"], "key", learnt=True).collect()}
    plain = means()
    monkeypatch.setattr(E, "HOT", 10)
    spread = means()
    assert plain.keys() == spread.keys() and len(plain) == 400 and all(abs(plain[k] - spread[k]) < 1e-9 for k in plain)
