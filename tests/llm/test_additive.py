"""The additive model: accuracy on rows held out, tables summed by hand, odd rows."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from docflow.llm import additive, queries

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    found = queries.op11_additive_quality(spark, SF)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"] and found.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    rows = found.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").filter("held_out").select("quality", "predicted", "score").collect()
    poor, good = ([r for r in rows if r["quality"] == q] for q in (0, 1))
    assert len(rows) > 50 and sum(r["predicted"] for r in good) >= 0.97 * len(good)
    assert sum(1 - r["predicted"] for r in poor) >= 0.85 * len(poor)
    wins = sum((g["score"] > p["score"]) + (g["score"] == p["score"]) / 2 for g in good for p in poor)
    assert wins / len(good) / len(poor) > 0.97


def test_pairs_explain_what_single_numbers_cannot():
    """Label 1 where two numbers lie on the same side: no table of one number tells, a pair's does."""
    rng = np.random.default_rng(1)
    x = rng.random((4000, 4))
    y = ((x[:, 0] > 0.5) == (x[:, 2] > 0.5)).astype(float)
    new = rng.random((2000, 4))
    truth = (new[:, 0] > 0.5) == (new[:, 2] > 0.5)
    model = additive.Model.fit(x, y)
    assert model.grids[0][:2] == (0, 2) and ((model.scores(new) > 0.5) == truth).mean() > 0.93
    alone = additive.Model.fit(x, y, additive.Settings(pairs=0))
    assert ((alone.scores(new) > 0.5) == truth).mean() < 0.65


def test_scores_are_sums_of_table_entries():
    rng = np.random.default_rng(2)
    x = rng.random((300, 3))
    model = additive.Model.fit(x, (x[:, 0] + x[:, 1] * x[:, 2] > 0.8).astype(float))
    for row, found in zip(x[:40], model.scores(x[:40])):
        bins = [sum(v >= e for e in edges) for v, edges in zip(row, model.edges)]
        z = model.start + sum(t[b] for t, b in zip(model.tables, bins))
        z += sum(g[model.coarse[i][bins[i]], model.coarse[j][bins[j]]] for i, j, g in model.grids)
        assert math.isclose(found, 1 / (1 + math.exp(-z)), rel_tol=1e-9)


def test_best_cut_of_a_grid():
    rng = np.random.default_rng(3)
    g, h, s = rng.normal(size=(5, 4)), rng.random((5, 4)) + 0.1, additive.Settings()
    gain = lambda a, b: a.sum() ** 2 / (b.sum() + s.shrinkage)
    parts = lambda a, i, j: (a[:i, :j], a[i:, :j], a[:i, j:], a[i:, j:])
    by_hand = max(sum(map(gain, parts(g, i, j), parts(h, i, j))) - gain(g, h) for i in range(1, 5) for j in range(1, 4))
    won, values = additive.quarters(g, h, s)
    assert math.isclose(won, by_hand) and len(np.unique(values)) == 4
    tree = additive.shallow_tree(np.array([1.0, 1, -5, -5, 3]), np.ones(5), s)
    assert tree[0] == tree[1] and tree[2] == tree[3] and len(np.unique(tree)) == 3


ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "漢字 ÉTÉ"), (5, "word " * 200_000), (5, "word " * 200_000), (None, "a\x00b"), (6, "A sound line of words.")]
SCHEMA = "doc_id long, text string, described string, score string, same int, y string"


def frame(spark, rows):
    return spark.createDataFrame([(k, t, "a", "b", 3, "c") for k, t in rows], SCHEMA)


def test_odd_rows(spark):
    df = frame(spark, ODD)
    seen = additive.describe(df)
    assert seen.columns == df.columns and seen.filter("size(described) <> 14").count() == 0
    for model in (additive.Model.fit(np.zeros((0, 14)), np.zeros(0)), additive.Model.fit(np.ones((3, 14)), np.ones(3))):
        found = additive.score(seen, model).select("doc_id", "score").collect()
        assert len(found) == len(ODD) and all(0 <= r["score"] <= 1 for r in found) and len({r["score"] for r in found}) == 1
    assert additive.score(additive.describe(df.limit(0)), additive.Model()).count() == 0


@pytest.mark.parametrize("partitions", [1, 7])
def test_model_does_not_depend_on_the_dealing(spark, partitions):
    rng = random.Random(5)
    texts = ["".join(rng.choices("abc DE.,!#\n", k=rng.randint(5, 80))) for _ in range(200)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(900 + k, texts[0]) for k in range(50)]
    df = additive.describe(frame(spark, rows).select("doc_id", "text").repartition(partitions))
    df = df.withColumns({"h": F.xxhash64("text"), "quality": F.when(F.length("text") > 40, 1).when(F.col("doc_id") % 7 == 0, None).otherwise(0)})
    model = additive.fit(df, "described", "quality", "h", max_rows=120)
    again = additive.fit(df.repartition(5), "described", "quality", "h", max_rows=120)
    assert model.start == again.start and all((a == b).all() for a, b in zip(model.tables, again.tables))


def test_copies_count_once_and_the_bound_holds(spark, monkeypatch):
    drawn = []
    monkeypatch.setattr(additive.Model, "fit", classmethod(lambda cls, x, y, s: drawn.append(len(y))))
    df = spark.range(3000).select((F.col("id") % 600).alias("h"), F.array(*[F.lit(0.0).cast("float")] * 14).alias("x"), (F.col("id") % 2).alias("y"))
    additive.fit(df, "x", "y", "h")
    additive.fit(df, "x", "y", "h", max_rows=200)
    assert drawn[0] == 600 and 150 < drawn[1] < 250
