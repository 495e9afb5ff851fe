"""Vector search against all pairs, and the recall of the index."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from docflow.checks import retrieval as checks
from docflow.operators import retrieval

SF = "/root/testdata/sf0.01"
SCHEMA = "id long, e array<float>, query string, score string"


def brute(queries, corpus, k, among_self=False):
    def unit(v):
        n = math.sqrt(sum(x * x for x in v)) if v and all(x is not None and math.isfinite(x) for x in v) else 0
        return [x / n for x in v] if n else None

    width = 4
    usable = [(i, u) for i, v in corpus if i is not None and v is not None and len(v) == width and (u := unit(v))]
    out = []
    for q, v in queries:
        if q is None or v is None or len(v) != width or not (u := unit(v)):
            continue
        found = sorted((-round(sum(a * b for a, b in zip(u, w)), 9), i) for i, w in usable if among_self or i != q)[:k]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(found, 1)]
    return sorted(out)


def made(n=90):
    """Few directions, so that many similarities tie; odd vectors among them."""
    rng = random.Random(1)
    rows = [(i, [float(rng.choice([-1, 0, 1, 2])) for _ in range(4)]) for i in range(n)]
    return rows + [(200, None), (201, []), (202, [0.0] * 4), (203, [1.0, 2.0]), (204, [math.nan, 1.0, 1.0, 1.0]), (205, [math.inf, 0.0, 0.0, 1.0]), (None, [1.0] * 4),
                   (206, [1.0, None, 1.0, 1.0]), (7, [3.0, 1.0, 0.0, 0.0])]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "a", "b") for i, v in rows], SCHEMA)


@pytest.mark.parametrize("query_rows, corpus_rows", [(16_384, 1_000_000), (10, 25), (1, 1000), (1000, 3)])
@pytest.mark.parametrize("among_self", [False, True])
def test_exact_is_all_pairs(spark, query_rows, corpus_rows, among_self):
    rows = made()
    asked = [r for r in rows if r[0] is None or r[0] % 3 == 0 or r[0] > 199]
    found = retrieval.exact_topk(frame(spark, asked), frame(spark, rows), "id", "e", 5, among_self, query_rows, corpus_rows)
    assert found.columns == ["query", "rank", "key", "score"]
    assert sorted((*r[:3], round(r[3], 9)) for r in map(tuple, found.collect())) == brute(asked, rows, 5, among_self)


def test_fewer_rows_than_neighbours_and_empty_sides(spark):
    two, none = frame(spark, made()[:2]), frame(spark, [])
    assert retrieval.exact_topk(two, two, "id", "e", 5).count() == 2
    assert retrieval.exact_topk(none, two, "id", "e", 5).count() == 0 and retrieval.exact_topk(two, none, "id", "e", 5).count() == 0
    assert retrieval.train(none, "id", "e") is None


@pytest.mark.parametrize("part_rows", [200_000, 7])
def test_index_finds_nine_of_ten(spark, monkeypatch, part_rows):
    if part_rows < 100:
        real = retrieval.index_topk
        monkeypatch.setattr(retrieval, "index_topk", lambda *a, **b: real(*a, **b, part_rows=part_rows))
    exact, found = checks.vector_topk(spark, SF), checks.vector_index_topk(spark, SF).cache()
    assert found.count() == exact.count() and retrieval.recall(found, exact) >= 0.9
    same = found.join(exact.select("query", "key", F.col("score").alias("s")), ["query", "key"])
    assert same.filter(F.abs(F.col("score") - F.col("s")) > 2e-9).count() == 0


def test_index_of_all_cells_and_candidates_is_exact(spark):
    own = made()[:-1]  # without the key that two rows have
    rows = frame(spark, own)
    quantizer = retrieval.train(rows, "id", "e", cells=6, parts=2)
    indexed = retrieval.index(rows, "id", "e", quantizer)
    assert indexed.count() == retrieval.usable(rows, "id", "e", 4).count()
    found = retrieval.index_topk(rows, rows, indexed, quantizer, "id", "e", 4, probes=6, again=100, part_rows=10)
    assert sorted((q, r, i, round(s, 9)) for q, r, i, s in map(tuple, found.collect())) == brute(own, own, 4)


def test_a_sample_is_enough_to_index_every_row(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet")
    quantizer = retrieval.train(rows, "vec_id", "embedding", cells=10, sample=100)
    assert len(quantizer.cells) == 10 and retrieval.index(rows, "vec_id", "embedding", quantizer).count() == rows.count()


def test_empty_clusters_are_filled():
    import numpy as np

    x = np.array([[1.0, 0]] * 50 + [[0.0, 1]] + [[0.5, 0.5]])
    assert len(np.unique(retrieval.centres(x, 3), axis=0)) == 3


def test_scores_held_at_once_are_bounded(monkeypatch, spark):
    """A stripe of all queries met a block of the corpus in one matrix before."""
    real, seen = retrieval.Best.add, spark.sparkContext.accumulator(0)

    def add(self, scores, keys):
        seen.add(int(scores.size > 8 * 16))
        return real(self, scores, keys)

    monkeypatch.setattr(retrieval.Best, "add", add)
    monkeypatch.setattr(retrieval, "QUERY_BLOCK", 8, raising=False)
    monkeypatch.setattr(retrieval, "KEY_BLOCK", 16, raising=False)
    rows = made()[:-1]  # without the key that two rows have
    found = retrieval.exact_topk(frame(spark, rows), frame(spark, rows), "id", "e", 5)
    assert sorted((*r[:3], round(r[3], 9)) for r in map(tuple, found.collect())) == brute(rows, rows, 5) and seen.value == 0


def test_a_query_leaves_bounded_candidates_however_many_cells_it_probes(spark, monkeypatch):
    """Each cell left its best of each query before, all of which were shuffled and ordered."""
    seen, real = spark.sparkContext.accumulator(0), retrieval.Best.rows

    def rows_of(self, queries):
        out = real(self, queries)
        seen.add(out.num_rows)
        return out

    monkeypatch.setattr(retrieval.Best, "rows", rows_of)
    rows = spark.read.parquet(f"{SF}/embeddings.parquet")
    quantizer = retrieval.train(rows, "vec_id", "embedding", cells=40, parts=32)
    indexed = retrieval.index(rows, "vec_id", "embedding", quantizer)
    asked = rows.filter("vec_id % 20 = 0")
    assert retrieval.index_topk(asked, rows, indexed, quantizer, "vec_id", "embedding", 3, probes=40, again=6).count() == 3 * asked.count()
    assert seen.value <= asked.count() * 6 * spark.sparkContext.defaultParallelism
