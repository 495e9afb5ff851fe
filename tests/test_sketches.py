"""Sketches by file: error bounds, unions, files that are known, weighted samples."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from docflow.operators import sketches as K


def rows(spark, start, stop):
    return spark.range(start, stop).select(
        "id", (F.col("id") % 997).alias("v"), F.when(F.col("id") % 5 != 0, F.col("id") * 0.5).alias("x"), F.concat(F.lit("t"), F.sqrt(F.col("id")).cast("int").cast("string")).alias("text"),
        F.array("id").alias("list"), F.lit(None).cast("string").alias("nothing"),
    )


@pytest.fixture()
def store(spark, tmp_path):
    path, kept = str(tmp_path / "data"), str(tmp_path / "sketches")
    seen = []
    for start, stop in ((0, 30_000), (30_000, 60_000), (60_000, 100_000)):
        rows(spark, start, stop).repartition(3).write.mode("append").parquet(path)
        seen.append(K.update(spark, spark.read.parquet(path), kept))
    return path, kept, seen


def test_only_new_files_are_sketched_and_bounds_hold(spark, store):
    path, kept, seen = store
    assert seen == [3, 3, 3] and K.update(spark, spark.read.parquet(path), kept) == 0
    sketches = spark.read.schema(K.SCHEMA).parquet(kept)
    assert sketches.count() == 9 * 6
    found = {r["column_name"]: r for r in K.estimates(K.merged(sketches)).collect()}
    for name, exact in {"id": 100_000, "v": 997, "x": 80_000, "text": 317, "list": 100_000}.items():
        assert abs(found[name]["n_distinct"] - exact) <= 0.05 * exact + 1
    assert [abs(q - 100_000 * s) < 3000 for q, s in zip(found["id"]["quantiles"], (0.25, 0.5, 0.75))] == [True] * 3
    assert (found["x"]["n_nulls"], found["x"]["least"], found["id"]["greatest"], found["text"]["least"]) == (20_000, "0.5", "99999", "t0")
    assert found["nothing"]["n_nulls"] == 100_000 and found["nothing"]["samples"] is None and found["nothing"]["n_distinct"] == 0
    top = {r["item"]: r["count"] for r in found["text"]["frequent"]}
    assert set(top) <= {f"t{k}" for k in range(300, 317)} and all(v <= 700 for v in top.values())
    assert found["list"]["quantiles"] is None and all(s.startswith("[") for s in found["list"]["samples"])


def test_unions_give_what_one_pass_gives(spark, store):
    path, kept, _ = store
    whole = {r["column_name"]: r for r in K.table_sketch(spark.read.parquet(path), "t").collect()}
    parts = {r["column_name"]: r for r in K.estimates(K.merged(spark.read.schema(K.SCHEMA).parquet(kept))).collect()}
    for name in whole:
        assert (whole[name]["n_distinct"], whole[name]["samples"]) == (parts[name]["n_distinct"], parts[name]["samples"])


def test_samples_follow_weights_and_seed(spark, tmp_path):
    path = str(tmp_path / "w")
    spark.range(20_000).select("id").write.parquet(path)
    heavy = F.when(F.col("id") < 2000, 9.0).otherwise(1.0)

    def values(df):
        return {int(r["v"]) for r in df.select(F.explode("sample.value").alias("v")).collect()}

    def drawn(seed, w):
        return values(K.sketch_files(spark.read.parquet(path), {"id": "bigint"}, w, seed, 400))

    def whole(seed, w):
        text = F.col("id").cast("string")
        each = spark.read.parquet(path).select(F.lit(1).alias("k"), text.alias("value"), K.weighted_rank(text, w, seed).alias("rank"))
        return values(K.drawn_values(each, ["k"], 400))

    once = whole(7, heavy)
    picked = drawn(7, heavy)
    assert once <= picked  # the files' samples hold the table's
    assert 150 < sum(v < 2000 for v in once) < 250  # half of the weight lies there
    even = whole(7, F.lit(1.0))
    assert sum(v < 2000 for v in even) < 80 and even != whole(8, F.lit(1.0)) and even == whole(7, F.lit(1.0))


def test_empty_tables(spark, tmp_path):
    path = str(tmp_path / "none")
    spark.range(0).write.parquet(path)
    assert K.table_sketch(spark.read.parquet(path), "t").count() == 0


def test_few_values_are_left_to_draw_from(spark):
    """A column of many values was grouped and ordered whole to draw some."""
    each = spark.range(40_000).select(F.lit("f").alias("file"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("column_name"), (F.col("id") % 9000).cast("string").alias("value"))
    each = each.withColumn("rank", K.weighted_rank(F.col("value"), F.lit(1.0), 7))
    left = K.likely(each, ["file", "column_name"], 20)
    assert left.select("column_name", "value").distinct().count() < 800
    key = ["file", "column_name"]
    assert sorted(K.drawn_values(left, key, 20).collect()) == sorted(K.drawn_values(each, key, 20).collect())
    heavy = each.withColumn("rank", K.weighted_rank(F.col("value"), F.when(F.col("value") < "5", 1e6).otherwise(F.rand(3)), 7)).localCheckpoint()
    assert sorted(K.drawn_values(K.likely(heavy, key, 20), key, 20).collect()) == sorted(K.drawn_values(heavy, key, 20).collect())
    few = each.filter("value < '10'")
    assert sorted(K.drawn_values(K.likely(few, key, 20), key, 20).collect()) == sorted(K.drawn_values(few, key, 20).collect())
