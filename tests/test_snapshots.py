"""Tables of folders under a manifest: tiers, repeats, stops; and streams that lean on them."""

from __future__ import annotations

import random

import pytest
from pyspark.errors import PySparkRuntimeError
from pyspark.sql import functions as F

from docflow.checks.stub import StubClient
from docflow.operators import upsert as U
from docflow.sources import keyed as K
from docflow.sources import snapshots as S
from docflow.streaming.flows import read_answers, read_stream, stream_reviews


def test_tiers_leave_a_logarithmic_number_of_parts():
    rng = random.Random(1)
    for typical in (1 << 10, 1 << 22, 1 << 26):
        sizes: list[int] = []
        written = 0
        for _ in range(2000):
            sizes.append(rng.randint(typical // 2, typical * 2))
            for start, stop in reversed(S.to_fold(sizes)):
                written += sum(sizes[start:stop])
                sizes[start:stop] = [sum(sizes[start:stop])]
            levels = S.tier(sum(sizes)) + 1
            assert len(sizes) < S.FAN * levels
        if typical > S.BASE_BYTES:
            assert written < 8 * sum(sizes)  # each row again for each tier, not for each merge
    assert S.to_fold([10, 10, S.BASE_BYTES * 5]) == [(0, 3)] and S.to_fold([S.BASE_BYTES * 5, 10, 10]) == []


def test_many_merges_are_read_from_few_folders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "BASE_BYTES", 1 << 11)
    path, rng, expected = str(tmp_path / "t"), random.Random(2), {}
    for n in range(40):
        rows = [(rng.randrange(60), rng.choice([None, f"a{n}"]), rng.choice([None, n])) for _ in range(3)]
        rows = list({r[0]: r for r in rows}.values())
        for k, a, b in rows:
            old = expected.get(k, (None, None))
            expected[k] = (a if a is not None else old[0], b if b is not None else old[1])
        U.upsert_table(spark, path, spark.createDataFrame([(*r, 0) for r in rows], "k int, a string, b int, at int").coalesce(1), ["k"], "at")
    store = S.Store(spark, path)
    parts = store.load().parts
    assert S.ranges(parts) == [[0, 39]] and len(parts) <= 12
    assert {r["k"]: (r["a"], r["b"]) for r in U.read_table(spark, path, ["k"]).collect()} == expected
    folders = {p.name for p in (tmp_path / "t" / "data").iterdir() if p.is_dir()}
    assert len(folders) <= 2 * len(parts) + S.FAN  # what is folded goes, the last snapshot aside
    U.compact_table(spark, path, ["k"])
    assert len(store.load().parts) == 1 and {r["k"]: (r["a"], r["b"]) for r in U.read_table(spark, path, ["k"]).collect()} == expected


def merge(spark, path, rows, number=None):
    U.upsert_table(spark, path, spark.createDataFrame([(*r, 0) for r in rows], "k int, a string, at int").coalesce(1), ["k"], "at", merge=number)


def test_repeats_stops_and_other_writers(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    store = S.Store(spark, path)
    for n in range(3):
        merge(spark, path, [(n, f"v{n}")], n)
    merge(spark, path, [(2, "again")], 2)
    rows = lambda: {r["k"]: r["a"] for r in U.read_table(spark, path, ["k"]).collect()}
    assert rows() == {0: "v0", 1: "v1", 2: "again"}
    monkeypatch.setattr(S.Store, "commit", lambda *_: (_ for _ in ()).throw(OSError("stopped")))
    with pytest.raises(OSError):
        merge(spark, path, [(9, "lost")], 3)
    monkeypatch.undo()
    assert rows() == {0: "v0", 1: "v1", 2: "again"} and store.load().last_write() == 2
    for n in range(3, 6):
        merge(spark, path, [(n, f"v{n}")], n)
    folded = next(p for p in store.load().parts if p.holds(1))
    assert folded.writes != [[1, 1]]
    merge(spark, path, [(1, "too late")], 1)  # folded since: known
    assert rows()[1] == "v1"
    old = store.load()
    store.commit(old, old.parts)
    with pytest.raises(PySparkRuntimeError):
        store.commit(old, [])
    with pytest.raises(ValueError):
        U.read_table(spark, str(tmp_path / "none"), ["k"])


def test_streams_go_on_from_their_state(spark, tmp_path):
    """A query that is started again knows the keys that came before it, without what was answered; repeats in any batch are dropped."""
    source, output, checkpoint = (str(tmp_path / x) for x in ("in", "out", "check"))
    schema = "event_id long, comments string"

    def arrive(keys, into):
        spark.createDataFrame([(k, f"comment {k} {'x' * (k % 9)}") for k in keys], schema).coalesce(1).write.mode("append").parquet(source)
        rows = read_stream(spark, source, "*.parquet", spark.createDataFrame([], schema).schema, files_per_batch=1)
        stream_reviews(rows, "event_id", "comments", into, checkpoint, StubClient).awaitTermination()
        return sorted(r["event_id"] for r in read_answers(spark, into).collect())

    assert arrive([1, 2, 3, 3, 2], output) == [1, 2, 3]
    other = str(tmp_path / "elsewhere")  # nothing of the first answers is here
    assert arrive([3, 4, 1, 5], other) == [4, 5]
    assert (tmp_path / "check" / "state").exists()
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def keyed(spark, path, rows, buckets=4):
    df = spark.createDataFrame(rows, "k string, n int, text string").repartition(3)
    K.write_keyed(df, path, "k string, n int, text string", "k", buckets)


def test_replaced_rows_are_marked_and_stored_files_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    rng, expected = random.Random(3), {}
    read = lambda: sorted((r["k"] or "", r["n"], r["text"]) for r in K.read_keyed(spark, path, "k string, n int, text string").collect())
    assert read() == []
    before = {}
    for turn in range(3):
        keys = rng.sample([None, *map(str, range(30))], 31 if turn == 0 else 9)
        rows = [(k, n, f"{turn}-{n}") for k in keys for n in range(rng.randint(1, 4))]
        expected |= {k: [r for r in rows if r[0] == k] for k in keys}
        keyed(spark, path, rows)
        assert read() == sorted((k or "", n, t) for own in expected.values() for k, n, t in own)
        stored = {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "data").rglob("*") if p.is_file()}
        assert all(stored[p] == at for p, at in before.items())
        before = stored
    parts = S.Store(spark, path).load().parts
    assert len(parts) == 3 and len(parts[0].deletions) == 2 and parts[2].deletions == []
    keyed(spark, path, [])
    assert S.Store(spark, path).load().parts == parts
    keyed(spark, path, [("new", 1, "x")])  # the fourth of a tier: all are folded, and marked rows are gone for good
    (part,) = S.Store(spark, path).load().parts
    assert part.deletions == [] and part.writes == [[0, 3]]
    assert read() == sorted([("new", 1, "x")] + [(k or "", n, t) for own in expected.values() for k, n, t in own])
    assert spark.read.parquet(str(tmp_path / "t" / part.folder)).count() == len(read())


def test_many_rows_of_a_file_are_marked_block_by_block(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k string, n int, text string"
    rows = spark.range(100_000).selectExpr("cast(id % 10 as string) as k", "cast(id as int) as n", "'t' as text").coalesce(1)
    K.write_keyed(rows, path, schema, "k", 1)
    K.write_keyed(rows.filter("k = '3' and n < 500"), path, schema, "k", 1)
    K.write_keyed(rows.filter("k = '7' and n < 50"), path, schema, "k", 1)
    found = {r["k"]: r["count"] for r in K.read_keyed(spark, path, schema).groupBy("k").count().collect()}
    assert found == {str(k): 10_000 for k in range(10)} | {"3": 50, "7": 5}


def test_what_a_job_wrote_can_be_dropped(spark, tmp_path, monkeypatch):
    from docflow import session

    monkeypatch.setattr(session, "_test_dir", str(tmp_path))
    session.write_once(spark.range(3), "stage")
    spark.range(3).write.option("path", session.fresh_path(spark, "table")).saveAsTable("docflow_test_dropped")
    spark.range(3).write.option("path", str(tmp_path / "kept")).saveAsTable("docflow_test_kept")
    session.drop_written(spark)
    assert not list(tmp_path.glob("*/stage-*")) and not spark.catalog.tableExists("docflow_test_dropped")
    assert spark.table("docflow_test_kept").count() == 3
    spark.sql("DROP TABLE docflow_test_kept")


def test_state_has_as_many_parts_as_cores_can_use(spark, tmp_path):
    """Every batch opens every part: the session's number of shuffle partitions made most of the time of a batch."""
    source, checkpoint, name = str(tmp_path / "in"), tmp_path / "offsets", "spark.sql.shuffle.partitions"
    spark.range(20).select(F.col("id").alias("event_id"), F.lit("fine").alias("comments")).write.parquet(source)
    before = spark.conf.get(name)
    spark.conf.set(name, "40")
    try:
        rows = read_stream(spark, source, "*.parquet", "event_id long, comments string")
        stream_reviews(rows, "event_id", "comments", str(tmp_path / "out"), str(checkpoint), StubClient).awaitTermination()
        assert spark.conf.get(name) == "40"
    finally:
        spark.conf.set(name, before)
    parts = [p for p in (checkpoint / "state" / "0").iterdir() if p.name.isdigit()]
    assert 0 < len(parts) <= 2 * spark.sparkContext.defaultParallelism and read_answers(spark, str(tmp_path / "out")).count() == 20


def test_reading_merges_shuffles_no_hash(spark, tmp_path):
    """Keys are unique within a part, so the number of the merge alone ranks rows; a hash beside every field was shuffled before."""
    path = str(tmp_path / "table")
    rows = spark.range(60).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), F.lit("old").alias("x"), F.lit(0).alias("at"))
    U.upsert_table(spark, path, rows, ["k"], "at", merge=0)
    U.upsert_table(spark, path, rows.filter("k is null or k < 10").withColumn("x", F.when(F.col("k").isNull() | (F.col("k") < 5), "new")), ["k"], "at", merge=1)
    found = U._merged(U.Store(spark, path), U.Store(spark, path).load().parts, ["k"])
    assert sorted((r["k"] or 0, r["x"]) for r in found.collect()) == [(k, "new" if k < 5 else "old") for k in range(60)]
    parts = [U._written(U.Store(spark, path), rows.drop("at").withColumn("x", F.lit(v)), [[n, n]]) for n, v in enumerate("ab")]
    both = U._merged(U.Store(spark, path), parts, ["k"])
    assert {r["x"] for r in both.collect()} == {"b"} and "xxhash64" not in both._jdf.queryExecution().optimizedPlan().toString()
