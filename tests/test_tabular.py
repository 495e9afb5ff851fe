import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from docflow.operators import automl as A
from docflow.operators import registry as R
from docflow.operators import split as S
from docflow.operators import sqlqa as Q
from docflow.checks.stub import FixedTextToSql
from docflow.operators import upsert as U
from docflow.plans import training
from docflow.session import fresh_path
from docflow.sources import files, jdbc


def test_upsert_equals_one_change_after_another(spark):
    rng = random.Random(3)
    fields = lambda: (rng.choice([None, "a", "b"]), rng.choice([None, 1, 2]))
    old = [(k, *fields()) for k in range(0, 60, 2)]
    # a third of all changes meet one key
    changes = [(7 if rng.random() < 0.35 else rng.randrange(60), *fields(), at) for at in range(500)]
    expected = {k: [x, y] for k, x, y in old}
    for k, x, y, _ in changes:
        row = expected.setdefault(k, [None, None])
        row[0], row[1] = x if x is not None else row[0], y if y is not None else row[1]
    o = spark.createDataFrame(old, "k int, x string, y int")
    n = spark.createDataFrame(changes, "k int, x string, y int, at int")
    new = U.latest_fields(n, ["k"], "at")
    assert {r["k"]: [r["x"], r["y"]] for r in U.upsert(o, new, ["k"]).collect()} == expected
    path = fresh_path(spark, "table")
    U.upsert_table(spark, path, o.withColumn("at", F.lit(-1)), ["k"], "at")
    for _ in range(2):
        U.upsert_table(spark, path, n, ["k"], "at", merge=1)
    assert {r["k"]: [r["x"], r["y"]] for r in U.read_table(spark, path, ["k"]).collect()} == expected
    U.compact_table(spark, path, ["k"])
    assert {r["k"]: [r["x"], r["y"]] for r in U.read_table(spark, path, ["k"]).collect()} == expected


def test_a_merge_leaves_stored_files_and_columns_alone(spark, tmp_path):
    path = str(tmp_path / "table")
    U.upsert_table(spark, path, spark.createDataFrame([(i, "t", "s", 0) for i in range(50)], "id int, text string, section string, at int"), ["id"], "at")
    before = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*") if p.is_file()}
    U.upsert_table(spark, path, spark.createDataFrame([(3, "new", 0)], "id int, section string, at int"), ["id"], "at")
    assert all(p.stat().st_mtime_ns == at for p, at in before.items())
    rows = {r["id"]: (r["text"], r["section"]) for r in U.read_table(spark, path, ["id"]).collect()}
    assert rows[3] == ("t", "new") and rows[4] == ("t", "s") and len(rows) == 50


def test_ties_follow_one_row(spark):
    rows = [(1, "x", "x", 0), (1, "y", "y", 0), (1, "z", None, 0)]
    for order in (rows, rows[::-1]):
        (r,) = U.latest_fields(spark.createDataFrame(order, "k int, a string, b string, at int"), ["k"], "at").collect()
        assert (r["a"], r["b"]) in {("x", "x"), ("y", "y"), ("z", "x"), ("z", "y")}
    assert len({tuple(U.latest_fields(spark.createDataFrame(o, "k int, a string, b string, at int"), ["k"], "at").first()) for o in (rows, rows[::-1])}) == 1


def test_fields_not_sent_stay(spark):
    o = spark.createDataFrame([(1, "a", 2)], "k int, x string, y int")
    n = spark.createDataFrame([(1, "b"), (2, "c")], "k int, x string")
    assert sorted(map(tuple, U.upsert(o, n, ["k"]).collect())) == [(1, "b", 2), (2, "c", None)]


def test_rows_without_a_key_have_a_side(spark):
    df = spark.range(100).select(F.when(F.col("id") % 4 != 0, F.col("id").cast("string")).alias("k"), "id")
    rows = S.split_exact(df, "k").collect()
    assert {r["split"] for r in rows if r["k"] is None} == {"train"} and sum(r["k"] is None for r in rows) == 25
    assert sum(r["split"] == "test" for r in rows) == 8 and sum(r["split"] == "validation" for r in rows) == 7  # of the 75 with a key
    hashed = S.split_hash(df, "k").filter("k is null").select("split").distinct().collect()
    assert [r["split"] for r in hashed] == ["train"]
    assert S.split_exact(df.filter("k is null"), "k").filter("split <> 'train'").count() == 0


@pytest.mark.parametrize("n", [1, 7, 1000, 9001])
@pytest.mark.parametrize("nested", [True, False])
def test_split_sizes_and_order(spark, n, nested, monkeypatch):
    monkeypatch.setattr(S, "_FEW", 3)  # forces several rounds of narrowing
    df = spark.range(n).repartition(3)
    got = {r["id"]: r["split"] for r in S.split_exact(df, "id", nested=nested).collect()}
    ranked = sorted(range(n), key=lambda k: (hashlib.md5(f"42_{k}".encode()).hexdigest(), k))
    rest = math.ceil(n * (1 - 0.8))
    test = math.ceil(rest * 0.1) if nested else math.ceil(n * 0.1)
    expected = {k: "test" if i < test else "validation" if i < rest else "train" for i, k in enumerate(ranked)}
    assert got == expected


def test_split_needs_a_key(spark, monkeypatch):
    monkeypatch.setattr(S, "_FEW", 3)
    with pytest.raises(ValueError, match="unique"):
        S.split_exact(spark.createDataFrame([(1,)] * 50, "id bigint"), "id")
    with pytest.raises(ValueError, match="add up"):
        S.split_exact(spark.range(3), "id", train=0.9)


def test_split_is_stable_under_partitioning(spark):
    one = S.split_hash(spark.range(500).coalesce(1), "id")
    many = S.split_hash(spark.range(500).repartition(7), "id")
    assert one.exceptAll(many).count() == 0
    assert S.split_overlaps(one, "id").count() == 0


def test_manifest(spark):
    m = spark.createDataFrame([("n", [("./a.csv",), ("./b.csv",)], "t", "y")],
                              "name string, paths array<struct<file:string>>, transformations string, type string")
    row = files.rewrite_manifest(m, "./new.csv").collect()[0]
    assert ([p["file"] for p in row["paths"]], row["transformations"]) == (["./new.csv", "./b.csv"], "t")


def test_registry(spark):
    known = spark.createDataFrame([("a", "1", "t", "p")], "name string, version string, type string, path string")
    offered = spark.createDataFrame([("a", "1", "t", "q"), ("a", "2", "t", "q"), ("a", "2", "t", "r")], known.schema)
    assert [tuple(r) for r in R.new_assets(known, offered).collect()] == [("a", "2", "t", "q")]
    assert R.register_assets(known, offered).count() == 2
    models = spark.createDataFrame([("m", 3, "r", "u", "p", 0.1)], "name string, version bigint, run_id string, uri string, path string, r2 double")
    runs = spark.createDataFrame([("m", "r9", "x", 0.5), ("z", "r1", "y", 0.2)], "name string, run_id string, path string, r2 double")
    new = R.register_models(models, runs)
    assert sorted((r["name"], r["version"], r["uri"]) for r in new.collect()) == [
        ("m", 4, "runs:/r9/outputs/mlflow-model"), ("z", 1, "runs:/r1/outputs/mlflow-model"),
    ]
    assert {r["version"] for r in R.latest_models(models.unionByName(new)).collect()} == {4, 1}


def test_guard(spark):
    cases = {
        "select 1": None, "SELECT 'a;b; drop' AS x;": None, "with a as (select 1) select * from a": None,
        "select `update`, \"drop\" from t -- delete": None, "with a as (select 1 /* ' */) insert into t select * from a /* ' */": "changes data",
        "drop table x": "not one read-only statement", "select 1; select 2": "not one read-only statement", "": "not one read-only statement",
        "with a as (select 1) insert into t select * from a": "changes data", "explain select 1": "not one read-only statement",
    }
    rows = spark.createDataFrame([(c,) for c in cases], "s string").select("s", Q.guard(F.col("s")).alias("g")).collect()
    assert {r["s"]: r["g"] for r in rows} == cases
    assert {c for c in cases if Q.refusal(spark, c, frozenset({"t"})) is None} == {c for c, why in cases.items() if why is None}


ALLOWED = (
    "select id, upper(cast(id as string)) from numbers where id in (select id from numbers n where n.id > 3)",
    "with a as (select id from numbers), b as (select * from a) select count(*), sum(id) over () from b group by id having count(*) > 0",
    "select x from numbers lateral view explode(array(id, id + 1)) t as x", "select * from range(3)", "select * from numbers order by id limit 3",
    "select transform(array(id), y -> y + 1) from NUMBERS union all select array(1)", "values (1), (2)", "select (select max(id) from numbers)",
    "select * from numbers pivot (count(*) for id in (1, 2))", "select * from numbers n join lateral (select n.id + 1 as z)",
)
REFUSED = (
    "select java_method('java.lang.System', 'getProperty', 'user.home')", "select reflect('java.util.UUID', 'randomUUID')",
    "select id from numbers where id > length(try_reflect('java.util.UUID', 'randomUUID'))", "select * from text.`/etc/hostname`",
    "select * from parquet.`/tmp/x`", "with a as (select * from csv.`/etc/passwd`) select * from a", "select (select max(value) from text.`/etc/hostname`)",
    "select * from other", "select * from default.numbers", "select input_file_name() from numbers", "select current_user()", "select unknown_function(1)",
    "select * from numbers where exists (select 1 from text.`/etc/hostname`)", "select transform(id) using 'cat' as (x) from numbers",
    "select * from read_files('/etc')", "select max(reflect('java.util.UUID', 'randomUUID')) over () from numbers", "show tables", "describe numbers",
    "select transform(array(1), y -> java_method('java.lang.System', 'getProperty', 'user.home'))", "with a as (select 1) select * from b", "set x = 1",
    "select * from numbers lateral view explode(array(version())) t as x", "insert into numbers select 1", "select id from a.b.c",
)


def test_plans_decide_what_runs(spark):
    spark.range(30).createOrReplaceTempView("numbers")
    assert {s: Q.refusal(spark, s) for s in ALLOWED if Q.refusal(spark, s) is not None} == {}
    assert [s for s in REFUSED if Q.refusal(spark, s) is None] == []
    assert Q.refusal(spark, "select * from other", frozenset({"OTHER"})) is None
    assert Q.refusal(spark, "select version()", functions=frozenset({"version"})) is None
    for s in ALLOWED:
        spark.sql(s).collect()  # what is allowed also runs


def test_equal_statements_run_once(spark, tmp_path):
    spark.range(30).createOrReplaceTempView("numbers")
    known = {"a": "select id from numbers where id < 5", "b": "SELECT  n.id FROM numbers AS n WHERE n.id < 5 ;", "c": "select id as other from numbers where id < 5"}
    asked = spark.createDataFrame([(q,) for q in known], "question string")
    done, answers = Q.answer_questions(spark, asked, FixedTextToSql(known), str(tmp_path / "answers"))
    assert {r["question"]: (r["n_rows"], r["error"]) for r in done.collect()} == {q: (5, None) for q in known}
    assert {r["question"]: r["count"] for r in answers.groupBy("question").count().collect()} == {q: 5 for q in known}
    assert {r["row_json"] for r in answers.filter("question = 'c'").collect()} == {f'{{"other":{i}}}' for i in range(5)}
    assert len([p for p in (tmp_path / "answers").iterdir() if p.name.startswith("statement=")]) == 2


def test_answers_keep_errors(spark):
    spark.range(30).createOrReplaceTempView("numbers")
    known = {
        "all": "select id from numbers order by id", "bad": "select nothing from numbers", "zero": "select 1 / (id - id) as x from numbers",
        "drop": "drop view numbers",
    }
    asked = spark.createDataFrame([(q,) for q in [*known, "unknown"]], "question string")
    done, answers = Q.answer_questions(spark, asked, FixedTextToSql(known), fresh_path(spark, "answers"))
    out = {r["question"]: r for r in done.collect()}
    rows = answers.filter("question = 'all'").orderBy("position").collect()
    assert [r["row_json"] for r in rows] == [f'{{"id":{i}}}' for i in range(30)] and out["all"]["n_rows"] == 30
    assert [s["action"] for s in out["all"]["steps"]] == ["write_sql", "check", "run"]
    assert out["bad"]["error"] and out["zero"]["error"] and out["unknown"]["error"].startswith("KeyError")
    assert out["drop"]["error"] == "changes data" and spark.table("numbers").count() == 30


def test_context(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, s string")
    rows = [tuple(r) for r in Q.table_context(df, "t").collect()]
    assert rows == [("t", "k", "int", 2, 0, "1", "2", 2), ("t", "s", "string", 2, 1, "a", "a", 1)]


def test_trials(spark):
    kind = F.when(F.col("id") % 3 == 0, "big").otherwise("small")
    df = spark.range(400).select(
        "id", (F.col("id") % 50).cast("double").alias("x"), kind.alias("kind"), F.lit(1).alias("constant"),
        F.when(F.col("id") % 11 != 0, F.col("id") % 7).cast("double").alias("gaps"),
    ).withColumn("price", F.col("x") * 3 + F.when(F.col("kind") == "big", 40.0).otherwise(0.0))
    assert A.choose_columns(A.column_profile(df.drop("id")), "price") == (["x", "gaps"], ["kind"], [])
    prepared = training.prepare(df, "id")
    trials, best = training.train(prepared, "price", ["id"])
    assert [t.status for t in trials] == ["finished"] * 5 and best.name == "linear" and best.r2 > 0.99
    empty = spark.createDataFrame([], "name string, version bigint, run_id string, uri string, path string, r2 double")
    registry = training.register(empty, "m", best, "run", fresh_path(spark, "model"))
    scored = training.score(registry, "m", prepared.filter("split = 'test'"), ["id", "price"])
    assert scored.filter(F.abs(F.col("prediction") - F.col("price")) > 2).count() == 0
    path = fresh_path(spark, "predictions")
    for _ in range(2):
        files.append_predictions(scored, path)
    assert spark.read.option("header", True).csv(path).count() == 2 * scored.count()
    with pytest.raises(ValueError, match="registered"):
        training.score(registry, "other", df, ["id"])


def test_trials_stop_in_time(spark):
    df = spark.range(50).select(F.col("id").cast("double").alias("x"), (F.col("id") * 2).cast("double").alias("price"))
    trials = A.run_trials(df, df, "price", timeout_seconds=-1)
    assert {t.status for t in trials} == {"skipped"}
    with pytest.raises(RuntimeError, match="skipped"):
        A.best_trial(trials)


def test_jdbc_options():
    """No database is started for tests: what would be sent is looked at instead."""
    query = jdbc.non_blank_query("dbo.Reviews", "Review Comments", top=20)
    assert query == "(SELECT TOP 20 * FROM dbo.Reviews WHERE LEN([Review Comments]) > 0) AS source_rows"
    options = jdbc.read_options("jdbc:x", query, "id", (1, 100), 16)
    assert (options["numPartitions"], options["upperBound"], options["dbtable"]) == ("16", "100", query)
    with pytest.raises(ValueError):
        jdbc.read_options("jdbc:x", query, "id")


def test_delimited(spark):
    path = fresh_path(spark, "csv")
    rows = [("d", "h", "x|y", 'said "no"\nand left'), ("d", "h", "", None)]
    schema = "review_date string, hotel string, highlights string, comments string"
    files.write_delimited(spark.createDataFrame(rows, schema), path)
    back = files.read_delimited(spark, path, schema, multi_line=True).collect()
    assert sorted(r["highlights"] or "" for r in back) == ["", "x|y"]
    assert {r["comments"] for r in back} == {'said "no"\nand left', None}


def test_payloads(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(bytes(range(256)))
    row = files.read_payloads(spark, str(tmp_path)).collect()[0]
    import base64

    assert row["url"] == "data:image/png;base64," + base64.b64encode(bytes(range(256))).decode()


def test_run_ids_of_files(spark, tmp_path):
    (tmp_path / "MLmodel").write_text("a: b\nrun_id: x1\nflavor: y\n  run_id: x2 : z\nend: 1\n")
    assert [r["run_id"] for r in R.read_run_ids(spark, str(tmp_path)).collect()] == ["x2"]
