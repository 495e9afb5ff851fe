"""Registered queries over tables: upsert, split, manifests, registries, questions, trials."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.checks.compare import TABLES
from docflow.checks.shapes import table
from docflow.checks.stub import FixedTextToSql
from docflow.operators import automl as A
from docflow.operators import encoding as E
from docflow.operators import registry as R
from docflow.operators import sketches as K
from docflow.operators import split as S
from docflow.operators import sqlqa as Q
from docflow.operators import upsert as U
from docflow.operators.skew import lookup, salt_of
from docflow.plans import training
from docflow.session import fresh_path, write_once
from docflow.sources import files

# ---------------------------------------------------------------- upsert


def chunk_upsert(spark, sf):
    """All but odd threes are there; keys divisible by three change one field, those by nine another one after that."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    none = F.lit(None).cast("string")
    first = orders.filter(F.col("o_orderkey") % 3 == 0).select(
        "o_orderkey", F.lit("X").alias("o_orderstatus"), none.alias("o_orderpriority"), "o_totalprice", F.lit(1).alias("sent")
    )
    second = orders.filter(F.col("o_orderkey") % 9 == 0).select(
        "o_orderkey", none.alias("o_orderstatus"), F.lit("NEW").alias("o_orderpriority"),
        F.lit(None).cast("double").alias("o_totalprice"), F.lit(2).alias("sent"),
    )
    new = U.latest_fields(first.unionByName(second), ["o_orderkey"], "sent")
    return U.upsert(orders.filter((F.col("o_orderkey") % 2 == 0) | (F.col("o_orderkey") % 3 != 0)), new, ["o_orderkey"])


def chunk_upsert_table(spark, sf):
    """The same merge into a stored table, sent twice: the second time changes nothing."""
    path = fresh_path(spark, "index")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", F.lit(0).alias("sent"))
    U.upsert_table(spark, path, orders.filter(F.col("o_orderkey") % 3 != 0), ["o_orderkey"], "sent")
    changes = orders.filter(F.col("o_orderkey") % 3 == 0).withColumn("o_orderstatus", F.lit("X"))
    for _ in range(2):
        U.upsert_table(spark, path, changes, ["o_orderkey"], "sent", merge=1)
    return U.read_table(spark, path, ["o_orderkey"])


def chunk_upsert_fields(spark, sf):
    """Each merge gives other columns, the second one two versions of a key; folded at the end."""
    path = fresh_path(spark, "index")
    orders = table(spark, sf, "orders").withColumn("sent", F.lit(0))
    U.upsert_table(spark, path, orders.select("o_orderkey", "o_orderstatus", "o_totalprice", "sent"), ["o_orderkey"], "sent")
    again = orders.filter(F.col("o_orderkey") % 2 == 0).select("o_orderkey", "o_orderpriority", "sent")
    later = again.select("o_orderkey", F.lit("LAST").alias("o_orderpriority"), F.lit(1).alias("sent")).filter(F.col("o_orderkey") % 4 == 0)
    U.upsert_table(spark, path, again.unionByName(later), ["o_orderkey"], "sent")
    U.compact_table(spark, path, ["o_orderkey"])
    return U.read_table(spark, path, ["o_orderkey"])


def _batches(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderpriority", "o_orderkey")
    return U.upload_batches(orders, ["o_orderpriority"], "o_orderkey")


def upload_batches(spark, sf):
    return _batches(spark, sf)


# ---------------------------------------------------------------- split


def _orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")


def split_exact(spark, sf):
    return S.split_exact(_orders(spark, sf), "o_orderkey", nested=True).select("o_orderkey", "split")


def split_exact_shares(spark, sf):
    return S.split_exact(_orders(spark, sf), "o_orderkey").select("o_orderkey", "split")


def split_hash(spark, sf):
    return S.split_hash(_orders(spark, sf), "o_orderkey").select("o_orderkey", "split")


def split_counts(spark, sf):
    prepared = S.split_exact(_orders(spark, sf), "o_orderkey", nested=True).transform(training.identity)
    return S.split_counts(prepared).withColumn("n_columns", F.col("n_columns").cast("bigint"))


def split_disjoint(spark, sf):
    """How many keys lie in more than one split, and how many in none."""
    orders = _orders(spark, sf)
    done = S.split_exact(orders, "o_orderkey", nested=True)
    shared = S.split_overlaps(done, "o_orderkey").agg(F.lit("shared").alias("what"), F.count("*").alias("n"))
    lost = orders.select("o_orderkey").exceptAll(done.select("o_orderkey")).agg(
        F.lit("lost").alias("what"), F.count("*").alias("n")
    )
    return shared.unionByName(lost)


def split_sink(spark, sf):
    path = fresh_path(spark, "splits")
    files.write_splits(S.split_exact(_orders(spark, sf), "o_orderkey", nested=True), path)
    return spark.read.schema("o_orderkey bigint, o_custkey bigint, o_totalprice double, split string").options(
        header=True
    ).csv(path)


def split_manifests(spark, sf):
    """Splits with a manifest beside the data of each, read again by way of the manifests."""
    path, given = fresh_path(spark, "splits"), fresh_path(spark, "given")
    paths = F.array(F.struct(F.lit("./orders.csv").alias("file")))
    spark.range(1).select(F.lit("orders").alias("name"), paths.alias("paths")).write.json(given)
    files.write_splits(S.split_exact(_orders(spark, sf), "o_orderkey", nested=True), path, files.read_manifest(spark, given))
    shape = "o_orderkey bigint, o_custkey bigint, o_totalprice double"
    return reduce(DataFrame.unionByName, [files.read_split(spark, path, s, shape).withColumn("split", F.lit(s)) for s in files.SPLITS])


def manifest_scan(spark, sf):
    """A table as CSV, found through its manifest."""
    base = fresh_path(spark, "training")
    orders = _orders(spark, sf)
    orders.write.option("header", True).csv(f"{base}/orders.csv")
    paths = F.array(F.struct(F.lit("./orders.csv").alias("file")))
    spark.range(1).select(F.lit("orders").alias("name"), paths.alias("paths")).write.json(f"{base}/manifest")
    manifest = files.read_manifest(spark, f"{base}/manifest")
    return files.read_manifest_data(spark, manifest, base, "o_orderkey bigint, o_custkey bigint, o_totalprice double")


def manifest_rewrite(spark, sf):
    """One manifest per part; its first path moves, all else stays."""
    key = F.col("p_partkey").cast("string")
    manifests = table(spark, sf, "part").select(
        "p_partkey", F.col("p_name").alias("name"),
        F.array(
            F.struct(F.concat(F.lit("./"), key, F.lit(".csv")).alias("file")), F.struct(F.lit("./more.csv").alias("file"))
        ).alias("paths"),
        F.lit("mltable").alias("type"),
    )
    moved = files.rewrite_manifest(manifests, F.concat(F.lit("./"), key, F.lit("_train.csv")))
    return moved.select("p_partkey", "name", F.array_join("paths.file", ",").alias("files"), "type")


# ---------------------------------------------------------------- registries


def asset_register_new(spark, sf):
    """Some assets are stored; all are offered, twice; what the stored registry then holds."""
    path = fresh_path(spark, "assets")
    offered = table(spark, sf, "part").select(
        F.col("p_name").alias("name"), F.col("p_size").cast("string").alias("version"), F.lit("table").alias("type"),
        F.concat(F.lit("part/"), F.col("p_partkey").cast("string")).alias("path"), "p_partkey",
    )
    R.store_assets(spark, path, offered.filter(F.col("p_partkey") % 4 == 0).withColumn("path", F.lit("known")).drop("p_partkey"))
    for _ in range(2):
        R.store_assets(spark, path, offered.drop("p_partkey"))
    return R.read_registry(spark, path)


def _registry(spark, sf):
    k = F.col("s_suppkey")
    return table(spark, sf, "supplier").select(
        F.concat(F.lit("model "), (k % 7).cast("string")).alias("name"),
        F.floor(k / 7 + 1).cast("bigint").alias("version"),
        F.concat(F.lit("run "), k.cast("string")).alias("run_id"),
        F.concat(F.lit("models/"), k.cast("string")).alias("path"),
    )


def model_register(spark, sf):
    k = F.col("p_partkey")
    runs = table(spark, sf, "part").select(
        F.concat(F.lit("model "), (k % 10).cast("string")).alias("name"),
        F.concat(F.lit("run p"), k.cast("string")).alias("run_id"),
        F.concat(F.lit("runs/"), k.cast("string")).alias("path"),
        F.col("p_retailprice").alias("r2"),
    )
    path = fresh_path(spark, "models")
    _registry(spark, sf).withColumns({"uri": R.model_uri(F.col("run_id")), "r2": F.lit(None).cast("double")}).write.parquet(path)
    R.store_models(spark, path, runs)
    return R.latest_models(R.read_registry(spark, path).filter("r2 is not null"))


def model_latest(spark, sf):
    return R.latest_models(_registry(spark, sf))


def run_id_extract(spark, sf):
    key = F.col("s_suppkey").cast("string")
    text = F.concat(
        F.lit("artifact_path: m\nrun_id: early\n"),
        F.when(F.col("s_suppkey") % 5 != 0, F.concat(F.lit("  run_id:  run-"), key, F.lit(" : x\n"))).otherwise(F.lit("")),
        F.lit("utc_time: 10:20\n"),
    )
    run = R.run_id(text)
    return table(spark, sf, "supplier").select("s_suppkey", run.alias("run_id"), R.model_uri(run).alias("uri"))


# ---------------------------------------------------------------- questions


def _exact_distinct(df: DataFrame) -> DataFrame:
    """Each column by itself: one aggregate of them all would copy every row for each column. Long texts are told apart by their digests."""
    def one(name: str, kind: str) -> DataFrame:
        c = F.col(f"`{name}`")
        value = F.struct(F.length(c), F.when(F.length(c) > 64, F.sha2(c, 256)).otherwise(c)) if kind == "string" else c
        return df.filter(c.isNotNull()).select(value.alias("v")).distinct().agg(F.lit(name).alias("column_name"), F.count("*").alias("exact"))

    return reduce(DataFrame.unionByName, [one(name, kind) for name, kind in df.dtypes])


def _close(found, exact):
    return F.abs(found - exact) <= F.greatest(F.lit(1.0), exact * 0.06)


def _ends() -> list:
    """Least and greatest value as text; doubles are written in more than one way, and are left to the tests."""
    return [F.when(F.col("column_type") != "double", F.col(c)).alias(c) for c in ("least", "greatest")]


def schema_context(spark, sf):
    """Every column of every table from one pass of sketches; distinct counts are held against exact ones, samples are counted."""
    def one(name: str) -> DataFrame:
        df = table(spark, sf, name)
        found = K.table_sketch(df, name).join(_exact_distinct(df), "column_name")
        return found.select(
            "table_name", "column_name", "column_type", "n_rows", "n_nulls", *_ends(), F.col("exact").alias("n_distinct"),
            _close(F.col("n_distinct"), F.col("exact")).alias("close"), F.coalesce(F.size("samples"), F.lit(0)).cast("bigint").alias("n_samples"),
        )

    return reduce(DataFrame.unionByName, [one(t) for t in TABLES])


def column_sketches(spark, sf):
    """Orders arrive in three parts; each time only the new files are sketched, and the union of all speaks for the table."""
    path, store = fresh_path(spark, "arriving"), fresh_path(spark, "sketches")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    files_seen = []
    for part in range(3):
        orders.filter(F.col("o_orderkey") % 3 == part).repartition(2).write.mode("append").parquet(path)
        files_seen.append(K.update(spark, spark.read.parquet(path), store))
    files_seen.append(K.update(spark, spark.read.parquet(path), store))
    found = K.estimates(K.merged(spark.read.schema(K.SCHEMA).parquet(store)), (0.5,)).join(_exact_distinct(orders), "column_name")
    median = {r["column_name"]: r["quantiles"][0] for r in found.filter("quantiles is not null").select("column_name", "quantiles").collect()}
    ranks = orders.agg(*[F.avg((F.col(c) <= v).cast("int")).alias(c) for c, v in median.items()])
    ranked = ranks.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("rank")) for c in median])).alias("r")).select("r.*")
    return found.join(ranked, "column_name", "left").select(
        "column_name", "n_rows", "n_nulls", *_ends(), F.col("exact").alias("n_distinct"), _close(F.col("n_distinct"), F.col("exact")).alias("close"),
        (F.abs(F.col("rank") - 0.5) < 0.03).alias("median_close"), F.when(F.col("exact") < 100, F.get("frequent", F.lit(0))["item"]).alias("most_frequent"),
        F.lit(",".join(map(str, files_seen))).alias("files"),
    )


STATEMENTS = (
    "SELECT p_name FROM part WHERE p_name = 'drop; table'",
    "DROP TABLE part",
    "  with a as (select 1 as x) select x from a ; ",
    "select 1; delete from part",
    "WITH a AS (SELECT 1) INSERT INTO part SELECT * FROM a",
    "select updated_at from part",
    "WITH a AS (SELECT 1 /* it's */) INSERT INTO part SELECT * FROM a /* ' */",
    'WITH a AS (SELECT "\'") INSERT INTO part SELECT * FROM a WHERE x = "\'"',
    "select `update` from t",
    'select "drop" as x',
    "select 1 -- drop it",
    "-- first\nselect 'it\\'s; -- here' from t",
    "select 'open",
    "select '{name}; drop table part' as x, p_size from part where p_name = '{name}'",
    "update part set p_name = '{name}'",
    "SELECT java_method('java.lang.System', 'getProperty', '{name}')",
    "select * from Text . `/data/{name}` where 1 = 1",
    "select 'java_method(1)' as x, reflected (p_size) from part -- {name}",
)
REFUSALS = (
    None, "not one read-only statement", None, "not one read-only statement", "changes data", None, "changes data", "changes data",
    None, None, None, None, "not one read-only statement", None, "not one read-only statement", "runs code", "reads files", None,
)


def sql_guard(spark, sf):
    choices = F.array(*[F.lit(s) for s in STATEMENTS])
    statement = F.replace(F.get(choices, (F.col("p_partkey") % len(STATEMENTS)).cast("int")), F.lit("{name}"), F.col("p_name"))
    return table(spark, sf, "part").select("p_partkey", Q.guard(statement).alias("refused"))


QUESTIONS = {
    "How many orders has each status?": (
        "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus ORDER BY o_orderstatus"
    ),
    "Which five customers have most orders?": (
        "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey ORDER BY n DESC, o_custkey LIMIT 5"
    ),
    "How many line items does each nation's suppliers ship?": (
        "WITH s AS (SELECT s_suppkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey) "
        "SELECT n_name, count(*) AS n FROM lineitem JOIN s ON l_suppkey = s_suppkey GROUP BY n_name ORDER BY n_name"
    ),
    "Remove all orders.": "DELETE FROM orders",
}


def _answered(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    for t in TABLES:
        table(spark, sf, t).createOrReplaceTempView(t)
    nation = table(spark, sf, "nation")
    context = Q.context_text(Q.table_context(nation, "nation"), Q.samples(nation, "nation"))
    asked = spark.createDataFrame([(q,) for q in QUESTIONS], "question string")
    return Q.answer_questions(spark, asked, FixedTextToSql(QUESTIONS), fresh_path(spark, "answers"), context)


def sql_answer(spark: SparkSession, sf: str) -> DataFrame:
    """Every row of every answer; a question without one has a null row and its error."""
    done, answers = _answered(spark, sf)
    return done.join(answers, "question", "left").select(
        "question", "sql", "row_json", "n_rows", F.size("steps").cast("bigint").alias("n_steps"), "error"
    )


# ---------------------------------------------------------------- trials


def _items(spark, sf):
    """Line items with their part, and a price that follows from quantity, size and brand; it is what is learnt."""
    line = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_returnflag")
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_name", "p_size")
    key = F.concat_ws("_", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    joined = lookup(line, part, ["l_partkey"], salt_of(F.col("l_orderkey"), F.col("l_linenumber")), "inner")
    price = F.col("l_quantity") * 3 + F.col("p_size") * 0.5 + F.length("p_brand") * 10 + F.when(F.col("l_returnflag") == "R", 25).otherwise(0)
    return joined.withColumns({"row_key": key, "price": price.cast("double")})



_DROP = ["row_key", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
_TARGET = "price"


def automl_trials(spark, sf):
    """Five trials on a target that bends: lines explain little of it, trees most."""
    trials, _ = training.train(_waves(spark, sf), _TARGET, _DROP)
    return A.trial_table(spark.range(1), trials).select("name", (F.col("r2") > 0.6).alias("learnt"), "status")


def _cells(spark, sf):
    """A noisy price that depends on flag and priority together: the best there is to say of a row is the mean of its cell."""
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority")
    line = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    met = lookup(line, orders, ["l_orderkey"], salt_of(F.col("l_linenumber")), "inner")
    key = F.concat_ws("_", "l_orderkey", "l_linenumber")
    noise = F.conv(F.substring(F.md5(key), 1, 4), 16, 10).cast("double") / 65536 * 30
    level = F.conv(F.substring(F.md5(F.concat("l_returnflag", "o_orderpriority")), 1, 2), 16, 10).cast("double")
    rows = met.select(key.alias("row_key"), "l_returnflag", "o_orderpriority", (level + noise).alias("price"))
    return write_once(S.split_hash(rows, "row_key"), "splits")


def automl_best_trial(spark, sf):
    """The best of all five trials, and how it does on rows that no trial has seen."""
    prepared = _cells(spark, sf)
    _, best = training.train(prepared, _TARGET, ["row_key"])
    test = A.r2(best.model.transform(prepared.filter("split = 'test'")), _TARGET)
    return test.select(F.lit("linear" in best.name).alias("linear"), F.round(F.lit(best.r2), 3).alias("r2"), F.round("r2", 3).alias("test_r2"), "n_rows")


def _scored(spark, sf):
    prepared = _cells(spark, sf)
    _, best = training.train(prepared, _TARGET, ["row_key"])
    registry = fresh_path(spark, "registry")
    training.register_stored(spark, registry, "price", best, "run-1", fresh_path(spark, "model"))
    test = prepared.filter("split = 'test'")
    return training.score(R.latest_models(R.read_registry(spark, registry)), "price", test, ["row_key", _TARGET])


def target_encode(spark, sf):
    """Parts and suppliers of line items by the mean price among the other folds; a third of the items have one supplier, some have none."""
    n = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    supplier = F.when(n % 3 == 0, 1).when(n % 7 != 1, F.col("l_suppkey"))
    items = table(spark, sf, "lineitem").select(
        F.concat_ws("_", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity").alias("key"), "l_partkey", supplier.alias("supplier"),
        F.when(n % 11 != 0, F.col("l_extendedprice")).alias("price"),
    )
    columns = ["l_partkey", "supplier"]
    sums = E.target_sums(items, columns, "price", "key")
    return E.encode(items, sums, columns, "key", learnt=True).select("key", *[F.round(f"{c}__mean", 3).alias(c) for c in columns])


def _waves(spark, sf):
    """A target that is no sum of its columns, with noise from a hash of the key."""
    flag = F.when((F.col("l_returnflag") == "R") & (F.col("l_discount") > 0.04), 60).otherwise(0)
    noise = F.conv(F.substring(F.md5("row_key"), 1, 4), 16, 10).cast("double") / 65536 * 20
    bent = (F.col("l_quantity") - 25) * (F.col("l_quantity") - 25) / 5
    return write_once(S.split_hash(_items(spark, sf).withColumn("price", (bent + flag + noise).cast("double")), "row_key"), "splits")


def halving_trials(spark, sf):
    """Rungs of successive halving, run twice over one trial table: the second time fits nothing. A straight line cannot win here."""
    prepared, path = _waves(spark, sf).drop("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "p_name"), fresh_path(spark, "trials")
    parts = [prepared.filter(F.col("split") == s).drop("split") for s in ("train", "validation")]
    trials, best = A.halving_trials(*parts, "price", "row_key", path)
    again, same = A.halving_trials(*parts, "price", "row_key", path)
    return again.groupBy("rung").agg(
        F.count("*").alias("n_trials"), F.max("n_rows").alias("n_rows"), (F.max("r2") > 0.8).alias("learnt"),
        F.lit("linear" not in best.name and same.name == best.name and abs(same.r2 - best.r2) < 1e-9).alias("bent_wins"),
    )


def batch_score(spark, sf):
    return _scored(spark, sf).withColumn("prediction", F.round("prediction", 2))


def score_append(spark, sf):
    """Two runs append to the same predictions."""
    path = fresh_path(spark, "predictions")
    scored = _scored(spark, sf)
    for _ in range(2):
        files.append_predictions(scored, path)
    back = spark.read.schema("row_key string, price double, prediction double").option("header", True).csv(path)
    return back.agg(F.count("*").alias("n_rows"), F.count_distinct("row_key").alias("n_keys"))


def regression_r2(spark, sf):
    guess = table(spark, sf, "lineitem").select("l_extendedprice", (F.col("l_quantity") * 2000).alias("prediction"))
    return A.r2(guess, "l_extendedprice").select(F.round("r2", 6).alias("r2"), "n_rows")


def column_profile(spark, sf):
    return A.column_profile(table(spark, sf, "part"), exact=True)


QUERIES = {
    f.__name__: f
    for f in (
        chunk_upsert, chunk_upsert_table, chunk_upsert_fields, upload_batches, split_exact, split_exact_shares, split_hash,
        split_counts, split_disjoint, split_sink, split_manifests, manifest_scan, manifest_rewrite, asset_register_new, model_register,
        model_latest, run_id_extract, schema_context, column_sketches, sql_guard, sql_answer, automl_trials, automl_best_trial, target_encode, halving_trials,
        batch_score, score_append, regression_r2, column_profile,
    )
}


# ---------------------------------------------------------------- the same in SQL

_RANKED = """ranked AS (
  SELECT o_orderkey, o_custkey, o_totalprice, row_number() OVER (ORDER BY md5('42_' || o_orderkey), o_orderkey) AS rn,
         count(*) OVER () AS n FROM orders)"""
_REST = "ceil(n * (1 - CAST(0.8 AS DOUBLE)))"


def _cut(test: str) -> str:
    return f"""cut AS (SELECT *, CASE WHEN rn <= {test} THEN 'test' WHEN rn <= {_REST} THEN 'validation' ELSE 'train' END AS split FROM ranked)"""


_NESTED = f"{_RANKED}, {_cut(f'ceil({_REST} * CAST(0.1 AS DOUBLE))')}"
_SHARES = f"{_RANKED}, {_cut('ceil(n * CAST(0.1 AS DOUBLE))')}"
_BATCHES = """batches AS (SELECT o_orderpriority, o_orderkey,
  (row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1) // 900 AS batch FROM orders)"""
_MODELS = """models AS (SELECT 'model ' || (s_suppkey % 7) AS name, s_suppkey // 7 + 1 AS version,
  'run ' || s_suppkey AS run_id, 'models/' || s_suppkey AS path FROM supplier)"""

COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


KINDS = dict(c.split(" ", 1) for columns in COLUMNS.values() for c in columns.split(", "))


def _end(f: str, column: str, kind: str) -> str:
    """Least or greatest value as text; none of lists and doubles."""
    return "CAST(NULL AS VARCHAR)" if "<" in kind or kind == "double" else f"CAST({f}({column}) AS VARCHAR)"


def _context_sql() -> str:
    rows = []
    for name, columns in COLUMNS.items():
        for column, kind in (c.split(" ", 1) for c in columns.split(", ")):
            ends = [_end(f, column, kind) for f in ("min", "max")]
            rows.append(
                f"SELECT '{name}' AS table_name, '{column}' AS column_name, '{kind}' AS column_type, count(*) AS n_rows, "
                f"count(*) - count({column}) AS n_nulls, {ends[0]} AS least, {ends[1]} AS greatest, count(DISTINCT {column}) AS n_distinct, "
                f"true AS close, least(3, count(DISTINCT {column})) AS n_samples FROM {name}"
            )
    return "\nUNION ALL ".join(rows)


def _answer_sql() -> str:
    shapes = {
        0: ("""'{"o_orderstatus":"' || o_orderstatus || '","n":' || n || '}'""", "o_orderstatus"),
        1: ("""'{"o_custkey":' || o_custkey || ',"n":' || n || '}'""", "n DESC, o_custkey"),
        2: ("""'{"n_name":"' || n_name || '","n":' || n || '}'""", "n_name"),
    }
    rows = []
    for i, (question, sql) in enumerate(QUESTIONS.items()):
        q, s = question.replace("'", "''"), sql.replace("'", "''")
        if i in shapes:
            shape, _ = shapes[i]
            rows.append(
                f"SELECT '{q}' AS question, '{s}' AS sql, {shape} AS row_json, count(*) OVER () AS n_rows, "
                f"CAST(3 AS BIGINT) AS n_steps, NULL AS error FROM ({sql})"
            )
        else:
            rows.append(f"SELECT '{q}', '{s}', NULL, NULL, 2, 'changes data'")
    return "\nUNION ALL ".join(rows)


def _profile_sql() -> str:
    rows = []
    for column, kind in (c.split(" ", 1) for c in COLUMNS["part"].split(", ")):
        label = "categorical" if kind == "string" else "numeric"
        rows.append(
            f"SELECT '{column}' AS column_name, '{label}' AS kind, count(*) AS n_rows, count(*) - count({column}) AS n_nulls, "
            f"count(DISTINCT {column}) AS n_distinct FROM part"
        )
    return "\nUNION ALL ".join(rows)


_CELLS = """items AS (
  SELECT l_orderkey || '_' || l_linenumber AS row_key, l_returnflag, o_orderpriority,
    ('0x' || substr(md5(l_returnflag || o_orderpriority), 1, 2))::BIGINT + ('0x' || substr(md5(l_orderkey || '_' || l_linenumber), 1, 4))::BIGINT / 65536.0 * 30 AS price
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
placed AS (SELECT *, ('0x' || substr(md5('42_' || row_key), 1, 8))::BIGINT / 4294967296.0 AS u FROM items),
cell AS (SELECT l_returnflag, o_orderpriority, avg(price) AS prediction FROM placed WHERE u < 0.8 GROUP BY ALL),
scored AS (SELECT row_key, price::DOUBLE AS price, prediction, u FROM placed JOIN cell USING (l_returnflag, o_orderpriority)),
test AS (SELECT * FROM scored WHERE u >= 0.9)"""
_R2 = "round(1 - sum((price - prediction) * (price - prediction)) / (count(*) * var_pop(price)), 3)"
_TRIALS = ("linear", "decision_tree", "robust_linear", "random_forest", "boosted_trees")

_REFUSED = " ".join(f"WHEN {i} THEN '{r}'" for i, r in enumerate(REFUSALS) if r)

ORACLE = {
    "chunk_upsert": """WITH old AS (SELECT * FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 <> 0), new AS (SELECT * FROM orders WHERE o_orderkey % 3 = 0)
SELECT coalesce(n.o_orderkey, o.o_orderkey) AS o_orderkey,
  CASE WHEN n.o_orderkey IS NOT NULL THEN 'X' ELSE o.o_orderstatus END AS o_orderstatus,
  CASE WHEN n.o_orderkey % 9 = 0 THEN 'NEW' ELSE o.o_orderpriority END AS o_orderpriority,
  coalesce(n.o_totalprice, o.o_totalprice) AS o_totalprice
FROM old o FULL JOIN new n ON o.o_orderkey = n.o_orderkey""",
    "chunk_upsert_table": """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice
FROM orders""",
    "chunk_upsert_fields": """SELECT o_orderkey, o_orderstatus, o_totalprice,
  CASE WHEN o_orderkey % 4 = 0 THEN 'LAST' WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS o_orderpriority FROM orders""",
    "upload_batches": f"WITH {_BATCHES} SELECT * FROM batches",
    "split_exact": f"WITH {_NESTED} SELECT o_orderkey, split FROM cut",
    "split_exact_shares": f"WITH {_SHARES} SELECT o_orderkey, split FROM cut",
    "split_hash": """WITH u AS (SELECT o_orderkey, CAST('0x' || substr(md5('42_' || o_orderkey), 1, 8) AS BIGINT) / 4294967296.0 AS u FROM orders)
SELECT o_orderkey, CASE WHEN u < 0.8 THEN 'train' WHEN u < 0.9 THEN 'validation' ELSE 'test' END AS split FROM u""",
    "split_counts": f"WITH {_NESTED} SELECT split, count(*) AS n_rows, CAST(3 AS BIGINT) AS n_columns FROM cut GROUP BY split",
    "split_disjoint": f"""WITH {_NESTED}
SELECT 'shared' AS what, (SELECT count(*) FROM (SELECT o_orderkey FROM cut GROUP BY o_orderkey HAVING count(DISTINCT split) > 1)) AS n
UNION ALL SELECT 'lost', (SELECT count(*) FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM cut))""",
    "split_sink": f"WITH {_NESTED} SELECT o_orderkey, o_custkey, o_totalprice, split FROM cut",
    "split_manifests": f"WITH {_NESTED} SELECT o_orderkey, o_custkey, o_totalprice, split FROM cut",
    "manifest_scan": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
    "manifest_rewrite": """SELECT p_partkey, p_name AS name, './' || p_partkey || '_train.csv,./more.csv' AS files, 'mltable' AS type FROM part""",
    "asset_register_new": """WITH offered AS (SELECT p_name AS name, CAST(p_size AS VARCHAR) AS version, 'part/' || p_partkey AS path, p_partkey FROM part)
SELECT name, version, 'table' AS type, CASE WHEN bool_or(p_partkey % 4 = 0) THEN 'known' ELSE min(path) END AS path
FROM offered GROUP BY name, version""",
    "model_register": f"""WITH {_MODELS}, runs AS (
  SELECT 'model ' || (p_partkey % 10) AS name, 'run p' || p_partkey AS run_id, 'runs/' || p_partkey AS path, p_retailprice AS r2 FROM part),
best AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY r2 DESC, run_id DESC) AS rn FROM runs)
SELECT b.name, coalesce((SELECT max(version) FROM models m WHERE m.name = b.name), 0) + 1 AS version, run_id,
  'runs:/' || run_id || '/outputs/mlflow-model' AS uri, path, r2 FROM best b WHERE rn = 1""",
    "model_latest": f"""WITH {_MODELS}
SELECT name, version, run_id, path FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY version DESC) AS rn FROM models) WHERE rn = 1""",
    "run_id_extract": """WITH r AS (SELECT s_suppkey, CASE WHEN s_suppkey % 5 <> 0 THEN 'run-' || s_suppkey ELSE 'early' END AS run_id FROM supplier)
SELECT s_suppkey, run_id, 'runs:/' || run_id || '/outputs/mlflow-model' AS uri FROM r""",
    "schema_context": _context_sql(),
    "column_sketches": "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_nulls, {_end('min', c, KINDS[c])} AS least, {_end('max', c, KINDS[c])} AS greatest, "
        f"count(DISTINCT {c}) AS n_distinct, true AS close, {'NULL' if c == 'o_orderstatus' else 'true'} AS median_close, "
        f"{'mode(o_orderstatus)' if c == 'o_orderstatus' else 'CAST(NULL AS VARCHAR)'} AS most_frequent, '2,2,2,0' AS files FROM orders"
        for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    ),
    "sql_guard": f"SELECT p_partkey, CASE p_partkey % {len(STATEMENTS)} {_REFUSED} END AS refused FROM part",
    "sql_answer": _answer_sql(),
    "automl_trials": " UNION ALL ".join(f"SELECT '{t}' AS name, {'false' if 'linear' in t else 'true'} AS learnt, 'finished' AS status" for t in _TRIALS),
    "automl_best_trial": f"""WITH {_CELLS}
SELECT false AS linear, (SELECT {_R2} FROM scored WHERE u >= 0.8 AND u < 0.9) AS r2, {_R2} AS test_r2, count(*) AS n_rows FROM test""",
    "target_encode": """WITH items AS (
  SELECT l_orderkey || '_' || l_linenumber || '_' || l_partkey || '_' || l_suppkey || '_' || l_quantity AS key, l_partkey,
    CASE WHEN n % 3 = 0 THEN 1 WHEN n % 7 <> 1 THEN l_suppkey END AS supplier, CASE WHEN n % 11 <> 0 THEN l_extendedprice END AS price
  FROM (SELECT *, l_orderkey * 10 + l_linenumber AS n FROM lineitem)),
folded AS (SELECT *, ('0x' || substr(md5('42_' || key), 1, 8))::BIGINT % 5 AS fold FROM items),
f AS (SELECT unnest(range(5)) AS fold),
whole AS (SELECT f.fold, avg(price) AS m FROM f JOIN folded x ON x.fold <> f.fold GROUP BY f.fold),
p AS (SELECT l_partkey, fold, sum(price) AS s, count(price) AS n FROM folded GROUP BY ALL),
pt AS (SELECT l_partkey, sum(s) AS s, sum(n) AS n FROM p GROUP BY ALL),
s AS (SELECT supplier, fold, sum(price) AS s, count(price) AS n FROM folded GROUP BY ALL),
st AS (SELECT supplier, sum(s) AS s, sum(n) AS n FROM s GROUP BY ALL)
SELECT key, round((coalesce(pt.s, 0) - coalesce(p.s, 0) + 10 * m) / (pt.n - p.n + 10), 3) AS l_partkey,
  round((coalesce(st.s, 0) - coalesce(s.s, 0) + 10 * m) / (st.n - s.n + 10), 3) AS supplier
FROM folded x JOIN whole USING (fold) JOIN p ON p.l_partkey = x.l_partkey AND p.fold = x.fold JOIN pt ON pt.l_partkey = x.l_partkey
JOIN s ON s.supplier IS NOT DISTINCT FROM x.supplier AND s.fold = x.fold JOIN st ON st.supplier IS NOT DISTINCT FROM x.supplier""",
    "halving_trials": """WITH t AS (
  SELECT ('0x' || substr(md5('sample_42_' || row_key), 1, 8))::BIGINT AS place FROM (
    SELECT l_orderkey || '_' || l_linenumber || '_' || l_partkey || '_' || l_suppkey || '_' || l_quantity AS row_key FROM lineitem JOIN part ON l_partkey = p_partkey)
  WHERE ('0x' || substr(md5('42_' || row_key), 1, 8))::BIGINT < 3435973836),
r(rung, n_trials, least) AS (VALUES (0, 5, 4294967296 // 9), (1, 2, 4294967296 // 3), (2, 1, 4294967296))
SELECT rung, n_trials::BIGINT AS n_trials, (SELECT count(*) FROM t WHERE place < least) AS n_rows, true AS learnt, true AS bent_wins FROM r""",
    "batch_score": f"WITH {_CELLS} SELECT row_key, price, round(prediction, 2) AS prediction FROM test",
    "score_append": f"WITH {_CELLS} SELECT 2 * count(*) AS n_rows, count(DISTINCT row_key) AS n_keys FROM test",
    "regression_r2": """WITH g AS (SELECT l_extendedprice AS y, l_quantity * 2000 AS p FROM lineitem)
SELECT round(1 - sum((y - p) * (y - p)) / (count(*) * var_pop(y)), 6) AS r2, count(*) AS n_rows FROM g""",
    "column_profile": _profile_sql(),
}
