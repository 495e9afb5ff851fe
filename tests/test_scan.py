import random

from pyspark.sql import functions as F

from docflow.operators.scan import Running, row_numbers, running
from docflow.operators.skew import lookup, once_per_value, salt_of


def hot_rows(n=600, seed=1):
    """A third of the rows and more under one key, the rest under many."""
    rng = random.Random(seed)
    rows, at = [], {}
    for _ in range(n):
        key = 0 if rng.random() < 0.4 else rng.randrange(1, 40)
        at[key] = at.get(key, 0) + rng.randrange(1, 9)
        rows.append((key, at[key], rng.choice([None, "a", "b", "c"]), rng.randrange(100)))
    rng.shuffle(rows)
    return rows


def test_running_equals_a_loop(spark):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "k int, pos bigint, t string, n bigint")
    for block in (4, 50, 1_000_000):
        out = running(
            df, ["k"], "pos",
            {
                "last": Running("last", F.col("t")), "prior": Running("last", F.col("t"), inclusive=False),
                "top": Running("max", F.col("n")), "total": Running("sum", F.col("n")),
                "text": Running("join", F.col("t"), separator="-"),
            },
            block=block,
        )
        got = {(r["k"], r["pos"]): (r["last"], r["prior"], r["top"], r["total"], r["text"]) for r in out.collect()}
        expected, state = {}, {}
        for k, pos, t, n in sorted(rows, key=lambda r: (r[0], r[1])):
            last, top, total, texts = state.get(k, (None, -1, 0, []))
            prior, last = last, t if t is not None else last
            texts = texts + [t] if t is not None else texts
            state[k] = (last, max(top, n), total + n, texts)
            expected[(k, pos)] = (last, prior, max(top, n), total + n, "-".join(texts) if texts else None)
        assert got == expected


def test_row_numbers_are_dense(spark):
    df = spark.createDataFrame([(r[0], r[1]) for r in hot_rows()], "k int, pos bigint")
    numbered = row_numbers(df, ["k"], "pos", block=7).groupBy("k").agg(
        F.count("*").alias("c"), F.max("rn").alias("m"), F.count_distinct("rn").alias("d")
    )
    assert all(r["c"] == r["m"] == r["d"] for r in numbered.collect())


def test_a_hot_key_is_split(spark):
    """The windows of a hot key run in many groups: no window task sees more than a block."""
    df = spark.range(4000).select(F.lit(1).alias("k"), F.col("id").alias("pos"))
    plan = row_numbers(df, ["k"], "pos", block=100)._jdf.queryExecution().optimizedPlan().toString()
    assert "_block" in plan and plan.count("Window") == 2


def test_lookup_keeps_rows(spark):
    facts = spark.createDataFrame([(r[0] if r[0] != 5 else None, r[1]) for r in hot_rows()], "k int, pos bigint")
    dims = spark.createDataFrame([(k, f"d{k}") for k in range(0, 30)], "k int, d string")
    out = lookup(facts, dims, ["k"], salt_of(F.col("pos"), salts=5))
    assert out.count() == facts.count()
    assert out.filter("d is not null and d <> concat('d', k)").count() == 0
    assert out.filter("k < 30 and d is null").count() == 0


def test_lookup_spreads_hot_keys_only(spark):
    facts = spark.createDataFrame([*[(1, p) for p in range(300)], *[(2 + p % 40, p) for p in range(80)], (None, 1), (1, None), (2, None)], "k int, pos bigint")
    dims = spark.createDataFrame([(k, f"d{k}") for k in range(0, 30)], "k int, d string")
    found = lookup(facts, dims, ["k"], F.floor(F.col("pos") / 10), hot=50)
    expected = [(k, p, f"d{k}" if k is not None and p is not None and k < 30 else None) for k, p in map(tuple, facts.collect())]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, expected))
    inner = lookup(facts, dims, ["k"], F.floor(F.col("pos") / 10), "inner", hot=50)
    assert sorted(map(tuple, inner.collect())) == sorted(r for r in expected if r[2])


def test_lookup_does_not_copy_what_is_not_hot(spark):
    """Pairs of key and salt were made for every key before, as many as there are rows."""
    facts, dims = spark.range(2000).select((F.col("id") % 500).alias("k"), "id"), spark.range(500).select(F.col("id").alias("k"), F.lit(1).alias("d"))
    seen = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def count(d):
        seen.add(1)
        return d

    copied = dims.select("k", count.asNondeterministic()("d").alias("d"))
    assert lookup(facts, copied, ["k"], salt_of(F.col("id"))).filter("d = 1").count() == 2000
    pairs = lookup(facts, dims, ["k"], salt_of(F.col("id")), hot=3).filter("d = 1").count()
    assert pairs == 2000 and seen.value <= 1000


def test_values_are_computed_once(spark):
    facts = spark.createDataFrame([(r[2], r[1]) for r in hot_rows()], "t string, pos bigint")
    out = once_per_value(facts, "t", "u", F.upper, salt_of(F.col("pos"), salts=3))
    assert out.count() == facts.count() and out.filter("not (u <=> upper(t))").count() == 0
