"""Column statistics from mergeable sketches kept by file, so that new files cost only themselves."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.session import read_or_empty

#: What is kept of each column of each file. Sketches are bounded whatever the number of rows.
SCHEMA = (
    "file string, column_name string, column_type string, n_rows long, n_nulls long, least string, greatest string, hll binary, kll binary, "
    "often struct<sketch:binary,maxItemsTracked:int,itemDataType:string,itemDataTypeDDL:string>, sample array<struct<rank:double,value:string>>"
)
NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")
ORDERED = (*NUMBERS, "string", "date", "timestamp", "timestamp_ntz")
#: About 1.6 % error (one standard deviation) of distinct counts, 1.3 % of ranks, and so many values tracked.
LG_K, TRACKED, SAMPLE = 12, 1000, 20


def _said(c: Column, kind: str) -> Column:
    """A value as text; arrays and structs as JSON."""
    return c.cast("string") if "<" not in kind else F.to_json(c)


def weighted_rank(value: Column, weight: Column, seed: int) -> Column:
    """Ranks of a weighted reservoir: the greatest are drawn, each row in proportion to its weight; a seed draws the same rows again.

    A row's rank is u ** (1 / weight) with u from a hash of its value, on a log scale.
    """
    u = (F.pmod(F.xxhash64(value, F.lit(seed)), F.lit(1 << 52)) + 1) / F.lit(float((1 << 52) + 1))
    return F.log(u) / F.greatest(weight, F.lit(1e-9))


def sketch_files(files: DataFrame, columns: dict[str, str], weight: Column | None = None, seed: int = 7, sample: int = SAMPLE) -> DataFrame:
    """One row per file and column of ``files`` (a scan whose rows have ``_metadata``): counts, ends, sketches and a sample.

    Everything is one aggregate by file, combined before the shuffle. The sample has ``sample`` different values, drawn by ``weight``.
    """
    w = F.lit(1.0) if weight is None else weight
    named = files.select(F.col("_metadata.file_path").alias("file"), w.alias("_w"), *[F.col(f"`{c}`") for c in columns])
    aggs, rows = [F.count("*").alias("_n")], []
    for i, (name, kind) in enumerate(columns.items()):
        c, none = F.col(f"`{name}`"), F.lit(None)
        text = _said(c, kind)
        aggs += [
            F.count_if(c.isNull()).alias(f"z{i}"), F.hll_sketch_agg(text, LG_K).alias(f"h{i}"), F.call_function("approx_top_k_accumulate", text, F.lit(TRACKED)).alias(f"t{i}"),
        ]
        if kind in ORDERED:
            aggs += [F.min(c).cast("string").alias(f"a{i}"), F.max(c).cast("string").alias(f"b{i}")]
        if kind in NUMBERS:
            aggs.append(F.call_function("kll_sketch_agg_double", c.cast("double")).alias(f"k{i}"))
        rows.append(F.struct(
            F.lit(name).alias("column_name"), F.lit(kind).alias("column_type"), F.col("_n").alias("n_rows"), F.col(f"z{i}").alias("n_nulls"),
            (F.col(f"a{i}") if kind in ORDERED else none.cast("string")).alias("least"), (F.col(f"b{i}") if kind in ORDERED else none.cast("string")).alias("greatest"),
            F.col(f"h{i}").alias("hll"), (F.col(f"k{i}") if kind in NUMBERS else none.cast("binary")).alias("kll"), F.col(f"t{i}").alias("often"),
        ))
    counted = named.groupBy("file").agg(*aggs).select("file", F.explode(F.array(*rows)).alias("s")).select("file", "s.*")
    values = F.array(*[F.struct(F.lit(n).alias("column_name"), _said(F.col(f"`{n}`"), k).alias("value")) for n, k in columns.items()])
    each = named.select("file", "_w", F.explode(values).alias("v")).select("file", "v.*", "_w").filter("value is not null")
    drawn = drawn_values(likely(each.withColumn("rank", weighted_rank(F.col("value"), F.col("_w"), seed)), ["file", "column_name"], sample), ["file", "column_name"], sample)
    return counted.join(drawn, ["file", "column_name"], "left").select(*[c.split()[0] for c in _fields()])


def _fields() -> list[str]:
    return ["file", "column_name", "column_type", "n_rows", "n_nulls", "least", "greatest", "hll", "kll", "often", "sample"]


def likely(each: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The rows of ``each`` that can be drawn: those down to the first level of ranks that alone has ``n`` different values.

    A level halves what is above it, so some hundred values of a key are left, however many it has, and no task holds them all. Counts
    of values are estimates, so twice ``n`` are asked for.
    """
    level = F.floor(F.log2(-F.col("rank")))
    levels = each.groupBy(*keys, level.alias("level")).agg(F.approx_count_distinct("value").alias("found"))
    last = levels.groupBy(*keys).agg(F.min(F.when(F.col("found") >= 2 * n, F.col("level"))).alias("last"))  # a row per key
    return each.join(F.broadcast(last), keys).filter(F.col("last").isNull() | (level <= F.col("last"))).drop("last")


def drawn_values(each: DataFrame, keys: list[str], n: int) -> DataFrame:
    """keys and sample: the ``n`` different values of greatest rank, tied ones by value; only ``n`` of a key leave a task."""
    from pyspark.sql import Window

    best = each.groupBy(*keys, "value").agg(F.max("rank").alias("rank"))
    first = Window.partitionBy(*keys).orderBy(F.desc("rank"), "value")
    kept = best.withColumn("_k", F.row_number().over(first)).filter(F.col("_k") <= n)
    return kept.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("rank", "value")), asc=False).alias("sample"))


def update(spark: SparkSession, source: DataFrame, store: str, weight: Column | None = None) -> int:
    """Sketch the files of ``source`` (a scan of files) that ``store`` does not have, and add them; how many there were.

    Files that are known are not opened, so a table that grows pays for what is new. What is stored is never rewritten.
    """
    plain = lambda c: F.regexp_replace(c, "^([a-z0-9]+):/+", "$1:/")
    known = read_or_empty(spark, store, SCHEMA).select(plain(F.col("file")).alias("place")).distinct()
    here = spark.createDataFrame([(f,) for f in source.inputFiles()], "file string")  # a name per file
    new = [r["file"] for r in here.withColumn("place", plain(F.col("file"))).join(known, "place", "left_anti").collect()]
    if not new:
        return 0
    columns = {f.name: f.dataType.simpleString() for f in source.schema.fields}
    sketch_files(spark.read.schema(source.schema).parquet(*new), columns, weight).write.mode("append").parquet(store)
    return len(new)


def merged(sketches: DataFrame) -> DataFrame:
    """One row per column over all files: the union of their sketches; nothing of the data is read again."""
    by = ["column_name", "column_type"]
    number = F.col("column_type").isin(*NUMBERS)

    def end(c: str, plain, by):
        """The least or greatest of all files: numbers as numbers, others as text."""
        return F.coalesce(by(F.when(number, F.col(c)), F.col(c).try_cast("double")), plain(F.when(~number, F.col(c))))

    whole = sketches.groupBy(*by).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_nulls").alias("n_nulls"), end("least", F.min, F.min_by).alias("least"), end("greatest", F.max, F.max_by).alias("greatest"),
        F.hll_union_agg("hll").alias("hll"), F.call_function("kll_merge_agg_double", F.col("kll")).alias("kll"),
        F.call_function("approx_top_k_combine", F.col("often"), F.lit(TRACKED)).alias("often"),
    )
    each = sketches.select(*by, F.explode("sample").alias("s")).select(*by, "s.rank", "s.value")
    return whole.join(drawn_values(each, by, SAMPLE), by, "left")


def estimates(whole: DataFrame, quantiles: tuple[float, ...] = (0.25, 0.5, 0.75), most: int = 5, sample: int = 3) -> DataFrame:
    """Of :func:`merged`: about how many values, quantiles of numbers, the most frequent values with their counts, and some values."""
    shares = F.array(*[F.lit(q) for q in quantiles])
    return whole.select(
        "column_name", "column_type", "n_rows", "n_nulls", "least", "greatest", F.hll_sketch_estimate("hll").alias("n_distinct"),
        F.when(F.col("column_type").isin(*NUMBERS) & (F.col("n_nulls") < F.col("n_rows")), F.call_function("kll_sketch_get_quantile_double", F.col("kll"), shares)).alias("quantiles"),
        F.call_function("approx_top_k_estimate", F.col("often"), F.lit(most)).alias("frequent"),
        F.transform(F.slice("sample", 1, sample), lambda s: s["value"]).alias("samples"),
    )


def table_sketch(df: DataFrame, name: str) -> DataFrame:
    """Estimates of a scan's columns with the name of its table, sketched now."""
    columns = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return estimates(merged(sketch_files(df, columns))).select(F.lit(name).alias("table_name"), "*")


def all_tables(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [table_sketch(df, name) for name, df in tables.items()])
