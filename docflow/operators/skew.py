"""Look-ups from many rows to one row per key, where a key may be hot."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.session import write_once

SALTS = 256
#: A key of more rows is hot.
HOT = 10_000


def lookup(facts: DataFrame, dims: DataFrame, keys: list[str], spread: Column, how: str = "left", often: DataFrame | None = None, hot: int = HOT) -> DataFrame:
    """Join ``dims`` (unique on ``keys``) to ``facts``, the rows of a hot key spread by ``spread``.

    Rows are counted by key first. Keys of more than ``hot`` rows, of which there is at most one for so many rows, are known to every
    task: their rows meet ``dims`` under key and salt, and ``dims`` is copied only for pairs that occur. All others meet by key
    alone. Where hot keys are known without counting they are given as ``often``, and ``spread`` is a number below ``SALTS``.
    """
    named = reduce(and_, [F.col(k).isNotNull() for k in keys])
    known = often
    if known is None:
        often = facts.filter(named).groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > hot)
    often = often.select(*keys, F.lit(True).alias("_hot"))

    def marked(df: DataFrame) -> DataFrame:
        salt = spread.cast("long")
        out = df.withColumn("_salt", salt).join(F.broadcast(often), keys, "left").withColumn("_hot", F.coalesce("_hot", ~named))
        return out.withColumn("_salt", F.when(F.col("_hot") | F.col("_salt").isNull(), F.col("_salt")).otherwise(F.lit(0)))

    if known is None:
        pairs = marked(facts).filter(F.col("_hot") & named).select(*keys, "_hot", "_salt").distinct()
    else:
        pairs = often.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    cold = dims.withColumns({"_hot": F.lit(False), "_salt": F.lit(0).cast("long")})
    return marked(facts).join(cold.unionByName(pairs.join(dims, keys)), [*keys, "_hot", "_salt"], how).drop("_hot", "_salt")


def salt_of(*cols: Column, salts: int = SALTS) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(salts)).cast("int")


def value_table(facts: DataFrame, columns: list[str], output: str, compute: Callable[[Column], Column]) -> DataFrame:
    """An expensive value for each distinct text of the columns, computed once and written."""
    texts = facts.select(F.explode(F.array_compact(F.array(*columns))).alias("value")).distinct()
    return write_once(texts.withColumn(output, compute(F.col("value"))), output)


def once_per_value(
    facts: DataFrame, column: str, output: str, compute: Callable[[Column], Column], spread: Column
) -> DataFrame:
    """Compute an expensive value once for each distinct text of ``column`` and hand it to every row."""
    values = value_table(facts, [column], output, compute).withColumnRenamed("value", column)
    return lookup(facts, values, [column], spread)
