"""Text columns of many values as numbers: shrunken means of the target, taken from the other folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.operators.skew import HOT, lookup, salt_of
from docflow.operators.split import split_hash_of
from docflow.session import write_once


def fold_of(key: Column, folds: int, seed: int) -> Column:
    """The fold of a row by a hash of its key; a null key is in fold 0."""
    return F.coalesce((F.conv(F.substring(split_hash_of(key, seed), 1, 8), 16, 10).cast("bigint") % folds).cast("int"), F.lit(0))


def target_sums(train: DataFrame, columns: list[str], target: str, key: str, folds: int = 5, seed: int = 42) -> DataFrame:
    """column_name, value, fold, total, n: sums of the target by value and fold, one row each, written once.

    Rows without a target count for nothing. A null is a value of its own. Sums are made before anything is shuffled, so a value that
    a third of all rows have costs a row per task.
    """
    known = train.filter(F.col(target).isNotNull()).select(
        fold_of(F.col(key), folds, seed).alias("fold"), F.col(target).cast("double").alias("y"),
        F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])).alias("c"),
    )
    return write_once(known.groupBy("c.column_name", "c.value", "fold").agg(F.sum("y").alias("total"), F.count("*").alias("n")), "target-sums")


def encode(df: DataFrame, sums: DataFrame, columns: list[str], key: str, learnt: bool, folds: int = 5, seed: int = 42, shrinkage: float = 10.0) -> DataFrame:
    """``df`` with a column ``<name>__mean`` for each of ``columns``: the mean of the target among rows with the same value.

    With ``learnt`` the rows are those that ``sums`` were made from: a row then sees the sums of all folds but its own, so nothing of its
    target reaches it. Other rows see all folds. A mean of n rows is drawn to the mean of all rows seen by ``shrinkage`` / (n + ``shrinkage``);
    an unknown value has just that mean. Values meet their rows by value, frequent ones by value and salt, so that they are
    spread; with ``learnt`` the sums tell which these are.
    """
    out = df.withColumn("_fold", fold_of(F.col(key), folds, seed) if learnt else F.lit(-1))
    numbers = F.array(*[F.lit(k) for k in range(folds)] if learnt else [F.lit(-1)])
    for column in columns:
        mine = sums.filter(F.col("column_name") == column)
        # what each fold sees: of a value, and of all values
        seen = mine.select("value", "fold", "total", "n", F.explode(numbers).alias("_fold")).filter("fold <> _fold")
        whole = seen.groupBy("_fold").agg((F.sum("total") / F.sum("n")).alias("_all"))  # a row per fold
        means = seen.groupBy("value", "_fold").agg(F.sum("total").alias("_total"), F.sum("n").alias("_n"))
        named = means.select(_known("value").alias("_known"), F.col("value").alias("_value"), "_fold", "_total", "_n").withColumn("_value", F.coalesce("_value", F.lit("")))
        keyed = out.withColumns({"_known": _known(column), "_value": F.coalesce(F.col(column).cast("string"), F.lit(""))})
        often = mine.filter(F.col("n") > HOT).select(_known("value").alias("_known"), F.coalesce("value", F.lit("")).alias("_value"), F.col("fold").alias("_fold"))
        met = lookup(keyed, named, ["_known", "_value", "_fold"], salt_of(F.col(key)), often=often if learnt else None).join(F.broadcast(whole), "_fold", "left")
        value = (F.coalesce("_total", F.lit(0.0)) + shrinkage * F.col("_all")) / (F.coalesce("_n", F.lit(0)) + shrinkage)
        out = met.withColumn(f"{column}__mean", value).drop("_known", "_value", "_total", "_n", "_all")
    return out.drop("_fold")


def _known(column: str) -> Column:
    return F.col(column).isNotNull()
