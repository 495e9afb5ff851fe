"""Versioned assets and models as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.functions import text
from docflow.session import read_or_empty, write_once

MODEL = "name string, version bigint, run_id string, uri string, path string, r2 double"


def new_assets(registry: DataFrame, offered: DataFrame) -> DataFrame:
    """Offered assets whose name and version the registry does not hold yet, each once."""
    keys = ["name", "version"]
    rest = [c for c in offered.columns if c not in keys]
    once = offered.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_r")).select(*keys, "_r.*")
    return once.join(registry, keys, "left_anti")


def register_assets(registry: DataFrame, offered: DataFrame) -> DataFrame:
    return registry.unionByName(new_assets(registry, offered), allowMissingColumns=True)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def store_assets(spark: SparkSession, path: str, offered: DataFrame) -> None:
    """Append the offered assets that the registry at ``path`` lacks; offering them again adds nothing."""
    known = read_or_empty(spark, path, offered.schema)
    new_assets(known, offered).select(*offered.columns).write.mode("append").parquet(path)


def store_models(spark: SparkSession, path: str, runs: DataFrame) -> DataFrame:
    """Append a version for each name in ``runs`` to the registry at ``path``; returns the rows that were added."""
    new = write_once(register_models(read_or_empty(spark, path, MODEL), runs), "models")
    new.write.mode("append").parquet(path)
    return new


def run_id(mlmodel_text: Column) -> Column:
    """From the last line that speaks of a run id: what stands between the first colon and the next."""
    lines = F.filter(F.split(mlmodel_text, "\n"), lambda line: F.contains(line, F.lit("run_id")))
    return text.strip(F.split_part(F.try_element_at(lines, F.lit(-1)), F.lit(":"), F.lit(2)))


def read_run_ids(spark: SparkSession, path: str) -> DataFrame:
    """Run id of every model file below ``path``; a file is one row."""
    texts = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    return texts.select(F.col("_metadata.file_path").alias("path"), run_id(F.col("value")).alias("run_id"))


def model_uri(run: Column) -> Column:
    return F.format_string("runs:/%s/outputs/mlflow-model", run)


def register_models(registry: DataFrame, runs: DataFrame) -> DataFrame:
    """One new version for each name in ``runs`` (``name, run_id, path, r2``): the best known one plus one."""
    highest = registry.groupBy("name").agg(F.max("version").alias("_v"))
    latest = runs.groupBy("name").agg(
        F.max_by(F.struct("run_id", "path", "r2"), F.struct("r2", "run_id")).alias("_r")
    )
    return latest.join(highest, "name", "left").select(
        "name",
        (F.coalesce("_v", F.lit(0)) + 1).cast("bigint").alias("version"),
        F.col("_r.run_id").alias("run_id"),
        model_uri(F.col("_r.run_id")).alias("uri"),
        F.col("_r.path").alias("path"),
        F.col("_r.r2").alias("r2"),
    )


def latest_models(registry: DataFrame) -> DataFrame:
    """The highest version of each model, with all that is known of it."""
    rest = [c for c in registry.columns if c != "name"]
    return registry.groupBy("name").agg(F.max_by(F.struct(*rest), "version").alias("_r")).select("name", "_r.*")
