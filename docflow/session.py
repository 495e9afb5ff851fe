"""Shared folder and materialisation: what a job may rely on when executors are lost."""

from __future__ import annotations

import pickle
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

_test_dir: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own.
    """
    global _test_dir
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _test_dir is None:
        _test_dir = tempfile.mkdtemp(prefix="docflow-")
    return _test_dir


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other call has been given.

    Paths of one application share a folder, so that it can be dropped when the application is done.
    """
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


class Shared:
    """A value of bounded size for all tasks; its classes travel with it, so executors need not have the package."""

    def __init__(self, spark: SparkSession, value):
        self._sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        """The value, opened anew at each call."""
        return pickle.loads(self._sent.value)


def drop_written(spark: SparkSession) -> None:
    """Drop all that this application has written to its share of the shared folder, and the tables that lie there.

    For the end of a job, when its results are stored elsewhere: tables of :func:`write_once` are read until then.
    """
    mine = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}"
    for found in spark.catalog.listTables():
        if found.tableType == "EXTERNAL":
            detail = spark.sql(f"DESCRIBE EXTENDED `{found.name}`").filter("col_name = 'Location'").first()
            if detail and f"/{spark.sparkContext.applicationId}/" in detail["data_type"]:
                spark.sql(f"DROP TABLE `{found.name}`")
    folder, files = _file_system(spark, mine)
    files.delete(folder, True)


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out anew where the input comes in fewer splits than there are cores.

    Large inputs have far more splits than that and are left as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


@contextmanager
def files_apart(spark: SparkSession) -> Iterator[None]:
    """While it lasts, scans that start do not put several files into one task, however small they are."""
    name = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, spark.conf.get("spark.sql.files.maxPartitionBytes"))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below ``path``; none where there is no such path."""
    folder, files = _file_system(spark, path)
    return [x.getPath().getName() for x in files.listStatus(folder) if x.isDirectory()] if files.exists(folder) else []


def _file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def for_folders(df: DataFrame, column: str) -> DataFrame:
    """Bring the rows of an output folder together before ``partitionBy(column)``.

    Else every task would write a file into every folder. Folders with many rows
    are split again at run time, and small ones share a task.
    """
    return df.hint("rebalance", column)


def read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    """The Parquet table at ``path``, or an empty one where none has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_once(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and return the written table.

    Used after model calls, so that no later action calls the model again, and
    so that a lost executor costs a re-read, not a re-computation.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
