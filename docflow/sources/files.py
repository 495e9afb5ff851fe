"""Readers and writers of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow import schemas
from docflow.functions.text import base64_text, base_name, data_url, mime_type
from docflow.operators.skew import lookup, salt_of
from docflow.session import subfolders, write_once
from docflow.sources.keyed import read_keyed, write_keyed

BAD = "_bad"


def read_delimited(
    spark: SparkSession, path: str, schema: str, sep: str = "|", multi_line: bool = False
) -> DataFrame:
    """Delimited text with a header; every column as the schema says, nothing inferred.

    With ``multi_line`` quoted fields may span lines, but a file is then read by one task.
    """
    return (
        spark.read.schema(schema)
        .options(sep=sep, header=True, multiLine=multi_line, quote='"', escape='"')
        .csv(path)
    )


def write_delimited(df: DataFrame, path: str, sep: str = "|", mode: str = "overwrite") -> None:
    df.write.mode(mode).options(sep=sep, header=True, quote='"', escape='"').csv(path)


def overwrite_table(df: DataFrame, path: str) -> None:
    """Replace a table; errors are raised, never swallowed."""
    df.write.mode("overwrite").parquet(path)


def read_extracts(spark: SparkSession, path: str, lines: bool = False) -> tuple[DataFrame, DataFrame]:
    """Page extracts below ``path`` and what could not be parsed, each with its file.

    A file holds one object, or one per line with ``lines``.
    """
    parsed = F.from_json(
        "value", f"{schemas.PAGE_EXTRACT}, {BAD} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}
    )
    rows = (
        spark.read.text(path, wholetext=not lines, recursiveFileLookup=True)
        .select("value", F.col("_metadata.file_path").alias("extract_path"), parsed.alias("_x"))
    )
    broken = F.col("_x").isNull() | F.col(f"_x.{BAD}").isNotNull()
    good = rows.filter(~broken).select("_x.*", "extract_path").drop(BAD)
    bad = rows.filter(broken).select("extract_path", F.col("value").alias("content"))
    return good, bad


PAGE_TABLE = f"file_name string, extract_path string, {schemas.PAGE_EXTRACT}"


def read_page_table(spark: SparkSession, path: str) -> DataFrame:
    """Extracts as :func:`write_pages` keeps them, with the bucket of their document."""
    return read_keyed(spark, path, PAGE_TABLE)


def write_pages(pages: DataFrame, path: str, buckets: int = 64) -> None:
    """Keep page extracts by document; a document that is written replaces what it had, and no stored file is written again.

    See :func:`docflow.sources.keyed.write_keyed`: new extracts are added, replaced ones are marked as deleted. Buckets, not a folder
    per document, keep the number of files in hand however many documents there are.
    """
    write_keyed(pages, path, PAGE_TABLE, "file_name", buckets)


def rewrite_changed(filled: DataFrame, path: str, buckets: int = 64) -> None:
    """Write the documents that have a changed page again, and no others."""
    touched = write_once(filled.filter("changed").select("file_name").distinct(), "changed")
    again = lookup(filled.drop("changed"), touched, ["file_name"], salt_of(F.col("page_sequence_number")), "inner")
    write_pages(again, path, buckets)


def write_chunks(chunks: DataFrame, path: str) -> None:
    """Chunks as JSON lines, in a folder for each writing; a document that is written again replaces what it had.

    Only what is new is written. :func:`read_chunks` leaves out what has been replaced. No chunks make an empty folder.
    """
    number = max([int(x.split("=")[1]) for x in subfolders(chunks.sparkSession, path) if x.startswith("writing=")], default=-1) + 1
    chunks.write.mode("overwrite").json(f"{path}/writing={number}")


def read_chunks(spark: SparkSession, path: str, schema) -> DataFrame:
    """The chunks of each document as they were written last."""
    every = spark.read.schema(schema).option("basePath", path).json(path)
    last = every.groupBy("file_name").agg(F.max("writing").alias("_last"))
    return lookup(every, last, ["file_name"], salt_of(F.col("id"))).filter("writing = _last").drop("writing", "_last")


def read_payloads(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Binary files as data URLs with the media type of their extension."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
    )
    return files.select(
        "path",
        base_name(F.col("path")).alias("name"),
        "length",
        data_url(mime_type(F.col("path")), base64_text(F.col("content"))).alias("url"),
    )


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.MANIFEST).json(path)


def read_manifest_data(spark: SparkSession, manifest: DataFrame, base: str, schema: str) -> DataFrame:
    """The table that a one-row manifest points to."""
    first = manifest.select(F.get("paths", F.lit(0))["file"].alias("file")).limit(1).collect()
    if not first or not first[0]["file"]:
        raise ValueError("the manifest names no file")
    return spark.read.schema(schema).options(header=True, quote='"', escape='"').csv(
        f"{base}/{first[0]['file'].removeprefix('./')}"
    )


def rewrite_manifest(manifest: DataFrame, file) -> DataFrame:
    """Point the first path of each manifest to ``file``; everything else is kept."""
    target = F.lit(file) if isinstance(file, str) else file
    return manifest.withColumn(
        "paths", F.transform("paths", lambda x, i: F.when(i == 0, x.withField("file", target)).otherwise(x))
    )


SPLITS = ("train", "validation", "test")
BESIDE = "_manifest"  # readers of a folder's data leave out names that begin so


def write_splits(df: DataFrame, path: str, manifest: DataFrame | None = None) -> None:
    """All splits in one pass, a folder each, with header; with ``manifest``, one of its own beside the data of each.

    A split's manifest is the given one with its first path moved to the folder it lies in. All three are there even if a split
    has no rows.
    """
    df.write.mode("overwrite").option("header", True).partitionBy("split").csv(path)
    for split in SPLITS if manifest is not None else ():
        rewrite_manifest(manifest, "./").coalesce(1).write.mode("overwrite").json(f"{path}/split={split}/{BESIDE}")


def read_split(spark: SparkSession, path: str, split: str, schema: str) -> DataFrame:
    """A split of :func:`write_splits` by way of the manifest beside its data."""
    base = f"{path}/split={split}"
    return read_manifest_data(spark, read_manifest(spark, f"{base}/{BESIDE}"), base, schema)


def append_predictions(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("header", True).csv(path)
