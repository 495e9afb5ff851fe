"""Tables whose rows are replaced key by key: what is replaced is marked by bitmaps of deleted rows, and no stored file is touched."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.session import for_folders
from docflow.sources.snapshots import Part, Store, ranges, to_fold

_PLACE = ("_bucket", "_file", "_block")


def bucket_of(column: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int")


def _row() -> Column:
    """The number of a row within its file, from 1."""
    return F.col("_metadata.row_index") + 1


def _with_places(store: Store, parts: list[Part], schema: str, columns: list[str]) -> DataFrame:
    """Rows of some parts with bucket, file and block of rows, and their place in the block."""
    each = [store.spark.read.schema(f"{schema}, bucket int").option("basePath", store.where(p.folder)).parquet(store.where(p.folder)) for p in parts]
    placed = [
        df.select(*columns, "bucket", F.col("bucket").alias("_bucket"), F.col("_metadata.file_name").alias("_file"),
                  F.bitmap_bucket_number(_row()).alias("_block"), F.bitmap_bit_position(_row()).alias("_place"))
        for df in each
    ]
    return reduce(DataFrame.unionByName, placed)


def _living(store: Store, parts: list[Part], schema: str, columns: list[str]) -> DataFrame:
    """The rows that no write has replaced. Without deletions nothing is joined."""
    rows = _with_places(store, parts, schema, columns)
    folders = sorted({d for p in parts for d in p.deletions})
    if folders:
        gone = store.spark.read.parquet(*map(store.where, folders)).groupBy(*_PLACE).agg(F.bitmap_or_agg("bits").alias("_bits"))
        byte = F.conv(F.hex(F.col("_bits").substr((F.col("_place") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        dead = F.call_function("shiftright", byte, (F.col("_place") % 8).cast("int")).bitwiseAND(F.lit(1)) == 1
        rows = rows.join(gone, list(_PLACE), "left").filter(F.col("_bits").isNull() | ~dead)
    return rows.select(*columns, "bucket")


def _names(schema: str) -> list[str]:
    return SparkSession.active().createDataFrame([], schema).columns


def write_keyed(rows: DataFrame, path: str, schema: str, key: str, buckets: int = 64) -> None:
    """Write ``rows``; a key that is written replaces all it had.

    The new rows become a folder of their own, in ``buckets`` by a hash of the key. Of what is stored only the keys are read, in the buckets
    that are met, and the rows of replaced keys are marked in bitmaps (a bit a row, in blocks of 32768). Both become the table by one
    rename. Folders of like size are folded now and then, and lose their marked rows. Columns that are missing are null;
    a null key is a key. Nothing happens without rows.
    """
    store, columns = Store(rows.sparkSession, path), _names(schema)
    whole = rows.select(*[F.col(c) if c in rows.columns else F.lit(None).alias(c) for c in columns])
    now = store.load()
    mine = _written(store, whole.withColumn("bucket", bucket_of(key, buckets)), [[now.last_write() + 1] * 2])
    new = store.spark.read.schema(f"{schema}, bucket int").parquet(store.where(mine.folder)).select(key, "bucket").distinct()
    touched = [r["bucket"] for r in new.select("bucket").distinct().collect()]  # ``buckets`` numbers at most
    if not touched:
        store.drop(mine.folder)
        return
    parts = list(now.parts)
    if parts:
        folder = store.new_folder("deletions")
        old = _with_places(store, parts, schema, [key]).filter(F.col("bucket").isin(touched))
        a, b = old.alias("a"), new.alias("b")
        replaced = a.join(b, F.col(f"a.{key}").eqNullSafe(F.col(f"b.{key}")), "left_semi")
        replaced.groupBy(*_PLACE).agg(F.bitmap_construct_agg("_place").alias("bits")).write.parquet(store.where(folder))
        if store.spark.read.parquet(store.where(folder)).isEmpty():
            store.drop(folder)
        else:
            parts = [Part(p.folder, p.writes, p.size, [*p.deletions, folder]) for p in parts]
    parts.append(mine)
    for start, stop in reversed(to_fold([p.size for p in parts])):
        run = parts[start:stop]
        parts[start:stop] = [_written(store, _living(store, run, schema, columns), ranges(run))]
    store.commit(now, parts)
    if mine not in parts:
        store.drop(mine.folder)


def _written(store: Store, rows: DataFrame, writes: list[list[int]]) -> Part:
    folder = store.new_folder("data")
    for_folders(rows, "bucket").write.partitionBy("bucket").parquet(store.where(folder))
    return Part(folder, writes, store.size(folder))


def read_keyed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of :func:`write_keyed` and their bucket; none where nothing has been written."""
    store = Store(spark, path)
    parts = store.load().parts
    if not parts:
        return spark.createDataFrame([], f"{schema}, bucket int")
    return _living(store, parts, schema, _names(schema))
