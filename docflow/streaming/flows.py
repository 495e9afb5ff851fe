"""The batch operators on arriving data."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docflow.operators.chunks import build_chunks
from docflow.operators.model import ClientFactory
from docflow.operators.upsert import upsert_table
from docflow.plans.reviews import as_json, complete, parse

PROVIDER, ROCKS_SETTING = "spark.sql.streaming.stateStore.providerClass", "spark.sql.streaming.stateStore.rocksdb"
PARTS, PARTS_A_CORE = "spark.sql.shuffle.partitions", 2
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_chunks(
    pages: DataFrame, table: str, checkpoint: str, user_id: str, image_dir: str, prepare=None
) -> StreamingQuery:
    """Upsert the chunks of arriving page extracts into a table; ``pages`` is a stream.

    ``prepare`` shapes what arrives into extracts. A batch is written as the merge of its number: one that is repeated
    after a failure replaces itself. :func:`docflow.operators.upsert.read_table` gives the rows.
    """
    def merge(batch: DataFrame, batch_id: int) -> None:
        extracts = batch if prepare is None else prepare(batch)
        chunks = build_chunks(extracts, user_id, image_dir).withColumn("_order", F.lit(0))
        upsert_table(batch.sparkSession, table, chunks, ["id"], "_order", merge=batch_id)

    return (
        pages.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


@contextmanager
def _keys_on_disk(spark: SparkSession) -> Iterator[None]:
    """State of queries that start here is kept by RocksDB, beside the heap, unless the session names another provider.

    Every batch opens and commits every part of the state, so there are ``PARTS_A_CORE`` parts a core, if the session does not ask for fewer.
    """
    parts = min(int(spark.conf.get(PARTS)), PARTS_A_CORE * spark.sparkContext.defaultParallelism)
    names = {PARTS: str(parts)}
    if spark.conf.get(PROVIDER).endswith("HDFSBackedStateStoreProvider"):
        names |= {PROVIDER: ROCKS, f"{ROCKS_SETTING}.changelogCheckpointing.enabled": "true"}
    before = {name: spark.conf.get(name, None) for name in names}
    for name in before:
        spark.conf.set(name, names[name])
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def stream_reviews(
    rows: DataFrame, key: str, comment: str, output: str, checkpoint: str, factory: ClientFactory
) -> StreamingQuery:
    """Complete arriving rows, each key once whenever it arrives, and keep answers and errors as JSON text.

    Keys that have arrived are held by Spark's state store, which is written with the offsets: no batch lists or reads what
    earlier ones have answered, and a query that is started again goes on from both. Only the changes of a batch are
    written, so its cost follows its rows, not those before. A batch calls the model for its new rows and writes a folder of its number;
    one that is repeated meets the state as it was, and replaces itself. Nothing depends on the time of a row or on how many
    files a batch takes; the state grows by a key each. A null key is a key. :func:`read_answers` gives what is stored.
    """
    def answer(batch: DataFrame, batch_id: int) -> None:
        as_json(complete(batch, factory, comment=comment)).write.mode("overwrite").parquet(f"{output}/batch={batch_id}")

    new = rows.dropDuplicates([key])
    with _keys_on_disk(rows.sparkSession):
        return new.writeStream.foreachBatch(answer).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_answers(spark: SparkSession, output: str) -> DataFrame:
    """Every row that :func:`stream_reviews` has stored: the parsed answer, or the error that took its place."""
    stored = spark.read.parquet(output).drop("batch")
    error = F.from_json("error_json", "code string, message string")
    return parse(stored, every=True).withColumns({"error_code": error["code"], "error_message": error["message"]})


def read_stream(spark: SparkSession, folder: str, name: str, schema, files_per_batch: int = 1000) -> DataFrame:
    """A stream of the Parquet files of a folder that match ``name``."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", name)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )
