"""Registered queries on arriving data; each gives what the batch form gives."""

from __future__ import annotations

from pyspark.sql import functions as F

from docflow.checks import pages, shapes
from docflow.functions.messages import REVIEW_PROMPT
from docflow.checks.stub import StubClient
from docflow.operators.upsert import read_table
from docflow.session import fresh_path
from docflow.streaming.flows import read_answers, read_stream, stream_chunks, stream_reviews


def stream_chunk_upsert(spark, sf):
    """Documents arrive in several files, a batch each; some arrive twice."""
    source, index = fresh_path(spark, "arriving"), fresh_path(spark, "index")
    documents = shapes.table(spark, sf, "documents")
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2))
    documents.withColumn("half", half).write.partitionBy("half").parquet(source)
    documents.filter(F.col("doc_id") % 4 == 0).withColumn("half", F.lit(2)).write.partitionBy("half").mode("append").parquet(source)
    arriving = read_stream(spark, f"{source}/half=*", "*.parquet", documents.schema, files_per_batch=1)
    stream_chunks(
        arriving, index, fresh_path(spark, "offsets"), shapes.USER, pages.IMAGES,
        prepare=lambda batch: shapes.to_extracts(shapes.paged(batch)),
    ).awaitTermination()
    return read_table(spark, index, ["id"]).withColumn("text_content", F.md5("text_content"))


def stream_enrich(spark, sf):
    """Events as short comments, newest first, a file a batch; a fifth of them arrives twice and is answered once."""
    source, output = fresh_path(spark, "events"), fresh_path(spark, "answers")
    events = shapes.table(spark, sf, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), F.concat_ws(" ", "event_type", "props", F.pow(F.lit(2), F.col("event_id") % 61).cast("bigint").cast("string")).alias("comments")
    )
    for late in range(3):
        events.filter(F.pmod(F.datediff(F.lit("2100-01-01"), "ts"), F.lit(3)) == late).write.mode("append").parquet(source)
    events.filter(F.col("event_id") % 5 == 0).write.mode("append").parquet(source)
    arriving = read_stream(spark, source, "*.parquet", events.schema, files_per_batch=1)
    stream_reviews(arriving, "event_id", "comments", output, fresh_path(spark, "offsets"), StubClient).awaitTermination()
    return read_answers(spark, output).select("event_id", "output_sentiment", "output_action_type", "error_code")


QUERIES = {"stream_chunk_upsert": stream_chunk_upsert, "stream_enrich": stream_enrich}

ORACLE = {
    "stream_chunk_upsert": pages.ORACLE["chunk_build"],
    "stream_enrich": f"""WITH e AS (SELECT event_id, length(event_type || ' ' || props || ' ' || CAST(pow(2, event_id % 61) AS BIGINT)) + {len(REVIEW_PROMPT)} AS n FROM events)
SELECT event_id, CASE WHEN n % 23 = 0 THEN NULL WHEN n % 3 = 0 THEN 'positive' WHEN n % 3 = 1 THEN 'negative' ELSE 'neutral' END AS output_sentiment,
  CASE WHEN n % 23 = 0 THEN NULL WHEN n % 3 = 0 THEN 'continue' WHEN n % 3 = 1 THEN 'improve' ELSE 'N/A' END AS output_action_type,
  CASE WHEN n % 23 = 0 THEN '429' END AS error_code
FROM e""",
}
