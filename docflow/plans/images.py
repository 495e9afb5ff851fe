"""Picture description: request envelopes in, response envelopes out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.functions.gate import described
from docflow.functions.messages import image_messages
from docflow.functions.text import data_url
from docflow.operators.model import IMAGE_PARAMS, ClientFactory, complete_rows
from docflow.session import write_once


def describe_records(records: DataFrame, system: str, factory: ClientFactory) -> DataFrame:
    """Description and error of every picture; ``records`` has ``mime`` and ``payload`` (base64)."""
    asked = records.withColumn("messages", image_messages(F.lit(system), data_url(F.col("mime"), F.col("payload"))))
    called = complete_rows(
        asked.drop("payload"), factory=factory, params=IMAGE_PARAMS
    ).drop("messages")
    return called.withColumns(
        {"description": described(F.col("chat_completions")), "errors": F.col("error.message")}
    ).drop("chat_completions", "error")


def describe_requests(requests: DataFrame, key: str, system: str, factory: ClientFactory) -> DataFrame:
    """One response envelope per request envelope, with one result per record, in the order of the records.

    An envelope holds what one call may send, so its records fit into one row again.
    """
    records = requests.select(key, F.posexplode("values").alias("_pos", "_v")).select(
        key, "_pos", F.col("_v.recordId").alias("record_id"), F.col("_v.data.content_type").alias("mime"),
        F.col("_v.data.image.data").alias("payload"),
    )
    results = write_once(describe_records(records, system, factory), "pictures")
    value = F.struct(
        F.col("record_id").alias("recordId"),
        F.struct("description").alias("data"),
        "errors",
        F.lit(None).cast("string").alias("warnings"),
    )
    answers = results.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_pos", value.alias("value")))).alias("_l"))
    empty = F.array().cast(
        "array<struct<recordId:string,data:struct<description:string>,errors:string,warnings:string>>"
    )
    return requests.select(key).join(answers, key, "left").select(
        key, F.coalesce(F.transform("_l", lambda x: x["value"]), empty).alias("values")
    )
