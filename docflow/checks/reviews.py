"""Registered queries of the review flow and of picture description."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow import schemas
from docflow.checks.shapes import REVIEWS, reviews, table
from docflow.checks.stub import StubClient
from docflow.functions import gate
from docflow.functions import text as T
from docflow.functions.messages import PROMPTS, REVIEW_PROMPT, REVIEW_SYSTEM, multimodal_messages, prompt_for
from docflow.operators.model import PAGE_PARAMS, complete_rows
from docflow.plans import images
from docflow.plans import reviews as plan
from docflow.session import fresh_path, write_once
from docflow.sources import files


def _kept(spark: SparkSession, sf: str) -> DataFrame:
    return reviews(spark, sf).filter(T.not_blank(F.col("comments")))


def _completed(spark: SparkSession, sf: str) -> DataFrame:
    return plan.complete(reviews(spark, sf), StubClient)


def filter_nonblank(spark, sf):
    return _kept(spark, sf).select("doc_id", "hotel", F.length("comments").cast("bigint").alias("n"))


def scan_delimited(spark, sf):
    path = fresh_path(spark, "reviews-csv")
    rows = reviews(spark, sf).select(
        F.col("doc_id").cast("string").alias("review_date"), "hotel", "highlights", "comments"
    )
    files.write_delimited(rows.filter(T.not_blank(F.col("comments"))), path)
    return files.read_delimited(spark, path, schemas.REVIEW, multi_line=True).select(
        "review_date", "hotel", "highlights", F.md5("comments").alias("digest")
    )


def scan_delimited_split(spark, sf):
    """The form whose files Spark splits among tasks: no field spans lines."""
    path = fresh_path(spark, "reviews-lines")
    one_line = F.translate("comments", "\n\r", "  ")
    rows = reviews(spark, sf).select(F.col("doc_id").cast("string").alias("review_date"), "hotel", "highlights", one_line.alias("comments"))
    files.write_delimited(rows.filter(T.not_blank(F.col("comments"))), path)
    return files.read_delimited(spark, path, schemas.REVIEW).select("review_date", "hotel", "highlights", F.md5("comments").alias("digest"))


def table_overwrite(spark, sf):
    path = fresh_path(spark, "enriched")
    files.overwrite_table(reviews(spark, sf), path)
    files.overwrite_table(plan.as_json(_completed(spark, sf)), path)
    return spark.read.parquet(path).select("doc_id", "hotel", F.md5("messages_json").alias("digest"), "error_json")


def messages_build(spark, sf):
    return plan.with_messages(_kept(spark, sf)).select(
        "doc_id", F.explode("messages").alias("m")
    ).select("doc_id", "m.role", F.md5("m.content").alias("digest"), "m.name")


def complete(spark, sf):
    return _completed(spark, sf).select(
        "doc_id",
        gate.finish_reason(F.col("chat_completions")).alias("finish_reason"),
        F.col("error.code").alias("error_code"),
        F.col("error.message").alias("error_message"),
    )


def project_nested_content(spark, sf):
    contents = _completed(spark, sf).select("doc_id", F.col("chat_completions.choices.message.content").alias("c"))
    return contents.select("doc_id", F.size("c").cast("bigint").alias("n"), F.array_join("c", "|").alias("content"))


def completions_to_json(spark, sf):
    return plan.as_json(_completed(spark, sf)).select("doc_id", "chat_completions_json", "error_json")


def parse_completions(spark, sf):
    return plan.parse(plan.as_json(_completed(spark, sf))).select(
        "doc_id", "output_role", "output_sentiment", "output_identified_action", "output_action_type"
    )


def completion_gate(spark, sf):
    response = F.col("chat_completions")
    answer = gate.payload_json(response, schemas.REVIEW_ANSWER)
    return _completed(spark, sf).select(
        "doc_id", answer["sentiment"].alias("sentiment"),
        F.when(answer.isNull(), F.coalesce(gate.finish_reason(response), F.lit("no choices"))).alias("problem"),
    )


def preview_topk(spark, sf):
    """The preview of the flow: its feature is the limit, made definite by an order."""
    return _kept(spark, sf).select("doc_id", "hotel").orderBy("doc_id").limit(20)


def sentiment_counts(spark, sf):
    """The whole flow: filter, prompt, complete, write once, parse, count."""
    stored = write_once(plan.as_json(_completed(spark, sf)), "reviews")
    return plan.parse(stored).groupBy("output_sentiment", "output_action_type").agg(F.count("*").alias("n"))


def _turns(spark, sf):
    """A turn of a conversation with its kind of prompt; every third carries a picture."""
    kinds = F.array(*[F.lit(k) for k in PROMPTS])
    url = T.data_url(F.lit("image/png"), F.concat(F.lit("p"), F.col("turn").cast("string")))
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", "text",
        F.get(kinds, (F.col("turn") % len(PROMPTS)).cast("int")).alias("kind"),
        F.when(F.col("conv_id") % 3 == 0, F.array(url)).otherwise(F.array().cast("array<string>")).alias("images"),
    )


def multimodal(spark, sf):
    prompt = F.when(F.col("conv_id") % 5 != 0, F.col("text"))
    made = _turns(spark, sf).select(
        "conv_id", "turn", multimodal_messages(prompt_for(F.col("kind")), F.col("images"), prompt, "high").alias("m")
    )
    flat = made.select("conv_id", "turn", F.posexplode("m").alias("pos", "m"))
    part = F.get("m.content", F.lit(0))
    return flat.select(
        "conv_id", "turn", F.col("pos").cast("bigint").alias("pos"), "m.role", part["type"].alias("type"),
        F.md5(F.coalesce(part["text"], part["image_url"]["url"])).alias("digest"),
        part["image_url"]["detail"].alias("detail"),
    )


def complete_pages(spark, sf):
    asked = _turns(spark, sf).withColumn(
        "messages", multimodal_messages(prompt_for(F.col("kind")), F.col("images"), F.col("text"), "high")
    )
    called = complete_rows(asked, factory=partial(StubClient, "page_summary"), params=PAGE_PARAMS)
    response = F.col("chat_completions")
    return called.select(
        "conv_id", "turn",
        gate.payload_json(response, "struct<page_summary:string>")["page_summary"].alias("summary"),
        gate.reported_reason(gate.finish_reason(response)).alias("reason"), F.col("error.code").alias("error_code"),
    )


def _pictures(spark, sf):
    extensions = F.array(*[F.lit(e) for e in ("png", "JPG", "tiff", "unknown")])
    return table(spark, sf, "pages").select(
        "page_id",
        F.concat(F.lit("files/a.b/page"), F.col("page_id").cast("string"), F.lit("."),
                 F.get(extensions, (F.col("page_id") % 4).cast("int"))).alias("path"),
        T.base64_text(F.encode("html", "UTF-8")).alias("payload"), T.base64_text(F.encode("url", "UTF-8")).alias("address"),
    )


def binary_to_data_url(spark, sf):
    url = T.data_url(T.mime_type(F.col("path")), F.col("payload"))
    return _pictures(spark, sf).select(
        "page_id", T.mime_type(F.col("path")).alias("mime"), F.length(url).cast("bigint").alias("n"), F.md5(url).alias("digest")
    )


def image_describe(spark, sf):
    """Each page's picture in an envelope of its own, twice; the second record is its address."""
    data = F.struct(F.struct(F.col("payload").alias("data")).alias("image"), T.mime_type(F.col("path")).alias("content_type"))
    short = F.struct(F.struct(F.col("address").alias("data")).alias("image"), F.lit("image/png").alias("content_type"))
    page = F.col("page_id").cast("string")
    requests = _pictures(spark, sf).select(
        "page_id",
        F.array(
            F.struct(F.concat(page, F.lit("-a")).alias("recordId"), data.alias("data")),
            F.struct(F.concat(page, F.lit("-b")).alias("recordId"), short.alias("data")),
        ).alias("values"),
    )
    answered = images.describe_requests(requests, "page_id", "You describe pictures.", StubClient)
    return answered.select("page_id", F.explode("values").alias("v")).select(
        "page_id", F.col("v.recordId").alias("record_id"), F.col("v.data.description").alias("description"), "v.errors"
    )


QUERIES = {
    "filter_nonblank": filter_nonblank,
    "scan_delimited": scan_delimited,
    "scan_delimited_split": scan_delimited_split,
    "table_overwrite_roundtrip": table_overwrite,
    "messages_build": messages_build,
    "complete_rows": complete,
    "project_nested_content": project_nested_content,
    "completions_to_json": completions_to_json,
    "parse_completions": parse_completions,
    "completion_gate": completion_gate,
    "preview_topk": preview_topk,
    "sentiment_counts": sentiment_counts,
    "multimodal_messages": multimodal,
    "complete_pages": complete_pages,
    "binary_to_data_url": binary_to_data_url,
    "image_describe": image_describe,
}


# ---------------------------------------------------------------- the same in SQL

def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_SYSTEM, _PROMPT = _quoted(REVIEW_SYSTEM), _quoted(REVIEW_PROMPT)

ANSWERED = f"""{REVIEWS},
sized AS (SELECT *, length(comments) + {len(REVIEW_PROMPT)} AS n FROM kept),
answered AS (
  SELECT *, n % 23 = 0 AS failed,
    CASE WHEN n % 23 <> 0 THEN CASE WHEN n % 17 = 0 THEN 'content_filter' ELSE 'stop' END END AS reason,
    CASE n % 3 WHEN 0 THEN 'positive' WHEN 1 THEN 'negative' ELSE 'neutral' END AS sentiment,
    CASE n % 3 WHEN 0 THEN 'continue' WHEN 1 THEN 'improve' ELSE 'N/A' END AS action_type,
    'action ' || (n % 7) AS action
  FROM sized),
written AS (
  SELECT *, '{{"sentiment": "' || sentiment || '", "identified_action": "' || action || '", "action_type": "'
         || action_type || '"}}' AS content
  FROM answered)"""

_MESSAGES_JSON = f"""'[{{"role":"system","content":' || to_json({_SYSTEM}) || ',"name":"system"}},{{"role":"user","content":'
  || to_json({_PROMPT} || comments) || ',"name":"user"}}]'"""
_ERROR_JSON = """CASE WHEN failed THEN '{"code":"429","message":"refused at length ' || n || '"}' END"""

_KINDS = "CASE turn % 4 " + " ".join(f"WHEN {i} THEN {_quoted(p)}" for i, p in enumerate(PROMPTS.values())) + " END"
_URL = "'data:image/png;base64,p' || turn"
_PATHS = """pictures AS (
  SELECT page_id, url, to_base64(encode(html)) AS payload,
    CASE page_id % 4 WHEN 0 THEN 'image/png' WHEN 1 THEN 'image/jpeg' WHEN 2 THEN 'image/tiff'
         ELSE 'application/octet-stream' END AS mime
  FROM pages)"""

ORACLE = {
    "filter_nonblank": f"WITH {REVIEWS} SELECT doc_id, hotel, length(comments) AS n FROM kept",
    "scan_delimited": f"""WITH {REVIEWS}
SELECT CAST(doc_id AS VARCHAR) AS review_date, hotel, highlights, md5(comments) AS digest FROM kept""",
    "scan_delimited_split": f"""WITH {REVIEWS}
SELECT CAST(doc_id AS VARCHAR) AS review_date, hotel, highlights, md5(translate(comments, chr(10) || chr(13), '  ')) AS digest FROM kept""",
    "table_overwrite_roundtrip": f"""WITH {ANSWERED}
SELECT doc_id, hotel, md5({_MESSAGES_JSON}) AS digest, {_ERROR_JSON} AS error_json FROM written""",
    "messages_build": f"""WITH {REVIEWS}
SELECT doc_id, 'system' AS role, md5({_SYSTEM}) AS digest, 'system' AS name FROM kept
UNION ALL SELECT doc_id, 'user', md5({_PROMPT} || comments), 'user' FROM kept""",
    "complete_rows": f"""WITH {ANSWERED}
SELECT doc_id, reason AS finish_reason, CASE WHEN failed THEN '429' END AS error_code,
       CASE WHEN failed THEN 'refused at length ' || n END AS error_message FROM written""",
    "project_nested_content": f"""WITH {ANSWERED}
SELECT doc_id, CASE WHEN NOT failed THEN CAST(1 AS BIGINT) END AS n, CASE WHEN NOT failed THEN content END AS content
FROM written""",
    "completions_to_json": f"""WITH {ANSWERED}
SELECT doc_id, CASE WHEN NOT failed THEN '{{"choices":[{{"message":{{"role":"assistant","content":' || to_json(content)
       || '}},"finish_reason":"' || reason || '"}}]}}' END AS chat_completions_json, {_ERROR_JSON} AS error_json
FROM written""",
    "parse_completions": f"""WITH {ANSWERED}
SELECT doc_id, 'assistant' AS output_role, sentiment AS output_sentiment, action AS output_identified_action,
       action_type AS output_action_type FROM written WHERE NOT failed""",
    "completion_gate": f"""WITH {ANSWERED}
SELECT doc_id, CASE WHEN reason = 'stop' THEN sentiment END AS sentiment,
       CASE WHEN failed THEN 'no choices' WHEN reason <> 'stop' THEN reason END AS problem FROM written""",
    "preview_topk": f"WITH {REVIEWS} SELECT doc_id, hotel FROM kept ORDER BY doc_id LIMIT 20",
    "sentiment_counts": f"""WITH {ANSWERED}
SELECT sentiment AS output_sentiment, action_type AS output_action_type, count(*) AS n
FROM written WHERE NOT failed GROUP BY ALL""",
    "multimodal_messages": f"""WITH t AS (
  SELECT conv_id, turn, {_KINDS} AS system, CASE WHEN conv_id % 3 = 0 THEN {_URL} END AS url,
         CASE WHEN conv_id % 5 <> 0 AND length(text) > 0 THEN text END AS prompt FROM conversations)
SELECT conv_id, turn, CAST(0 AS BIGINT) AS pos, 'system' AS role, 'text' AS type, md5(system) AS digest, NULL AS detail FROM t
UNION ALL SELECT conv_id, turn, 1, 'user', 'image_url', md5(url), 'high' FROM t WHERE url IS NOT NULL
UNION ALL SELECT conv_id, turn, CASE WHEN url IS NULL THEN 1 ELSE 2 END, 'user', 'text', md5(prompt), NULL
FROM t WHERE prompt IS NOT NULL""",
    "complete_pages": f"""WITH t AS (
  SELECT conv_id, turn, CASE WHEN conv_id % 3 = 0 THEN {_URL} ELSE '' END || text AS said FROM conversations)
SELECT conv_id, turn,
  CASE WHEN length(said) % 23 <> 0 AND length(said) % 17 <> 0 THEN 'page_summary ' || substr(md5(said), 1, 8) END AS summary,
  CASE WHEN length(said) % 23 <> 0 AND length(said) % 17 = 0 THEN 'content_filter' END AS reason,
  CASE WHEN length(said) % 23 = 0 THEN '429' END AS error_code
FROM t""",
    "binary_to_data_url": f"""WITH {_PATHS}
SELECT page_id, mime, length('data:' || mime || ';base64,' || payload) AS n,
       md5('data:' || mime || ';base64,' || payload) AS digest FROM pictures""",
    "image_describe": f"""WITH {_PATHS}, records AS (
  SELECT page_id, page_id || '-a' AS record_id, length('Describe this picture:data:' || mime || ';base64,' || payload) AS n FROM pictures
  UNION ALL SELECT page_id, page_id || '-b', length('Describe this picture:data:image/png;base64,' || to_base64(encode(url))) FROM pictures)
SELECT page_id, record_id,
  CASE WHEN n % 23 = 0 THEN 'finish_reason:None' WHEN n % 17 = 0 THEN 'finish_reason:content_filter'
       ELSE 'A picture of ' || n || ' characters' END AS description,
  CASE WHEN n % 23 = 0 THEN 'refused at length ' || n END AS errors FROM records""",
}
