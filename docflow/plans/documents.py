"""Documents: pages to extracts (title, summaries, contents), and extracts to chunks with vectors in an index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow import schemas
from docflow.functions import gate
from docflow.functions.messages import multimodal_messages, prompt_for
from docflow.operators.chunks import build_chunks, embed_chunks
from docflow.operators.model import PAGE_PARAMS, ClientFactory, complete_rows
from docflow.operators.pages import enrich_pages, fill_sections, first_pages, group_values, join_texts, require_complete
from docflow.operators.upload import SearchFactory, send
from docflow.operators.upsert import upsert_table
from docflow.session import write_once
from docflow.sources import files

ANSWERS = {
    "title": "document_title",
    "page_summary": "page_summary",
    "document_summary": "document_summary",
    "content": "content",
}


def ask(
    df: DataFrame, kind: str, images: Column, prompt: Column, keep: list[str], factory: ClientFactory, detail: str = "high"
) -> DataFrame:
    """One call per row; the answer is written once beside the columns to keep, so that later steps read it."""
    messages = multimodal_messages(prompt_for(F.lit(kind)), images, prompt, detail)
    called = complete_rows(
        df.select(*keep, messages.alias("messages")), factory=factory, params=PAGE_PARAMS
    )
    return write_once(called.drop("messages"), kind)


def extract(
    pages: DataFrame, factory: ClientFactory, key: str = "doc_id", seq: str = "page_sequence_number",
    url: str = "image_url", title_pages: int = 3, summary_pages: int = 10,
) -> DataFrame:
    """Page extracts of all documents at once.

    ``pages`` has a dense page number from 1 and the data URL of each page. Four
    passes of calls: titles, summaries per page group, a summary of summaries, and
    contents per page. A failed call leaves its field blank and its reason kept.
    """
    none = F.lit(None).cast("string")
    no_images = F.array().cast("array<string>")
    response = F.col("chat_completions")

    def answer(kind: str) -> Column:
        field = ANSWERS[kind]
        return gate.payload_json(response, f"struct<{field}:string>")[field]

    titles = ask(first_pages(pages, [key], seq, url, title_pages), "title", F.col(url + "s"), none, [key], factory).select(
        key,
        F.coalesce(answer("title"), F.lit("")).alias("document_title"),
        gate.reported_reason(gate.finish_reason(response)).alias("extract_title_finish_reason"),
    )

    grouped = group_values(
        pages.withColumn("_grp", F.floor((F.col(seq) - 1) / F.lit(summary_pages)).cast("bigint")), [key, "_grp"], seq, url
    )
    parts = ask(grouped, "page_summary", F.col(url + "s"), none, [key, "_grp"], factory).select(
        key, "_grp", answer("page_summary").alias("_summary"), gate.finish_reason(response).alias("_reason")
    )
    reasons = parts.groupBy(key).agg(
        gate.reported_reason(F.max_by("_reason", "_grp")).alias("page_summary_finish_reason")
    )
    joined = join_texts(parts, [key], "_grp", "_summary", "_joined")
    summaries = ask(joined, "document_summary", no_images, F.col("_joined"), [key], factory).select(
        key,
        F.coalesce(answer("document_summary"), F.lit("")).alias("document_summary"),
        gate.reported_reason(gate.finish_reason(response)).alias("document_summary_finish_reason"),
    )
    documents = titles.join(reasons, key).join(summaries, key)

    kept = [c for c in pages.columns if c != url]
    contents = ask(pages, "content", F.array(url), none, kept, factory)
    content = gate.payload_json(response, schemas.PAGE_ANSWER)
    bodies = contents.select(
        *kept,
        content.alias("_c"),
        gate.reported_reason(gate.finish_reason(response)).alias("llm_extract_content_finish_reason"),
    ).select("*", "_c.*").drop("_c")
    return enrich_pages(bodies, documents, key, seq)


def upload(
    pages: DataFrame, listed: DataFrame, user_id: str, image_dir: str, embed, factory: SearchFactory, table: str, export: str,
    fill: bool = True,
) -> DataFrame:
    """Loaded page extracts to chunks with vectors: exported, merged into the index table, and sent.

    Stops if a page of ``listed`` (``file_path, page_sequence_number``) is not loaded. Sections are filled unless
    that has been done before. Returns per chunk whether the service took it. Every step reads what the one before wrote.
    """
    require_complete(listed, pages, ["file_path", "page_sequence_number"])
    filled = fill_sections(pages, ["file_path"]).drop("changed") if fill else pages
    chunks = write_once(build_chunks(filled, user_id, image_dir), "chunks")
    ready = write_once(embed_chunks(chunks, embed), "vectors")
    files.write_chunks(ready, export)
    upsert_table(pages.sparkSession, table, ready.withColumn("_order", F.lit(0)), ["id"], "_order", stored=True)
    return write_once(send(ready, ["id", "file_name"], factory), "sent")
