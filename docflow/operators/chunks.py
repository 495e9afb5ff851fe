"""Search chunks out of pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.functions import text as T
from docflow.operators.skew import lookup, salt_of, value_table

VECTORS = {"section": "section_vector", "parent_section": "parent_section_vector", "text_content": "text_content_vector"}


def chunk_id(owner: Column, file_name: Column, page: Column, item: Column) -> Column:
    return T.urlsafe_encode(F.concat_ws("_", owner, file_name, page.cast("string"), item.cast("string")))


def build_chunks(pages: DataFrame, user_id: str, image_dir: str, id_prefix: str | None = None) -> DataFrame:
    """One row per item that has text, in the layout of the search index without the vectors.

    ``pages`` holds a page extract per row plus ``file_path`` and ``extract_path``.
    Items are numbered before blank ones are dropped. ``id_prefix`` replaces the
    user in the id. Nothing is shuffled. (An outer explode is used as a plain one has
    the optimizer test the size of the array first, and so compute the array twice.)
    """
    page = pages.select(
        "file_path",
        "extract_path",
        T.base_name(F.col("file_path")).alias("file_name"),
        T.missing_to_blank(F.col("page_header")).alias("_header"),
        T.missing_to_blank(F.col("page_footer")).alias("_footer"),
        T.printed_page_number(F.col("page_number")).alias("page_number"),
        T.missing_to_blank(F.col("document_title")).alias("extracted_title"),
        T.missing_to_blank(F.col("document_summary")).alias("document_summary"),
        F.coalesce("page_sequence_number", F.lit(0)).cast("bigint").alias("page_sequence_number"),
        F.posexplode_outer("page_content").alias("_pos", "_item"),
    ).filter(T.has_text(F.col("_item")["text"]))
    item = F.col("_item")
    parts = page.withColumns(
        {
            "section": T.missing_to_blank(item["section_name"]),
            "parent_section": T.missing_to_blank(item["parent_section_name"]),
            "_image": T.missing_to_blank(item["image_diagram_summary"]),
        }
    )
    return parts.select(
        chunk_id(
            F.lit(user_id if id_prefix is None else id_prefix),
            F.col("file_name"),
            F.col("page_sequence_number"),
            F.col("_pos") + 1,
        ).alias("id"),
        "file_name",
        "file_path",
        "extracted_title",
        "section",
        "parent_section",
        T.chunk_text(
            F.col("_header"),
            F.col("extracted_title"),
            F.col("document_summary"),
            F.col("parent_section"),
            F.col("section"),
            item["text"],
            F.col("_image"),
            F.col("_footer"),
            F.col("page_number"),
            F.col("page_sequence_number"),
        ).alias("text_content"),
        T.is_true(item["contains_image_diagam"]).alias("image_flag"),
        "page_sequence_number",
        "page_number",
        T.page_image_path(image_dir, F.col("file_path"), F.col("extract_path")).alias("page_image_path"),
        "document_summary",
        F.lit(user_id).alias("user_id"),
    )


def embed_chunks(chunks: DataFrame, embed, spread: Column | None = None) -> DataFrame:
    """Add the three vectors of a chunk and, in ``vector_errors``, what went wrong; a blank text has an empty vector.

    Section names repeat much, as sections and as parents: each distinct name is
    embedded once. Only ids and names meet the vectors; the chunks are joined with what was found in one step, by id.
    Chunk texts hardly repeat and are embedded where they lie, last, so that their vectors are never shuffled.
    ``chunks`` must have unique ids; it is read several times and is best a written table. Write the result before it
    is used twice.
    """
    spread = salt_of(F.col("id")) if spread is None else spread
    names = {"section": "_section", "parent_section": "_parent"}
    keys = chunks.select("id", *[F.nullif(F.col(name), F.lit("")).alias(key) for name, key in names.items()])
    vectors = value_table(keys, list(names.values()), "_vector", embed)
    empty = F.array().cast("array<float>")
    sides = keys.select("id", F.explode(F.array(*[F.struct(F.lit(n).alias("side"), F.col(k).alias("value")) for n, k in names.items()])).alias("s"))
    found = lookup(sides.select("id", "s.*").filter("value is not null"), vectors, ["value"], spread, "inner")
    found = found.groupBy("id").agg(
        *[F.max_by("_vector", F.when(F.col("side") == n, 1)).alias(k) for n, k in names.items()]
    )
    out = chunks.join(found, "id", "left").withColumn("_text", embed(F.col("text_content")))
    columns = {VECTORS[n]: F.coalesce(F.col(k)["vector"], empty) for n, k in [*names.items(), ("text_content", "_text")]}
    errors = F.array_compact(F.array(*[F.col(k)["error"] for k in [*names.values(), "_text"]]))
    return out.withColumns({**columns, "vector_errors": F.nullif(F.array_join(errors, "; "), F.lit(""))}).drop(*names.values(), "_text")
