"""Layout results (content, tables, paragraphs) to a map of text and table rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.operators.scan import Running, running
from docflow.operators.tables import table_html
from docflow.session import write_once


def _span_end(span: Column) -> Column:
    return span["offset"] + span["length"] - 1


def _exploded(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Outer explode and filter: a plain explode would have the computed array computed twice."""
    return rows.select(*keys, F.explode_outer("_rows").alias("_r")).filter(F.col("_r").isNotNull()).select(*keys, "_r.*")


def _piece(wide: Column, offset: Column, length: Column) -> Column:
    """``substr`` of a text that is given as UTF-32: a character is found by its place, without a walk from the text's start.

    A mark goes before the piece, as the reader takes the first one for the order of bytes and drops it.
    """
    at = (offset + 1).cast("int")
    cut = F.substr(wide, F.when(at > 0, 4 * at - 3).otherwise(4 * at), 4 * length.cast("int"))
    return F.decode(F.concat(F.unhex(F.lit("0000FEFF")), cut), "UTF-32")


def paragraphs_of(layout: DataFrame, keys: list[str]) -> DataFrame:
    """One row per paragraph with its text, cut from the content before rows are multiplied."""
    def row(wide: Column) -> Callable[[Column, Column], Column]:
        def made(p: Column, i: Column) -> Column:
            span = F.get(p["spans"], F.lit(0))
            return F.struct(
                i.cast("bigint").alias("idx"),
                span["offset"].alias("start"),
                _span_end(span).alias("end"),
                p["role"].alias("role"),
                F.get(p["boundingRegions"], F.lit(0))["pageNumber"].cast("bigint").alias("page"),
                _piece(wide, span["offset"], span["length"]).alias("text"),
            )

        return made

    # the content as UTF-32 is bound once a document; named in the inner lambda it would be made anew for each paragraph
    bound = F.transform(F.array(F.encode("content", "UTF-32")), lambda wide: F.transform("paragraphs", row(wide)))
    return _exploded(layout.select(*keys, F.get(bound, F.lit(0)).alias("_rows")), keys)


def tables_of(layout: DataFrame, keys: list[str]) -> DataFrame:
    """One row per table: least offset, and the first span's end plus the lengths of the others less one each."""
    def row(t: Column, i: Column) -> Column:
        others = F.slice(t["spans"], F.lit(2), F.greatest(F.size(t["spans"]), F.lit(1)))
        return F.struct(
            i.cast("bigint").alias("idx"),
            F.array_min(F.transform(t["spans"], lambda s: s["offset"])).alias("start"),
            F.aggregate(
                others, _span_end(F.get(t["spans"], F.lit(0))), lambda acc, s: acc + s["length"] - 1
            ).alias("end"),
            t["rowCount"].alias("row_count"),
        )

    rows = layout.select(*keys, F.transform("tables", row).alias("_rows"))
    return _exploded(rows, keys)


def cells_of(layout: DataFrame, keys: list[str]) -> DataFrame:
    tables = layout.select(*keys, F.posexplode("tables").alias("idx", "_t"))
    return tables.select(
        *keys, F.col("idx").cast("bigint").alias("idx"), F.explode("_t.cells").alias("_c")
    ).select(
        *keys,
        "idx",
        F.col("_c.rowIndex").alias("row_index"),
        F.col("_c.columnIndex").alias("column_index"),
        F.col("_c.kind").alias("kind"),
        F.col("_c.columnSpan").alias("column_span"),
        F.col("_c.rowSpan").alias("row_span"),
        F.col("_c.content").alias("content"),
    )


def _elements(paragraphs: DataFrame, tables: DataFrame, keys: list[str]) -> DataFrame:
    def shaped(df: DataFrame, kind: str, order: int) -> DataFrame:
        role = F.col("role") if "role" in df.columns else F.lit(None).cast("string")
        page = F.col("page") if "page" in df.columns else F.lit(None).cast("bigint")
        return df.select(
            *keys, F.lit(kind).alias("kind"), "idx", "start", "end", role.alias("role"), page.alias("page"),
            F.lit(order).alias("_order"),
        )

    return shaped(paragraphs, "paragraph", 1).unionByName(shaped(tables, "table", 0))


def classify(paragraphs: DataFrame, tables: DataFrame, keys: list[str], block: int = 32_768) -> DataFrame:
    """Paragraphs and tables with their class.

    A paragraph lies in a table if one that starts no later ends no earlier than it
    starts, so a running maximum of table ends stands in for a range join.
    """
    covered = running(
        _elements(paragraphs, tables, keys),
        keys,
        "start",
        {"_covered": Running("max", F.when(F.col("kind") == "table", F.col("end")))},
        tie=["_order", "idx"],
        block=block,
    )
    role = F.col("role")
    return covered.select(
        *keys, "kind", "idx", "start", "end", "page",
        F.when(F.col("kind") == "table", "table")
        .when(F.col("_covered") >= F.col("start"), "in_table")
        .when(role.isNull(), "text")
        .when(role == "title", "title")
        .when(role == "sectionHeading", "heading")
        .otherwise("dropped")
        .alias("class"),
    )


def document_map(
    paragraphs: DataFrame, tables: DataFrame, cells: DataFrame, keys: list[str], block: int = 32_768
) -> DataFrame:
    """Text and table rows with titles, section and page.

    Scans run over narrow rows; texts are joined to their results at the end. A scan
    reads its input twice, so rows are written between scans: texts are cut from the
    layout results once, however many scans follow, and these read no texts.
    """
    written = write_once(paragraphs.select(*keys, "idx", "start", "end", "role", "page", "text"), "paragraphs")
    spans = written.drop("text")
    narrow_tables = write_once(tables.select(*keys, "idx", "start", "end"), "table-spans")
    classed = write_once(classify(spans, narrow_tables, keys, block), "classes")
    elements = classed.filter(F.col("class").isin("text", "table", "title", "heading"))

    # page of the last paragraph that starts at or before the end of the element
    probes = elements.select(
        *keys, "kind", "idx", "start", "class", F.col("end").alias("_at"),
        F.lit(None).cast("bigint").alias("page"), F.lit(1).alias("_order"),
    )
    marks = spans.select(
        *keys, F.lit("mark").alias("kind"), "idx", "start", F.lit("mark").alias("class"),
        F.col("start").alias("_at"), "page", F.lit(0).alias("_order"),
    )
    paged = write_once(
        running(
            probes.unionByName(marks), keys, "_at", {"_page": Running("last", F.col("page"))},
            tie=["_order", "idx", "kind"], block=block,
        )
        .filter(F.col("_order") == 1)
        .select(*keys, "kind", "idx", "start", "class", F.coalesce("_page", F.lit(0)).cast("bigint").alias("page_number")),
        "element-pages",
    )

    headed = written.filter(F.col("role").isin("title", "sectionHeading") & F.col("text").isNotNull())
    names = headed.select(*keys, "idx", F.col("text").alias("_text"))
    named = write_once(paged.filter(F.col("class").isin("title", "heading")).join(names, [*keys, "idx"]), "headings")
    titles = named.filter(F.col("class") == "title")
    firsts = titles.groupBy(*keys).agg(F.min("start").alias("start")).withColumn("_first", F.lit(True))
    grown = running(
        titles.join(firsts, [*keys, "start"], "left").filter(F.col("_first") | (F.col("page_number") == 1)),
        keys, "start", {"_main": Running("join", F.col("_text"), separator="; ")}, block=block,
    ).select(*keys, "start", "_main")

    body = paged.filter(F.col("class").isin("text", "table"))
    rows = body.withColumns(
        {"_title": F.lit(None).cast("string"), "_section": F.lit(None).cast("string"), "_main": F.lit(None).cast("string")}
    ).unionByName(
        named.join(grown, [*keys, "start"], "left").select(
            *keys, "kind", "idx", "start", "class", "page_number",
            F.when(F.col("class") == "title", F.col("_text")).alias("_title"),
            F.when(F.col("class") == "heading", F.col("_text")).alias("_section"),
            "_main",
        )
    )
    placed = running(
        rows, keys, "start",
        {
            "title": Running("last", F.col("_main")),
            "subtitle": Running("last", F.col("_title")),
            "section": Running("last", F.col("_section")),
        },
        block=block,
    ).filter(F.col("class").isin("text", "table"))

    counts = tables.select(*keys, "idx", "row_count") if "row_count" in tables.columns else None
    bodies = written.select(*keys, F.lit("paragraph").alias("kind"), "idx", F.col("text").alias("_text"))
    texts = bodies.unionByName(
        table_html(cells, [*keys, "idx"], counts).select(*keys, F.lit("table").alias("kind"), "idx", F.col("html").alias("_text"))
    )
    blank = F.lit("")
    return placed.join(texts, [*keys, "kind", "idx"], "left").select(
        *keys,
        F.col("start").alias("offset"),
        F.coalesce("_text", blank).alias("text"),
        F.col("class").alias("type"),
        F.coalesce("title", blank).alias("title"),
        F.coalesce("subtitle", blank).alias("subtitle"),
        F.coalesce("section", blank).alias("section"),
        "page_number",
    )


def layout_map(layout: DataFrame, keys: list[str], block: int = 32_768) -> DataFrame:
    """Document map straight from layout results, one row per document."""
    return document_map(paragraphs_of(layout, keys), tables_of(layout, keys), cells_of(layout, keys), keys, block)


def overlaps(paragraphs: DataFrame, tables: DataFrame, keys: list[str], block: int = 32_768) -> DataFrame:
    """Paragraphs outside tables that start before an earlier one ends: the map does not define their order."""
    free = classify(paragraphs, tables, keys, block).filter(F.col("class").isin("text", "title", "heading"))
    seen = running(
        free, keys, "start", {"_end": Running("max", F.col("end"), inclusive=False)}, tie=["idx"], block=block
    )
    return seen.filter(F.col("_end") >= F.col("start")).select(*keys, "idx", "start", "end")
