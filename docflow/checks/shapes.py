"""How the given tables take the shape of the flows' inputs, in Spark and as SQL for the comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.functions.text import MISSING
from docflow.session import spread

USER = "user1@example.com"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# ---------------------------------------------------------------- reviews

def reviews(spark: SparkSession, sf: str) -> DataFrame:
    """A document is a review; some comments are blank, some absent."""
    comment = (
        F.when(F.col("doc_id") % 10 == 3, F.lit("  "))
        .when(F.col("doc_id") % 25 == 7, F.lit(None))
        .otherwise(F.col("text"))
    )
    return spread(table(spark, sf, "documents").select("doc_id", "text", "lang", "source")).select(
        "doc_id", F.col("source").alias("hotel"), F.col("lang").alias("highlights"), comment.alias("comments")
    )


REVIEWS = """reviews AS (
  SELECT doc_id, source AS hotel, lang AS highlights,
         CASE WHEN doc_id % 10 = 3 THEN '  ' WHEN doc_id % 25 = 7 THEN NULL ELSE text END AS comments
  FROM documents),
kept AS (SELECT * FROM reviews WHERE length(rtrim(comments, ' ')) > 0)"""


# ---------------------------------------------------------------- pages

PAGE_LINES = 10


def _item(line):
    n = F.length(line)
    missing = F.lit(MISSING)
    return F.struct(
        F.when(n % 4 == 0, F.substring(line, 1, 12)).otherwise(missing).alias("section_name"),
        F.when(n % 7 == 0, F.substring(line, 1, 8)).otherwise(missing).alias("parent_section_name"),
        F.when(n % 11 == 0, missing).otherwise(line).alias("text"),
        F.when(n % 5 == 0, F.concat(F.lit("figure of "), n.cast("string"))).otherwise(missing).alias("image_diagram_summary"),
        F.when(n % 3 == 0, F.lit("true")).when(n % 3 == 1, F.lit(" TRUE ")).otherwise(F.lit("false")).alias("contains_image_diagam"),
        F.lit("false").alias("contains_table"),
    )


def page_lines(spark: SparkSession, sf: str) -> DataFrame:
    return paged(spread(table(spark, sf, "documents").select("doc_id", "text", "lang", "source")))


def paged(documents: DataFrame) -> DataFrame:
    """Ten lines make a page: one row per page with its lines, made inside the document's row."""
    lines = F.split("text", "\n")
    starts = F.sequence(F.lit(0), F.floor((F.size("_lines") - 1) / F.lit(PAGE_LINES)).cast("int"))
    return (
        documents.select("doc_id", "lang", "source", lines.alias("_lines"))
        .select(
            "doc_id", "lang", "source",
            F.posexplode(F.transform(starts, lambda i: F.slice("_lines", i * PAGE_LINES + 1, PAGE_LINES))).alias("_p", "lines"),
        )
        .select("doc_id", "lang", "source", (F.col("_p") + 1).cast("bigint").alias("page_sequence_number"), "lines")
    )


def extracts(spark: SparkSession, sf: str) -> DataFrame:
    """Page extracts: a line is an item; some pages are empty, some have no items at all."""
    return to_extracts(page_lines(spark, sf))


def to_extracts(pages: DataFrame) -> DataFrame:
    page, doc = F.col("page_sequence_number"), F.col("doc_id")
    mark = doc + page
    items = F.transform("lines", _item)
    name = F.concat(F.lit("doc "), doc.cast("string"), F.lit(".pdf"))
    return pages.select(
        "doc_id",
        F.concat(F.lit("in/"), name).alias("file_path"),
        F.concat(F.lit("extracts/"), name, F.lit("_page_"), page.cast("string"), F.lit(".png.json")).alias("extract_path"),
        F.when(mark % 13 == 0, F.slice(items, 1, 0)).when(mark % 17 != 0, items).alias("page_content"),
        F.when(page % 2 == 1, F.lit(MISSING)).otherwise(F.concat(F.lit("header "), "lang")).alias("page_header"),
        F.when(page % 3 == 1, F.lit(" [missing] ")).otherwise(F.concat(F.lit("footer "), "source")).alias("page_footer"),
        F.when(page % 5 == 0, "iv").when(page % 7 == 0, " 12").when(page % 6 == 0, MISSING)
        .otherwise(page.cast("string")).alias("page_number"),
        F.when(doc % 9 == 0, MISSING).otherwise(F.concat(F.lit("title "), doc.cast("string"))).alias("document_title"),
        F.when(doc % 8 == 0, MISSING).otherwise(F.concat(F.lit("summary "), doc.cast("string"))).alias("document_summary"),
        "page_sequence_number",
    )


# ---------------------------------------------------------------- layout results

def layout(spark: SparkSession, sf: str) -> DataFrame:
    """A line is a paragraph with its place in the text; every ninth line is a table, every second of these
    with a second span on the line after it."""
    spans = "array<struct<offset:bigint,length:bigint>>"

    def rows(s: Column) -> Column:
        lengths = s["n"]
        return F.transform(
            s["l"],
            lambda line, i: F.struct(
                i.cast("bigint").alias("i"),
                (F.aggregate(F.slice(lengths, F.lit(1), i), F.lit(0), lambda a, n: a + n) + i).cast("bigint").alias("o"),
                F.get(lengths, i).cast("bigint").alias("n"),
                line.alias("line"),
            ),
        )

    # lines and lengths are bound as s: a column that a lambda names once is put into it, and texts were split anew for each line
    bound = lambda value, f: F.get(F.transform(F.array(value), f), F.lit(0))
    split = bound(F.split("text", "\n"), lambda l: F.struct(l.alias("l"), F.transform(l, F.length).alias("n")))
    placed = (
        spread(table(spark, sf, "documents").select("doc_id", "text"))
        .select("doc_id", F.col("text").alias("content"), bound(split, rows).alias("_every"))
        .withColumn("_rows", F.filter("_every", lambda r: r["n"] > 0))
    )
    role = lambda r: (
        F.when((r["i"] == 0) | (r["i"] % 50 == 5), "title")
        .when(r["i"] % 13 == 4, "pageHeader")
        .when(r["n"] < 30, "sectionHeading")
    )
    span = lambda r: F.struct(r["o"].alias("offset"), r["n"].alias("length"))
    paragraphs = F.transform(
        "_rows",
        lambda r: F.struct(
            F.array(span(r)).alias("spans"),
            role(r).alias("role"),
            F.array(F.struct(F.floor(r["i"] / 10 + 1).cast("int").alias("pageNumber"))).alias("boundingRegions"),
        ),
    )

    def cell(row: int, column: int, kind: str | None, width: int | None, content) -> Column:
        return F.struct(
            F.lit(row).alias("rowIndex"), F.lit(column).alias("columnIndex"), F.lit(kind).cast("string").alias("kind"),
            F.lit(width).cast("int").alias("columnSpan"), F.lit(None).cast("int").alias("rowSpan"),
            content.cast("string").alias("content"),
        )

    def made(r):
        after = F.filter(F.slice("_every", (r["i"] + 2).cast("int"), F.lit(1)), lambda x: (x["n"] > 0) & (r["i"] % 18 == 17))
        return F.struct(
            F.concat(F.array(span(r)), F.transform(after, span)).cast(spans).alias("spans"),
            F.lit(2).alias("rowCount"),
            F.array(
                cell(1, 1, None, 2, r["i"]), cell(0, 0, "columnHeader", 1, r["line"]), cell(1, 0, None, None, r["n"])
            ).alias("cells"),
        )

    tables = F.transform(F.filter("_rows", lambda r: r["i"] % 9 == 8), made)
    return placed.select("doc_id", "content", tables.alias("tables"), paragraphs.alias("paragraphs"))


LAYOUT = """lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents),
laid AS (
  SELECT *, length(line) AS n,
    CAST(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i) AS BIGINT) - length(line) - 1 AS o FROM lines),
para AS (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS idx, i, line, o AS start, o + n - 1 AS stop,
    CASE WHEN i = 0 OR i % 50 = 5 THEN 'title' WHEN i % 13 = 4 THEN 'pageHeader' WHEN n < 30 THEN 'sectionHeading' END AS role,
    i // 10 + 1 AS page FROM laid WHERE n > 0),
tab AS (
  SELECT a.doc_id, a.i, a.line, a.o AS start, a.o + a.n - 1 + CASE WHEN b.n > 0 AND a.i % 18 = 17 THEN b.n - 1 ELSE 0 END AS stop
  FROM laid a LEFT JOIN laid b ON b.doc_id = a.doc_id AND b.i = a.i + 1 WHERE a.n > 0 AND a.i % 9 = 8),
classed AS (
  SELECT p.*, CASE WHEN EXISTS (SELECT 1 FROM tab t WHERE t.doc_id = p.doc_id AND p.start BETWEEN t.start AND t.stop) THEN 'in_table'
    WHEN role IS NULL THEN 'text' WHEN role = 'title' THEN 'title' WHEN role = 'sectionHeading' THEN 'heading' ELSE 'dropped' END AS class
  FROM para p)"""


# ---------------------------------------------------------------- page extracts as SQL
# one row per page, and one per item; positions count from 1
PAGES = f"""lines AS (
  SELECT doc_id, lang, source, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS n
  FROM documents),
placed AS (SELECT *, CAST((n - 1) // {PAGE_LINES} + 1 AS BIGINT) AS page, (n - 1) % {PAGE_LINES} + 1 AS j FROM lines),
pages_raw AS (SELECT DISTINCT doc_id, lang, source, page FROM placed),
page_rows AS (
  SELECT doc_id, page,
    'in/doc ' || doc_id || '.pdf' AS file_path,
    'extracts/doc ' || doc_id || '.pdf_page_' || page || '.png.json' AS extract_path,
    CASE WHEN page % 2 = 1 THEN '{MISSING}' ELSE 'header ' || lang END AS page_header,
    CASE WHEN page % 3 = 1 THEN ' {MISSING} ' ELSE 'footer ' || source END AS page_footer,
    CASE WHEN page % 5 = 0 THEN 'iv' WHEN page % 7 = 0 THEN ' 12' WHEN page % 6 = 0 THEN '{MISSING}'
         ELSE CAST(page AS VARCHAR) END AS page_number,
    CASE WHEN doc_id % 9 = 0 THEN '{MISSING}' ELSE 'title ' || doc_id END AS document_title,
    CASE WHEN doc_id % 8 = 0 THEN '{MISSING}' ELSE 'summary ' || doc_id END AS document_summary
  FROM pages_raw),
items AS (
  SELECT doc_id, page, j,
    CASE WHEN length(line) % 4 = 0 THEN substr(line, 1, 12) ELSE '{MISSING}' END AS section_name,
    CASE WHEN length(line) % 7 = 0 THEN substr(line, 1, 8) ELSE '{MISSING}' END AS parent_section_name,
    CASE WHEN length(line) % 11 = 0 THEN '{MISSING}' ELSE line END AS text,
    CASE WHEN length(line) % 5 = 0 THEN 'figure of ' || length(line) ELSE '{MISSING}' END AS image_summary,
    CASE WHEN length(line) % 3 = 0 THEN 'true' WHEN length(line) % 3 = 1 THEN ' TRUE ' ELSE 'false' END AS flag
  FROM placed WHERE (doc_id + page) % 13 <> 0 AND (doc_id + page) % 17 <> 0)"""
