"""Registered queries over layout results."""

from __future__ import annotations

from pyspark.sql import functions as F

from docflow.checks.shapes import LAYOUT, layout, table
from docflow.operators import layout as L
from docflow.operators.tables import table_html
from docflow.session import spread, write_once

KEYS = ["doc_id"]


def _results(spark, sf):
    """Layout results come as a table; here they are made from documents and written once."""
    return write_once(layout(spark, sf), "layout")


def layout_paragraph_class(spark, sf):
    results = _results(spark, sf)
    classed = L.classify(L.paragraphs_of(results, KEYS), L.tables_of(results, KEYS), KEYS)
    return classed.filter(F.col("kind") == "paragraph").select("doc_id", "idx", "class")


def layout_document_map(spark, sf):
    mapped = L.layout_map(_results(spark, sf), KEYS)
    return mapped.select(
        "doc_id", "offset", F.md5("text").alias("digest"), "type", F.md5("title").alias("title"),
        F.md5("subtitle").alias("subtitle"), F.md5("section").alias("section"), "page_number",
    )


def table_to_html(spark, sf):
    """A document is a table: lines are rows, words are cells; in some documents every row is a header."""
    documents = spread(table(spark, sf, "documents").select("doc_id", "text"))
    rows = documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("row_index", "line"))
    cells = rows.select("doc_id", "row_index", F.posexplode(F.split("line", " ")).alias("column_index", "content")).select(
        "*",
        F.when((F.col("row_index") == 0) | (F.col("doc_id") % 7 == 0), "columnHeader")
        .when(F.col("column_index") == 0, "rowHeader").alias("kind"),
        F.when(F.col("column_index") % 5 == 4, 3).otherwise(1).alias("column_span"),
        F.when(F.col("column_index") % 6 == 4, 2).alias("row_span"),
    )
    return table_html(cells, KEYS).select("doc_id", F.length("html").cast("bigint").alias("n"), F.md5("html").alias("digest"))


QUERIES = {
    "layout_paragraph_class": layout_paragraph_class,
    "layout_document_map": layout_document_map,
    "table_to_html": table_to_html,
}

_ESC = "replace(replace(replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), chr(39), '&#x27;')"

ORACLE = {
    "layout_paragraph_class": f"WITH {LAYOUT} SELECT doc_id, idx, class FROM classed",
    "layout_document_map": f"""WITH {LAYOUT},
elements AS (
  SELECT doc_id, start, stop, class, line AS text FROM classed WHERE class IN ('text', 'title', 'heading')
  UNION ALL
  SELECT doc_id, start, stop, 'table', '<table><thead><tr><th>' || {_ESC.format('line')} || '</th></tr></thead><tr><td>'
    || length(line) || '</td><td colSpan=2>' || i || '</td></tr></table>' FROM tab),
paged AS (
  SELECT e.*, coalesce(p.page, 0) AS page FROM elements e ASOF LEFT JOIN para p ON e.doc_id = p.doc_id AND e.stop >= p.start),
ranked AS (
  SELECT *, CASE WHEN class = 'title' THEN row_number() OVER (PARTITION BY doc_id, class ORDER BY start) END AS nth FROM paged),
running AS (
  SELECT *,
    string_agg(CASE WHEN class = 'title' AND (nth = 1 OR page = 1) THEN text END, '; ') OVER w AS main,
    last_value(CASE WHEN class = 'title' THEN text END IGNORE NULLS) OVER w AS sub,
    last_value(CASE WHEN class = 'heading' THEN text END IGNORE NULLS) OVER w AS sec
  FROM ranked WINDOW w AS (PARTITION BY doc_id ORDER BY start ROWS UNBOUNDED PRECEDING))
SELECT doc_id, start AS "offset", md5(text) AS digest, class AS type, md5(coalesce(main, '')) AS title,
  md5(coalesce(sub, '')) AS subtitle, md5(coalesce(sec, '')) AS section, page AS page_number
FROM running WHERE class IN ('text', 'table')""",
    "table_to_html": f"""WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS r FROM documents),
words AS (
  SELECT doc_id, r, unnest(string_split(line, ' ')) AS word, generate_subscripts(string_split(line, ' '), 1) - 1 AS c,
    r = 0 OR doc_id % 7 = 0 AS head FROM lines),
rows_html AS (
  SELECT doc_id, r, head, '<tr>' || string_agg(
    CASE WHEN head OR c = 0 THEN '<th' ELSE '<td' END || CASE WHEN c % 5 = 4 THEN ' colSpan=3' ELSE '' END
    || CASE WHEN c % 6 = 4 THEN ' rowSpan=2' ELSE '' END || '>' || {_ESC.format('word')}
    || CASE WHEN head OR c = 0 THEN '</th>' ELSE '</td>' END, '' ORDER BY c) || '</tr>' AS html
  FROM words GROUP BY ALL),
whole AS (
  SELECT doc_id, '<table><thead>' || string_agg(CASE WHEN NOT head AND r = 1 THEN '</thead>' ELSE '' END || html, '' ORDER BY r)
    || CASE WHEN bool_and(head) THEN '</thead>' ELSE '' END || '</table>' AS html FROM rows_html GROUP BY doc_id)
SELECT doc_id, length(html) AS n, md5(html) AS digest FROM whole""",
}
