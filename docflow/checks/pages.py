"""Registered queries over pages, sections, chunks and vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow import schemas
from docflow.checks.shapes import PAGE_LINES, PAGES, USER, extracts, page_lines, table
from docflow.checks.stub import StubClient
from docflow.functions import gate
from docflow.functions import text as T
from docflow.operators import pages as P
from docflow.operators import upsert as U
from docflow.operators.chunks import VECTORS, build_chunks, embed_chunks
from docflow.operators.model import embed_text
from docflow.operators.upsert import read_table
from docflow.operators.skew import once_per_value, salt_of
from docflow.plans import documents as plan
from docflow.session import fresh_path, write_once
from docflow.sources import files

IMAGES = "images"


def _items(spark: SparkSession, sf: str) -> DataFrame:
    rows = extracts(spark, sf).select(
        "doc_id", "page_sequence_number", F.posexplode_outer("page_content").alias("j", "i")
    ).filter(F.col("i").isNotNull())
    return rows.select("doc_id", F.col("page_sequence_number").alias("page"), (F.col("j") + 1).cast("bigint").alias("j"), "i.*")


def page_enumerate(spark, sf):
    lines = F.split("text", "\n")
    starts = F.sequence(F.lit(0), F.floor((F.size(lines) - 1) / F.lit(PAGE_LINES)).cast("int"))
    pages = F.transform(starts, lambda i: F.array_join(F.slice(lines, i * PAGE_LINES + 1, PAGE_LINES), "\n"))
    docs = table(spark, sf, "documents").select("doc_id", "text")
    name = F.concat(F.lit("doc "), F.col("doc_id").cast("string"), F.lit(".pdf"))
    return P.enumerate_pages(docs, pages, name, IMAGES).select(
        "doc_id", "page_sequence_number", "image_path", F.md5("page").alias("digest")
    )


def page_groups(spark, sf):
    """Some pages are left out, so that groups follow the order, not the numbers."""
    present = page_lines(spark, sf).select("doc_id", F.col("page_sequence_number").alias("page")).filter(
        (F.col("doc_id") + F.col("page")) % 17 != 0
    )
    return P.number_groups(present, ["doc_id"], "page", 10)


def _texts(spark, sf):
    return page_lines(spark, sf).select(
        "doc_id", F.col("page_sequence_number").alias("page"), F.md5(F.array_join("lines", "\n")).alias("digest")
    )


def title_pages(spark, sf):
    return P.first_pages(_texts(spark, sf), ["doc_id"], "page", "digest").select(
        "doc_id", F.array_join("digests", ",").alias("digests")
    )


def _summaries(spark, sf):
    grp = F.floor((F.col("page_sequence_number") - 1) / F.lit(3)).cast("bigint")
    groups = page_lines(spark, sf).select("doc_id", grp.alias("grp")).distinct()
    text = F.concat(F.lit("s"), F.col("doc_id").cast("string"), F.lit("-"), F.col("grp").cast("string"))
    mark = F.col("doc_id") + F.col("grp")
    return groups.select(
        "doc_id", "grp", F.when(mark % 5 != 0, text).alias("summary"),
        F.when(mark % 3 == 0, "length").when(mark % 3 == 1, "stop").alias("reason"),
    )


def summary_concat(spark, sf):
    return P.join_texts(_summaries(spark, sf), ["doc_id"], "grp", "summary", "joined", block=4)


def finish_reason_audit(spark, sf):
    return _summaries(spark, sf).groupBy("doc_id").agg(
        gate.reported_reason(F.max_by("reason", "grp")).alias("last_reason"),
        F.count(gate.reported_reason(F.col("reason"))).alias("n_reported"),
    )


def _filled(spark, sf):
    return P.fill_sections(extracts(spark, sf), ["doc_id"])


def _filled_items(filled: DataFrame) -> DataFrame:
    rows = filled.select(
        "doc_id", F.col("page_sequence_number").alias("page"), F.posexplode_outer("page_content").alias("j", "i")
    ).filter(F.col("i").isNotNull())
    return rows.select(
        "doc_id", "page", (F.col("j") + 1).cast("bigint").alias("j"),
        F.col("i.section_name").alias("section"), F.col("i.parent_section_name").alias("parent"),
    )


def section_fill(spark, sf):
    return _filled_items(_filled(spark, sf))


def section_fill_pages(spark, sf):
    return _filled(spark, sf).select("doc_id", F.col("page_sequence_number").alias("page"), "changed")


def section_fill_changed(spark, sf):
    """Written, filled, and only documents with changes written again."""
    path = fresh_path(spark, "extracts")
    columns = ["extract_path", "page_content", "page_sequence_number"]
    pages = extracts(spark, sf).select(T.base_name(F.col("file_path")).alias("file_name"), *columns)
    files.write_pages(pages, path)
    stored = files.read_page_table(spark, path).select("file_name", *columns)
    files.rewrite_changed(P.fill_sections(stored, ["file_name"]), path)
    doc = F.split_part("file_name", F.lit(" "), F.lit(2))
    again = files.read_page_table(spark, path).withColumn(
        "doc_id", F.split_part(doc, F.lit("."), F.lit(1)).cast("bigint")
    )
    return _filled_items(again)


def page_enrich(spark, sf):
    pages = _texts(spark, sf)
    docs = table(spark, sf, "documents").select(
        "doc_id", F.concat_ws(" ", "source", "lang").alias("document_title"), F.col("text").alias("document_summary")
    )
    return P.enrich_pages(pages, docs, "doc_id", "page").select(
        "doc_id", "page", "digest", "document_title", F.md5("document_summary").alias("summary_digest")
    )


def normalize_missing(spark, sf):
    named = {
        "section": "section_name", "parent": "parent_section_name", "body": "text", "image": "image_diagram_summary",
    }
    return _items(spark, sf).select(
        "doc_id", "page", "j",
        *[F.md5(T.missing_to_blank(F.col(c))).alias(n) for n, c in named.items()], T.has_text(F.col("text")).alias("kept"),
    )


def page_number_parse(spark, sf):
    return extracts(spark, sf).select(
        "doc_id", F.col("page_sequence_number").alias("page"), T.printed_page_number(F.col("page_number")).alias("printed")
    )


def flag_normalize(spark, sf):
    return _items(spark, sf).select("doc_id", "page", "j", T.is_true(F.col("contains_image_diagam")).alias("flag"))


def page_image_path(spark, sf):
    return extracts(spark, sf).select(
        "doc_id", F.col("page_sequence_number").alias("page"),
        T.page_image_path(IMAGES, F.col("file_path"), F.col("extract_path")).alias("image_path"),
    )


def urlsafe_codec(spark, sf):
    coded = table(spark, sf, "documents").select("doc_id", "text", T.urlsafe_encode(F.col("text")).alias("coded"))
    return coded.select(
        "doc_id", F.md5("coded").alias("digest"), (T.urlsafe_decode(F.col("coded")) == F.col("text")).alias("same")
    )


def _chunks(spark, sf):
    return build_chunks(extracts(spark, sf), USER, IMAGES)


def chunk_text(spark, sf):
    return _chunks(spark, sf).select("id", F.length("text_content").cast("bigint").alias("n"), F.md5("text_content").alias("digest"))


def chunk_build(spark, sf):
    return _chunks(spark, sf).withColumn("text_content", F.md5("text_content"))


def _digits(vector: Column) -> Column:
    return F.array_join(F.transform(vector, lambda x: F.round(x * 256).cast("int").cast("string")), ",")


def embed_texts(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return docs.select("doc_id", embed_text(StubClient)(F.col("text")).alias("v")).select("doc_id", _digits(F.col("v.vector")).alias("vector"), "v.error")


def embed_dedup_join(spark, sf):
    """Sources repeat: each is embedded once and handed back to its documents."""
    docs = table(spark, sf, "documents").select("doc_id", "source")
    return once_per_value(docs, "source", "v", lambda c: embed_text(StubClient)(c)["vector"], salt_of(F.col("doc_id"))).select(
        "doc_id", "source", _digits(F.col("v")).alias("vector")
    )


def chunk_vectors(spark, sf):
    done = embed_chunks(write_once(_chunks(spark, sf), "chunks"), embed_text(StubClient))
    return done.select("id", *[_digits(F.col(v)).alias(v) for v in VECTORS.values()])


def _uploaded(spark, sf):
    pages, index = write_once(extracts(spark, sf), "loaded"), fresh_path(spark, "index")
    listed = pages.select("file_path", "page_sequence_number")
    sent = plan.upload(pages, listed, USER, IMAGES, embed_text(StubClient), StubClient, index, fresh_path(spark, "export"))
    return sent, read_table(spark, index, ["id"])


def document_upload(spark, sf):
    """The flow from end to end: sections filled, chunks built, embedded, exported, merged into the index and sent."""
    _, index = _uploaded(spark, sf)
    return index.select("id", F.md5("text_content").alias("text_content"), *[_digits(F.col(v)).alias(v) for v in VECTORS.values()], "vector_errors")


def upload_report(spark, sf):
    """What the service took of each document."""
    sent, _ = _uploaded(spark, sf)
    return U.upload_report(sent, ["file_name"], "succeeded")


def chunk_jsonl(spark, sf):
    """All written, then some documents again with fewer chunks and another text: they replace what they had."""
    path = fresh_path(spark, "chunks")
    chunks = _chunks(spark, sf)
    files.write_chunks(chunks, path)
    again = F.col("page_sequence_number") == 1
    files.write_chunks(chunks.filter(again & (F.length("file_name") % 2 == 0)).withColumn("text_content", F.lit("second")), path)
    back = files.read_chunks(spark, path, chunks.schema)
    return back.select("id", "file_name", "page_number", "image_flag", F.md5("text_content").alias("digest"))


def extract_scan(spark, sf):
    """Extracts with some files cut short: those are set aside and counted, the others read."""
    path = fresh_path(spark, "extract-lines")
    line = F.to_json(F.struct("page_content", "page_header", "page_footer", "page_number", "document_title",
                              "document_summary", "page_sequence_number"))
    broken = (F.col("doc_id") + F.col("page_sequence_number")) % 19 == 0
    extracts(spark, sf).select(F.when(broken, F.expr("substr('{\"page_header\": \"cut', 1, 18)")).otherwise(line).alias("value")).write.text(path)
    good, bad = files.read_extracts(spark, path, lines=True)
    counted = good.groupBy("document_title").agg(
        F.count("*").alias("n_pages"), F.sum(F.coalesce(F.size("page_content"), F.lit(0))).alias("n_items"),
        F.max("page_sequence_number").alias("last_page"),
    )
    return counted.unionByName(
        bad.agg(F.lit("(set aside)").alias("document_title"), F.count("*").alias("n_pages"),
                F.lit(0).cast("bigint").alias("n_items"), F.lit(0).cast("bigint").alias("last_page"))
    )


def extract_sink(spark, sf):
    """All documents written, then every third one again with other headers: it replaces what it had."""
    path = fresh_path(spark, "extract-sink")
    pages = extracts(spark, sf).withColumn("file_name", T.base_name(F.col("file_path")))
    columns = ["file_name", "extract_path", "page_content", "page_header", "page_sequence_number"]
    files.write_pages(pages.select(*columns), path)
    again = pages.filter((F.col("doc_id") % 3 == 0) & (F.col("page_sequence_number") <= 2)).withColumn("page_header", F.lit("second"))
    files.write_pages(again.select(*columns), path)
    return files.read_page_table(spark, path).select(
        "file_name", F.col("page_sequence_number").alias("page"), "page_header",
        F.coalesce(F.size("page_content"), F.lit(0)).cast("bigint").alias("n_items"),
    )


def extract_integrity(spark, sf):
    listed = page_lines(spark, sf).select("doc_id", F.col("page_sequence_number").alias("page"))
    loaded = listed.filter((F.col("doc_id") + F.col("page")) % 17 != 0)
    return P.missing_extracts(listed, loaded, ["doc_id", "page"])


def doc_extract(spark, sf):
    pages = page_lines(spark, sf).select(
        "doc_id", "page_sequence_number", F.concat(F.lit("data:,"), F.md5(F.array_join("lines", "\n")), F.lit("x") ).alias("image_url"),
        F.size("lines").alias("n_lines"),
    ).withColumn("image_url", F.expr("concat(image_url, repeat('y', n_lines))")).drop("n_lines")
    done = plan.extract(pages, StubClient, summary_pages=3)
    return done.select(
        "doc_id", F.col("page_sequence_number").alias("page"), "document_title", "document_summary", "page_number",
        F.get("page_content", F.lit(0))["section_name"].alias("section"),
        "llm_extract_content_finish_reason", "extract_title_finish_reason", "page_summary_finish_reason",
        "document_summary_finish_reason",
    )


QUERIES = {
    "page_enumerate": page_enumerate,
    "page_groups": page_groups,
    "title_pages": title_pages,
    "summary_concat": summary_concat,
    "finish_reason_audit": finish_reason_audit,
    "section_fill": section_fill,
    "section_fill_pages": section_fill_pages,
    "section_fill_changed": section_fill_changed,
    "page_enrich": page_enrich,
    "normalize_missing": normalize_missing,
    "page_number_parse": page_number_parse,
    "flag_normalize": flag_normalize,
    "page_image_path": page_image_path,
    "urlsafe_codec": urlsafe_codec,
    "chunk_text": chunk_text,
    "chunk_build": chunk_build,
    "embed_texts": embed_texts,
    "embed_dedup_join": embed_dedup_join,
    "chunk_vectors": chunk_vectors,
    "chunk_jsonl": chunk_jsonl,
    "document_upload": document_upload,
    "upload_report": upload_report,
    "extract_scan": extract_scan,
    "extract_sink": extract_sink,
    "extract_integrity": extract_integrity,
    "doc_extract": doc_extract,
}


# ---------------------------------------------------------------- the same in SQL

M = "'[missing]'"
_TEXTS = """texts AS (SELECT doc_id, page, md5(string_agg(line, chr(10) ORDER BY n)) AS digest,
                  count(*) AS n_lines FROM placed GROUP BY doc_id, page)"""
_SUMMARIES = """groups AS (SELECT DISTINCT doc_id, (page - 1) // 3 AS grp FROM pages_raw),
summaries AS (SELECT doc_id, grp, CASE WHEN (doc_id + grp) % 5 <> 0 THEN 's' || doc_id || '-' || grp END AS summary,
  CASE (doc_id + grp) % 3 WHEN 0 THEN 'length' WHEN 1 THEN 'stop' END AS reason FROM groups)"""

# walks the pages of every document one after the other
_WALK = f"""raw AS (
  SELECT doc_id, page, j, CASE WHEN trim(section_name) <> {M} THEN section_name END AS s,
    CASE WHEN trim(parent_section_name) <> {M} THEN parent_section_name END AS p,
    trim(text) NOT IN ('', {M}) AS t FROM items),
ordered AS (SELECT doc_id, page, row_number() OVER (PARTITION BY doc_id ORDER BY page) AS k FROM pages_raw),
headed AS (
  SELECT r.*, o.k, CASE WHEN o.k = 1 THEN j ELSE
      max(CASE WHEN j = 1 OR s IS NOT NULL OR p IS NOT NULL THEN j END) OVER (PARTITION BY r.doc_id, r.page ORDER BY j) END AS h
  FROM raw r JOIN ordered o USING (doc_id, page)),
sourced AS (
  SELECT a.doc_id, a.page, a.k, a.j, a.h, a.s AS own_s, a.p AS own_p, a.t, b.s, b.p
  FROM headed a JOIN headed b ON a.doc_id = b.doc_id AND a.page = b.page AND a.h = b.j),
info AS (
  SELECT o.doc_id, o.page, o.k, count(x.j) AS n,
    coalesce(bool_or(x.j = 1 AND x.t AND x.own_s IS NULL) AND o.k > 1, false) AS takes,
    max(CASE WHEN x.j = 1 THEN x.own_p END) AS p0,
    arg_max(x.h, x.j) AS h, max(x.j) AS last_j
  FROM ordered o LEFT JOIN sourced x USING (doc_id, page) GROUP BY o.doc_id, o.page, o.k),
ends AS (
  SELECT i.*, x.s AS cs, x.p AS cp FROM info i
  LEFT JOIN sourced x ON x.doc_id = i.doc_id AND x.page = i.page AND x.j = i.last_j),
walk AS (
  SELECT doc_id, k, cs AS s, cp AS p FROM ends WHERE k = 1
  UNION ALL
  SELECT e.doc_id, e.k,
    CASE WHEN e.takes AND e.h = 1 THEN w.s ELSE e.cs END,
    CASE WHEN e.takes AND e.h = 1 THEN CASE WHEN w.s IS NOT NULL THEN e.p0 ELSE coalesce(e.p0, w.p) END ELSE e.cp END
  FROM walk w JOIN ends e ON e.doc_id = w.doc_id AND e.k = w.k + 1),
given AS (
  SELECT e.doc_id, e.page, e.k, e.n, e.takes, e.p0, w.s AS in_s, w.p AS in_p
  FROM ends e LEFT JOIN walk w ON w.doc_id = e.doc_id AND w.k = e.k - 1),
filled AS (
  SELECT x.doc_id, x.page, x.j,
    coalesce(CASE WHEN g.takes AND x.h = 1 THEN g.in_s ELSE x.s END, {M}) AS section,
    coalesce(CASE WHEN g.takes AND x.h = 1 THEN CASE WHEN g.in_s IS NOT NULL THEN x.p ELSE coalesce(x.p, g.in_p) END
             ELSE x.p END, {M}) AS parent
  FROM sourced x JOIN given g USING (doc_id, page))"""

_CHUNKS = f"""cleaned AS (
  SELECT i.*, p.*,
    CASE WHEN trim(section_name) = {M} THEN '' ELSE section_name END AS section,
    CASE WHEN trim(parent_section_name) = {M} THEN '' ELSE parent_section_name END AS parent_section,
    CASE WHEN trim(image_summary) = {M} THEN '' ELSE image_summary END AS image,
    CASE WHEN trim(page_header) = {M} THEN '' ELSE page_header END AS header,
    CASE WHEN trim(page_footer) = {M} THEN '' ELSE page_footer END AS footer,
    CASE WHEN trim(document_title) = {M} THEN '' ELSE document_title END AS extracted_title,
    CASE WHEN trim(document_summary) = {M} THEN '' ELSE document_summary END AS summary,
    CASE WHEN regexp_full_match(page_number, '[0-9]+') THEN CAST(page_number AS BIGINT) ELSE 0 END AS printed
  FROM items i JOIN page_rows p USING (doc_id, page)
  WHERE trim(text) NOT IN ('', {M})),
chunks AS (
  SELECT doc_id,
    translate(to_base64(encode('{USER}_doc ' || doc_id || '.pdf_' || page || '_' || j)), '+/', '-_') AS id,
    'doc ' || doc_id || '.pdf' AS file_name, file_path, extracted_title, section, parent_section,
    concat_ws(chr(10), '----', CASE WHEN header <> '' THEN 'Page header: ' || header END, '----',
      CASE WHEN extracted_title <> '' THEN 'Document title: ' || extracted_title END,
      CASE WHEN summary <> '' THEN 'Document summary: ' || summary END, '----',
      CASE WHEN parent_section <> '' THEN 'Parent section name: ' || parent_section END,
      CASE WHEN section <> '' THEN 'Section name: ' || section END,
      'Text content: ' || text,
      CASE WHEN image <> '' THEN 'Summary of image / diagram (if present): ' || image END, '----',
      CASE WHEN footer <> '' THEN 'Page footer: ' || footer END,
      CASE WHEN printed > 0 THEN 'Printed page number (if present): ' || printed END,
      'Page sequence number: ' || page, '----') AS text_content,
    upper(trim(flag)) = 'TRUE' AS image_flag, page AS page_sequence_number, printed AS page_number,
    'images/doc ' || doc_id || '.pdf/doc ' || doc_id || '.pdf_page_' || page || '.png' AS page_image_path,
    summary AS document_summary, '{USER}' AS user_id
  FROM cleaned)"""


# the same chunks after sections have been filled
_FILLED_CHUNKS = f"""{_WALK},
filled_items AS (
  SELECT i.* REPLACE (f.section AS section_name, f.parent AS parent_section_name) FROM items i JOIN filled f USING (doc_id, page, j)),
{_CHUNKS.replace("FROM items i JOIN", "FROM filled_items i JOIN")}"""


def _vector(text: str) -> str:
    return (
        f"array_to_string([CAST('0x' || substr(md5({text}), 2 * i - 1, 2) AS INTEGER) for i in range(1, 9)], ',')"
    )


def _told(name: str, said: str, kind: str) -> str:
    """Answer and reason of a call on ``said``."""
    return f"""CASE WHEN length({said}) % 23 <> 0 AND length({said}) % 17 <> 0
        THEN '{kind} ' || substr(md5({said}), 1, 8) END AS {name},
      CASE WHEN length({said}) % 23 <> 0 THEN CASE WHEN length({said}) % 17 = 0 THEN 'content_filter' ELSE 'stop' END END AS {name}_reason"""


_MD5 = ["section_name", "parent_section_name", "text", "image_summary"]

ORACLE = {
    "page_enumerate": f"""WITH {PAGES}, {_TEXTS}
SELECT doc_id, page AS page_sequence_number,
  'images/doc ' || doc_id || '.pdf/doc ' || doc_id || '.pdf_page_' || page || '.png' AS image_path, digest FROM texts""",
    "page_groups": f"""WITH {PAGES}
SELECT doc_id, page, (row_number() OVER (PARTITION BY doc_id ORDER BY page) - 1) // 10 AS grp
FROM pages_raw WHERE (doc_id + page) % 17 <> 0""",
    "title_pages": f"""WITH {PAGES}, {_TEXTS}
SELECT doc_id, string_agg(digest, ',' ORDER BY page) AS digests FROM texts WHERE page <= 3 GROUP BY doc_id""",
    "summary_concat": f"""WITH {PAGES}, {_SUMMARIES}
SELECT doc_id, coalesce(string_agg(summary, ' ' ORDER BY grp), '') AS joined FROM summaries GROUP BY doc_id""",
    "finish_reason_audit": f"""WITH {PAGES}, {_SUMMARIES}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY grp DESC) AS back FROM summaries)
SELECT doc_id, max(CASE WHEN back = 1 AND reason <> 'stop' THEN reason END) AS last_reason,
  count(CASE WHEN reason <> 'stop' THEN 1 END) AS n_reported FROM ranked GROUP BY doc_id""",
    "section_fill": f"WITH RECURSIVE {PAGES}, {_WALK} SELECT doc_id, page, j, section, parent FROM filled",
    "section_fill_pages": f"""WITH RECURSIVE {PAGES}, {_WALK}
SELECT g.doc_id, g.page, g.k > 1 AND g.n > 0 AND (
    EXISTS (SELECT 1 FROM raw r WHERE r.doc_id = g.doc_id AND r.page = g.page AND r.j > 1 AND r.s IS NULL AND r.p IS NULL)
    OR (g.takes AND (g.in_s IS NOT NULL OR (g.p0 IS NULL AND g.in_p IS NOT NULL)))) AS changed FROM given g""",
    "section_fill_changed": f"WITH RECURSIVE {PAGES}, {_WALK} SELECT doc_id, page, j, section, parent FROM filled",
    "page_enrich": f"""WITH {PAGES}, {_TEXTS}
SELECT doc_id, page, digest, source || ' ' || lang AS document_title, md5(documents.text) AS summary_digest
FROM texts JOIN documents USING (doc_id)""",
    "normalize_missing": f"""WITH {PAGES}
SELECT doc_id, page, j, {', '.join(
    f"md5(CASE WHEN trim({c}) = {M} THEN '' ELSE {c} END) AS {n}"
    for c, n in zip(_MD5, ("section", "parent", "body", "image"), strict=True))},
  trim(text) NOT IN ('', {M}) AS kept FROM items""",
    "page_number_parse": f"""WITH {PAGES}
SELECT doc_id, page, CASE WHEN regexp_full_match(page_number, '[0-9]+') THEN CAST(page_number AS BIGINT) ELSE 0 END AS printed
FROM page_rows""",
    "flag_normalize": f"WITH {PAGES} SELECT doc_id, page, j, upper(trim(flag)) = 'TRUE' AS flag FROM items",
    "page_image_path": f"""WITH {PAGES} SELECT doc_id, page,
  'images/doc ' || doc_id || '.pdf/doc ' || doc_id || '.pdf_page_' || page || '.png' AS image_path FROM page_rows""",
    "urlsafe_codec": """SELECT doc_id, md5(translate(to_base64(encode(text)), '+/', '-_')) AS digest, true AS same FROM documents""",
    "chunk_text": f"""WITH {PAGES}, {_CHUNKS}
SELECT id, length(text_content) AS n, md5(text_content) AS digest FROM chunks""",
    "chunk_build": f"""WITH {PAGES}, {_CHUNKS}
SELECT * EXCLUDE (doc_id) REPLACE (md5(text_content) AS text_content) FROM chunks""",
    "embed_texts": f"SELECT doc_id, {_vector('text')} AS vector, CAST(NULL AS VARCHAR) AS error FROM documents",
    "embed_dedup_join": f"SELECT doc_id, source, {_vector('source')} AS vector FROM documents",
    "chunk_vectors": f"""WITH {PAGES}, {_CHUNKS}
SELECT id, CASE WHEN section <> '' THEN {_vector('section')} ELSE '' END AS section_vector,
  CASE WHEN parent_section <> '' THEN {_vector('parent_section')} ELSE '' END AS parent_section_vector,
  {_vector('text_content')} AS text_content_vector FROM chunks""",
    "chunk_jsonl": f"""WITH {PAGES}, {_CHUNKS}
SELECT id, file_name, page_number, image_flag, CASE WHEN again THEN md5('second') ELSE md5(text_content) END AS digest
FROM (SELECT *, bool_or(length(file_name) % 2 = 0 AND page_sequence_number = 1) OVER (PARTITION BY file_name) AS again FROM chunks)
WHERE NOT again OR page_sequence_number = 1""",
    "document_upload": f"""WITH RECURSIVE {PAGES}, {_FILLED_CHUNKS}
SELECT id, md5(text_content) AS text_content, CASE WHEN section <> '' THEN {_vector('section')} ELSE '' END AS section_vector,
  CASE WHEN parent_section <> '' THEN {_vector('parent_section')} ELSE '' END AS parent_section_vector,
  {_vector('text_content')} AS text_content_vector, CAST(NULL AS VARCHAR) AS vector_errors FROM chunks""",
    "upload_report": f"""WITH RECURSIVE {PAGES}, {_FILLED_CHUNKS}
SELECT file_name, count(CASE WHEN length(id) % 7 <> 0 THEN 1 END) AS succeeded, count(*) AS sent FROM chunks GROUP BY file_name""",
    "extract_scan": f"""WITH {PAGES}, sized AS (
  SELECT p.doc_id, p.page, p.document_title, count(i.j) AS n FROM page_rows p LEFT JOIN items i USING (doc_id, page)
  GROUP BY ALL)
SELECT document_title, count(*) AS n_pages, CAST(sum(n) AS BIGINT) AS n_items, max(page) AS last_page
FROM sized WHERE (doc_id + page) % 19 <> 0 GROUP BY document_title
UNION ALL SELECT '(set aside)', count(*), 0, 0 FROM sized WHERE (doc_id + page) % 19 = 0""",
    "extract_sink": f"""WITH {PAGES}, sized AS (
  SELECT p.doc_id, p.page, p.page_header, count(i.j) AS n_items FROM page_rows p LEFT JOIN items i USING (doc_id, page)
  GROUP BY ALL)
SELECT 'doc ' || doc_id || '.pdf' AS file_name, page, CASE WHEN doc_id % 3 = 0 THEN 'second' ELSE page_header END AS page_header,
  n_items FROM sized WHERE doc_id % 3 <> 0 OR page <= 2""",
    "extract_integrity": f"WITH {PAGES} SELECT doc_id, page FROM pages_raw WHERE (doc_id + page) % 17 = 0",
    "doc_extract": f"""WITH {PAGES}, {_TEXTS},
urls AS (SELECT doc_id, page, 'data:,' || digest || 'x' || repeat('y', n_lines) AS url FROM texts),
title_in AS (SELECT doc_id, string_agg(url, '' ORDER BY page) AS said FROM urls WHERE page <= 3 GROUP BY doc_id),
titles AS (SELECT doc_id, {_told('title', 'said', 'document_title')} FROM title_in),
group_in AS (SELECT doc_id, (page - 1) // 3 AS grp, string_agg(url, '' ORDER BY page) AS said FROM urls GROUP BY ALL),
parts AS (SELECT doc_id, grp, {_told('part', 'said', 'page_summary')},
          row_number() OVER (PARTITION BY doc_id ORDER BY grp DESC) AS back FROM group_in),
joined AS (SELECT doc_id, coalesce(string_agg(part, ' ' ORDER BY grp), '') AS said,
           max(CASE WHEN back = 1 THEN part_reason END) AS last_reason FROM parts GROUP BY doc_id),
summaries AS (SELECT doc_id, last_reason, {_told('summary', 'said', 'document_summary')} FROM joined),
contents AS (SELECT doc_id, page, length(url) AS n, {_told('body', 'url', 'x')} FROM urls)
SELECT c.doc_id, c.page, coalesce(title, '') AS document_title, coalesce(summary, '') AS document_summary,
  CASE WHEN body_reason = 'stop' THEN CAST(n % 100 AS VARCHAR) END AS page_number,
  CASE WHEN body_reason = 'stop' THEN CASE WHEN n % 2 = 1 THEN 'Section ' || (n % 5) ELSE {M} END END AS section,
  nullif(body_reason, 'stop') AS llm_extract_content_finish_reason, nullif(title_reason, 'stop') AS extract_title_finish_reason,
  nullif(last_reason, 'stop') AS page_summary_finish_reason, nullif(summary_reason, 'stop') AS document_summary_finish_reason
FROM contents c JOIN titles t USING (doc_id) JOIN summaries s USING (doc_id)""",
}
