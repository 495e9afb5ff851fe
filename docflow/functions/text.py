"""Scalar text functions, all evaluated in the JVM."""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the marker that page extracts use for "not there".
MISSING = "[missing]"

WHITESPACE = "".join(ch for ch in map(chr, range(sys.maxunicode + 1)) if ch.isspace())

# Media type by file extension.
MIME_TYPES = {
    "bmp": "image/bmp",
    "gif": "image/gif",
    "html": "text/html",
    "jpeg": "image/jpeg",
    "jpg": "image/jpeg",
    "json": "application/json",
    "pdf": "application/pdf",
    "png": "image/png",
    "svg": "image/svg+xml",
    "tif": "image/tiff",
    "tiff": "image/tiff",
    "txt": "text/plain",
    "webp": "image/webp",
}
DEFAULT_MIME = "application/octet-stream"


def strip(c: Column) -> Column:
    """Drop every kind of Unicode white space at both ends."""
    return F.btrim(c, F.lit(WHITESPACE))


def not_blank(c: Column) -> Column:
    """True if something other than trailing blanks is there; null stays null and is filtered out."""
    return F.length(F.rtrim(c)) > 0


def missing_to_null(c: Column) -> Column:
    """The value as it is, or null where it is absent or only the missing marker."""
    return F.when(strip(c) != MISSING, c)


def missing_to_blank(c: Column) -> Column:
    return F.coalesce(missing_to_null(c), F.lit(""))


def null_to_missing(c: Column) -> Column:
    return F.coalesce(c, F.lit(MISSING))


def has_text(c: Column) -> Column:
    """True for text that is neither null, blank nor the missing marker."""
    return F.coalesce(~strip(c).isin("", MISSING), F.lit(False))


def is_true(c: Column) -> Column:
    """Flags come as booleans or as text in any case; everything but true is false."""
    return F.coalesce(F.upper(strip(c.cast("string"))) == "TRUE", F.lit(False))


def printed_page_number(c: Column) -> Column:
    """Digits only, as they stand; roman numerals, padded or absent numbers give 0."""
    return F.when(c.rlike(r"\A[0-9]+\z"), F.coalesce(c.try_cast("bigint"), F.lit(0))).otherwise(F.lit(0)).cast("bigint")


def base64_text(b: Column) -> Column:
    """Base64 on one line (the built-in function may break lines)."""
    return F.translate(F.base64(b), "\r\n", "")


def urlsafe_encode(c: Column) -> Column:
    return F.translate(F.base64(F.encode(c, "UTF-8")), "+/\r\n", "-_")


def urlsafe_decode(c: Column) -> Column:
    return F.decode(F.unbase64(F.translate(c, "-_", "+/")), "UTF-8")


def base_name(path: Column) -> Column:
    """Last part of a path with either kind of slash."""
    return F.substring_index(F.translate(path, "\\", "/"), "/", -1)


def page_file(file_name: Column, page: Column) -> Column:
    return F.concat(file_name, F.lit("_page_"), page.cast("string"), F.lit(".png"))


def page_image_path(image_dir: Column | str, file_path: Column, extract_path: Column) -> Column:
    """Where the image of a page lies, from the path of its document and of its extract."""
    folder = F.lit(image_dir) if isinstance(image_dir, str) else image_dir
    return F.concat_ws("/", folder, base_name(file_path), F.replace(base_name(extract_path), F.lit(".json"), F.lit("")))


def extension(path: Column) -> Column:
    name = base_name(path)
    return F.when(F.instr(name, ".") > 0, F.lower(F.substring_index(name, ".", -1)))


def mime_type(path: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in MIME_TYPES.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.coalesce(extension(path), F.lit(""))), F.lit(DEFAULT_MIME))


def data_url(mime: Column, payload_base64: Column) -> Column:
    return F.concat(F.lit("data:"), mime, F.lit(";base64,"), payload_base64)


def html_escape(c: Column) -> Column:
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(raw), F.lit(safe))
    return c


def labelled(label: str, value: Column) -> Column:
    """``label: value``, or null where there is no value."""
    return F.when(F.length(value) > 0, F.concat(F.lit(label + ": "), value))


def chunk_text(
    page_header: Column,
    title: Column,
    summary: Column,
    parent_section: Column,
    section: Column,
    text: Column,
    image_summary: Column,
    page_footer: Column,
    page_number: Column,
    page_sequence: Column,
) -> Column:
    """The text of a chunk with its labels; absent parts leave no line behind."""
    rule = F.lit("----")
    return F.concat_ws(
        "\n",
        rule,
        labelled("Page header", page_header),
        rule,
        labelled("Document title", title),
        labelled("Document summary", summary),
        rule,
        labelled("Parent section name", parent_section),
        labelled("Section name", section),
        labelled("Text content", text),
        labelled("Summary of image / diagram (if present)", image_summary),
        rule,
        labelled("Page footer", page_footer),
        labelled("Printed page number (if present)", F.when(page_number > 0, page_number.cast("string"))),
        labelled("Page sequence number", F.when(page_sequence > 0, page_sequence.cast("string"))),
        rule,
    )
