"""Explicit schemas; nothing is inferred in production code."""

from __future__ import annotations

REVIEW = "review_date string, hotel string, highlights string, comments string"

MESSAGES = "array<struct<role:string,content:string,name:string>>"

RESPONSE = "struct<choices:array<struct<message:struct<role:string,content:string>,finish_reason:string>>>"

REVIEW_ANSWER = "struct<sentiment:string,identified_action:string,action_type:string>"

# The keys of a page extract, spelt as the files spell them.
ITEM = (
    "struct<section_name:string,parent_section_name:string,text:string,"
    "image_diagram_summary:string,contains_image_diagam:string,contains_table:string>"
)
PAGE_BODY = f"page_content array<{ITEM}>, page_header string, page_footer string, page_number string"
PAGE_ANSWER = (
    f"struct<page_content:array<{ITEM}>,page_header:string,page_footer:string,page_number:string>"
)
PAGE_EXTRACT = (
    PAGE_BODY + ", document_title string, document_summary string, page_sequence_number bigint, "
    "llm_extract_content_finish_reason string, extract_title_finish_reason string, "
    "page_summary_finish_reason string, document_summary_finish_reason string"
)

LAYOUT = (
    "content string, "
    "tables array<struct<spans:array<struct<offset:bigint,length:bigint>>,rowCount:int,"
    "cells:array<struct<rowIndex:int,columnIndex:int,kind:string,columnSpan:int,rowSpan:int,content:string>>>>, "
    "paragraphs array<struct<spans:array<struct<offset:bigint,length:bigint>>,role:string,"
    "boundingRegions:array<struct<pageNumber:int>>>>"
)

SKILL_REQUEST = (
    "values array<struct<recordId:string,data:struct<image:struct<data:string>,content_type:string>>>"
)

MANIFEST = "name string, paths array<struct<file:string>>, transformations string, type string"
