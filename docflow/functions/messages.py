"""Chat messages as native array and struct columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docflow.functions.text import MISSING

REVIEW_SYSTEM = "You analyse guest reviews for a hotel group and advise its change management team."

# The answer keys and the values they take.
REVIEW_PROMPT = (
    "Read one review and answer with one JSON object: "
    '{"sentiment": "positive" / "negative" / "neutral", "identified_action": "", '
    '"action_type": "continue" / "improve" / "N/A"}. '
    "A positive review names what to keep doing, a negative one what to improve, a neutral one N/A.\n"
    "Review:\n"
)

IMAGE_PROMPT = "Describe this picture:"

# One instruction for each kind of call; the answer keys are fixed values.
PROMPTS = {
    "title": f'Find the title of the document on its first pages. Answer {{"document_title": ""}}, or "{MISSING}".',
    "content": (
        'Read the page from top to bottom. Answer {"page_content": [{"section_name": "", "parent_section_name": "", '
        '"text": "", "image_diagram_summary": "", "contains_image_diagam": "", "contains_table": ""}], '
        f'"page_header": "", "page_footer": "", "page_number": ""}}, with "{MISSING}" for what is not there.'
    ),
    "page_summary": f'Sum up these pages in two or three sentences. Answer {{"page_summary": ""}}, or "{MISSING}".',
    "document_summary": (
        f'Sum up the text in four or five sentences. Answer {{"document_summary": ""}}, or "{MISSING}".'
    ),
}


def prompt_for(kind: Column) -> Column:
    """The instruction for a kind of call; an unknown kind gives null."""
    table = F.create_map(*[F.lit(x) for pair in PROMPTS.items() for x in pair])
    return F.try_element_at(table, kind)


def _message(role: Column, content: Column) -> Column:
    return F.struct(role.alias("role"), content.alias("content"), role.alias("name"))


def message_pair(role1: Column, content1: Column, role2: Column, content2: Column) -> Column:
    """Two messages, each named after its role."""
    return F.array(_message(role1, content1), _message(role2, content2))


def review_messages(comment: Column) -> Column:
    """System and user message for a review; a null comment leaves the user content null."""
    return message_pair(
        F.lit("system"), F.lit(REVIEW_SYSTEM), F.lit("user"), F.concat(F.lit(REVIEW_PROMPT), comment)
    )


def _part(kind: str, text: Column | None = None, url: Column | None = None, detail: str | None = None) -> Column:
    return F.struct(
        F.lit(kind).alias("type"),
        (F.lit(None).cast("string") if text is None else text).alias("text"),
        (
            F.lit(None).cast("struct<url:string,detail:string>")
            if url is None
            else F.struct(url.alias("url"), F.lit(detail).cast("string").alias("detail"))
        ).alias("image_url"),
    )


def multimodal_messages(system: Column, images: Column, prompt: Column, detail: str = "auto") -> Column:
    """System message, then the images if there are any, then the prompt if it is not empty."""
    def turn(role: str, parts: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), parts.alias("content"))

    return F.array_compact(
        F.array(
            turn("system", F.array(_part("text", text=system))),
            F.when(
                F.size(images) > 0,
                turn("user", F.transform(images, lambda url: _part("image_url", url=url, detail=detail))),
            ),
            F.when(F.length(prompt) > 0, turn("user", F.array(_part("text", text=prompt)))),
        )
    )


def image_messages(system: Column, url: Column) -> Column:
    """One user turn that holds the fixed question and the picture."""
    return F.array(
        F.struct(F.lit("system").alias("role"), F.array(_part("text", text=system)).alias("content")),
        F.struct(
            F.lit("user").alias("role"),
            F.array(_part("text", text=F.lit(IMAGE_PROMPT)), _part("image_url", url=url)).alias("content"),
        ),
    )
