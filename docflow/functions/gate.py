"""What to take from a model's response, and what to report instead."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docflow import schemas


def first_choice(response: Column) -> Column:
    """The first choice, or null if there is none."""
    return F.get(response["choices"], F.lit(0))


def finish_reason(response: Column) -> Column:
    return first_choice(response)["finish_reason"]


def payload(response: Column) -> Column:
    """Content of the first choice if the call came to its natural end."""
    return F.when(finish_reason(response) == "stop", first_choice(response)["message"]["content"])


def payload_json(response: Column, schema: str) -> Column:
    return F.from_json(payload(response), schema)


def reported_reason(reason: Column) -> Column:
    """A finish reason worth keeping: neither empty nor the natural end."""
    return F.when(~reason.isin("stop", ""), reason)


def described(response: Column) -> Column:
    """Content, or the reason why there is none."""
    reason = finish_reason(response)
    return F.when(reason == "stop", first_choice(response)["message"]["content"]).otherwise(
        F.concat(F.lit("finish_reason:"), F.coalesce(reason, F.lit("None")))
    )


def parse_review(completions_json: Column) -> Column:
    """Role and the three answers that lie in a JSON text inside a JSON text.

    Each level is parsed once; what cannot be parsed gives nulls.
    """
    message = F.get(F.from_json(completions_json, schemas.RESPONSE)["choices"], F.lit(0))["message"]
    answer = F.from_json(message["content"], schemas.REVIEW_ANSWER)
    return F.struct(
        message["role"].alias("role"),
        answer["sentiment"].alias("sentiment"),
        answer["identified_action"].alias("identified_action"),
        answer["action_type"].alias("action_type"),
    )
