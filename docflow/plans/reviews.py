"""Reviews: filter, prompt, complete, keep as JSON, parse."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.functions.gate import parse_review
from docflow.functions.messages import review_messages
from docflow.functions.text import not_blank
from docflow.operators.model import REVIEW_PARAMS, ClientFactory, complete_rows


def with_messages(reviews: DataFrame, comment: str = "comments") -> DataFrame:
    return reviews.withColumn("messages", review_messages(F.col(comment)))


def complete(
    reviews: DataFrame, factory: ClientFactory, params: dict[str, Any] | None = None,
    comment: str = "comments", concurrency: int = 5,
) -> DataFrame:
    """Completions of all reviews that are not blank, with the error column beside them."""
    wanted = reviews.filter(not_blank(F.col(comment)))
    return complete_rows(
        with_messages(wanted, comment), factory=factory,
        params=REVIEW_PARAMS if params is None else params, concurrency=concurrency,
    )


def as_json(completed: DataFrame) -> DataFrame:
    """The three nested columns as JSON text, ready for a table in a database."""
    nested = ("messages", "chat_completions", "error")
    return completed.withColumns({f"{c}_json": F.to_json(c) for c in nested}).drop(*nested)


def parse(stored: DataFrame, every: bool = False) -> DataFrame:
    """Answers of the rows whose completion came from the assistant; with ``every``, rows without one stay, with nulls."""
    answered = stored.withColumn("_a", parse_review(F.col("chat_completions_json")))
    return (
        (answered if every else answered.filter(F.col("_a.role") == "assistant"))
        .withColumns({f"output_{n}": F.col(f"_a.{n}") for n in ("role", "sentiment", "identified_action", "action_type")})
        .drop("_a")
    )
