"""A model service that needs no model, for checks and tests."""

from __future__ import annotations

import hashlib
import json
from typing import Any

from docflow.functions.messages import PROMPTS
from docflow.operators.model import CallError
from docflow.plans.documents import ANSWERS

_KINDS = {text: ANSWERS[kind] for kind, text in PROMPTS.items()}


def _kind(messages: list[dict]) -> str:
    """Pages have one of the instructions for pages, pictures another one, reviews plain text."""
    content = messages[0].get("content")
    return _KINDS.get(content[0].get("text"), "image") if isinstance(content, list) else "review"


def _texts(messages: list[dict]) -> str:
    """All that the user turns hold, pictures included, as one text."""
    parts = []
    for m in messages:
        if m.get("role") != "user":
            continue
        content = m.get("content")
        for part in content if isinstance(content, list) else [{"text": content}]:
            parts.append((part.get("image_url") or {}).get("url") or part.get("text") or "")
    return "".join(parts)


class StubClient:
    """Answers by text length and digest, so that plain SQL can re-compute every answer.

    What is answered follows from the instruction, unless ``kind`` says it.
    """

    def __init__(self, kind: str | None = None) -> None:
        self.kind = kind

    def complete(self, messages: list[dict], params: dict[str, Any]) -> dict:
        text = _texts(messages)
        n = len(text)
        if n % 23 == 0:
            raise CallError("429", f"refused at length {n}")
        reason = "content_filter" if n % 17 == 0 else "stop"
        content = self._answer(self.kind or _kind(messages), text)
        return {"choices": [{"message": {"role": "assistant", "content": content}, "finish_reason": reason}]}

    def _answer(self, kind: str, text: str) -> str:
        n, digest = len(text), hashlib.md5(text.encode()).hexdigest()[:8]
        if kind == "review":
            sentiment, action = (("positive", "continue"), ("negative", "improve"), ("neutral", "N/A"))[n % 3]
            return json.dumps({"sentiment": sentiment, "identified_action": f"action {n % 7}", "action_type": action})
        if kind == "image":
            return f"A picture of {n} characters"
        if kind == "content":
            item = {
                "section_name": f"Section {n % 5}" if n % 2 else "[missing]",
                "parent_section_name": "[missing]",
                "text": text,
                "image_diagram_summary": "[missing]",
                "contains_image_diagam": "false",
                "contains_table": "false",
            }
            return json.dumps(
                {"page_content": [item], "page_header": "[missing]", "page_footer": "[missing]", "page_number": str(n % 100)}
            )
        return json.dumps({kind: f"{kind} {digest}"})

    def upload(self, rows: list[dict[str, Any]]) -> list[bool]:
        return [len(r["id"]) % 7 != 0 for r in rows]

    def embed(self, texts: list[str]) -> list[list[float]]:
        return [[b / 256 for b in hashlib.md5(t.encode()).digest()[:8]] for t in texts]


class FixedTextToSql:
    """Stands in for a model that writes SQL: a known question gives its statement."""

    def __init__(self, known: dict[str, str]):
        self.known = known

    def __call__(self, question: str, context: str) -> str:
        return self.known[question]
