"""Sending rows to a search service, in batches, behind a client that the user supplies."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.operators.model import CallError


class SearchClient(Protocol):
    """What a search service has to offer: merge or upload rows by their key, and say for each whether it took it."""

    def upload(self, rows: list[dict[str, Any]]) -> list[bool]: ...


SearchFactory = Callable[[], SearchClient]


def send(rows: DataFrame, keys: list[str], factory: SearchFactory, size: int = 900, retries: int = 3, pause: float = 1.0) -> DataFrame:
    """Send every row; per row its keys (as text), whether it was taken, and the error of its batch.

    Each task opens one client and sends what it holds in batches of ``size``, without a shuffle. A batch that
    fails is sent again; as rows are merged by key, sending one twice changes nothing. Write the result once.
    """
    sent = rows.select(*[F.col(k).cast("string").alias(k) for k in keys], F.to_json(F.struct("*")).alias("_row"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = None
        for batch in batches:
            client = client or factory()
            for at in range(0, len(batch), size):
                part = batch.iloc[at : at + size]
                taken, error = _sent(client, [json.loads(x) for x in part["_row"]], retries, pause)
                yield part[keys].assign(succeeded=taken, error=error)

    return sent.mapInPandas(run, ", ".join(f"{k} string" for k in keys) + ", succeeded boolean, error string")


def _sent(client: SearchClient, rows: list[dict], retries: int, pause: float) -> tuple[list[bool], str | None]:
    for left in range(retries, -1, -1):
        try:
            return client.upload(rows), None
        except Exception as error:
            if left == 0 or isinstance(error, CallError) and not error.again:
                return [False] * len(rows), f"{getattr(error, 'code', type(error).__name__)}: {error}"
            time.sleep(pause)
    raise AssertionError("unreachable")
