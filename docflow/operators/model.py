"""Model calls as distributed columns, behind a client that the user supplies."""

from __future__ import annotations

import json
import time
from collections import OrderedDict
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow import schemas
from docflow.session import read_or_empty, write_once

# Settings of the three kinds of calls.
REVIEW_PARAMS = {"max_tokens": 200, "temperature": 0.5}
PAGE_PARAMS = {"max_tokens": 4000, "temperature": 0, "top_p": 0.95, "response_format": {"type": "json_object"}}
IMAGE_PARAMS = {"max_tokens": 300}


class CallError(Exception):
    """A call that failed; kept as data beside the row, at once or, with ``again``, when retries have not helped."""

    def __init__(self, code: str, message: str, again: bool = False) -> None:
        super().__init__(message)
        self.code, self.again = code, again


class Client(Protocol):
    """What a model service has to offer. One client is opened per task."""

    def complete(self, messages: list[dict], params: dict[str, Any]) -> dict: ...

    def embed(self, texts: list[str]) -> list[list[float]]: ...


ClientFactory = Callable[[], Client]


def _attempt(client: Client, messages: list[dict], params: dict, retries: int, pause: float) -> tuple:
    for left in range(retries, -1, -1):
        try:
            return json.dumps(client.complete(messages, params)), None, None
        except Exception as error:  # transport, or a refusal that may pass: try again, then keep it as data
            if left == 0 or isinstance(error, CallError) and not error.again:
                return None, getattr(error, "code", type(error).__name__), str(error)
            time.sleep(pause)


def call_model(
    messages: Column,
    factory: ClientFactory,
    params: dict[str, Any] | None = None,
    concurrency: int = 5,
    retries: int = 3,
    pause: float = 1.0,
) -> Column:
    """Struct of response text, error code and error message for an array of messages.

    Only the messages cross to Python. Each task that has rows opens one client and
    keeps ``concurrency`` calls in flight.
    """
    settings = dict(params or {})

    @F.pandas_udf("response string, code string, message string")
    def call(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        client = None
        with ThreadPoolExecutor(concurrency) as pool:
            for batch in batches:
                client = client or factory()
                done = pool.map(
                    lambda m: (None, None, None) if m is None else _attempt(client, json.loads(m), settings, retries, pause),
                    batch,
                )
                yield pd.DataFrame(list(done), columns=["response", "code", "message"], dtype=object)

    return call.asNondeterministic()(F.to_json(messages))


def complete_rows(
    df: DataFrame,
    messages: str = "messages",
    output: str = "chat_completions",
    error: str = "error",
    *,
    factory: ClientFactory,
    params: dict[str, Any] | None = None,
    concurrency: int = 5,
    retries: int = 3,
) -> DataFrame:
    """Add the completion of every row and, beside it, what went wrong.

    Follow it with :func:`docflow.session.write_once` where more than one action reads the result.
    """
    called = df.withColumn("_call", call_model(F.col(messages), factory, params, concurrency, retries))
    call = F.col("_call")
    return called.withColumns(
        {
            output: F.from_json(call["response"], schemas.RESPONSE),
            error: F.when(
                call["code"].isNotNull(), F.struct(call["code"].alias("code"), call["message"].alias("message"))
            ),
        }
    ).drop("_call")


def request_key(messages: Column, params: dict[str, Any]) -> Column:
    """Key of a call: the same messages under the same settings give the same key."""
    return F.sha2(F.concat(F.to_json(messages), F.lit(json.dumps(params, sort_keys=True))), 256)


def complete_stored(
    df: DataFrame, store: str, messages: str = "messages", *, factory: ClientFactory,
    params: dict[str, Any] | None = None, concurrency: int = 5,
) -> DataFrame:
    """Completions out of a store that grows by the requests it lacks; no request is sent twice.

    A run that is repeated reads what the first one wrote. Failed calls are not stored, so they are tried again.
    """
    from docflow.operators.skew import lookup, salt_of

    spark, settings = df.sparkSession, dict(params or {})
    keyed = df.withColumn("request_key", request_key(F.col(messages), settings))
    shape = f"request_key string, chat_completions {schemas.RESPONSE}"
    known = read_or_empty(spark, store, shape)
    wanted = keyed.groupBy("request_key").agg(F.any_value(messages).alias(messages)).join(known, "request_key", "left_anti")
    done = write_once(complete_rows(wanted, messages, factory=factory, params=params, concurrency=concurrency), "calls")
    done.filter(F.col("error").isNull()).select("request_key", "chat_completions").write.mode("append").parquet(store)
    failed = done.filter(F.col("error").isNotNull()).select("request_key", "error")
    stored = spark.read.schema(shape).parquet(store)
    answers = stored.join(failed, "request_key", "full")
    return lookup(keyed, answers, ["request_key"], salt_of(*[F.col(c) for c in df.columns if c != messages]))


def embed_text(
    factory: ClientFactory, batch: int = 16, remembered: int = 4096, retries: int = 3, pause: float = 1.0
) -> Callable[[Column], Column]:
    """A function from a text column to a struct of ``vector`` and ``error``.

    Each task opens one client, sends ``batch`` texts per call and remembers the
    vectors of its last texts, so that repeats nearby cost nothing. Null gives nulls. A call
    that fails is tried again; if that does not help, its texts have the error instead of a vector.
    """

    @F.pandas_udf("vector array<float>, error string")
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        client = None
        memory: OrderedDict[str, list[float]] = OrderedDict()
        for texts in batches:
            client = client or factory()
            known = {t: memory[t] for t in texts.dropna().unique() if t in memory}
            failed: dict[str, str] = {}
            new = [t for t in texts.dropna().unique() if t not in known]
            for at in range(0, len(new), batch):
                part = new[at : at + batch]
                vectors, error = _embedded(client, part, retries, pause)
                known.update(zip(part, vectors, strict=True) if error is None else ())
                failed.update(dict.fromkeys(part, error) if error is not None else {})
            memory.update(known)
            while len(memory) > remembered:
                memory.popitem(last=False)
            yield pd.DataFrame({"vector": [known.get(t) for t in texts], "error": [failed.get(t) for t in texts]}, dtype=object)

    nondeterministic = embed.asNondeterministic()
    return lambda column: nondeterministic(column)


def _embedded(client: Client, part: list[str], retries: int, pause: float) -> tuple[list, str | None]:
    for left in range(retries, -1, -1):
        try:
            return client.embed(part), None
        except Exception as error:
            if left == 0 or isinstance(error, CallError) and not error.again:
                return [], f"{getattr(error, 'code', type(error).__name__)}: {error}"
            time.sleep(pause)
    raise AssertionError("unreachable")
