import json
import sys

from pyspark import cloudpickle
from pyspark.sql import functions as F

from docflow import schemas
from docflow.checks.stub import StubClient
from docflow.functions import gate
from docflow.functions.messages import image_messages, multimodal_messages, prompt_for, review_messages
from docflow.operators.model import CallError, complete_rows, complete_stored, embed_text
from docflow.plans import images, reviews
from docflow.session import fresh_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Flaky:
    """Fails once per text in each task before it answers; refuses some texts for good."""

    def __init__(self):
        self.seen = set()

    def complete(self, messages, params):
        text = messages[-1]["content"]
        if text == "never":
            raise CallError("400", "no")
        if text not in self.seen:
            self.seen.add(text)
            raise ConnectionError("try again")
        return {"choices": [{"message": {"role": "assistant", "content": f"{text}/{params['max_tokens']}"}, "finish_reason": "stop"}]}

    def embed(self, texts):
        return [[float(len(t))] for t in texts]


def said(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    return rows.withColumn("messages", F.array(F.struct(F.lit("user").alias("role"), F.col("t").alias("content"))))


def test_retries_and_errors_are_data(spark):
    from docflow.operators.model import call_model

    rows = said(spark, ["a", "b", "never"]).withColumn("r", call_model(F.col("messages"), Flaky, {"max_tokens": 9}, pause=0.01))
    got = {r["t"]: (r["r"]["response"], r["r"]["code"]) for r in rows.collect()}
    assert json.loads(got["a"][0])["choices"][0]["message"]["content"] == "a/9"
    assert got["never"] == (None, "400")


def test_store_is_asked_first(spark):
    store = fresh_path(spark, "store")
    first = complete_stored(said(spark, ["x", "y", "x"]), store, factory=StubClient)
    assert first.count() == 3 and first.filter(F.col("chat_completions").isNotNull()).count() == 3

    def broken():
        raise AssertionError("no call is due")

    again = complete_stored(said(spark, ["y", "x"]), store, factory=broken)
    assert [r["error"] for r in again.collect()] == [None, None]
    assert spark.read.parquet(store).count() == 2


def test_nulls(spark):
    rows = complete_rows(said(spark, ["a"]).withColumn("messages", F.when(F.lit(False), F.col("messages"))), factory=StubClient)
    assert [(r["chat_completions"], r["error"]) for r in rows.collect()] == [(None, None)]
    vectors = spark.createDataFrame([("a",), (None,), ("a",)], "t string").select(embed_text(Flaky)(F.col("t"))["vector"].alias("v"))
    assert sorted((r["v"] or [] for r in vectors.collect()), key=len) == [[], [1.0], [1.0]]


def test_review_messages(spark):
    rows = spark.createDataFrame([("good",), (None,)], "c string").select(review_messages(F.col("c")).alias("m"))
    assert rows.schema["m"].dataType.simpleString() == schemas.MESSAGES
    good, none = (r["m"] for r in rows.collect())
    assert [m["name"] for m in good] == ["system", "user"] and good[1]["content"].endswith("good") and none[1]["content"] is None


def test_multimodal_parts(spark):
    rows = spark.range(1).select(
        multimodal_messages(prompt_for(F.lit("title")), F.array(F.lit("data:a"), F.lit("data:b")), F.lit(None).cast("string"), "high").alias("m"),
        multimodal_messages(F.lit("s"), F.array().cast("array<string>"), F.lit("p")).alias("p"),
        image_messages(F.lit("s"), F.lit("data:c")).alias("i"),
        prompt_for(F.lit("unknown")).alias("none"),
    ).collect()[0]
    assert [[p["image_url"]["url"] for p in m["content"]] for m in rows["m"][1:]] == [["data:a", "data:b"]]
    assert [m["content"][0]["text"] for m in rows["p"]] == ["s", "p"]
    assert [p["type"] for p in rows["i"][1]["content"]] == ["text", "image_url"] and rows["none"] is None


def test_gate(spark):
    cases = [
        '{"choices":[{"message":{"role":"assistant","content":"{\\"a\\":\\"1\\"}"},"finish_reason":"stop"}]}',
        '{"choices":[{"message":{"role":"assistant","content":"x"},"finish_reason":"length"}]}',
        '{"choices":[]}', "{}", "not json", None,
    ]
    r = F.from_json("x", schemas.RESPONSE)
    rows = spark.createDataFrame([(c,) for c in cases], "x string").select(
        gate.payload_json(r, "struct<a:string>")["a"].alias("a"), gate.reported_reason(gate.finish_reason(r)).alias("why"),
        gate.described(r).alias("d"), gate.parse_review(F.col("x")).alias("p"),
    ).collect()
    assert [x["a"] for x in rows] == ["1"] + [None] * 5
    assert [x["why"] for x in rows] == [None, "length"] + [None] * 4
    assert [x["d"] for x in rows][1:] == ["finish_reason:length"] + ["finish_reason:None"] * 4
    assert [x["p"]["role"] for x in rows][:3] == ["assistant", "assistant", None]


def test_review_flow(spark):
    rows = spark.createDataFrame([(i, "c" * i if i else "  ") for i in range(60)] + [(60, None)], "k int, comments string")
    stored = reviews.as_json(reviews.complete(rows, StubClient))
    assert {"messages_json", "chat_completions_json", "error_json"} < set(stored.columns)
    assert stored.count() == 59
    failed = stored.filter("error_json is not null").count()
    assert failed > 0 and reviews.parse(stored).count() == 59 - failed


def test_every_record_is_answered(spark):
    record = "struct<recordId:string,data:struct<image:struct<data:string>,content_type:string>>"
    rows = spark.createDataFrame(
        [(1, [("a", (("AAAA",), "image/png")), ("b", (("BB",), "image/gif"))]), (2, [])], f"k int, values array<{record}>"
    )
    got = {r["k"]: r["values"] for r in images.describe_requests(rows, "k", "sys", StubClient).collect()}
    assert [v["recordId"] for v in got[1]] == ["a", "b"] and got[2] == []
    assert all(v["data"]["description"] for v in got[1])
