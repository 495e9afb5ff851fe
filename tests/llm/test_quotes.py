"""Quotation linking on small threads."""

from __future__ import annotations

from docflow.llm import quotes

SCHEMA = "conv_id long, turn long, role string, text string, depth string"


def linked(spark, rows):
    found = quotes.linked(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)).collect()
    return {(r["conv"], r["turn"]): r for r in found}


def test_replies_follow_quotes(spark):
    found = linked(spark, [
        (1, 0, "user", "Hello there\nfriend.\n\nSecond para"),
        (1, 1, "assistant", "On Monday, x wrote:\n> Hello THERE   friend.\n\nHi!"),
        (1, 2, "user", "> second para\n>> nothing like it\nWhat?"),
        (1, 3, "assistant", "> What?\n> > Second para\n\nyes"),
        (1, 4, "user", "thanks"),
    ])
    assert [found[1, k]["parent_turn"] for k in range(5)] == [None, 0, 0, 2, 3]
    assert [found[1, k]["depth"] for k in range(5)] == [0, 1, 1, 2, 3]
    assert [found[1, k]["n_linked"] for k in range(5)] == [0, 1, 1, 2, 0]
    assert [found[1, k]["body"] for k in range(5)][1:4] == ["Hi!", "What?", "yes"]
    assert [found[1, k]["position"] for k in range(5)] == list(range(5))


def test_most_quoted_message_is_the_parent(spark):
    found = linked(spark, [
        (1, 0, "u", "short"), (1, 1, "u", "a much longer line of text"), (1, 2, "u", "> short\n> a much longer line of text\nok"),
        (1, 3, "u", "> not said before\nok"), (2, 0, "u", "> a much longer line of text"),
    ])
    assert found[1, 2]["parent_turn"] == 1 and found[1, 3]["parent_turn"] == 2
    assert found[2, 0]["parent_turn"] is None and found[2, 0]["body"] == ""


def test_gaps_nulls_repeats_and_a_long_chain(spark):
    rows = [(3, k, "u", f"message {k}") for k in range(300)]
    rows += [(4, 0, "u", None), (4, 5, "u", ""), (None, 1, "u", "x"), (6, None, "u", "y"), (7, 0, "u", "same"), (7, 0, "u", "same")]
    frame = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    found = quotes.linked(frame).collect()
    assert len(found) == len(rows)
    chain = {r["turn"]: (r["depth"], r["root_turn"], r["position"]) for r in found if r["conv"] == 3}
    assert chain == {k: (k, 0, k) for k in range(300)}
    assert sorted(r["position"] for r in found if r["conv"] == 7) == [0, 1]
    assert {r["parent_turn"] for r in found if r["conv"] in (6, 7, None)} == {None}
    assert {r["turn"]: r["parent_turn"] for r in found if r["conv"] == 4} == {0: None, 5: 0}
    assert quotes.linked(frame.limit(0)).count() == 0


def test_the_turn_before_is_the_last_there_is(spark):
    rows = [(1, t, "u", f"m {t}") for t in (1, 3, 4, 4095, 4096, 20_000)]
    found = linked(spark, rows)
    assert [found[1, t]["parent_turn"] for t in (1, 3, 4, 4095, 4096, 20_000)] == [None, 1, 3, 4, 4095, 4096]
    assert {r["root_turn"] for r in found.values()} == {1}


def test_messages_of_many_quoted_lines(spark):
    lines = [f"line number {k % 3000}" for k in range(9000)]
    found = linked(spark, [(1, 0, "u", "\n".join(lines)), (1, 1, "u", "\n".join(f"> {x}" for x in lines) + "\nyes")])
    assert (found[1, 1]["parent_turn"], found[1, 1]["n_quoted"], found[1, 1]["n_linked"], found[1, 1]["body"]) == (0, 9000, 1, "yes")


def test_clashing_columns_are_left_out(spark):
    df = spark.createDataFrame([(1, 0, "u", "a", 1, 2, 3)], "conv_id long, turn long, role string, text string, conv int, block int, passages int")
    assert quotes.linked(df).count() == 1
