"""Quotation linking: quoted passages lead from a message to the one it answers. Columns and joins only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docflow.session import write_once

MARKS = r"^((?:[ \t]*>)+)"
ATTRIBUTION = r"(?i)^(on|am|le|el)\b.*\b(wrote|schrieb|écrit|escribió)\b.*:$"


def levels(text: Column) -> Column:
    """Of each line: its quote level, the line, and its words in lower case, parted by one space."""
    marks = lambda x: F.regexp_extract(x, MARKS, 1)
    words = lambda x: F.lower(F.trim(F.regexp_replace(F.regexp_replace(x, MARKS, ""), r"[\x20\x09-\x0D]+", " ")))
    return F.transform(
        F.split(F.coalesce(text, F.lit("")), "\n", -1),
        lambda x: F.struct(F.length(F.regexp_replace(marks(x), "[^>]", "")).alias("level"), x.alias("line"), words(x).alias("words")),
    )


def own_lines(lines: Column) -> Column:
    """The lines at level 0, without those that only announce the quotation below them."""
    announces = lambda x, i: x["words"].rlike(ATTRIBUTION) & (F.coalesce(F.get(lines, i + 1)["level"], F.lit(0)) > 0)
    return F.filter(lines, lambda x, i: (x["level"] == 0) & ~announces(x, i))


def passages(lines: Column) -> Column:
    """Runs of lines of one level, ended by lines without words, and their single lines: level and words of each, repeats included."""
    at = F.sequence(F.lit(0), F.size(lines) - 1)
    opens = lambda i: (
        (i == 0) | (F.get(lines, i)["level"] != F.get(lines, i - 1)["level"]) | (F.get(lines, i)["words"] == "") | (F.get(lines, i - 1)["words"] == "")
    )
    starts = F.filter(at, opens)
    run = lambda s, k: F.slice(lines, s + 1, F.coalesce(F.get(starts, k + 1), F.size(lines)) - s)
    whole = F.transform(starts, lambda s, k: F.struct(F.get(lines, s)["level"].alias("level"), F.array_join(F.transform(run(s, k), lambda x: x["words"]), " ").alias("words")))
    single = F.transform(lines, lambda x: F.struct(x["level"].alias("level"), x["words"].alias("words")))
    return F.filter(F.concat(whole, single), lambda p: p["words"] != "")


def linked(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """``df`` by message: conv, turn, role, body, n_quoted and, by joins, parent_turn, root_turn, depth, n_linked and position.

    A line is quoted as deep as it has ``>`` marks before it. Quoted passages, and single quoted lines, are normalised (marks off, lower
    case, white space made one space), hashed, and joined to the earliest message of their conversation with the same passage
    at level 0; it must be earlier than the quoting one. The parent is the message with most characters among the
    level 1 quotes, the latest of several; without any, the message of the last turn before that there is. root_turn and
    depth follow the parents up; position counts from 0 in the reply order of a root's messages, where each comes
    after the one it answers. body is the message without quotes and the lines that announce them.

    Null and empty texts are messages without words. Rows with one conversation and turn are told apart by nothing and stand at
    one node, each with a position. Rows whose conversation or turn is null are roots of their own. A conversation may hold any
    share of the rows: joins are by conversation and turn or passage, positions by blocks of turns.
    """
    lines = F.col("__lines")
    messages = df.select(
        F.col(conversation).alias("conv"), F.col(turn).cast("long").alias("turn"), *[F.col(c).alias("role") for c in df.columns if c == "role"],
        levels(F.col(text)).alias("__lines"),
    )
    messages = messages.select(
        *[c for c in messages.columns if c != "__lines"],
        F.regexp_replace(F.array_join(F.transform(own_lines(lines), lambda x: x["line"]), "\n"), r"^\n+|\n+$", "").alias("body"),
        F.size(F.filter(lines, lambda x: x["level"] > 0)).cast("long").alias("n_quoted"), passages(lines).alias("passages"),
    )
    messages = write_once(messages, "messages")
    said = messages.select("conv", "turn", F.explode("passages").alias("p")).select(
        "conv", "turn", "p.level", F.md5("p.words").alias("passage"), F.length("p.words").alias("chars")
    )
    origin = said.filter("level = 0").groupBy("conv", "passage").agg(F.min("turn").alias("origin"))
    quoted = said.filter("level > 0").distinct().join(origin, ["conv", "passage"]).filter("origin < turn")
    weight = quoted.groupBy("conv", "turn", "level", "origin").agg(F.sum("chars").alias("chars"))
    known = weight.groupBy("conv", "turn").agg(
        F.max_by(F.when(F.col("level") == 1, F.col("origin")), F.struct(F.col("level") == 1, "chars", "origin")).alias("quoted_turn"),
        F.count_distinct("origin").cast("long").alias("n_linked"),
    )
    nodes = messages.select("conv", "turn").distinct().filter("conv is not null and turn is not null")
    parents = previous(nodes).join(known, ["conv", "turn"], "left").select(
        "conv", "turn", F.coalesce("quoted_turn", "previous").alias("parent_turn"), F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked")
    )
    parents = write_once(parents, "parents")
    start = parents.select("conv", "turn", F.coalesce("parent_turn", "turn").alias("root_turn"), F.col("parent_turn").isNotNull().cast("long").alias("depth"))
    above = roots(start.withColumn("open", F.col("depth") > 0))
    placed = messages.drop("passages").join(parents.join(above, ["conv", "turn"]), ["conv", "turn"], "left")
    placed = placed.withColumn("root_turn", F.coalesce("root_turn", "turn")).fillna(0, ["depth", "n_linked"])
    return positions(placed)


def previous(nodes: DataFrame, block: int = 4096) -> DataFrame:
    """``previous``: the last turn of the conversation before each, from the turns of a block and the last one before the block."""
    nodes = write_once(nodes.withColumn("block", F.floor(F.col("turn") / block)), "nodes")
    ends = nodes.groupBy("conv", "block").agg(F.max("turn").alias("end"))
    earlier = ends.withColumn("earlier", F.lag("end").over(Window.partitionBy("conv").orderBy("block"))).drop("end")
    own = F.lag("turn").over(Window.partitionBy("conv", "block").orderBy("turn"))
    return nodes.withColumn("own", own).join(earlier, ["conv", "block"]).select("conv", "turn", F.coalesce("own", "earlier").alias("previous"))


def roots(above: DataFrame) -> DataFrame:
    """The root of every node and its distance, from the parent (``root_turn``, ``depth``) of those that are ``open``.

    Each round doubles how far up an open node has looked; one that has met a root is done and leaves the rounds.
    """
    tables = [write_once(above, "above")]
    while True:
        done = reduce(DataFrame.union, [t.filter("not open") for t in tables])
        rest = tables[-1].filter("open")
        if rest.isEmpty():
            return done.drop("open")
        up = done.union(rest).select("conv", F.col("turn").alias("root_turn"), F.col("root_turn").alias("higher"), F.col("depth").alias("more"))
        joined = rest.drop("open").join(up, ["conv", "root_turn"])
        tables.append(write_once(joined.select(
            "conv", "turn", F.col("higher").alias("root_turn"), (F.col("depth") + F.col("more")).alias("depth"), (F.col("more") > 0).alias("open")
        ), "above"))


def positions(placed: DataFrame, block: int = 4096) -> DataFrame:
    """``position``: numbers from 0 by turn within conversation and root, from counts of blocks of turns."""
    placed = write_once(placed.withColumn("block", F.floor(F.col("turn") / block)), "placed")
    counts = placed.groupBy("conv", "root_turn", "block").agg(F.count("*").alias("n"))
    before = counts.withColumn("before", F.sum("n").over(Window.partitionBy("conv", "root_turn").orderBy("block")) - F.col("n")).drop("n")
    own = Window.partitionBy("conv", "root_turn", "block").orderBy("turn", F.xxhash64("body"))
    numbered = placed.withColumn("k", F.row_number().over(own))
    same = [numbered[c].eqNullSafe(before[c]) for c in ("conv", "root_turn", "block")]
    joined = numbered.join(before, same[0] & same[1] & same[2])
    kept = [numbered[c] for c in placed.columns if c != "block"]
    return joined.select(*kept, (F.col("before") + F.col("k") - 1).cast("long").alias("position"))
