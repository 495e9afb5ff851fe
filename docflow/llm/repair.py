"""Repair of conversations by iterative-deepening A*: the cheapest edits that give a legal order of roles.

A conversation is searched as a string of small codes, a byte a row. Rows are dealt by ranges of conversation and turn, so that a
conversation of any length spreads over tasks; the pieces of one that lies in several are searched for every state in which
they may be entered and left, and joined by their costs. Only the repaired texts of one conversation run through one task, row
after row, because their digest is a single one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.llm import texts
from docflow.session import write_once

#: Letters of the edits, in the order in which they are tried.
DELETE, INSERT, KEEP, REROLE = "DIKR"
DELETE_COST, INSERT_COST, REROLE_COST, TRUNCATED_COST = 3, 2, 2, 1
#: Initials of roles and faults of rows; a row's code is initial + 4 * fault.
SYSTEM, USER, ASSISTANT, OTHER = range(4)
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
#: What has been said so far: nothing, the system's row, a user's row, an assistant's row.
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
STATES = range(4)
#: The state after a user's or an assistant's row that fits, and after a kept row.
NEXT = (AFTER_USER, AFTER_USER, AFTER_ASSISTANT, AFTER_USER)
KEPT = ({SYSTEM: AFTER_SYSTEM, USER: AFTER_USER}, {USER: AFTER_USER}, {ASSISTANT: AFTER_ASSISTANT}, {USER: AFTER_USER})
#: Insertions that end a conversation from each state.
CLOSING = ("", "II", "I", "")
BLOCK = 16
_REMEMBERED = 50_000

COUNTS = ("n_rows", "blank", "duplicate", "truncated", "illegal", "first", "last", "least", "most", "turns", "first_turn", "last_turn")
_COUNTS = ", ".join(f"{c} long" for c in COUNTS)


def moves(code: int, state: int) -> Iterator[tuple[str, int, int, int]]:
    """Edits of a row in their order: letter, cost, rows used, next state."""
    fault = code >> 2
    late = TRUNCATED_COST if fault == TRUNCATED else 0
    yield DELETE, DELETE_COST, 1, state
    yield INSERT, INSERT_COST, 0, NEXT[state]
    if fault not in (BLANK, DUPLICATE):
        if (kept := KEPT[state].get(code & 3)) is not None:
            yield KEEP, late, 1, kept
        yield REROLE, REROLE_COST + late, 1, NEXT[state]


def least_costs(codes: bytes) -> list[int]:
    """What the rows from each on cost at least, whatever their roles."""
    floor = [0] * (len(codes) + 1)
    for i in range(len(codes) - 1, -1, -1):
        fault = codes[i] >> 2
        floor[i] = floor[i + 1] + (DELETE_COST if fault in (BLANK, DUPLICATE) else TRUNCATED_COST if fault == TRUNCATED else 0)
    return floor


def search(codes: bytes, entry: int, leave: int | None, most: int | None = None) -> tuple[int, str] | None:
    """Cost and letters of the cheapest edits, the ASCII-least of them, by iterative-deepening A*.

    With ``leave`` the edits end with the last row in that state; else they end legally, insertions after the last row included.
    Depth first in the order of the letters, under a bound that rises to the least cost that went beyond it. ``failed`` knows the
    greatest budget with which a place and state have failed; it stays valid from bound to bound. None if there is no way, or none
    that costs ``most`` or less.
    """
    n, floor, failed, path = len(codes), least_costs(codes), {}, []
    closing = [INSERT_COST * len(x) for x in CLOSING]
    beyond = 0

    def visit(i: int, state: int, budget: int, used: int) -> bool:
        nonlocal beyond
        if i == n:
            if leave is not None:
                return state == leave
            if closing[state] > budget:
                beyond = min(beyond, used + closing[state])
                return False
            path.extend(CLOSING[state])
            return True
        need = max(floor[i], failed.get((i, state), -1) + 1)
        if need > budget:
            beyond = min(beyond, used + need)
            return False
        for letter, cost, step, then in moves(codes[i], state):
            if cost > budget:
                beyond = min(beyond, used + cost)
                continue
            path.append(letter)
            if visit(i + step, then, budget - cost, used + cost):
                return True
            path.pop()
        failed[i, state] = budget
        return False

    bound = floor[0]
    most = DELETE_COST * n + 4 * INSERT_COST if most is None else most
    while bound <= most:
        beyond = most + 1
        if visit(0, entry, bound, 0):
            return bound, "".join(path)
        bound = beyond
    return None


Table = dict[tuple[int, int], tuple[int, str]]


def table(codes: bytes) -> Table:
    """Cost and letters of a block for each state of entry and leave that the cheapest edits of a conversation may take.

    Whoever leaves before a user or assistant has spoken deletes every row, but for one row of the system. Of the two other states
    one is searched first. The other is wanted only up to the cost of an insertion more, which turns the one into it.
    """
    n = len(codes)
    out = {(e, e): (DELETE_COST * n, DELETE * n) for e in (START, AFTER_SYSTEM)}
    kept = [(code >> 2 == TRUNCATED, -i) for i, code in enumerate(codes) if code & 3 == SYSTEM and code >> 2 in (SOUND, TRUNCATED)]
    if kept:  # a later row gives the lesser letters
        late, i = min(kept)
        out[START, AFTER_SYSTEM] = (DELETE_COST * (n - 1) + late * TRUNCATED_COST, DELETE * -i + KEEP + DELETE * (n - 1 + i))
    for entry in STATES:
        most = None
        for leave in (AFTER_ASSISTANT, AFTER_USER):
            if (found := search(codes, entry, leave, most)) is not None:
                out[entry, leave], most = found, found[0] + INSERT_COST
    return out


def tables(codes: bytes, known: dict[bytes, Table]) -> list[Table]:
    """The tables of the blocks of a piece; equal blocks are searched once."""
    out = []
    for at in range(0, len(codes), BLOCK):
        block = codes[at : at + BLOCK]
        if block not in known:
            if len(known) >= _REMEMBERED:
                known.clear()
            known[block] = table(block)
        out.append(known[block])
    return out


def togo(blocks: list[Table], end: list[int | None]) -> list[list[int | None]]:
    """What is left to pay from each state before each block, and after the last one; None where there is no way."""
    left = [end]
    for block in reversed(blocks):
        ways = [[cost + left[-1][x] for (e, x), (cost, _) in block.items() if e == entry and left[-1][x] is not None] for entry in STATES]
        left.append([min(w, default=None) for w in ways])
    return left[::-1]


def letters(blocks: list[Table], left: list[list[int | None]], entry: int) -> tuple[int, str]:
    """The state after the last block and the letters on the way there: of the cheapest ways the ASCII-least.

    Ways through one block end with its last row, so none begins another, and the least is found block by block.
    """
    out, state = [], entry
    for block, here, after in zip(blocks, left, left[1:]):
        way, state = min((w, x) for (e, x), (cost, w) in block.items() if e == state and after[x] is not None and cost + after[x] == here[state])
        out.append(way)
    return state, "".join(out)


ENDINGS = [INSERT_COST * len(x) for x in CLOSING]


def solved(codes: bytes, known: dict[bytes, Table], whole: dict[bytes, tuple[int, str]]) -> tuple[int, str]:
    """Cost and letters of a whole conversation."""
    if len(codes) <= BLOCK:
        if codes not in whole:
            if len(whole) >= _REMEMBERED:
                whole.clear()
            whole[codes] = search(codes, START, None)
        return whole[codes]
    blocks = tables(codes, known)
    left = togo(blocks, ENDINGS)
    state, way = letters(blocks, left, START)
    return left[0][START], way + CLOSING[state]


def damaged(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, turn, role, text of rows after damage that follows from conversation and turn alone.

    The checksum of ``conv:turn`` modulo 20 says what happens: 0 drops the row, 1 empties its text, 2 takes ``.!?`` out of it, 3 repeats it,
    4 sets its role to user. Nulls in key, role and text count as one space; a null turn stays null. Other columns are left out.
    """
    blank = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    hit = F.crc32(F.concat_ws(":", blank(conv), blank(turn)).cast("binary")) % 20
    rows = df.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"), blank(role).alias("role"), blank(text).alias("text"), hit.alias("hit"))
    rows = rows.filter("hit <> 0").select(
        "conv", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("hit") == 3, 2).otherwise(1))).alias("copy"),
    )
    return rows.drop("copy")


def same(text: Column) -> Column:
    """Stands for a text where texts are only compared."""
    return F.unhex(F.sha2(text, 256))


def faults(rows: DataFrame) -> DataFrame:
    """conv, turn, role, same, copies, code: one row for all equal rows of a turn; the code is that of the first of them.

    Equal rows are counted before anything is shuffled. A row is a duplicate if its role and text have a smaller turn, which is
    looked up only for what occurs in several turns.
    """
    said = F.rtrim(F.col("text"), F.lit(texts.WHITE))
    end = F.when(said == "", BLANK).when(~F.substring(said, -1, 1).isin(".", "!", "?"), TRUNCATED).otherwise(SOUND)
    each = rows.select("conv", "turn", "role", same(F.col("text")).alias("same"), end.alias("fault"))
    each = each.groupBy("conv", "turn", "role", "same").agg(F.first("fault").alias("fault"), F.count("*").alias("copies"))
    each = write_once(each, "turns")
    order = F.struct(F.col("turn").isNotNull(), F.coalesce("turn", F.lit(0)))
    firsts = each.groupBy("conv", "role", "same").agg(F.min(order).alias("first"), F.count("*").alias("n")).filter("n > 1")
    a, b = each.alias("a"), firsts.alias("b")
    met = F.col("a.conv").eqNullSafe(F.col("b.conv")) & (F.col("a.role") == F.col("b.role")) & (F.col("a.same") == F.col("b.same"))
    later = F.col("b.first").isNotNull() & (F.col("b.first") != F.struct(F.col("a.turn").isNotNull(), F.coalesce("a.turn", F.lit(0))))
    initial = F.substring("a.role", 1, 1)
    kind = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(OTHER)
    fault = F.when((F.col("a.fault") != BLANK) & later, DUPLICATE).otherwise(F.col("a.fault"))
    return a.join(b, met, "left").select("a.conv", "a.turn", "a.role", "a.same", "a.copies", (kind + 4 * fault).cast("int").alias("code"))


class Piece:
    """The rows of one conversation that lie in one task: their codes and what is counted of them."""

    def __init__(self, conv):
        self.conv, self.codes, self.turns = conv, bytearray(), []
        self.count = dict.fromkeys(("least", "most", "first_turn", "last_turn"), None) | {"turns": 0}

    def add(self, turn: int | None, code: int, copies: int) -> None:
        again = code if code >> 2 == BLANK else (code & 3) + 4 * DUPLICATE
        self.codes.append(code)
        self.codes.extend(bytes([again]) * (copies - 1))
        if turn is not None:
            c = self.count
            c["turns"] += turn != c["last_turn"]
            c["last_turn"] = c["most"] = turn
            if c["first_turn"] is None:
                c["first_turn"] = c["least"] = turn

    def counts(self) -> dict:
        kinds = [c >> 2 for c in self.codes]
        legal = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
        said = [c & 3 for c in self.codes]
        return self.count | {
            "n_rows": len(kinds), "blank": kinds.count(BLANK), "duplicate": kinds.count(DUPLICATE), "truncated": kinds.count(TRUNCATED),
            "illegal": sum(pair not in legal for pair in zip(said, said[1:])), "first": said[0], "last": said[-1],
        }


def pieces(rows: DataFrame) -> DataFrame:
    """One row per conversation and task. Conversations that lie in a single task for certain have cost and audit; the first and the
    last of a task, which may go on in another, have their codes and, for each pair of states, their costs."""
    kind = rows.schema["conv"].dataType.simpleString()
    schema = f"conv {kind}, piece long, edge boolean, cost long, audit string, codes binary, costs array<long>, {_COUNTS}"
    out_schema = rows.sparkSession.createDataFrame([], schema).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, number, known, whole = to_arrow_schema(out_schema), TaskContext.get().partitionId(), {}, {}

        def finished(p: Piece, edge: bool) -> dict:
            row = {"conv": p.conv, "piece": number, "edge": edge} | p.counts()
            codes = bytes(p.codes)
            if not edge:
                cost, audit = solved(codes, known, whole)
                return row | {"cost": cost, "audit": audit}
            blocks = tables(codes, known)
            ends = [[0 if x == y else None for y in STATES] for x in STATES]
            costs = [togo(blocks, end)[0] for end in ends]
            return row | {"codes": codes, "costs": [costs[x][e] for e in STATES for x in STATES]}

        now, first, done = None, True, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv", "turn", "code", "copies")]
            for conv, turn, code, copies in zip(*columns):
                if now is None or conv != now.conv:
                    if now is not None:
                        done.append(finished(now, first))
                        first = False
                    now = Piece(conv)
                now.add(turn, code, copies)
            if done:
                yield pa.RecordBatch.from_pylist(done, arrow)
                done = []
        if now is not None:
            yield pa.RecordBatch.from_pylist([finished(now, True)], arrow)

    order = "conv", "turn", "role", "same"
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "turn", "code", "copies").mapInArrow(run, schema)


def joined(parts: DataFrame) -> DataFrame:
    """The conversations that lie in several pieces: counts put together, costs summed along the cheapest way, letters in order.

    What meets in one group is a few numbers per task, however many rows the conversation has; only its letters, which are the
    result, come together in the end.
    """
    kind = parts.schema["conv"].dataType.simpleString()
    narrow = F.struct("piece", "costs", *COUNTS)
    grouped = parts.groupBy("conv").agg(F.array_sort(F.collect_list(narrow)).alias("parts"))

    @F.arrow_udf(f"struct<cost:bigint,left:array<struct<piece:bigint,after:array<bigint>>>,{_COUNTS.replace(', ', ',').replace(' ', ':')}>")
    def combine(column: pa.Array) -> pa.Array:
        return pa.array([combined(row) for row in column.to_pylist()], pa.struct([
            ("cost", pa.int64()), ("left", pa.list_(pa.struct([("piece", pa.int64()), ("after", pa.list_(pa.int64()))]))), *((c, pa.int64()) for c in COUNTS),
        ]))

    whole = write_once(grouped.select("conv", combine.asNondeterministic()("parts").alias("c")), "joined")
    ends = whole.select(F.col("conv").alias("of"), F.explode("c.left").alias("l")).select("of", F.col("l.piece").alias("at"), "l.after")
    mine = (F.col("piece") == F.col("at")) & F.col("conv").eqNullSafe(F.col("of"))

    @F.arrow_udf("array<struct<leave:int,way:string>>")
    def ways(codes: pa.Array, after: pa.Array) -> pa.Array:
        known: dict[bytes, Table] = {}
        out = []
        for c, end in zip(codes.to_pylist(), after.to_pylist()):
            blocks = tables(c, known)
            left = togo(blocks, end)
            out.append([dict(zip(("leave", "way"), letters(blocks, left, e) if left[0][e] is not None else (-1, ""))) for e in STATES])
        return pa.array(out, pa.list_(pa.struct([("leave", pa.int32()), ("way", pa.string())])))

    found = parts.join(ends, mine).select("conv", "piece", ways.asNondeterministic()("codes", "after").alias("ways"))
    found = write_once(found, "ways")

    @F.arrow_udf("array<struct<piece:bigint,entry:int>>")
    def entries(column: pa.Array) -> pa.Array:
        out = []
        for row in column.to_pylist():
            state, at = START, []
            for part in row:
                at.append({"piece": part["piece"], "entry": state})
                state = part["leaves"][state]
            at.append({"piece": -1, "entry": state})
            out.append(at)
        return pa.array(out, pa.list_(pa.struct([("piece", pa.int64()), ("entry", pa.int32())])))

    leaves = F.struct("piece", F.transform("ways", lambda w: w["leave"]).alias("leaves"))
    walked = found.groupBy("conv").agg(F.array_sort(F.collect_list(leaves)).alias("parts"))
    walked = walked.select(F.col("conv").alias("of"), F.explode(entries.asNondeterministic()("parts")).alias("e")).select("of", F.col("e.piece").alias("at"), "e.entry")
    closing = F.element_at(F.array(*map(F.lit, CLOSING)), F.col("entry") + 1)
    said = found.join(walked.filter("at >= 0"), mine).select("conv", "piece", F.element_at("ways", F.col("entry") + 1)["way"].alias("way"))
    said = said.unionByName(walked.filter("at < 0").select(F.col("of").alias("conv"), F.lit(2**62).alias("piece"), closing.alias("way")))
    said = said.groupBy("conv").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece", "way"))), lambda x: x["way"]), "").alias("audit"))
    a, b = whole.alias("a"), said.alias("b")
    return a.join(b, F.col("a.conv").eqNullSafe(F.col("b.conv"))).select("a.conv", "a.c.cost", "b.audit", *(f"a.c.{c}" for c in COUNTS))


def combined(parts: list[dict]) -> dict:
    """Of a conversation's pieces in order: its counts, its cost, and what is left to pay after each piece."""
    legal = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
    out = {c: sum(p[c] for p in parts) for c in ("n_rows", "blank", "duplicate", "truncated", "illegal", "turns")}
    out["illegal"] += sum((p["last"], q["first"]) not in legal for p, q in zip(parts, parts[1:]))
    out |= {"first": parts[0]["first"], "last": parts[-1]["last"], "first_turn": None, "last_turn": None, "least": None, "most": None}
    for p in parts:
        if p["first_turn"] is not None:
            out["turns"] -= p["first_turn"] == out["last_turn"]
            out["last_turn"] = out["most"] = p["last_turn"]
            if out["first_turn"] is None:
                out["first_turn"] = out["least"] = p["first_turn"]
    left, end = [], list(ENDINGS)
    for p in reversed(parts):
        left.append({"piece": p["piece"], "after": end})
        ways = [[p["costs"][4 * e + x] + end[x] for x in STATES if p["costs"][4 * e + x] is not None and end[x] is not None] for e in STATES]
        end = [min(w, default=None) for w in ways]
    return out | {"cost": end[START], "left": left}


def repairs(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (conv, turn, role, text): conv, cost, audit, gaps, blank, duplicate, truncated, illegal.

    Rows follow each other by turn, nulls first; those of one turn by role and a digest of the text. A row's first fault counts:
    blank (no character but white space), duplicate (its role and text came before), truncated (its last other character is none
    of ``.!?``). Edits: Keep 0, Rerole to user or assistant 2, Delete 3 (the only one for blank and duplicate rows), Insert an empty row
    of a user or assistant 2; a truncated row that stays adds 1. ``audit`` has the initials of the cheapest edits that leave no row, or an
    optional system row and pairs of user and assistant; of several the ASCII-least. illegal counts neighbours whose roles do not
    begin with su, ua or au; gaps the turns missing between the least and the greatest, nulls aside.

    Null conversations are one of their own; null roles and texts are not expected here (:func:`damaged` makes them a space).
    An empty table gives an empty one. The memory of a task grows by a byte a row of a conversation within it.
    """
    parts = write_once(pieces(faults(rows)), "pieces")
    whole = parts.filter("not edge").select("conv", "cost", "audit", *COUNTS)
    done = whole.unionByName(joined(parts.filter("edge")))
    gaps = F.coalesce(F.col("most") - F.col("least") + 1 - F.col("turns"), F.lit(0)).alias("gaps")
    return done.select("conv", "cost", "audit", gaps, "blank", "duplicate", "truncated", "illegal")


def repaired(rows: DataFrame, done: DataFrame) -> DataFrame:
    """conv, role, text of the rows that the audits in ``done`` leave, in order, each conversation within one task.

    Kept rows stay as they are, reroled ones have the role that fits, inserted ones an empty text. Rows stream: a task holds a batch
    and one audit.
    """
    kind = rows.schema["conv"].dataType.simpleString()
    schema = f"conv {kind}, role string, text string"
    out_schema = rows.sparkSession.createDataFrame([], schema).schema
    none = F.lit(None)
    heads = done.select("conv", F.lit(0).alias("part"), none.cast("long").alias("turn"), F.lit("").alias("role"), F.lit(b"").alias("same"), F.col("audit").alias("text"))
    body = rows.select("conv", F.lit(1).alias("part"), "turn", "role", same(F.col("text")).alias("same"), "text")
    order = "conv", "part", "turn", "role", "same"
    both = heads.unionByName(body).repartition("conv").sortWithinPartitions(*order).select("conv", "part", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(out_schema)
        out: list[tuple] = []
        now: dict = {"conv": None, "audit": "", "at": 0, "state": START}

        def put(role: str, text: str) -> None:
            out.append((now["conv"], role, text))

        def due() -> str:
            now["state"] = NEXT[now["state"]]
            return "user" if now["state"] == AFTER_USER else "assistant"

        def inserted() -> None:
            while now["audit"].startswith(INSERT, now["at"]):
                now["at"] += 1
                put(due(), "")

        for batch in batches:
            for conv, part, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "part", "role", "text"))):
                if part == 0:
                    inserted()
                    now = {"conv": conv, "audit": text, "at": 0, "state": START}
                    continue
                inserted()
                letter = now["audit"][now["at"]]
                now["at"] += 1
                if letter == KEEP:
                    now["state"] = AFTER_SYSTEM if role.startswith("s") else NEXT[now["state"]]
                    put(role, text)
                elif letter == REROLE:
                    put(due(), text)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)
                out.clear()
        inserted()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    return both.mapInArrow(run, schema)


def digests(rows: DataFrame) -> DataFrame:
    """conv and the sha256 of its ``role:text`` lines; ``rows`` as :func:`repaired` gives them, whose order is kept."""
    kind = rows.schema["conv"].dataType.simpleString()
    schema = f"conv {kind}, sha256 string"
    out_schema = rows.sparkSession.createDataFrame([], schema).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(out_schema)
        now, state, done = None, None, []
        for batch in batches:
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "role", "text"))):
                if state is None or conv != now:
                    if state is not None:
                        done.append({"conv": now, "sha256": state.hexdigest()})
                    now, state = conv, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode())
            if done:
                yield pa.RecordBatch.from_pylist(done, arrow)
                done = []
        if state is not None:
            yield pa.RecordBatch.from_pylist([{"conv": now, "sha256": state.hexdigest()}], arrow)

    return rows.mapInArrow(run, schema)
