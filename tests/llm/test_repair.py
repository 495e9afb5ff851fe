"""Conversation repair against a plain search over whole strings of edits."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from docflow.llm import queries, repair

LEGAL, PART = re.compile(r"(s?(ua)+)?"), re.compile(r"s?(ua)*u?")
SCHEMA = "conv_id long, turn long, role string, text string, conv int, audit string, piece int"


def plain_search(rows: list[tuple[str, str]]) -> tuple[int, str, list[str]]:
    """Uniform cost over strings of edits of (initial, fault) rows; of equal costs the ASCII-least comes first."""
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, said = heapq.heappop(heap)
        if i == len(rows) and LEGAL.fullmatch(said):
            return cost, audit, list(said)
        if (i, said[-1:]) in seen:
            continue
        seen.add((i, said[-1:]))
        ways = [(2, "I", i, said + r) for r in "ua"]
        if i < len(rows):
            initial, fault = rows[i]
            late = fault == "truncated"
            ways.append((3, "D", i + 1, said))
            if fault not in ("blank", "duplicate"):
                ways.append((late, "K", i + 1, said + initial))
                ways += [(2 + late, "R", i + 1, said + r) for r in "ua"]
        for more, letter, then, word in ways:
            if PART.fullmatch(word):
                heapq.heappush(heap, (cost + more, audit + letter, then, word))
    raise AssertionError


def sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def expected(table: list[tuple]) -> list[tuple]:
    space = lambda x: " " if x is None else str(x)
    out = []
    for conv in {r[0] for r in table}:
        rows = []
        for c, turn, role, text in (r[:4] for r in table):
            if c != conv:
                continue
            hit, role, text = zlib.crc32(f"{space(c)}:{space(turn)}".encode()) % 20, space(role), space(text)
            if hit == 1:
                text = ""
            if hit == 2:
                text = re.sub("[.!?]", "", text)
            if hit == 4:
                role = "user"
            rows += [(turn, role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        seen, found, count = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, role, text in rows:
            said = text.rstrip("\x20\x09\x0a\x0b\x0c\x0d")
            fault = "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else ""
            seen.add((role, text))
            if fault:
                count[fault] += 1
            found.append((role[:1] if role[:1] in ("s", "u", "a") else "x", fault))
        cost, audit, said = plain_search(found)
        left, at, k = [], 0, 0
        for letter in audit:
            if letter == "I":
                left.append(f"{'user' if said[k] == 'u' else 'assistant'}:")
                k += 1
                continue
            _, role, text = rows[at]
            at += 1
            if letter == "D":
                continue
            left.append(f"{role}:{text}" if letter == "K" else f"{'user' if said[k] == 'u' else 'assistant'}:{text}")
            k += 1
        turns = [r[0] for r in rows if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in zip(found, found[1:]))
        out.append((conv, gaps, *count.values(), illegal, cost, audit, sha("\n".join(left))))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0))


def made(seed: int, n: int = 120) -> list[tuple]:
    rng = random.Random(seed)
    words = ["Yes.", "no", "Why?", "Well!  \n", "", " \t", None, "é.", "漢", "A long text. " * 30]
    rows = []
    for conv in [*range(n), None]:
        for turn in rng.sample(range(12), rng.randint(1, 7)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            rows.append((conv, rng.choice([turn, turn, turn, turn, None]), role, rng.choice(words)))
            if rng.random() < 0.1:
                rows.append(rows[-1])
    rng.shuffle(rows)
    return [(*r, 5, "x", 6) for r in rows]


def answers(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    names = "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
    df = queries.op13_conversation_repair(spark, str(tmp_path))
    assert df.columns == names
    return sorted(map(tuple, df.collect()), key=lambda r: (r[0] is not None, r[0] or 0))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_whole_tables(spark, tmp_path, seed):
    rows = made(seed)
    assert answers(spark, tmp_path, rows) == expected(rows)


@pytest.mark.parametrize("block", [1, 2, 3, 16])
def test_conversations_over_many_pieces_and_blocks(spark, tmp_path, monkeypatch, block):
    """Two conversations, one with most rows: all tasks hold a piece of it, cut into blocks of any size."""
    monkeypatch.setattr(repair, "BLOCK", block)
    rng = random.Random(block)
    rows = [(9, t, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["Fine.", f"Turn {t}.", "open"]), 1, "", 2) for t in range(26)]
    rows += [(10, 0, "user", "Hello.", 1, "", 2)]
    assert answers(spark, tmp_path, rows) == expected(rows)


def test_every_short_code():
    rng = random.Random(4)
    faults = ["", "blank", "duplicate", "truncated"]
    for _ in range(400):
        codes = bytes(rng.choice([0, 1, 2, 1, 2, 3]) + 4 * rng.choice([0, 0, 0, 1, 2, 3]) for _ in range(rng.randint(0, 6)))
        cost, audit, _ = plain_search([("suax"[c & 3], faults[c >> 2]) for c in codes])
        assert repair.search(codes, repair.START, None) == (cost, audit)


def test_blocks_of_any_size_agree(monkeypatch):
    rng = random.Random(6)
    for _ in range(150):
        codes = bytes(rng.choice([0, 1, 2, 1, 2, 3]) + 4 * rng.choice([0, 0, 0, 1, 2, 3]) for _ in range(rng.randint(1, 14)))
        monkeypatch.setattr(repair, "BLOCK", 16)
        whole = repair.solved(codes, {}, {})
        for block in (1, 2, 5):
            monkeypatch.setattr(repair, "BLOCK", block)
            assert repair.solved(codes, {}, {}) == whole


def test_long_conversations_take_bounded_work():
    """All rows alike, and the same in blocks: the failed places keep the search from growing beyond rows times cost."""
    known, whole = {}, {}
    cost, audit = repair.solved(bytes([repair.USER]) * 60, known, whole)
    assert cost == 60 and audit.count("R") == 30
    long_cost, long_audit = repair.solved(bytes([repair.USER]) * 6000, known, whole)
    assert long_cost == 6000 and sum(long_audit.count(x) for x in "DKR") == 6000


def test_empty_table_and_dropped_rows(spark, tmp_path):
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    assert answers(spark, tmp_path / "a", [(gone, 0, "user", "Hello.", 1, "", 2)]) == [(gone, 0, 0, 0, 0, 0, 0, "", sha(""))]
    assert answers(spark, tmp_path / "b", []) == []


def test_equal_rows_in_masses(spark):
    """A hundred thousand equal rows of one turn are counted before they are dealt."""
    rows = spark.range(100_000).select(F.lit(1).alias("conv"), F.lit(3).cast("long").alias("turn"), F.lit("user").alias("role"), F.lit("Same.").alias("text"))
    assert repair.faults(rows).count() == 1
    row = repair.repairs(rows).first()
    assert (row["cost"], row["duplicate"], row["gaps"]) == (3 * 99_999 + 2, 99_999, 0) and row["audit"] == "K" + "D" * 99_999 + "I"
