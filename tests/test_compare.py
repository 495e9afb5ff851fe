"""Section comparison against a plain version that tries every chain."""

from __future__ import annotations

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from docflow.operators import compare

SCHEMA = "doc long, position long, text string, i string, change string"


def chains(pairs):
    """All rising chains of pairs (i, j, weight), as lists of numbers."""
    for n in range(1, len(pairs) + 1):
        for c in combinations(range(len(pairs)), n):
            if all(pairs[p][0] < pairs[q][0] and pairs[p][1] < pairs[q][1] for p, q in zip(c, c[1:])):
                yield c


@pytest.mark.parametrize("seed", range(6))
def test_heaviest_chain(seed):
    rng = random.Random(seed)
    for _ in range(60):
        pairs = sorted({(rng.randrange(6), rng.randrange(6)): rng.choice([500, 700, 1000]) for _ in range(rng.randint(1, 9))}.items())
        pairs = [(i, j, w) for (i, j), w in pairs]
        found = compare.heaviest(*map(list, zip(*pairs)))
        weight = lambda c: sum(pairs[p][2] for p in c)
        best = max(map(weight, chains(pairs)))
        assert tuple(found) in set(chains(pairs)) and weight(found) == best
        # of equally heavy ones the last pair is the least, then the one before it
        assert found[::-1] == min(list(c[::-1]) for c in chains(pairs) if weight(c) == best)


def plain(old, new, rare=4, least=500):
    """old, new: {position: text} of one document."""
    def occurrences(side):
        seen, out = {}, {}
        for p in sorted(side):
            seen[side[p]] = seen.get(side[p], 0) + 1
            out[side[p], seen[side[p]]] = p
        return out

    a, b = occurrences(old), occurrences(new)
    pairs = {(a[x], b[x]): 1000 for x in a if x in b}
    left = [p for p in old if p not in {i for i, _ in pairs}]
    right = [p for p in new if p not in {j for _, j in pairs}]
    count = lambda side, at, w: sum(w in side[p].split() for p in at)
    for i in left:
        for j in right:
            x, y = set(old[i].split()), set(new[j].split())
            if any(count(old, left, w) <= rare and count(new, right, w) <= rare for w in x & y):
                weight = min(1000 * len(x & y) // len(x | y), 999)
                if weight >= least:
                    pairs[i, j] = weight
    listed = sorted((i, j, w) for (i, j), w in pairs.items())
    kept = [listed[p] for p in compare.heaviest(*map(list, zip(*listed)))] if listed else []
    out = [("same" if w == 1000 else "changed", i, j, w) for i, j, w in kept]
    out += [("moved", i, j, w) for i, j, w in listed if w == 1000 and (i, j, w) not in kept]
    out += [("removed", p, None, None) for p in old if p not in {r[1] for r in out}]
    return out + [("added", None, p, None) for p in new if p not in {r[2] for r in out}]


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) if not isinstance(x, str) else (True, x) for x in r))


@pytest.mark.parametrize("block", [4, 32_768])
def test_documents_of_every_kind(spark, block):
    rng = random.Random(block)
    vocabulary = [f"w{i}" for i in range(40)]
    old, new, expected = [], [], []
    for doc in range(25):
        lines = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 8))) for _ in range(rng.randint(0, 14))] + ["again and again"] * rng.randint(0, 3)
        rng.shuffle(lines)
        mine = {3 * p: x for p, x in enumerate(lines)}
        other = list(lines)
        for _ in range(rng.randint(0, 5)):
            if other:
                p = rng.randrange(len(other))
                act = rng.choice(["drop", "move", "reword", "add", "swap words"])
                if act == "drop":
                    other.pop(p)
                elif act == "move":
                    other.insert(rng.randrange(len(other)), other.pop(p))
                elif act == "reword":
                    other[p] += " reworded"
                elif act == "swap words":
                    other[p] = " ".join(reversed(other[p].split()))
                else:
                    other.insert(p, f"brand new {doc} {p}")
        yours = {2 * p + 1: x for p, x in enumerate(other)}
        old += [(doc, p, x, "q", "r") for p, x in mine.items()]
        new += [(doc, p, x, "q", "r") for p, x in yours.items()]
        expected += [(doc, *r) for r in plain(mine, yours)]
    rng.shuffle(old)
    odd = [(None, 1, "no document", "q", "r"), (3, 900, None, "q", "r"), (77, 1, "only here", "q", "r"), (78, 5, "", "q", "r")]
    expected += [(77, "removed", 1, None, None), (78, "removed", 5, None, None)]
    found = compare.compare_sections(spark.createDataFrame(old + odd, SCHEMA), spark.createDataFrame(new + odd[:2], SCHEMA), ["doc"], block=block)
    assert found.columns == ["doc", "change", "old_position", "new_position", "similarity"]
    assert order(map(tuple, found.collect())) == order(expected)
    assert {"same", "changed", "moved", "removed", "added"} == {r[1] for r in expected}


def test_segments_hold_what_moves_tie_together(spark):
    """A long document without moves falls into as many segments as it has sections; one move ties those it passes."""
    pairs = [(1, i, i, 1000) for i in range(200) if i != 50] + [(1, 50, 60, 1000), (1, 60, 61, 1000)]
    df = spark.createDataFrame(pairs, "doc long, i long, j long, weight long")
    sizes = sorted(r["count"] for r in compare.segments(df, ["doc"], 16).groupBy("doc", "segment").count().collect())
    assert sizes[-1] == 13 and sizes.count(1) == len(sizes) - 1


def test_equal_sections_make_as_many_pairs_as_there_are(spark):
    """Thousands of equal sections on both sides: pairs by occurrence, never all with all."""
    rows = [(1, p, "the same line", "", "") for p in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = compare.compare_sections(df, df.filter("position < 2500"), ["doc"])
    assert {r["change"]: r["count"] for r in found.groupBy("change").count().collect()} == {"same": 2500, "removed": 500}


def test_segments_stream_through_tasks(spark):
    """Segments of one and of many pairs, cut by batches of 3 rows, without a group of Python for each."""
    rng, rows, want = random.Random(5), [], set()
    for doc in ("a", "b"):
        at = 0
        for n in (1, 1, 7, 1, 2, 11, 1, 3, 6, 1):
            js = rng.sample(range(n), n)
            if n > 1:  # the first and the last pair cross all others, so they tie the segment
                js = [n - 1, *[j for j in js if j not in (0, n - 1)], 0]
            listed = [(at + i, at + j, rng.choice([500, 700, 1000])) for i, j in enumerate(js)]
            rows += [(doc, *p) for p in listed]
            want |= {(doc, *listed[p][:2]) for p in compare.heaviest(*map(list, zip(*listed)))}
            at += n
    rng.shuffle(rows)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, 3)
    try:
        found = compare.ordered(spark.createDataFrame(rows, "doc string, i long, j long, weight long"), ["doc"], 4)
        assert sorted(map(tuple, found.collect())) == sorted(want)
        assert "FlatMapGroups" not in found._jdf.queryExecution().executedPlan().toString()
        none = compare.ordered(spark.createDataFrame([], "doc string, i long, j long, weight long"), ["doc"], 4)
        assert none.columns == ["doc", "i", "j"] and none.count() == 0
    finally:
        spark.conf.set(name, before)


def changed_words(seed):
    """Sections of few words in ever new orders and choices, so that every word is in most sections of both versions."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(9)]
    line = lambda mark: " ".join([*rng.sample(vocabulary, rng.randint(1, 7)), *([mark] if rng.random() < 0.3 else [])])
    return {2 * p: line("old") for p in range(30)}, {3 * p + 1: line("new") for p in range(26)}


@pytest.mark.parametrize("least", [0, 1, 334, 500, 667, 999, 1000])
@pytest.mark.parametrize("near", [0, 1 << 40])
def test_alike_sections_are_all_found_however_frequent_their_words(spark, monkeypatch, near, least):
    monkeypatch.setattr(compare, "CELL", 3)  # words are dealt over a grid of tasks
    versions, want = {}, set()
    for doc in range(3):
        old, new = versions[doc] = changed_words(doc)
        for i, j in ((i, j) for i in old for j in new):
            x, y = set(old[i].split()), set(new[j].split())
            weight = min(1000 * len(x & y) // len(x | y), 999)
            if x & y and weight >= least:
                want.add((doc, i, j, weight))
    df = [spark.createDataFrame([(d, p, t) for d in versions for p, t in versions[d][side].items()], "doc long, position long, text string") for side in (0, 1)]
    found = [tuple(r) for r in compare.alike_sections(*df, ["doc"], least, near).select("doc", "i", "j", "weight").collect()]
    assert len(found) == len(set(found)) and set(found) == want and (least == 1000 or want)


def test_words_of_many_sections_pair_them(spark):
    """Eleven equal lines, each reworded: every word they share is in more sections than a few."""
    old, new = ([(1, p, f"row of the yearly table holds the sum {side}", "", "") for p in range(11)] for side in ("before", "now"))
    found = compare.compare_sections(spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA), ["doc"])
    assert sorted(map(tuple, found.collect())) == [(1, "changed", p, p, 777) for p in range(11)]


def test_no_table_goes_through_the_driver(spark, monkeypatch):
    """Tables of numbers are small as files and not in memory, so no join broadcasts one, but for what blocks of a long document inherit."""
    plans, write = [], compare.write_once
    monkeypatch.setattr(compare, "write_once", lambda df, name: (plans.append(df._jdf.queryExecution().executedPlan().toString()), write(df, name))[1])
    old = spark.createDataFrame([(d, p, f"{d} {p} some words", "", "") for d in range(4) for p in (0, 1, 1, 2)], SCHEMA).distinct()
    found = compare.compare_sections(old, old.withColumn("text", F.regexp_replace("text", " 1 ", " one ")), ["doc"])
    assert {r["change"]: r["count"] for r in found.groupBy("change").count().collect()} == {"same": 8, "changed": 4}
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    sent = [line for plan in plans for line in plan.splitlines() if "BroadcastHashJoin" in line and "_block" not in line]
    assert len(plans) > 8 and not sent
    assert compare._LAST // compare.BLOCK == (compare._LAST - compare.BLOCK + 1) // compare.BLOCK  # a short document inherits nothing from its first position
