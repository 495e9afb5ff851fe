"""Two versions of documents side by side: which sections stayed, changed, moved, came and went."""

from __future__ import annotations

from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.operators.scan import BLOCK, Running, row_numbers, running
from docflow.session import write_once

WHOLE = 1000  # similarity of equal texts
NEAR = 4096  # pairs of sections of a document that are compared without an index of words
CELL = 1024  # sections with one word that meet in one task, on either side
_LAST = (1 << 40) - 1  # positions are not above it; counted from there, blocks are the same as counted from 0


def terms(text: Column) -> Column:
    """The different words of a text."""
    return F.array_distinct(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != ""))


def meet(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join that sorts both sides. Rows of numbers take many times the memory of their files, by which a plan would send them through the driver."""
    return left.join(right.hint("merge"), keys, how)


def equal_sections(old: DataFrame, new: DataFrame, keys: list[str], block: int) -> DataFrame:
    """keys, i, j: the k-th section with a text beside the k-th with the same text; as many pairs as the rarer side has sections.

    A text that both versions have once makes its pair as it is counted; only sections of others are numbered.
    """
    def hashed(df: DataFrame, side: int) -> DataFrame:
        return df.select(*keys, F.unhex(F.sha2("text", 256)).alias("same"), F.lit(side).alias("side"), "position")

    both = hashed(old, 0).unionByName(hashed(new, 1))
    mine = lambda side: F.when(F.col("side") == side, F.col("position"))
    ends = [f(mine(side)).alias(f"{name}_{'ij'[side]}") for name, f in (("n", F.count), ("first", F.min)) for side in (0, 1)]
    shared = both.groupBy(*keys, "same").agg(*ends).filter((F.col("n_i") > 0) & (F.col("n_j") > 0))
    often = F.when(F.col("n_i") + F.col("n_j") > 2, F.col("same"))
    texts = write_once(shared.select(*keys, F.col("first_i").alias("i"), F.col("first_j").alias("j"), often.alias("same")), "equal-texts")
    again = write_once(meet(both, texts.filter(F.col("same").isNotNull()).select(*keys, "same"), [*keys, "same"], "left_semi"), "repeated-sections")

    def numbered(side: int, name: str) -> DataFrame:
        one = again.filter(F.col("side") == side).select(*keys, "same", "position")
        return row_numbers(one, [*keys, "same"], "position", "k", block).withColumnRenamed("position", name)

    repeated = meet(numbered(0, "i"), numbered(1, "j"), [*keys, "same", "k"])
    return texts.filter(F.col("same").isNull()).select(*keys, "i", "j").unionByName(repeated.select(*keys, "i", "j"))


def alike_sections(old: DataFrame, new: DataFrame, keys: list[str], least: int, near: int = NEAR) -> DataFrame:
    """keys, i, j, weight: all pairs with ``least`` or more thousandths of their words in common, however frequent these words are.

    Pairs share a word at least. Sections of a document with at most ``near`` pairs meet each with each; those of larger documents by
    :func:`candidates`, which lose none. Words are compared as they are.
    """
    def spelled(df: DataFrame, side: int) -> DataFrame:
        return df.select(*keys, F.lit(side).alias("side"), "position", terms(F.col("text")).alias("words")).filter(F.size("words") > 0)

    rest = write_once(spelled(old, 0).unionByName(spelled(new, 1)), "rest")
    sizes = rest.groupBy(*keys).agg(F.count_if(F.col("side") == 0).alias("n_old"), F.count_if(F.col("side") == 1).alias("n_new"))
    known = write_once(sizes.filter((F.col("n_old") > 0) & (F.col("n_new") > 0)).select(*keys, (F.col("n_old") * F.col("n_new") > near).alias("far")), "rest-sizes")
    dealt = write_once(meet(rest, known, keys), "rest-dealt")

    def one(side: int, position: str, words: str) -> DataFrame:
        return dealt.filter(F.col("side") == side).select(*keys, "far", F.col("position").alias(position), F.col("words").alias(words))

    x, y = one(0, "i", "x"), one(1, "j", "y").drop("far")
    pairs = candidates(dealt.filter("far"), keys, least)
    close = meet(x.filter(~F.col("far")), y, keys).drop("far")
    apart = meet(meet(pairs, x.drop("far"), [*keys, "i"]), y, [*keys, "j"])
    both = close.unionByName(apart).filter(_like(F.size("x"), F.size("y"), least)).withColumn("common", F.size(F.array_intersect("x", "y")))
    weight = F.floor(WHOLE * F.col("common") / (F.size("x") + F.size("y") - F.col("common"))).cast("long")
    below = F.least(weight, F.lit(WHOLE - 1)).alias("weight")  # the same words in another order are not the same text
    return both.filter(F.col("common") > 0).select(*keys, "i", "j", below).filter(F.col("weight") >= least)


def _like(m: Column, n: Column, least: int) -> Column:
    """Whether sections of so many words can have ``least`` thousandths in common."""
    return WHOLE * F.least(m, n).cast("long") >= least * F.greatest(m, n).cast("long")


def candidates(sections: DataFrame, keys: list[str], least: int) -> DataFrame:
    """keys, i, j: pairs of an old (``side`` 0) and a new section, among which are all that have ``least`` thousandths of ``words`` in common.

    All words of a document have one order, by the number of pairs that they lead to. Of n words of a section, at least ``least`` thousandths
    are in a pair's common share, so the first of the common words is among its first n, less these, and one: two sections that share
    none of these words are no pair. Words are hashed, which may add pairs and loses none. A word of many sections on both sides is dealt
    over a grid of tasks.
    """
    words = sections.select(*keys, "side", "position", F.size("words").alias("n"), F.explode(F.transform("words", lambda w: F.xxhash64(w))).alias("word"))
    counts = words.groupBy(*keys, "word").agg(F.count_if(F.col("side") == 0).alias("n_old"), F.count_if(F.col("side") == 1).alias("n_new"))
    shared = write_once(counts.filter((F.col("n_old") > 0) & (F.col("n_new") > 0)), "words")
    cost = F.coalesce(F.col("n_old") * F.col("n_new"), F.lit(0))  # words of one side come first and lead to no pair
    order = F.array_sort(F.collect_list(F.struct(cost.alias("cost"), "word", "n_old", "n_new")))
    ranked = meet(words, shared, [*keys, "word"], "left").groupBy(*keys, "side", "position", "n").agg(order.alias("order"))
    most = F.greatest(F.col("n") - F.ceil(F.lit(least) * F.col("n") / WHOLE) + 1, F.lit(0)).cast("int")
    first = ranked.select(*keys, "side", "position", "n", F.explode(F.slice("order", F.lit(1), most)).alias("w")).filter("w.cost > 0")
    found = write_once(first.select(*keys, "side", "position", "n", "w.word", "w.n_old", "w.n_new"), "first-words")

    def grid(side: int, position: str, n: str) -> DataFrame:
        parts = {"row": F.ceil(F.col("n_old") / CELL).cast("long"), "column": F.ceil(F.col("n_new") / CELL).cast("long")}
        own, other = ("row", "column") if side == 0 else ("column", "row")
        mine = found.filter(F.col("side") == side).withColumn(own, F.pmod(F.xxhash64("position"), parts[own]))
        every = F.explode(F.sequence(F.lit(0).cast("long"), parts[other] - 1))
        return mine.withColumn(other, every).select(*keys, "word", "row", "column", F.col("position").alias(position), F.col("n").alias(n))

    met = meet(grid(0, "i", "m"), grid(1, "j", "n"), [*keys, "word", "row", "column"])
    return met.filter(_like(F.col("m"), F.col("n"), least)).select(*keys, "i", "j").distinct()


def segments(pairs: DataFrame, keys: list[str], block: int) -> DataFrame:
    """Pairs with the number of their segment: of two segments all pairs of the one lie before all of the other on both sides.

    An order of sections is sought within segments only, so what one task holds is what moves have tied together. Segments end where
    no earlier pair reaches beyond a later one: by a running maximum from the start, and one from the end.
    """
    spans = write_once(pairs.groupBy(*keys, "i").agg(F.min("j").alias("lo"), F.max("j").alias("hi")), "spans")
    ahead = running(spans, keys, "i", {"reached": Running("max", F.col("hi"), inclusive=False)}, block=block)
    back = running(spans.withColumn("r", F.lit(_LAST) - F.col("i")), keys, "r", {"left": Running("max", -F.col("lo"))}, block=block)
    opens = F.coalesce((F.col("reached") < -F.col("left")).cast("long"), F.lit(1))
    marked = write_once(meet(ahead, back.select(*keys, "i", "left"), [*keys, "i"]).select(*keys, "i", opens.alias("opens")), "cuts")
    numbered = running(marked, keys, "i", {"segment": Running("sum", F.col("opens"))}, block=block)
    return meet(pairs, numbered.select(*keys, "i", "segment"), [*keys, "i"])


def heaviest(i: Sequence[int], j: Sequence[int], weight: Sequence[int]) -> list[int]:
    """Numbers of the pairs of the heaviest chain that rises on both sides; pairs come by i, then j.

    Of equally heavy chains each pair follows the one of least (i, j), and the last is the one of least (i, j). A binary indexed tree over
    the places j holds the best chain up to each.
    """
    places = {v: k for k, v in enumerate(sorted(set(j)), 1)}
    tree: list[tuple[int, int]] = [(0, 0)] * (len(places) + 1)  # weight, minus number of the pair's turn
    best, before = array("q", bytes(8 * len(i))), array("q", [-1]) * len(i)
    start = 0
    while start < len(i):
        stop = start
        while stop < len(i) and i[stop] == i[start]:
            k, top = places[j[stop]] - 1, (0, 1)
            while k:
                if tree[k] > top and tree[k][0]:
                    top = tree[k]
                k &= k - 1
            best[stop], before[stop] = weight[stop] + top[0], -top[1] if top[0] else -1
            stop += 1
        for p in range(start, stop):  # pairs of one old section do not follow each other
            k, mine = places[j[p]], (best[p], -p)
            while k < len(tree):
                if mine > tree[k]:
                    tree[k] = mine
                k += k & -k
        start = stop
    at = max(range(len(i)), key=lambda p: (best[p], -p))
    chain = []
    while at >= 0:
        chain.append(at)
        at = before[at]
    return chain[::-1]


def ordered(pairs: DataFrame, keys: list[str], block: int) -> DataFrame:
    """keys, i, j of the pairs that keep their order, by :func:`heaviest` within each segment.

    Segments are many and mostly of one pair, which is its own chain: so they do not become a group of Python each, but stream through
    a task in order, which holds one segment and one batch of rows at most.
    """
    parts = segments(pairs, keys, block).select(*keys, "segment", "i", "j", "weight")
    group = [*keys, "segment"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []  # the segment that may go on in the next batch

        def chains(table: pa.Table, starts: list[int]) -> list[pa.RecordBatch]:
            i, j, weight = (table.column(c).to_numpy() for c in ("i", "j", "weight"))
            kept: list[int] = []
            for start, stop in zip(starts, [*starts[1:], table.num_rows]):
                if stop == start + 1:
                    kept.append(start)
                else:
                    kept += [start + p for p in heaviest(*(memoryview(c[start:stop]) for c in (i, j, weight)))]
            return table.select([*keys, "i", "j"]).take(kept).combine_chunks().to_batches()

        for batch in batches:
            if not batch.num_rows:
                continue
            new = pa.Table.from_batches([batch])
            if held and all(held[0].column(c)[0] == new.column(c)[0] == new.column(c)[-1] for c in group):
                held.append(new)
                continue
            table = pa.concat_tables([*held, new])
            first = np.zeros(table.num_rows, dtype=bool)
            first[0] = True
            for c in group:
                column = table.column(c).combine_chunks()
                first[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(first).tolist()
            held = [table.slice(starts[-1])]
            if len(starts) > 1:
                yield from chains(table.slice(0, starts[-1]), starts[:-1])
        if held:
            yield from chains(pa.concat_tables(held), [0])

    together = parts.repartition(*group).sortWithinPartitions(*group, "i", "j")
    return together.mapInArrow(run, parts.select(*keys, "i", "j").schema)


def compare_sections(
    old: DataFrame, new: DataFrame, keys: list[str], position: str = "position", text: str = "text", least: int = 500, block: int = BLOCK
) -> DataFrame:
    """keys, change, old_position, new_position, similarity: every section of both versions once.

    Sections are rows with a document (``keys``), a unique ``position`` (a whole number from 0) and a text; null texts and keys take no part.
    The k-th section of a text pairs with the k-th of the same text in the other version; what finds no equal pairs with all
    sections that have ``least`` thousandths of their words in common with it. The heaviest chain of pairs that keeps the order on both
    sides says what is ``same`` and ``changed``; equal pairs beside it have ``moved``; all else is ``removed`` or ``added``.
    Equally heavy chains are decided by positions, so the answer does not depend on how rows are dealt. Empty sides are fine.
    """
    whole = lambda df: df.select(*keys, F.col(position).cast("long").alias("position"), F.col(text).alias("text")).dropna()
    a, b = write_once(whole(old), "old-sections"), write_once(whole(new), "new-sections")
    equal = write_once(equal_sections(a, b, keys, block), "equal-sections")
    rest = lambda df, n: meet(df, equal.select(*keys, F.col(n).alias("position")), [*keys, "position"], "left_anti")
    alike = alike_sections(rest(a, "i"), rest(b, "j"), keys, least)
    pairs = write_once(equal.withColumn("weight", F.lit(WHOLE).cast("long")).unionByName(alike), "pairs")
    chain = write_once(ordered(pairs, keys, block).withColumn("kept", F.lit(True)), "chain")
    equals = F.col("weight") == WHOLE
    placed = meet(pairs, chain, [*keys, "i", "j"], "left").filter(F.col("kept") | equals)
    change = F.when(F.col("kept").isNull(), "moved").when(equals, "same").otherwise("changed")
    met = write_once(placed.select(*keys, change.alias("change"), F.col("i").alias("old_position"), F.col("j").alias("new_position"), F.col("weight").alias("similarity")), "met")

    def alone(df: DataFrame, side: str, other: str, name: str) -> DataFrame:
        lone = meet(df.withColumnRenamed("position", side), met.select(*keys, side), [*keys, side], "left_anti")
        return lone.select(*keys, F.lit(name).alias("change"), side, F.lit(None).cast("long").alias(other), F.lit(None).cast("long").alias("similarity"))

    return met.unionByName(alone(a, "old_position", "new_position", "removed")).unionByName(alone(b, "new_position", "old_position", "added"))
