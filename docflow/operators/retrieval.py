"""Nearest vectors: exactly, block by block, and through an inverted file of residual codes."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docflow.session import Shared, write_once

#: Similarities are rounded to so many places before they are compared, so that equal ones tie whatever block they come from.
PLACES = 9


def unit_rows(column: pa.Array, width: int) -> np.ndarray:
    """A matrix of unit rows out of vectors of one width."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def usable(df: DataFrame, key: str, vector: str, width: int | None) -> DataFrame:
    """key and v: the vectors of the width wanted that have a direction; null, empty, zero and broken ones are left out."""
    v = F.col(f"`{vector}`").cast("array<float>")
    square = F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    whole = square.isNotNull() & (square > 0) & (square < float("inf")) & F.col(f"`{key}`").isNotNull()
    return df.select(F.col(f"`{key}`").cast("long").alias("key"), v.alias("v")).filter(whole if width is None else whole & (F.size("v") == width))


def width_of(df: DataFrame, vector: str) -> int | None:
    """The commonest size of the vectors, the greater of two as common; a few numbers reach the driver."""
    counted = df.filter(F.size(F.col(f"`{vector}`")) > 0).groupBy(F.size(F.col(f"`{vector}`")).alias("n")).count()
    first = counted.orderBy(F.desc("count"), F.desc("n")).first()
    return None if first is None else first["n"]


#: Queries and keys whose scores are held at once.
QUERY_BLOCK, KEY_BLOCK = 512, 2048


class Best:
    """The k best neighbours of each query so far: a bounded heap per query, held as sorted rows and merged all at once."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.score = np.full((queries, k), -np.inf)
        self.key = np.full((queries, k), np.iinfo(np.int64).max)

    def add(self, scores: np.ndarray, keys: np.ndarray) -> None:
        """Merge a block of scores, a row per query and a column per key; of equal scores the smaller key is better.

        What is below the k-th of its own block is left out first, so few of a block are sorted.
        """
        least = self.score[:, -1:]
        if scores.shape[1] > self.k:
            least = np.maximum(least, np.partition(scores, -self.k, axis=1)[:, -self.k, None])
        row, column = np.nonzero((scores >= least) & np.isfinite(scores))
        if not len(row):
            return
        touched = np.unique(row)
        old_row = np.repeat(touched, self.k)
        rows = np.concatenate([old_row, row])
        found = np.concatenate([self.score[touched].ravel(), scores[row, column]])
        names = np.concatenate([self.key[touched].ravel(), keys[column]])
        order = np.lexsort((names, -found, rows))
        rows, found, names = rows[order], found[order], names[order]
        starts = np.searchsorted(rows, touched)
        keep = (starts[:, None] + np.arange(self.k)).ravel()
        self.score[touched], self.key[touched] = found[keep].reshape(-1, self.k), names[keep].reshape(-1, self.k)

    def rows(self, queries: np.ndarray) -> pa.RecordBatch:
        there = np.isfinite(self.score)
        query = np.repeat(queries, there.sum(axis=1))
        return pa.RecordBatch.from_arrays([pa.array(query), pa.array(self.key[there]), pa.array(self.score[there])], names=["query", "key", "score"])


def top(found: DataFrame, k: int) -> DataFrame:
    """query, rank from 1, key, score: the k best of each query, the smaller key first where scores tie.

    Spark keeps k rows of each query per task before it shuffles them.
    """
    best = Window.partitionBy("query").orderBy(F.desc("score"), "key")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query", "rank", "key", "score")


def runs(cells: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    """Start and stop of rows that agree in all of ``cells``."""
    n = len(cells[0])
    change = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cells])) + 1
    edges = [0, *change.tolist(), n]
    return zip(edges, edges[1:])


def exact_topk(
    queries: DataFrame, corpus: DataFrame, key: str, vector: str, k: int = 10, among_self: bool = False,
    query_rows: int = 16_384, corpus_rows: int = 1_000_000,
) -> DataFrame:
    """The ``k`` most similar rows of ``corpus`` by cosine for every row of ``queries``: query, rank, key, score.

    Queries are dealt into stripes of about ``query_rows``, the corpus into columns of about ``corpus_rows``; a pair of a stripe and a
    column is the work of one task, which holds the stripe and its k best while the column streams through matrix products.
    Neither side is ever sent whole to a task; the least of the column is kept by no one.
    Scores are rounded to ``PLACES``; of equal ones the smaller key comes first. A row is no neighbour of its own key
    unless ``among_self``. Vectors that are null, empty, zero, not finite or of another width than the corpus's commonest take no
    part, nor do null keys. Keys are integers; equal keys are several neighbours. Empty sides give no rows.
    """
    width = width_of(corpus, vector)
    if width is None:
        return queries.sparkSession.createDataFrame([], "query long, rank int, key long, score double")
    q, c = usable(queries, key, vector, width), usable(corpus, key, vector, width)
    stripes = math.ceil(q.count() / query_rows) or 1
    columns = max(math.ceil(c.count() / corpus_rows), math.ceil(q.sparkSession.sparkContext.defaultParallelism / stripes))
    deal = lambda n: F.pmod(F.xxhash64("key", "v"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asks = q.select(deal(stripes).alias("stripe"), every(columns).alias("column"), F.lit(0).alias("side"), "key", "v")
    rows = c.select(every(stripes).alias("stripe"), deal(columns).alias("column"), F.lit(1).alias("side"), "key", "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, names, held, best = None, [], [], None
        for batch in batches:
            stripe, column, side, keys = (batch.column(i).to_numpy() for i in range(4))
            x = unit_rows(batch.column(4), width)
            for a, b in runs([stripe, column, side]):
                if (stripe[a], column[a]) != cell:
                    if best is not None:
                        yield from found(names, best)
                    cell, names, held, best = (stripe[a], column[a]), [], [], None
                if side[a] == 0:
                    names.append(keys[a:b])
                    held.append(x[a:b])
                elif len(names):
                    if best is None:
                        names, held = np.concatenate(names), np.concatenate(held)
                        best = [Best(min(QUERY_BLOCK, len(names) - q), k) for q in range(0, len(names), QUERY_BLOCK)]
                    for i in range(a, b, KEY_BLOCK):
                        j = min(i + KEY_BLOCK, b)
                        for q, mine in zip(range(0, len(names), QUERY_BLOCK), best):
                            scores = np.round(held[q : q + QUERY_BLOCK] @ x[i:j].T, PLACES)
                            if not among_self:
                                scores[names[q : q + QUERY_BLOCK, None] == keys[i:j]] = -np.inf
                            mine.add(scores, keys[i:j])
        if best is not None:
            yield from found(names, best)

    def found(names: np.ndarray, best: list[Best]) -> Iterator[pa.RecordBatch]:
        for q, mine in zip(range(0, len(names), QUERY_BLOCK), best):
            yield mine.rows(names[q : q + QUERY_BLOCK])

    order = "stripe", "column", "side"
    dealt = asks.unionByName(rows).repartition(stripes * columns, "stripe", "column").sortWithinPartitions(*order)
    return top(dealt.mapInArrow(run, "query long, key long, score double"), k)


# ---------------------------------------------------------------- inverted file of residual codes


def centres(x: np.ndarray, n: int, rounds: int = 12) -> np.ndarray:
    """k-means on rows in a fixed order; empty centres move to the rows that are farthest from theirs."""
    rng = np.random.default_rng(11)
    c = x[rng.permutation(len(x))[:n]].copy()
    for _ in range(rounds):
        near = nearest(x, c)
        sums, count = np.zeros_like(c), np.bincount(near, minlength=len(c))
        np.add.at(sums, near, x)
        full = count > 0
        c[full] = sums[full] / count[full, None]
        if not full.all():
            far = np.argsort(-((x - c[near]) ** 2).sum(axis=1))[: int((~full).sum())]
            c[~full] = x[far]
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), np.int64)
    half = (c * c).sum(axis=1) / 2
    for i in range(0, len(x), 8192):
        out[i : i + 8192] = (half - x[i : i + 8192] @ c.T).argmin(axis=1)
    return out


@dataclass
class Quantizer:
    """Coarse cells, and for each part of a vector the codes of what is left of it beside its cell."""

    cells: np.ndarray
    books: np.ndarray  # parts, codes, width of a part

    @property
    def width(self) -> int:
        return self.cells.shape[1]

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell, and a byte per part, of unit rows."""
        cell = nearest(x, self.cells)
        rest, w = x - self.cells[cell], self.books.shape[2]
        return cell, np.stack([nearest(rest[:, i * w : (i + 1) * w], book) for i, book in enumerate(self.books)], axis=1).astype(np.uint8)

    def decode(self, cell: int, codes: np.ndarray) -> np.ndarray:
        """What rows of a cell are by their codes."""
        return self.cells[cell] + np.concatenate([book[codes[:, p]] for p, book in enumerate(self.books)], axis=1)


#: Rows that cells and codes are learned from, at most about; all rows are indexed.
SAMPLE_ROWS = 50_000


def train(corpus: DataFrame, key: str, vector: str, cells: int | None = None, parts: int = 8, codes: int = 256, sample: int = SAMPLE_ROWS) -> Quantizer | None:
    """Learn cells and codes from about ``sample`` rows, drawn by a hash of key and vector; None if there is nothing to learn from.

    By default there are as many cells as the root of the number of rows, 4096 at most. The width must divide into ``parts``.
    """
    width = width_of(corpus, vector)
    if width is None:
        return None
    if width % parts:
        raise ValueError(f"a width of {width} does not divide into {parts} parts")
    rows = usable(corpus, key, vector, width).withColumn("h", F.xxhash64("key", "v"))
    n = rows.count()
    drawn = rows if n <= sample else rows.filter(F.pmod("h", F.lit(1 << 30)) < int(sample / n * (1 << 30)))
    taken = drawn.select("h", "v").toArrow().combine_chunks()
    if not len(taken):
        return None
    x = unit_rows(taken.column("v").combine_chunks(), width)[np.argsort(taken.column("h").to_numpy(), kind="stable")]
    c = centres(x, min(cells or min(4096, math.ceil(math.sqrt(n))), len(x)))
    rest, w = x - c[nearest(x, c)], width // parts
    books = [centres(rest[:, i * w : (i + 1) * w], min(codes, len(x))) for i in range(parts)]
    return Quantizer(c, np.stack(books))


def index(corpus: DataFrame, key: str, vector: str, quantizer: Quantizer) -> DataFrame:
    """cell, key and code of every usable row, written once; codes are a byte a part."""
    shared = Shared(corpus.sparkSession, quantizer)  # 4096 cells and 256 codes a part at most

    @F.arrow_udf("struct<cell:int,code:binary>")
    def encode(column: pa.Array) -> pa.Array:
        fitted: Quantizer = shared.value
        cell, code = fitted.encode(unit_rows(column, fitted.width))
        codes = pa.array([r.tobytes() for r in code], pa.binary())
        return pa.StructArray.from_arrays([pa.array(cell.astype(np.int32)), codes], names=["cell", "code"])

    rows = usable(corpus, key, vector, quantizer.width).select("key", encode.asNondeterministic()("v").alias("e"))
    return write_once(rows.select("e.cell", "key", "e.code"), "vector-index")


def index_topk(
    queries: DataFrame, corpus: DataFrame, indexed: DataFrame, quantizer: Quantizer, key: str, vector: str, k: int = 10, probes: int = 8,
    again: int = 100, among_self: bool = False, part_rows: int = 200_000, query_rows: int = 4096, corpus_rows: int = 1_000_000,
) -> DataFrame:
    """As :func:`exact_topk`, but only rows of the ``probes`` nearest cells of a query are looked at.

    Codes rank them, and the ``again`` best by codes are compared by their vectors, so scores are exact and only rows may be
    missing. As there, queries are dealt into stripes of about ``query_rows`` and the codes, by cell, into columns of about ``corpus_rows``; a
    task holds a stripe, its probes and its best while the codes stream by, so a query leaves ``again`` rows a column however many cells
    it probes. Cells with more than ``part_rows`` rows are split. Keys of the corpus and of the queries are unique.
    """
    shared = Shared(queries.sparkSession, quantizer)
    q = usable(queries, key, vector, quantizer.width)
    stripes = math.ceil(q.count() / query_rows) or 1
    columns = max(math.ceil(indexed.count() / corpus_rows), math.ceil(q.sparkSession.sparkContext.defaultParallelism / stripes))
    sizes = indexed.groupBy("cell").agg(F.ceil(F.count("*") / part_rows).cast("int").alias("parts"))  # a row per cell
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    part = F.pmod(F.xxhash64("key", "code"), "parts")
    codes = indexed.join(F.broadcast(sizes), "cell").select(
        every(stripes).alias("stripe"), F.pmod(F.xxhash64("cell", part), F.lit(columns)).cast("int").alias("column"), F.lit(1).alias("side"), "cell", "key", "code",
        F.lit(None).cast("array<float>").alias("v"),
    )
    asks = q.select(
        F.pmod(F.xxhash64("key", "v"), F.lit(stripes)).cast("int").alias("stripe"), every(columns).alias("column"), F.lit(0).alias("side"), F.lit(-1).alias("cell"), "key",
        F.lit(None).cast("binary").alias("code"), "v",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted: Quantizer = shared.value
        parts = len(fitted.books)
        place, names, held, best = None, [], [], None
        for batch in batches:
            stripe, column, side, cell, keys = (batch.column(i).to_numpy() for i in range(5))
            for a, b in runs([stripe, column, side, cell]):
                if (stripe[a], column[a]) != place:
                    if best is not None:
                        yield from found(names, best)
                    place, names, held, best = (stripe[a], column[a]), [], [], None
                if side[a] == 0:
                    names.append(keys[a:b])
                    held.append(unit_rows(batch.column(6).slice(a, b - a), fitted.width))
                elif len(names):
                    if best is None:
                        names, held = np.concatenate(names), np.concatenate(held)
                        probed = probes_of(fitted, held)
                        best = [Best(min(QUERY_BLOCK, len(names) - q), again) for q in range(0, len(names), QUERY_BLOCK)]
                    code = np.frombuffer(b"".join(batch.column(5).slice(a, b - a).to_pylist()), np.uint8).reshape(b - a, parts)
                    for i in range(a, b, KEY_BLOCK):
                        j = min(i + KEY_BLOCK, b)
                        x = fitted.decode(cell[a], code[i - a : j - a]).T
                        for q, mine in zip(range(0, len(names), QUERY_BLOCK), best):
                            scores = np.round(held[q : q + QUERY_BLOCK] @ x, PLACES)
                            scores[~probed[q : q + QUERY_BLOCK, cell[a]]] = -np.inf
                            if not among_self:
                                scores[names[q : q + QUERY_BLOCK, None] == keys[i:j]] = -np.inf
                            mine.add(scores, keys[i:j])
        if best is not None:
            yield from found(names, best)

    def probes_of(fitted: Quantizer, x: np.ndarray) -> np.ndarray:
        """A row per query and a column per cell: whether it is one of the ``probes`` nearest."""
        out = np.zeros((len(x), len(fitted.cells)), bool)
        for i in range(0, len(x), QUERY_BLOCK):
            near = np.argsort(-(x[i : i + QUERY_BLOCK] @ fitted.cells.T), axis=1, kind="stable")[:, :probes]
            np.put_along_axis(out[i : i + QUERY_BLOCK], near, True, axis=1)
        return out

    def found(names: np.ndarray, best: list[Best]) -> Iterator[pa.RecordBatch]:
        for q, mine in zip(range(0, len(names), QUERY_BLOCK), best):
            yield mine.rows(names[q : q + QUERY_BLOCK])

    order = "stripe", "column", "side", "cell"
    met = codes.unionByName(asks).repartition(stripes * columns, "stripe", "column").sortWithinPartitions(*order).mapInArrow(run, "query long, key long, score double")
    wanted = top(met, again).select("query", "key")
    c = usable(corpus, key, vector, quantizer.width)
    both = wanted.join(c.select("key", F.col("v").alias("x")), "key").join(q.select(F.col("key").alias("query"), F.col("v").alias("y")), "query")
    return top(both.select("query", "key", F.round(cosine(F.col("x"), F.col("y")), PLACES).alias("score")), k)


def cosine(a: Column, b: Column) -> Column:
    total = lambda values: F.aggregate(values, F.lit(0.0), lambda s, x: s + x)
    dot = lambda x, y: total(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")))
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def recall(found: DataFrame, exact: DataFrame) -> float:
    """The share of exact neighbours that were found."""
    hit = exact.join(found.select("query", "key", F.lit(1).alias("hit")), ["query", "key"], "left").agg(F.count("hit"), F.count("*")).first()
    return hit[0] / hit[1] if hit[1] else 1.0
