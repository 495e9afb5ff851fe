"""Shingle Jaccard join, heavy and light: small sets meet in subsets of a fixed size, large ones in inverted lists."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm import exchange as ex
from docflow.llm import texts
from docflow.llm.components import stars
from docflow.session import write_once

_LAST = np.iinfo(np.int64).max
_COUNTS = 0
LIGHT_LIMIT = 40
SETS = "key long, n_shingles long, node long, elements array<bigint>, prefix int, centre double, scan double"


def least_overlap(n: int, m: int, percent: int) -> int:
    """Smallest overlap at which sets of ``n`` and ``m`` are similar: 100 i >= percent (n + m - i)."""
    return -(-percent * (n + m) // (100 + percent))


class Shingles:
    """The distinct shingles of each document of a chunk, as hashes: ``hash`` in ``doc`` order, sorted within a document."""

    def __init__(self, documents: pa.Table, width: int):
        words = texts.Words(documents.column("text"), lower=True)
        start, h = words.start, words.hashes()
        sizes = np.diff(start)
        room = np.repeat(start[1:], sizes) - np.arange(len(h))
        at = np.flatnonzero(room >= width)
        found, doc = [ex.rolled(h, width)[at] if len(at) else h[:0]], [np.searchsorted(start, at, side="right") - 1]
        for n in range(1, width):  # the whole of a shorter document is its only shingle
            short = np.flatnonzero(sizes == n)
            if len(short):
                found.append(ex.mixed(ex.rolled(h, n)[start[short]] + np.uint64(n)))
                doc.append(short)
        h, doc = np.concatenate(found), np.concatenate(doc)
        order = np.argsort(h)
        order = order[np.argsort(doc[order].astype(np.min_scalar_type(len(sizes))), kind="stable")]
        h, doc = h[order], doc[order]
        new = np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])] if len(h) else np.zeros(0, bool)
        self.hash, self.doc = h[new], doc[new]
        self.start = np.searchsorted(self.doc, np.arange(len(sizes) + 1))


class CountAsk:
    """What a chunk asks: in how many documents, here and elsewhere, is each of its shingles?"""

    def __init__(self, shingles: Shingles, parts: int):
        h = shingles.hash
        code = (ex.part_of(h, parts).astype(np.uint64) << np.uint64(32)) | (h >> np.uint64(32))
        distinct, self.to_shingle, times = np.unique(code, return_inverse=True, return_counts=True)
        self.part, self.tails = (distinct >> np.uint64(32)).astype(np.int64), distinct.astype(np.uint32)
        self.times = np.minimum(times, 0xFFFF).astype(np.uint16)


def rows_of(shingles: Shingles, keys: np.ndarray, ranks: np.ndarray, percent: int) -> Iterator[tuple]:
    """A row per document; sets that can be similar to another have their shared elements, rarest first, once per chunk.

    ``ranks`` are 0 for a shingle that no other document has, and grow with the number of documents.
    """
    seen: set[int] = set()
    weight = np.exp2(ranks.astype(np.float64) / 12)
    for d, key in enumerate(keys.tolist()):
        own = slice(shingles.start[d], shingles.start[d + 1])
        n = own.stop - own.start
        rank = ranks[own]
        shared = int(np.count_nonzero(rank))
        if not n or shared < -(-percent * n // 100):
            yield key, n, None, None, None, None, None
            continue
        h = shingles.hash[own]
        node = struct.unpack("<q", xxhash.xxh3_64_digest(h.tobytes()))[0]
        if node in seen:
            yield key, n, node, None, None, None, None
            continue
        seen.add(node)
        order = np.lexsort((h, rank))[n - shared :]
        prefix = n - -(-percent * n // 100) + 1 - (n - shared)
        yield key, n, node, h[order].view(np.int64), prefix, float(rank.mean()), float(weight[own][order[:prefix]].sum())


def find_sets(df: DataFrame, key: str, text: str, width: int, percent: int) -> DataFrame:
    """The sets of all rows, written; see ``rows_of``."""
    chunks = ex.write_chunks(df.select(F.coalesce(F.col(key).cast("long"), F.lit(_LAST)).alias("key"), F.col(text).alias("text")), "key", "text")
    parts = chunks.parts

    def ask(chunk: int, documents: pa.Table) -> Iterator[pa.RecordBatch]:
        own = CountAsk(Shingles(documents, width), parts)
        rows = list(zip(*[(p, chunk, ex.squeezed(a, 4), ex.squeezed(b, 2)) for p, (a, b) in ex.dealt(own.part, parts, own.tails, own.times)])) or [()] * 4
        kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
        yield pa.record_batch([pa.array(c, t) for c, t in zip(rows, kinds)], names=["part", "chunk", "tails", "times"])

    def finish(chunk: int, documents: pa.Table, answers: pa.Table) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(documents, width)
        own = CountAsk(shingles, parts)
        told = ex.answers_of(answers, _COUNTS)
        ranks = np.concatenate([np.frombuffer(ex.widened(told[p]), np.uint8) for p in sorted(told)] or [np.zeros(0, np.uint8)])
        columns = list(zip(*rows_of(shingles, documents.column("key").to_numpy(), ranks[own.to_shingle], percent))) or [()] * len(kinds)
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    names = [x.split()[0] for x in SETS.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.float64(), pa.float64()]
    counts = write_once(ex.answered(chunks.ask("part int, chunk long, tails binary, times binary", ask), answer_counts), "counts")
    return write_once(chunks.ask(SETS, finish, counts), "sets")


def answer_counts(table: pa.Table) -> pa.Table:
    """Ranks of shingles: 0 for a single document, else about twelve times the logarithm of the number."""
    tails = [np.frombuffer(ex.widened(x.as_py()), np.uint32) for x in table.column("tails")]
    times = np.concatenate([np.frombuffer(ex.widened(x.as_py()), np.uint16) for x in table.column("times")])
    every, group = np.unique(np.concatenate(tails), return_inverse=True)
    total = np.bincount(group, weights=times, minlength=len(every))
    rank = np.where(total > 1, np.minimum(255, 12 * np.log2(np.maximum(total, 1))), 0).astype(np.uint8)[group]
    found = np.split(rank, np.cumsum([len(x) for x in tails])[:-1])
    return pa.table({
        "chunk": table.column("chunk"), "part": table.column("part"), "kind": pa.array([_COUNTS] * len(table), pa.int32()),
        "bits": pa.array([ex.squeezed(x.tobytes(), 1) for x in found], pa.binary()),
    })


def boundary(classes: DataFrame, percent: int) -> int:
    """Largest size of a light set: where enumerating subsets up to it and scanning lists beyond it costs least."""
    sizes = classes.filter(F.col("n") <= LIGHT_LIMIT).groupBy("n").agg(F.count("*").alias("sets"), F.sum("scan").alias("scan")).collect()  # LIGHT_LIMIT rows
    cost = {r["n"]: r["sets"] * sum(comb(r["n"], least_overlap(r["n"], m, percent)) for m in partners(r["n"], percent)) - r["scan"] for r in sizes}
    best, least, total = 0, 0.0, 0.0
    for n in range(1, LIGHT_LIMIT + 1):
        total += cost.get(n, 0.0)
        if total <= least and n in cost:
            best, least = n, total
    return best


def partners(n: int, percent: int) -> range:
    return range(-(-percent * n // 100), n * 100 // percent + 1)


def light_links(classes: DataFrame, most: int, percent: int) -> DataFrame:
    """Links between sets of at most ``most`` elements, each to the least set of those that share a subset of the size needed.

    For sizes n <= m the subsets have the least overlap that makes sets of n and m similar; sets of n that share
    one with a set of m are similar to it, so that all of them hang together if both sizes are there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for node, n, elements in zip(*(batch.column(c).to_pylist() for c in ("node", "n", "elements"))):
                own = sorted(elements)
                for m in partners(n, percent):
                    if m > most:
                        continue
                    need, pair = least_overlap(n, m, percent), (min(n, m), max(n, m))
                    for subset in combinations(own, need):
                        meet = xxhash.xxh3_128_digest(struct.pack(f"<2q{need}q", *pair, *subset))
                        rows.append((meet, node, n == pair[0], n == pair[1]))
                if len(rows) > 1 << 16:
                    yield meeting(rows)
                    rows = []
            yield meeting(rows)

    small = classes.filter(F.col("n") <= most).select("node", "n", "elements")
    met = small.mapInArrow(run, "meet binary, a long, smaller boolean, larger boolean")
    groups = met.groupBy("meet").agg(F.min("a").alias("b"), F.max("smaller").alias("s"), F.max("larger").alias("l"), F.count("*").alias("k"))
    return met.join(groups.filter("s and l and k > 1"), "meet").filter("a <> b").select("a", "b").distinct()


def meeting(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 4
    kinds = (pa.binary(), pa.int64(), pa.bool_(), pa.bool_())
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names=["meet", "a", "smaller", "larger"])


def similar(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs a, b that are similar, by their whole sets."""
    sets = classes.select("node", "n", "elements")
    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("elements").alias("e_a")), "a")
    both = left.join(sets.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("elements").alias("e_b")), "b")
    overlap = F.size(F.array_intersect("e_a", "e_b"))
    return both.filter((100 + percent) * overlap >= percent * (F.col("n_a") + F.col("n_b"))).select("a", "b")


def heavy_links(classes: DataFrame, most: int, percent: int, rounds: int = 2) -> tuple[DataFrame, DataFrame]:
    """Links, and the components they make, where a set has more than ``most`` elements.

    Two similar sets share an element of both prefixes (the rarest elements, so many that the rest is too few). The
    sets of an element's inverted list need not be compared with each other: ``rounds`` times each is compared with the
    most central set of its list that is in another component; what then still lies in different components
    of one list is compared pair by pair, so that no link between components is missed.
    """
    postings = classes.filter((F.col("n") * 100 >= percent * F.lit(most + 1))).select(
        "node", "n", "centre", F.size("elements").alias("k"), F.posexplode(F.slice("elements", F.lit(1), F.col("prefix"))).alias("at", "element")
    )
    postings = write_once(postings, "postings")
    links = None
    root = None
    sizes = (100 * F.least("n", "n_b") >= percent * F.greatest("n", "n_b")) & (F.greatest("n", "n_b") > most)
    # a similar pair is found at the first element that both have, where as much is left on either side as they need in common
    left = F.least(F.col("k") - F.col("at"), F.col("k_b") - F.col("at_b"))
    fits = sizes & ((100 + percent) * left >= percent * (F.col("n") + F.col("n_b")))
    other = lambda prefix: [F.col(f"{prefix}{c}").alias(f"{c}_b") for c in ("n", "k", "at", "root")]
    for _ in range(rounds):
        lists = rooted(postings, root)
        mixed = lists.groupBy("element").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("element")
        lists = lists.join(mixed, "element") if root is not None else lists
        leaders = lists.groupBy("element").agg(F.max_by(F.struct("node", "n", "k", "at", "root"), F.struct("centre", "node")).alias("l"))
        pairs = lists.join(leaders.select("element", F.col("l.node").alias("b"), *other("l.")), "element")
        pairs = pairs.filter((F.col("root") != F.col("root_b")) & fits).select(F.col("node").alias("a"), "b").distinct()
        found = write_once(similar(pairs, classes, percent), "similar")
        links = found if links is None else links.union(found)
        root = write_once(stars(links), "roots")
    lists = write_once(rooted(postings, root), "lists")
    mixed = lists.groupBy("element").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("element")
    lists = write_once(lists.join(mixed, "element").drop("centre"), "mixed")
    pairs = lists.join(lists.select("element", F.col("node").alias("b"), *other("")), "element")
    pairs = pairs.filter((F.col("root") < F.col("root_b")) & fits).select(F.col("node").alias("a"), "b").distinct()
    return links.union(similar(pairs, classes, percent))


def rooted(postings: DataFrame, root: DataFrame | None) -> DataFrame:
    if root is None:
        return postings.withColumn("root", F.col("node"))
    return postings.join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))


def near_groups(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``df``: doc_id (the key), n_shingles and component_id.

    A set is the distinct shingles of ``width`` words, after lower-casing A-Z; a text of fewer words is one shingle. Two
    rows link if 100 times the common shingles are at least ``percent`` times the shingles of both; component_id is
    the least key that links reach. Keys must be integers.

    First every shingle's number of documents is found, so that a set drops out if too few of its shingles occur
    elsewhere; equal sets are one class from there on. Light sets meet in subsets, heavy ones in inverted lists,
    with the boundary where the cost is least. A group of any size costs as many comparisons as it has members, or
    few more; only what lies in different components of one list is compared in pairs.

    Null and empty texts, and texts of white space, have no shingles and their own key as component. Repeated keys are
    documents of their own; a null key comes after all others and stays null. Other columns are left out; an empty
    table gives no row.
    """
    sets = find_sets(df, key, text, width, percent)
    known = sets.filter(F.col("node").isNotNull())
    classes = known.groupBy("node").agg(
        F.min("key").alias("rep"), F.first("n_shingles").alias("n"), F.first("elements", ignorenulls=True).alias("elements"),
        F.max("prefix").alias("prefix"), F.max("centre").alias("centre"), F.max("scan").alias("scan"),
    )
    classes = write_once(classes, "classes")
    most = boundary(classes, percent)
    links = light_links(classes, most, percent).union(heavy_links(classes, most, percent))
    root = stars(links)
    of_class = classes.select("node", "rep").join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = of_class.groupBy("root").agg(F.min("rep").alias("component"))
    of_class = of_class.join(least, "root").select("node", "component")
    out = sets.select("key", "n_shingles", "node").join(of_class, "node", "left")
    back = lambda c: F.when(c != _LAST, c)
    return out.select(
        back(F.col("key")).alias("doc_id"), "n_shingles", back(F.coalesce("component", "key")).alias("component_id")
    )


def one_of_each(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows whose key is the least of a group, or null; same columns as ``df``. Rows of one key stay or go together."""
    groups = near_groups(df, key, text, **options).filter("doc_id is not null")
    gone = groups.groupBy(F.col("doc_id").alias("__key")).agg(F.max(F.col("doc_id") == F.col("component_id")).alias("least")).filter("not least")
    return df.join(gone, F.col(key).cast("long") == F.col("__key"), "left_anti")
