"""Benchmark decontamination: suffix arrays over training shards, binary-searched by every suffix of every test item."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm import texts
from docflow.session import Shared

#: A-Z become a-z; every other ASCII byte but 0-9 and a-z separates words.
_FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256)
)
MATCH = "item_id:string,doc_start:bigint,item_start:bigint,length:bigint"
_MATCH_TYPE = pa.list_(
    pa.struct([("item_id", pa.string()), ("doc_start", pa.int64()), ("item_start", pa.int64()), ("length", pa.int64())])
)


def item_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


class ItemBlock:
    """The items of a block: word codes from 1, and the distinct windows of all items in sorted order.

    A window is ``width`` words, or the whole item where it has fewer. Equal windows are kept once, with the items that have
    them; ``low`` and ``high`` are the least and greatest suffix that starts with the window.
    """

    def __init__(self, items: list[tuple[str, str | None]], width: int):
        self.width = width
        self.code: dict[bytes, int] = {}
        places: dict[tuple[int, ...], set[int]] = {}
        self.names: list[str] = []
        self.words: list[np.ndarray] = []
        for name, text in items:
            codes = [self.code.setdefault(w, len(self.code) + 1) for w in item_words(text)]
            self.names.append(name)
            self.words.append(np.array(codes, dtype=np.int64))
            for start in range(max(1, len(codes) - width + 1) if codes else 0):
                places.setdefault(tuple(codes[start : start + width]), set()).add(len(self.names) - 1)
        windows = sorted(places)
        self.lengths = np.array([len(w) for w in windows], dtype=np.int64)
        pad = lambda fill: np.array([w + (fill,) * (width - len(w)) for w in windows], dtype=">u4").reshape(-1, width)
        self.low, self.high = as_keys(pad(0)), as_keys(pad(0xFFFFFFFF))
        self.first = np.cumsum([0] + [len(places[w]) for w in windows])
        self.item = np.array([i for w in windows for i in sorted(places[w])], dtype=np.int64)

    def search(self, docs: list[np.ndarray]) -> Iterator[tuple[int, list[dict]]]:
        """Number and maximal matches of each document of a shard that holds a window.

        Only suffixes that begin with as many known words as the shortest window has are put in the array.
        """
        if not len(self.lengths):
            return
        ends = np.cumsum([len(d) + 1 for d in docs])
        text = np.concatenate([x for d in docs for x in (d, [0])] + [np.zeros(self.width, np.int64)])
        stops = np.flatnonzero(text == 0)
        run = stops[np.searchsorted(stops, np.arange(len(text)))] - np.arange(len(text))
        suffixes = np.flatnonzero(run >= self.lengths.min())
        if not len(suffixes):
            return
        deep = text[suffixes[:, None] + np.arange(self.width)]
        deep[np.arange(self.width) >= run[suffixes][:, None]] = 0
        keys = as_keys(deep.astype(">u4"))
        order = np.argsort(keys, kind="stable")  # the suffix array of the shard, as deep as a window
        keys, suffixes = keys[order], suffixes[order]
        left, right = np.searchsorted(keys, self.low, "left"), np.searchsorted(keys, self.high, "right")
        found = np.flatnonzero(right > left)
        if not len(found):
            return
        window = np.repeat(found, (right - left)[found])
        place = suffixes[ranges(left[found], right[found])]
        by_doc = np.argsort(place, kind="stable")
        window, place = window[by_doc], place[by_doc]
        doc = np.searchsorted(ends, place, side="right")
        cuts = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1], True])
        for a, b in zip(cuts[:-1], cuts[1:]):
            k = int(doc[a])
            yield k, self.matches(docs[k], window[a:b], place[a:b] - (int(ends[k]) - len(docs[k]) - 1))

    def matches(self, doc: np.ndarray, window: np.ndarray, place: np.ndarray) -> list[dict]:
        """The longest matches of one document with each item, from where its windows lie; ``place`` rises.

        What is held is the words that are hit and one item at a time, never all pairs of their places.
        """
        out = []
        different = np.unique(window)
        first, last = self.first[different], self.first[different + 1]
        item, of = self.item[ranges(first, last)], np.repeat(different, last - first)
        order = np.argsort(item, kind="stable")
        item, of = item[order], of[order]
        cuts = np.flatnonzero(np.r_[True, item[1:] != item[:-1], True])
        for a, b in zip(cuts[:-1], cuts[1:]):
            words, name = self.words[item[a]], self.names[item[a]]
            mine = np.isin(window, of[a:b], kind="sort")
            for start, stop in spans(place[mine], self.lengths[window[mine]]):
                for at, item_start, length in longest(doc[start:stop], words):
                    if length >= min(self.width, len(words)):
                        out.append({"item_id": name, "doc_start": start + at, "item_start": item_start, "length": length})
        return out


def spans(places: np.ndarray, lengths: np.ndarray) -> list[tuple[int, int]]:
    """The runs of words that are in any of the windows at rising ``places``; windows that touch or overlap are one run."""
    ends = np.maximum.accumulate(places + lengths)
    opens = np.flatnonzero(np.r_[True, places[1:] > ends[:-1]])
    closes = np.r_[opens[1:], len(places)] - 1
    return [(int(places[a]), int(ends[b])) for a, b in zip(opens, closes)]


def suffix_array(codes: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in sorted order, whole suffixes compared: ranks of prefixes whose length doubles."""
    n, size = len(codes), 1
    rank = np.unique(codes, return_inverse=True)[1].astype(np.int64)
    while True:
        beyond = np.r_[rank[size:] + 1, np.zeros(min(size, n), np.int64)][:n]
        pair = rank * (n + 2) + beyond
        known, rank = np.unique(pair, return_inverse=True)
        if len(known) == n or size >= n:
            return np.argsort(rank, kind="stable")
        size *= 2


def common_prefixes(codes: np.ndarray, order: np.ndarray) -> np.ndarray:
    """How many words each suffix of the array shares with the one before it, found in the order of the text."""
    n, shared = len(codes), 0
    out, text, at = [0] * n, codes.tolist(), np.argsort(order).tolist()
    starts = order.tolist()
    for i in range(n):
        if at[i] == 0:
            shared = 0
            continue
        j = starts[at[i] - 1]
        while i + shared < n and j + shared < n and text[i + shared] == text[j + shared]:
            shared += 1
        out[at[i]] = shared
        shared = max(shared - 1, 0)
    return np.array(out, np.int64)


def longest(doc: np.ndarray, item: np.ndarray) -> list[tuple[int, int, int]]:
    """Start, place in the item and length of the longest matches of a run of words with an item.

    Both stand in one suffix array; a suffix of the run matches most with the nearest suffix of the item on either side. Matches
    that lie within the one before are left out, so there is one for each place at most.
    """
    codes = np.r_[doc, -1, item, -2]
    order = suffix_array(codes)
    shared = common_prefixes(codes, order)
    best, where = np.zeros(len(codes), np.int64), np.zeros(len(codes), np.int64)
    cut = len(doc) + 1
    for turn in (range(len(order)), range(len(order) - 1, -1, -1)):
        ahead = turn.step > 0
        near, length = -1, 0
        for k in turn:
            length = min(length, int(shared[k]) if ahead else int(shared[k + 1]) if k + 1 < len(order) else 0)
            i = int(order[k])
            if i >= cut:
                near, length = i - cut, len(codes)
            elif near >= 0 and i < len(doc) and length > best[i]:
                best[i], where[i] = length, near
    return [(i, int(where[i]), int(best[i])) for i in range(len(doc)) if best[i] and (i == 0 or best[i - 1] <= best[i])]


def as_keys(rows: np.ndarray) -> np.ndarray:
    """Rows of big-endian numbers as strings of bytes, which sort as the rows do."""
    return np.ascontiguousarray(rows).view(f"S{rows.shape[1] * 4}").ravel()


def ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All numbers of each half-open range, one range after the other."""
    sizes = ends - starts
    return np.arange(sizes.sum()) + np.repeat(starts - np.r_[0, np.cumsum(sizes)[:-1]], sizes)


def blocks_of(items: DataFrame, item_id: str, item_text: str, block_bytes: int) -> Iterator[list[tuple[str, str | None]]]:
    """The test items in blocks of about ``block_bytes``; a block is one item at least."""
    named = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("name"), F.col(item_text).alias("text"))
    size = F.coalesce(F.sum(F.octet_length("text")), F.lit(0))
    total = named.agg(size.alias("s")).first()["s"]
    n = max(1, -(-total // block_bytes))
    block = F.pmod(F.xxhash64("name", "text"), F.lit(n))
    for k in range(n):
        yield [(r["name"], r["text"]) for r in named.filter(block == k).collect()]


def find_matches(
    df: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    width: int = 10, result: str = "contamination", block_bytes: int = 32 << 20,
) -> DataFrame:
    """``df`` with a struct ``result``: n_words, n_hit, items (sorted ids as strings) and matches.

    Words are runs of digits, a-z and anything beyond ASCII, after lower-casing A-Z. A match is a longest run
    of words that a document and an item share, of ``width`` words at least, or of the whole item where it has
    fewer; n_hit counts the words of the document inside any match. Every document is searched against every
    item, and the matches of the words hit are found in a suffix array of both; of several places in an item one is given, and a match
    within the one before is left out. Items go to the tasks in blocks of ``block_bytes``, so that what is broadcast keeps its size when
    there are more of them (each block is one more pass over the texts).

    Null and empty texts have no words and no matches, on either side. Equal rows get equal results, one each;
    equal items count by id, a null id as the empty string. Other columns pass unchanged; one named ``result``
    is replaced. Empty tables on either side give no matches.
    """
    given = df.columns
    found = []
    df = df.select(F.struct(*[F.col(f"`{c}`") for c in given]).alias("row"), F.col(f"`{text}`").alias("text"))
    for k, block in enumerate(blocks_of(items, item_id, item_text, block_bytes)):
        shared = Shared(df.sparkSession, ItemBlock(block, width))
        df = df.withColumn(f"found_{k}", _search(shared)(F.col("text")))
        found.append(f"found_{k}")
    matches = F.concat(*[F.col(f"{c}.matches") for c in found])
    sorted_spans = F.array_sort(F.transform(F.col("matches"), lambda m: F.struct(m["doc_start"].alias("a"), (m["doc_start"] + m["length"]).alias("b"))))
    covered = F.aggregate(
        sorted_spans, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda s, x: F.struct((s["n"] + F.greatest(F.lit(0), x["b"] - F.greatest(x["a"], s["end"]))).alias("n"), F.greatest(s["end"], x["b"]).alias("end")),
        lambda s: s["n"],
    )
    ids = F.array_sort(F.array_distinct(F.transform(F.col("matches"), lambda m: m["item_id"])))
    whole = F.struct(F.col(f"{found[0]}.n_words").alias("n_words"), covered.alias("n_hit"), ids.alias("items"), F.col("matches").alias("matches"))
    done = df.withColumn("matches", matches)
    return done.select(*[F.col("row")[c].alias(c) for c in given if c != result], whole.alias(result))


def _search(shared):
    """A function from texts to their words' number and matches with one block of items.

    A shard is a slice of a batch of a few megabytes, with a suffix array of its own.
    """

    @F.arrow_udf(f"struct<n_words:bigint,matches:array<struct<{MATCH}>>>")
    def search(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tests: ItemBlock = shared.value
        code = tests.code.get
        for column in columns:
            matches: list[list[dict]] = [[] for _ in range(len(column))]
            sizes: list[int] = []
            shard: list[np.ndarray] = []
            words = 0
            for x in column:
                coded = [code(w, 0) for w in item_words(x.as_py())]
                sizes.append(len(coded))
                shard.append(np.array(coded, dtype=np.int64))
                words += len(coded)
                if words > 1 << 19 or len(sizes) == len(column):
                    first = len(sizes) - len(shard)
                    for k, rows in tests.search(shard):
                        matches[first + k] = rows
                    shard, words = [], 0
            yield texts.struct_of([("n_words", sizes, pa.int64()), ("matches", matches, _MATCH_TYPE)])

    return search.asNondeterministic()


def clean_documents(df: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents without any match; same columns as ``df``, whatever their names. Nulls, empty texts, ties as in :func:`find_matches`."""
    whole = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(f"`{options.pop('text', 'text')}`").alias("text"))
    found = find_matches(whole, items, result="contamination", **options)
    return found.filter(F.size("contamination.matches") == 0).select(*[F.col("row")[c].alias(c) for c in df.columns])
