"""Substring dedup by fixed-block anchors: blocks of words are indexed, every rolling window probes them, hits are extended."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm import exchange as ex
from docflow.llm import texts
from docflow.session import write_once

_BLOCKS, _WINDOWS = 0, 1
_SEED = np.uint64(0xA5A5A5A55A5A5A5B)


class Words:
    """The words of a chunk's documents as hashes, one after the other; ``start`` has where each document begins."""

    def __init__(self, documents: pa.Table):
        self.texts = texts.Words(documents.column("text"))
        self.start, self.hash = self.texts.start, self.texts.hashes()
        sizes = np.diff(self.start)
        self.room = np.repeat(self.start[1:], sizes) - np.arange(len(self.hash))  # words up to the end of the document

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of all windows of ``n`` words that lie in one document, and the words' hashes rolled over them."""
        at = np.flatnonzero(self.room >= n)
        return at, (ex.rolled(self.hash, n)[at] if len(at) else np.zeros(0, np.uint64))


class BlockAsk:
    """What a chunk asks first: for each of its blocks, whether a window elsewhere has the same hash."""

    def __init__(self, words: Words, block: int, parts: int):
        at, h = words.windows(block)
        part, tail = ex.part_of(h, parts), (h >> np.uint64(32)).astype(np.uint32)
        code = (part.astype(np.uint64) << np.uint64(32)) | tail
        distinct, times = np.unique(code, return_counts=True)
        begin = np.repeat(words.start[:-1], np.diff(words.start))[at]
        own = (at - begin) % block == 0
        self.at = at[own]
        self.blocks, self.to_block = np.unique(code[own], return_inverse=True)
        self.twice = times[np.searchsorted(distinct, self.blocks)] > 1
        self.part = (self.blocks >> np.uint64(32)).astype(np.int64)
        self.window_part, self.windows = (distinct >> np.uint64(32)).astype(np.int64), distinct.astype(np.uint32)

    def marked(self, answer: np.ndarray) -> np.ndarray:
        """Starts of the blocks that occur as a window anywhere else."""
        return self.at[(self.twice | answer)[self.to_block]]


class WindowAsk:
    """What a chunk asks second: for windows that hold a marked block, whether another chunk has the same words."""

    def __init__(self, words: Words, blocks: np.ndarray, block: int, width: int, parts: int):
        near = np.zeros(len(words.hash) + 1, dtype=np.int64)
        first = np.maximum(blocks - (width - block), words.start[np.searchsorted(words.start, blocks, side="right") - 1])
        np.add.at(near, first, 1)
        np.add.at(near, blocks + 1, -1)
        at, h = words.windows(width)
        chosen = np.cumsum(near)[at] > 0
        self.at, h = at[chosen], h[chosen]
        other = ex.rolled(ex.mixed(words.hash ^ _SEED), width)[self.at] if len(self.at) else h
        part, check = ex.part_of(h, parts), (other >> np.uint64(32)).astype(np.uint32)
        order = np.lexsort((check, h, part))
        part, h, check = part[order], h[order], check[order]
        new = np.r_[True, (h[1:] != h[:-1]) | (check[1:] != check[:-1])] if len(h) else np.zeros(0, bool)
        group = np.cumsum(new) - 1
        self.to_window = np.empty(len(h), dtype=np.int64)
        self.to_window[order] = group
        self.twice = np.bincount(group, minlength=int(new.sum())) > 1
        self.part, self.hash, self.check = part[new], h[new], check[new]

    def repeated(self, answer: np.ndarray) -> np.ndarray:
        return self.at[(self.twice | answer)[self.to_window]]


def repeated_spans(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 35) -> DataFrame:
    """One row per row of ``df``: doc_id (the key), n_words, n_removed, spans and kept_text.

    A word is removed if it lies in a window of ``width`` words whose words also start anywhere else, in another
    document or the same one; spans (first word, words) are the maximal runs of such words, kept_text the other
    words joined by a space.

    Blocks of ``(width + 1) // 2`` words, side by side from each document's start, are the index: any window holds
    a whole one. All rolling windows of that length probe it, by 32 bits of hash within their part; what passes too
    much falls out next. Windows around the blocks that were hit are then compared as a whole by 96 bits of
    two hashes, which extends the hits to maximal repeats. Copies and passages of any number cost each chunk one
    ask per hash.

    Null and empty texts and those shorter than ``width`` have nothing removed. Repeated rows, with one key or
    null keys too, are documents that repeat each other. Other columns are left out; an empty table gives no row.
    """
    block = (width + 1) // 2
    chunks = ex.write_chunks(df, key, text)
    parts = chunks.parts

    def ask_blocks(chunk: int, documents: pa.Table) -> Iterator[pa.RecordBatch]:
        ask = BlockAsk(Words(documents), block, parts)
        blocks = dict(ex.dealt(ask.part, parts, ask.blocks.astype(np.uint32)))
        yield asked([(p, chunk, w, blocks.get(p, [b""])[0]) for p, (w,) in ex.dealt(ask.window_part, parts, ask.windows)], "windows", "blocks")

    def ask_windows(chunk: int, documents: pa.Table, answers: pa.Table) -> Iterator[pa.RecordBatch]:
        words = Words(documents)
        ask = second_ask(words, answers)
        yield asked([(p, chunk, h, c) for p, (h, c) in ex.dealt(ask.part, parts, ask.hash, ask.check)], "hashes", "checks")

    def second_ask(words: Words, answers: pa.Table) -> WindowAsk:
        first = BlockAsk(words, block, parts)
        marked = first.marked(ex.flagged(first.part, parts, ex.answers_of(answers, _BLOCKS)))
        return WindowAsk(words, marked, block, width, parts)

    def finish(chunk: int, documents: pa.Table, answers: pa.Table) -> Iterator[pa.RecordBatch]:
        words = Words(documents)
        ask = second_ask(words, answers)
        at = ask.repeated(ex.flagged(ask.part, parts, ex.answers_of(answers, _WINDOWS)))
        edge = np.zeros(len(words.hash) + 1, dtype=np.int64)
        edge[at] += 1
        np.add.at(edge, at + width, -1)
        gone = np.cumsum(edge)[:-1] > 0
        removed = np.diff(np.r_[0, np.cumsum(gone)][words.start])
        first = np.zeros(len(gone) + 1, dtype=bool)
        first[words.start] = True
        begin = np.flatnonzero(gone & (first[:-1] | ~np.r_[False, gone][:-1]))
        end = np.flatnonzero(gone & (first[1:] | ~np.r_[gone, False][1:])) + 1
        spans = pa.StructArray.from_arrays([pa.array(begin - words.start[np.searchsorted(words.start, begin, side="right") - 1]), pa.array(end - begin)], names=["start", "words"])
        yield pa.record_batch(
            [
                documents.column("key").combine_chunks(), pa.array(np.diff(words.start), pa.int64()), pa.array(removed, pa.int64()),
                pa.ListArray.from_arrays(pa.array(np.searchsorted(begin, words.start), pa.int32()), spans), words.texts.joined(~gone),
            ],
            names=["doc_id", "n_words", "n_removed", "spans", "kept_text"],
        )

    one = chunks.ask("part int, chunk long, windows binary, blocks binary", ask_blocks)
    hit = write_once(ex.answered(one, answer_blocks), "blocks")
    two = chunks.ask("part int, chunk long, hashes binary, checks binary", ask_windows, hit)
    same = write_once(ex.answered(two, answer_windows), "windows")
    out = f"doc_id {chunks.key_type}, n_words long, n_removed long, spans array<struct<start:bigint,words:bigint>>, kept_text string"
    return chunks.ask(out, finish, hit.unionByName(same))


def asked(rows: list[tuple], a: str, b: str) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 4
    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary()]
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names=["part", "chunk", a, b])


def answer(table: pa.Table, kind: int, found: list[np.ndarray]) -> pa.Table:
    return pa.table({
        "chunk": table.column("chunk"), "part": table.column("part"), "kind": pa.array([kind] * len(table), pa.int32()),
        "bits": pa.array([ex.bits(f) for f in found], pa.binary()),
    })


def answer_blocks(table: pa.Table) -> pa.Table:
    """Index the blocks, probe with the windows of all chunks: is a block the window of two chunks or more?"""
    blocks = [np.frombuffer(x.as_buffer(), np.uint32) for x in table.column("blocks")]
    index = np.unique(np.concatenate(blocks))
    times = np.zeros(len(index) + 1, dtype=np.int64)
    for x in table.column("windows"):
        probe = np.frombuffer(x.as_buffer(), np.uint32)  # distinct and sorted
        at = np.searchsorted(probe, index)
        times[:-1] += probe[np.minimum(at, len(probe) - 1)] == index
    return answer(table, _BLOCKS, [times[np.searchsorted(index, b)] > 1 for b in blocks])


def answer_windows(table: pa.Table) -> pa.Table:
    """Is a window in two chunks or more? Both hashes must agree."""
    hashes = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("hashes")]
    checks = [np.frombuffer(x.as_buffer(), np.uint32) for x in table.column("checks")]
    h, c = np.concatenate(hashes), np.concatenate(checks)
    order = np.lexsort((c, h))
    h, c = h[order], c[order]
    new = np.r_[True, (h[1:] != h[:-1]) | (c[1:] != c[:-1])]
    group = np.cumsum(new) - 1
    twice = np.empty(len(h), dtype=bool)
    twice[order] = (np.bincount(group) > 1)[group]
    return answer(table, _WINDOWS, np.split(twice, np.cumsum([len(x) for x in hashes])[:-1]))
