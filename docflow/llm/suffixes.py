"""Suffix-array dedup by a logarithmic family: batches get sorted suffixes, are scanned against older levels, and merge."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm import exchange as ex
from docflow.session import write_once

_ANCHORS, _WINDOWS = 0, 1
_SLICE = 1 << 18
_LAST = np.iinfo(np.int64).max
_MULTIPLIERS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


class Family:
    """Sorted arrays of distinct strings, each at least about twice as large as the next; batches come in document order."""

    def __init__(self) -> None:
        self.levels: list[np.ndarray] = []

    def scan(self, strings: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Which strings also start in an earlier document; then the batch becomes a level and equal levels merge.

        ``docs`` must not decrease, neither here nor from batch to batch, and no document may reach into two batches.
        """
        order = np.argsort(strings, kind="stable")  # the suffix array of the batch
        suffixes, own = strings[order], docs[order]
        first = np.r_[True, suffixes[1:] != suffixes[:-1]]
        heads = suffixes[first]
        known = np.zeros(len(heads), dtype=bool)
        for level in self.levels:
            at = np.minimum(np.searchsorted(level, heads), len(level) - 1)
            known |= level[at] == heads
        group = np.cumsum(first) - 1
        found = np.empty(len(strings), dtype=bool)
        found[order] = known[group] | (own > own[first][group])
        self.add(heads[~known])
        return found

    def add(self, level: np.ndarray) -> None:
        if not len(level):
            return
        while self.levels and len(self.levels[-1]) < 2 * len(level):
            level = np.sort(np.concatenate([self.levels.pop(), level]), kind="stable")  # two sorted runs
        self.levels.append(level)


class Runs:
    """The windows of a chunk in runs that share an anchor.

    The anchor of a window is its leftmost substring of ``seed`` bytes with the least hash, so that equal windows have
    equal anchors wherever they are. ``first`` and ``last`` are the first and the last window of a run, ``hash`` is that of its anchor.
    """

    def __init__(self, documents: pa.Table, width: int, seed: int):
        self.data = [(x.as_py() or "").encode("utf-8", "surrogatepass") for x in documents.column("text")]
        self.keys = documents.column("key").cast(pa.int64()).fill_null(_LAST).to_numpy()
        self.start = np.r_[0, np.cumsum([len(x) for x in self.data])].astype(np.int64)
        self.bytes = b"".join(self.data)
        self.width = width
        padded = np.frombuffer(self.bytes + bytes(width + 8), np.uint8)
        found = [self._slice(padded, s, min(s + _SLICE, len(self.bytes)), seed) for s in range(0, len(self.bytes), _SLICE)]
        found = [f for f in found if len(f[0])] or [(np.zeros(0, np.int64),) * 3]
        self.first, self.last, self.anchor = (np.concatenate(x) for x in zip(*found))
        self.hash = ex.mixed(self._seeds(padded, self.anchor, seed) * _MULTIPLIERS[0] + np.uint64(1))
        self.doc = np.searchsorted(self.start, self.first, side="right") - 1

    @staticmethod
    def _seeds(padded: np.ndarray, at: np.ndarray | slice, seed: int) -> np.ndarray:
        """Hash of the ``seed`` bytes from each place; words of eight bytes are read at any place."""
        eight = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))
        shift = [0, 8, seed - 8]
        if isinstance(at, slice):
            out = [eight[at.start + k : at.stop + k] * m for k, m in zip(shift, _MULTIPLIERS)]
        else:
            out = [eight[at + k] * m for k, m in zip(shift, _MULTIPLIERS)]
        return ex.mixed(out[0] + out[1] + out[2])

    def _slice(self, padded: np.ndarray, begin: int, end: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        span = self.width - seed + 1  # places of a window's seeds
        stop = min(end + span - 1, len(padded) - 8 - seed)
        h = self._seeds(padded, slice(begin, stop), seed)
        low = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
        size = 1
        while 2 * size <= span:
            low = np.minimum(low[:-size], low[size:])
            size *= 2
        if size < span:
            low = np.minimum(low[: size - span], low[span - size :])
        low = low[: end - begin]
        d = np.searchsorted(self.start, begin, side="right") - 1
        valid = np.zeros(len(low), dtype=bool)
        while d + 1 < len(self.start) and self.start[d] < end:
            valid[max(0, self.start[d] - begin) : max(0, self.start[d + 1] - self.width + 1 - begin)] = True
            d += 1
        at = np.flatnonzero(valid)
        if not len(at):
            return (np.zeros(0, np.int64),) * 3
        anchor = (low[at] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        new = np.r_[True, (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)]
        heads = np.flatnonzero(new)
        tails = np.r_[heads[1:], len(at)] - 1
        return at[heads] + begin, at[tails] + begin, anchor[heads] + begin


class AnchorAsk:
    """What a chunk asks first: which of its anchors does another chunk have? Those in two of its own documents need no answer."""

    def __init__(self, runs: Runs, parts: int):
        code = (ex.part_of(runs.hash, parts).astype(np.uint64) << np.uint64(32)) | (runs.hash >> np.uint64(32))
        order = np.lexsort((runs.doc, code))
        sorted_code, doc = code[order], runs.doc[order]
        new = np.r_[True, sorted_code[1:] != sorted_code[:-1]] if len(code) else np.zeros(0, bool)
        group = np.cumsum(new) - 1
        self.to_anchor = np.empty(len(code), dtype=np.int64)
        self.to_anchor[order] = group
        self.twice = np.zeros(int(new.sum()), dtype=bool)
        self.twice[group[1:][(~new[1:]) & (doc[1:] != doc[:-1])]] = True
        distinct = sorted_code[new]
        self.part, self.tails = (distinct >> np.uint64(32)).astype(np.int64), distinct.astype(np.uint32)

    def shared(self, answer: np.ndarray) -> np.ndarray:
        """Numbers of the runs whose anchor occurs in another document."""
        return np.flatnonzero((self.twice | answer)[self.to_anchor])


class ContextAsk:
    """What a chunk asks second: for the bytes of a run with a shared anchor, which windows start in an earlier document?"""

    def __init__(self, runs: Runs, shared: np.ndarray, parts: int):
        part = ex.part_of(runs.hash[shared], parts)
        self.runs = shared[np.argsort(part, kind="stable")]
        data, width = runs.bytes, runs.width
        whole = [data[a : b + width] for a, b in zip(runs.first[self.runs].tolist(), runs.last[self.runs].tolist())]
        number: dict[bytes, int] = {}
        self.to_context = np.array([number.setdefault(x, len(number)) for x in whole], dtype=np.int64)
        self.contexts = list(number)
        self.doc = np.full(len(number), _LAST, dtype=np.int64)  # the earliest here
        np.minimum.at(self.doc, self.to_context, runs.keys[runs.doc[self.runs]])
        first = np.unique(self.to_context, return_index=True)[1]
        self.part = part[np.argsort(part, kind="stable")][first]
        at = self.runs[first]
        self.offset = (runs.anchor[at] - runs.first[at]).astype(np.uint8)

    def rows(self, chunk: int, parts: int) -> Iterator[tuple]:
        edges = np.searchsorted(self.part, np.arange(parts + 1))
        zstd = pa.Codec("zstd", 1)
        for p in np.flatnonzero(edges[1:] > edges[:-1]).tolist():
            own = slice(edges[p], edges[p + 1])
            texts = self.contexts[own]
            joined = b"".join(texts)
            sizes = np.array([len(x) for x in texts], dtype=np.uint8)
            yield p, chunk, len(joined), zstd.compress(joined, asbytes=True), sizes.tobytes(), self.offset[own].tobytes(), self.doc[own].tobytes()


CONTEXTS = "part int, chunk long, n_bytes int, contexts binary, sizes binary, offsets binary, docs binary"
_CONTEXT_TYPES = [pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 4]
_CONTEXT_NAMES = [x.split()[0] for x in CONTEXTS.split(", ")]


def scan_contexts(table: pa.Table, width: int, seed: int, batch: int = 1 << 15) -> list[np.ndarray]:
    """For each row (a chunk) the windows of each context that start in an earlier document, as bits of 32-bit numbers."""
    zstd = pa.Codec("zstd", 1)
    contexts: list[bytes] = []
    for joined, n, sizes in zip(table.column("contexts"), table.column("n_bytes").to_pylist(), table.column("sizes")):
        data = zstd.decompress(joined.as_buffer(), n, asbytes=True)
        ends = np.cumsum(np.frombuffer(sizes.as_buffer(), np.uint8), dtype=np.int64).tolist()
        contexts += [data[a:b] for a, b in zip([0, *ends], ends)]
    docs = np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in table.column("docs")])
    offsets = np.concatenate([np.frombuffer(x.as_buffer(), np.uint8) for x in table.column("offsets")])
    found = np.zeros(len(contexts), dtype=np.uint32)
    order = np.argsort(docs, kind="stable").tolist()
    earliest: dict[bytes, int] = {}
    for k in order:  # equal contexts: all but those of the first document are known whole
        first = earliest.setdefault(contexts[k], k)
        if docs[first] < docs[k]:
            found[k] = (1 << (len(contexts[k]) - width + 1)) - 1
    of_anchor: dict[bytes, int] = {}
    for x, k in earliest.items():
        seeds = x[offsets[k] : offsets[k] + seed]
        of_anchor[seeds] = of_anchor.get(seeds, 0) + 1
    family = Family()
    held: list[int] = []
    size = 0

    def flush() -> None:
        nonlocal size
        counts = np.array([len(contexts[k]) - width + 1 for k in held])
        strings = np.frombuffer(b"".join([contexts[k][j : j + width] for k, n in zip(held, counts.tolist()) for j in range(n)]), f"S{width}")
        hit = family.scan(strings, np.repeat(docs[held], counts))
        bit = np.left_shift(np.uint32(1), (np.arange(len(hit)) - np.repeat(np.cumsum(counts) - counts, counts)).astype(np.uint32))
        found[held] |= np.add.reduceat(np.where(hit, bit, np.uint32(0)), np.cumsum(counts) - counts, dtype=np.uint32)
        held.clear()
        size = 0

    for k in earliest.values():  # in document order
        if of_anchor[contexts[k][offsets[k] : offsets[k] + seed]] == 1:
            continue
        if size >= batch and docs[held[-1]] < docs[k]:
            flush()
        held.append(k)
        size += len(contexts[k]) - width + 1
    if held:
        flush()
    # the same bytes twice in the first document: both copies hold what the scan found
    first = np.array([earliest[x] for x in contexts], dtype=np.int64)
    found |= found[first] if len(first) else found
    return np.split(found, np.cumsum([len(x.as_py()) for x in table.column("sizes")])[:-1])


def earlier_spans(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 50, seed: int = 24) -> DataFrame:
    """One row per row of ``df``: doc_id (the key), n_bytes, n_removed, spans and kept (bytes).

    A byte of the UTF-8 text is removed if a string of ``width`` bytes that covers it also starts in a document with a
    smaller key; spans (start, bytes) are the maximal removed runs. Keys must be integers.

    The suffix arrays are sparse: of all suffixes they hold those around anchors, which every window finds in itself,
    and of those only anchors that two documents share (by hash; a false one costs work, not rightness). They are dealt
    by anchor; in each part, batches in document order are sorted, scanned against the levels of a logarithmic family,
    and merged into it. Equal surroundings of an anchor count once, so a passage in a third of all documents costs each
    chunk one ask. All comparisons that decide are of bytes.

    Null and empty texts and those shorter than ``width`` have nothing removed. Rows with one key are not earlier than
    each other, a null key is later than all others. Other columns are left out; an empty table gives no row.
    """
    if not 16 <= seed <= 24 or not seed < width <= seed + 31:
        raise ValueError("seed must be 16 to 24 and width at most 31 more")
    chunks = ex.write_chunks(df, key, text)
    parts = chunks.parts

    def ask_anchors(chunk: int, documents: pa.Table) -> Iterator[pa.RecordBatch]:
        ask = AnchorAsk(Runs(documents, width, seed), parts)
        rows = list(zip(*[(p, chunk, t) for p, (t,) in ex.dealt(ask.part, parts, ask.tails)])) or [()] * 3
        yield pa.record_batch([pa.array(c, t) for c, t in zip(rows, (pa.int32(), pa.int64(), pa.binary()))], names=["part", "chunk", "anchors"])

    def second_ask(runs: Runs, answers: pa.Table) -> ContextAsk:
        first = AnchorAsk(runs, parts)
        return ContextAsk(runs, first.shared(ex.flagged(first.part, parts, ex.answers_of(answers, _ANCHORS))), parts)

    def ask_contexts(chunk: int, documents: pa.Table, answers: pa.Table) -> Iterator[pa.RecordBatch]:
        ask = second_ask(Runs(documents, width, seed), answers)
        columns = list(zip(*ask.rows(chunk, parts))) or [()] * len(_CONTEXT_TYPES)
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, _CONTEXT_TYPES)], names=_CONTEXT_NAMES)

    def answer_contexts(table: pa.Table) -> pa.Table:
        return answer(table, _WINDOWS, [x.tobytes() for x in scan_contexts(table, width, seed)])

    def finish(chunk: int, documents: pa.Table, answers: pa.Table) -> Iterator[pa.RecordBatch]:
        runs = Runs(documents, width, seed)
        ask = second_ask(runs, answers)
        told = ex.answers_of(answers, _WINDOWS)
        mask = np.frombuffer(b"".join([told[p] for p in sorted(told)]), np.uint32)
        own = mask[ask.to_context]
        later = runs.keys[runs.doc[ask.runs]] > ask.doc[ask.to_context]  # an earlier document of this chunk has all of it
        own = np.where(later, np.uint32(0xFFFFFFFF), own)
        edge = np.zeros(len(runs.bytes) + 1, dtype=np.int32)
        first, last = runs.first[ask.runs], runs.last[ask.runs]
        for j in range(width - seed + 1):
            at = first[((own >> np.uint32(j)) & 1).astype(bool) & (first + j <= last)] + j
            np.add.at(edge, at, 1)
            np.add.at(edge, at + width, -1)
        gone = np.cumsum(edge[:-1]) > 0
        all_bytes = np.frombuffer(runs.bytes, np.uint8)
        removed, spans, kept = [], [], []
        for k, data in enumerate(runs.data):
            a, b = int(runs.start[k]), int(runs.start[k + 1])
            m = gone[a:b]
            n = int(m.sum())
            turn = np.flatnonzero(np.diff(np.r_[False, m, False].astype(np.int8))) if n else np.zeros(0, np.int64)
            removed.append(n)
            spans.append([{"start": int(x), "bytes": int(y - x)} for x, y in zip(turn[::2], turn[1::2])])
            kept.append(all_bytes[a:b][~m].tobytes() if n else data)
        yield pa.record_batch(
            [
                documents.column("key").combine_chunks(), pa.array(np.diff(runs.start), pa.int64()), pa.array(removed, pa.int64()),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("bytes", pa.int64())]))), pa.array(kept, pa.binary()),
            ],
            names=["doc_id", "n_bytes", "n_removed", "spans", "kept"],
        )

    shared = write_once(ex.answered(chunks.ask("part int, chunk long, anchors binary", ask_anchors), answer_anchors), "anchors")
    windows = write_once(ex.answered(chunks.ask(CONTEXTS, ask_contexts, shared), answer_contexts), "windows")
    out = f"doc_id {chunks.key_type}, n_bytes long, n_removed long, spans array<struct<start:bigint,bytes:bigint>>, kept binary"
    return chunks.ask(out, finish, shared.unionByName(windows))


def answer(table: pa.Table, kind: int, data: list[bytes]) -> pa.Table:
    return pa.table({
        "chunk": table.column("chunk"), "part": table.column("part"), "kind": pa.array([kind] * len(table), pa.int32()),
        "bits": pa.array(data, pa.binary()),
    })


def answer_anchors(table: pa.Table) -> pa.Table:
    """Does another chunk have the anchor?"""
    asked = [np.frombuffer(x.as_buffer(), np.uint32) for x in table.column("anchors")]
    every, times = np.unique(np.concatenate(asked), return_counts=True)
    return answer(table, _ANCHORS, [ex.bits(times[np.searchsorted(every, x)] > 1) for x in asked])
