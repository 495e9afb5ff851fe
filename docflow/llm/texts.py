"""What several of the operators share: words, hashes and reading one table."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from docflow.llm.exchange import mixed

#: The white space that separates words: space and 0x09 to 0x0D. ``bytes.split()`` splits on just these.
WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
_DROP_WHITE = dict.fromkeys(map(ord, WHITE))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def words(text: str | None) -> list[bytes]:
    """The maximal runs without white space, as UTF-8; none for null."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[list(WHITE.encode())] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_GOLD, _LONG = np.uint64(0x9E3779B97F4A7C15), 64


class Words:
    """The words of many texts at once, as places in their bytes, one text after the other; a null has none.

    Words have ``begin`` and ``end`` in ``data``; ``start`` has where each text's words begin, ``edges`` where its bytes do. No word becomes a
    Python object.
    """

    def __init__(self, column: pa.ChunkedArray, lower: bool = False):
        texts = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
        texts = texts.cast(pa.large_string()).fill_null("")
        _, edges, data = texts.buffers()
        n = len(texts)
        self.edges = np.frombuffer(edges, np.int64)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int64)
        self.data = np.frombuffer(data, np.uint8)[self.edges[0] : self.edges[-1]] if data is not None else np.zeros(0, np.uint8)
        self.edges = self.edges - self.edges[0]
        if lower:
            self.data = _LOWER[self.data]
        inside, first = _IS_WORD[self.data], np.zeros(len(self.data) + 1, dtype=bool)
        first[self.edges] = True
        before, after = np.r_[False, inside][:-1], np.r_[inside, False][1:]
        self.begin = np.flatnonzero(inside & (first[:-1] | ~before))
        self.end = np.flatnonzero(inside & (first[1:] | ~after)) + 1
        self.start = np.searchsorted(self.begin, self.edges)

    def hashes(self) -> np.ndarray:
        """64 bits for each word: eight bytes at a time of all words that have them; the few very long words one by one."""
        sizes = self.end - self.begin
        eights = np.ndarray(len(self.data), "<u8", np.r_[self.data, np.zeros(8, np.uint8)].tobytes(), strides=(1,))
        out = mixed(sizes.astype(np.uint64) * _GOLD)
        at = np.flatnonzero(sizes <= _LONG)
        for done in range(0, _LONG, 8):
            at = at[sizes[at] > done] if done else at
            if not len(at):
                break
            left = np.minimum(sizes[at] - done, 8).astype(np.uint64)
            some = eights[self.begin[at] + done] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - np.uint64(8) * left))
            out[at] = mixed((out[at] ^ some) * _GOLD)
        for k in np.flatnonzero(sizes > _LONG).tolist():
            out[k] = xxhash.xxh3_64_intdigest(self.data[self.begin[k] : self.end[k]].tobytes())
        return out

    def joined(self, chosen: np.ndarray) -> pa.Array:
        """Each text's chosen words, joined by a space."""
        begin, end, text = self.begin[chosen], self.end[chosen], np.repeat(np.arange(len(self.start) - 1), np.diff(self.start))[chosen]
        turns = np.zeros(len(self.data) + 1, dtype=np.int8)
        turns[begin] += 1
        turns[end] -= 1
        kept = np.cumsum(turns, dtype=np.int8)[:-1].astype(bool)
        space = end[:-1][text[1:] == text[:-1]]  # a white byte, as the text has a word after it
        kept[space] = True
        data = self.data.copy()
        data[space] = 0x20
        edges = np.r_[0, np.cumsum(kept)][self.edges]
        return pa.LargeStringArray.from_buffers(len(edges) - 1, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(data[kept])).cast(pa.string())


def without_white(text: str) -> str:
    return text.translate(_DROP_WHITE)


def struct_of(columns: Sequence[tuple[str, pa.Array | list, pa.DataType]]) -> pa.StructArray:
    """A struct array out of named columns of one length."""
    arrays = [x if isinstance(x, pa.Array) else pa.array(x, kind) for _, x, kind in columns]
    return pa.StructArray.from_arrays(arrays, names=[name for name, _, _ in columns])
