"""Packing by vectors: pieces of examples enter sequences under limits on tokens, segments and loss-bearing tokens."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from struct import pack as pack_ids

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = (
    "start long, length long, ids binary, loss_tokens long, doc_tokens long, sequence_id long, offset long, segment int"
)


@dataclass(frozen=True)
class Limits:
    """What a sequence may hold at most. ``max_gap``: a gap of more tokens is filled by cutting an example."""

    tokens: int = 4096
    segments: int = 256
    loss_tokens: int = 4096
    max_gap: int = 32


class Kept(dict):
    """Values made once for each key. When ``most`` are there they become the older ones, of which those met again stay: twice ``most`` at most."""

    def __init__(self, make: Callable[[str], bytes], most: int):
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key: str) -> bytes:
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class WordTokenizer:
    """Ids of a BPE with word ends and lower case, from the file at ``path``, without special tokens.

    Its words do not reach across spaces, so that the ids of a text are those of its words in turn; words
    and their parts are kept in bounded caches. What plain rules do not cover goes to the tokenizer whole.
    """

    CACHE = 400_000
    #: The tokenizer's own pattern (fixed value).
    PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.path = path
        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.words = Kept(self._word, self.CACHE)
        self.parts = Kept(self._part, self.CACHE)
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in printable]
        self.letter = {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(rest)}

    @classmethod
    def opened(cls, path: str) -> WordTokenizer:
        """The tokenizer that this Python worker has opened last, if it is that of ``path``: the tasks of a worker share its words."""
        last = getattr(cls, "_last", None)
        if last is None or last.path != path:
            last = cls._last = cls(path)
        return last

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        return b"".join(map(self.words.__getitem__, text.replace("\n", " ").split(" ")))

    def _word(self, word: str) -> bytes:
        low = word.lower()
        if low.isascii() or word.isprintable() and _in_latin_1(word):
            if low.isalpha():
                return self.parts[low]
            if low[:-1].isalpha() and low[-1] in ".,|!?":
                return self.parts[low[:-1]] + self.parts[low[-1]]
            if word.isprintable() and "<|" not in word:
                return b"".join([self.parts[p] for p in self.PARTS.findall(low)])
        ids = self.whole.encode(word, add_special_tokens=False).ids
        return pack_ids(f"<{len(ids)}I", *ids)

    def _part(self, part: str) -> bytes:
        spelt = part if part.isascii() else "".join([self.letter[b] for b in part.encode()])
        found = [t.id for t in self.model.tokenize(spelt)]
        return pack_ids(f"<{len(found)}I", *found)


def _in_latin_1(word: str) -> bool:
    """Latin-1 letters are composed already, and their lower case is another or the same one."""
    try:
        word.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


@dataclass
class Example:
    """What is left of an example: ids, how many of them bear no loss, and where they start in it."""

    key: object
    ids: bytes
    prompt: int
    total: int
    start: int = 0

    def demand(self, length: int | None = None) -> tuple[int, int, int]:
        n = len(self.ids) // 4 if length is None else length
        return n, 1, max(0, self.start + n - max(self.start, self.prompt))

    def cut(self, length: int) -> tuple[Example, Example]:
        a = Example(self.key, self.ids[: 4 * length], self.prompt, self.total, self.start)
        return a, Example(self.key, self.ids[4 * length :], self.prompt, self.total, self.start + length)


class Packer:
    """Fills one sequence after the other from a pool of examples that a task has read.

    The next piece is the one whose demands have the largest dot product with what is left of the limits, each
    limit weighted by its mean demand, among those that fit. When none fits and more than ``max_gap`` tokens
    are left, the smallest that is too long is cut, if segments and loss allow it.
    """

    POOL = 320

    def __init__(self, limits: Limits, base: int):
        self.limits, self.base, self.made = limits, base, 0
        self.full = np.array([limits.tokens, limits.segments, limits.loss_tokens], dtype=np.float64)
        self.pool: list[Example] = []
        self.rows: list[tuple] = []

    def add(self, example: Example) -> None:
        most = min(self.limits.tokens, self.limits.loss_tokens)
        while len(example.ids) // 4 >= most:  # fills a sequence on its own
            head, example = example.cut(most)
            self._emit([head])
        if example.ids:
            self.pool.append(example)
            if len(self.pool) >= self.POOL:
                self._fill(self.POOL // 2)

    def finish(self) -> None:
        self._fill(0)

    def _emit(self, pieces: list[Example]) -> None:
        offset = 0
        for k, p in enumerate(pieces):
            n, _, loss = p.demand()
            self.rows.append((p.key, p.start, n, p.ids, loss, p.total, self.base + self.made, offset, k))
            offset += n
        self.made += 1

    def _fill(self, leave: int) -> None:
        need = np.array([e.demand() for e in self.pool], dtype=np.float64).reshape(-1, 3)
        while len(self.pool) > leave:
            share = need / self.full
            alive = np.ones(len(self.pool), dtype=bool)
            weight = need.mean(axis=0) / self.full
            left, pieces = self.full.copy(), []
            while True:
                fits = alive & (need[:, 0] <= left[0]) & (need[:, 1] <= left[1]) & (need[:, 2] <= left[2])
                score = np.where(fits, share @ (weight * left / self.full), -1.0)
                k = int(score.argmax())
                if fits[k]:
                    piece = self.pool[k]
                    alive[k] = False
                else:
                    gap = int(min(left[0], left[2]))
                    long = np.flatnonzero(alive & (need[:, 0] > gap))
                    if gap <= self.limits.max_gap or left[1] < 1 or not len(long):
                        break
                    k = int(long[need[long, 0].argmin()])
                    piece, self.pool[k] = self.pool[k].cut(gap)
                    need[k] = self.pool[k].demand()
                    share[k] = need[k] / self.full
                left -= piece.demand()
                pieces.append(piece)
            self.pool, need = [e for e, a in zip(self.pool, alive) if a], need[alive]
            self._emit(pieces)


def pack(
    df: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", prompt: str | None = None,
    end_id: int = 2, limits: Limits = Limits(),
) -> DataFrame:
    """One row per piece: doc_id (the key), its ids, its place in its example and in its sequence.

    An example is the ids of ``prompt`` (which bear no loss), those of ``text``, and ``end_id``. Every id lies
    in exactly one piece. Pieces of full length get a sequence of their own; the rest share sequences. Each
    task packs what it reads, without a shuffle and with a bounded pool, and leaves one sequence short at most;
    sequence ids carry the partition, so that a task that runs again gives the same ones.

    A null or empty text is an example of the end id (and the prompt). Equal rows, keys repeated or null, are
    examples of their own. Other columns are left out. An empty table gives no piece.
    """
    source = df.select(
        F.col(key).alias("key"), F.coalesce(F.col(prompt) if prompt else F.lit(""), F.lit("")).alias("prompt"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    kind = source.schema["key"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer.opened(tokenizer_path)
        end = np.array([end_id], dtype="<u4").tobytes()
        packer = Packer(limits, TaskContext.get().partitionId() << 33)

        def rows() -> Iterator[pa.RecordBatch]:
            for at in range(0, len(packer.rows), 4096):
                columns = zip(*packer.rows[at : at + 4096])
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=names)
            packer.rows.clear()

        for batch in batches:
            types = [batch.schema.field("key").type, *_TYPES]
            names = ["doc_id", *_NAMES]
            for key_, prompt_, text_ in zip(*(batch.column(c) for c in ("key", "prompt", "text"))):
                head = tokenizer.ids(prompt_.as_py())
                ids = head + tokenizer.ids(text_.as_py()) + end
                packer.add(Example(key_.as_py(), ids, len(head) // 4, len(ids) // 4))
                if len(packer.rows) >= 4096:
                    yield from rows()
        packer.finish()
        if packer.rows:
            yield from rows()

    return source.mapInArrow(run, f"doc_id {kind.simpleString()}, {SCHEMA}")


_NAMES = [part.split()[0] for part in SCHEMA.split(", ")]
_TYPES = [{"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[part.split()[1]] for part in SCHEMA.split(", ")]
