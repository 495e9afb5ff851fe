"""Fill-in-middle over seekable compressed frames.

A text is stored as independent zstandard frames, each with the units and code points up to its end. A cut after so many units
is found by the counts, and only the frame it falls into is decompressed. What lies between cuts is moved as whole frames, still
compressed; digests stream the frames in order, so that no text is ever put together.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.llm import texts

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
FRAME_BYTES = 1 << 16
STORED = "struct<frames:array<binary>,units:array<bigint>,chars:array<bigint>,marked:boolean>"
MADE = "struct<n:bigint,form:string,prefix_chars:bigint,middle_chars:bigint,output:array<binary>>"

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


def starts(data: bytes, before: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Flags per byte: a unit starts, a code point starts. A unit is a run of letters A-Z, a-z or any other code point."""
    b = np.frombuffer(data, np.uint8)
    point, letter = (b & 0xC0) != 0x80, _LETTER[b]
    unit = point.copy()
    unit[1:] &= ~(letter[1:] & letter[:-1])
    if len(b) and letter[0] and _LETTER[before]:
        unit[0] = False
    return unit, point


def split(data: bytes, size: int) -> Iterator[bytes]:
    """``data`` in parts of at most ``size`` bytes that end with whole code points."""
    at = 0
    while at < len(data):
        end = min(at + size, len(data))
        while end < len(data) and data[end] & 0xC0 == 0x80 and end > at + 1:
            end -= 1
        yield data[at:end]
        at = end


def expanded(frame: bytes) -> bytes:
    return zstandard.decompress(frame)


def has_mark(parts: Iterable[bytes]) -> bool:
    """Whether one of the marks lies in the parts, in one or across two."""
    tail = b""
    for part in parts:
        seen = tail + part
        if b"<" in seen and any(m in seen for m in MARKS):
            return True
        tail = seen[-2:]
    return False


def encoded(data: bytes, size: int) -> tuple[list[bytes], list[int], list[int], bool]:
    """Frames, and the units and code points up to the end of each; whether a mark lies in the text."""
    frames, units, chars, n, c, before = [], [], [], 0, 0, 0
    for part in split(data, size):
        unit, point = starts(part, before)
        n, c, before = n + int(unit.sum()), c + int(point.sum()), part[-1]
        frames.append(zstandard.compress(part))
        units.append(n)
        chars.append(c)
    return frames, units, chars, has_mark(split(data, size))


def sizes(frames: list[bytes]) -> list[int]:
    """Bytes up to the end of each frame, read from the frame headers."""
    return np.cumsum([zstandard.frame_content_size(f) for f in frames], dtype=np.int64).tolist()


def seek(frames: list[bytes], units: list[int], chars: list[int], ends: list[int], count: int) -> tuple[int, int]:
    """Bytes and code points before the end of the first ``count`` units; at most one frame is decompressed."""
    if count == 0:
        return 0, 0
    if count == units[-1]:
        return ends[-1], chars[-1]
    k = bisect_left(units, count + 1)  # the frame in which the next unit starts
    base, wanted = (units[k - 1], ends[k - 1]) if k else (0, 0), count - (units[k - 1] if k else 0)
    part = expanded(frames[k])
    unit, point = starts(part)
    here = np.flatnonzero(unit)
    here = here[len(here) - (units[k] - base[0]) :]  # without a first unit that began in the frame before
    at = int(here[wanted])
    return base[1] + at, (chars[k - 1] if k else 0) + int(point[:at].sum())


def between(frames: list[bytes], ends: list[int], start: int, stop: int) -> list[bytes]:
    """The frames of the bytes from ``start`` to ``stop``: whole ones as they are, cut ones compressed anew."""
    out = []
    for k in range(bisect_left(ends, start + 1), len(frames)):
        base = ends[k - 1] if k else 0
        if base >= stop:
            break
        a, b = max(start - base, 0), min(stop, ends[k]) - base
        out.append(frames[k] if a == 0 and base + b == ends[k] else zstandard.compress(expanded(frames[k])[a:b]))
    return out


def arranged(stored: dict, draws: list[int], plain_from: int, spm_below: int) -> tuple:
    """n, form, prefix_chars, middle_chars and the frames of the output."""
    frames, units, chars = stored["frames"], stored["units"], stored["chars"]
    n = units[-1] if units else 0
    if not frames or stored["marked"] or draws[2] % 100 >= plain_from:
        return n, "plain", None, None, frames
    ends = sizes(frames)
    (a, before), (b, until) = (seek(frames, units, chars, ends, x) for x in sorted((draws[0] % (n + 1), draws[1] % (n + 1))))
    mark = {m: [zstandard.compress(m)] for m in MARKS}
    prefix, middle, suffix = between(frames, ends, 0, a), between(frames, ends, a, b), between(frames, ends, b, ends[-1])
    if draws[3] % 100 < spm_below:
        return n, "spm", before, until - before, mark[SUFFIX] + suffix + mark[PREFIX] + prefix + mark[MIDDLE] + middle
    return n, "psm", before, until - before, mark[PREFIX] + prefix + mark[SUFFIX] + suffix + mark[MIDDLE] + middle


def put_back(frames: list[bytes], form: str) -> list[bytes]:
    """The frames of the text that an output was made of, by the places of its three marks."""
    if form == "plain":
        return frames
    ends, at, base, tail = sizes(frames), {}, 0, b""
    for part in map(expanded, frames):
        seen = tail + part
        for m in MARKS if b"<" in seen else ():
            if (k := seen.find(m)) >= 0:
                at.setdefault(m, base - len(tail) + k)
        base, tail = base + len(part), seen[-2:]
    order = sorted(MARKS, key=at.__getitem__)
    stop = dict(zip(order, [*(at[m] for m in order[1:]), ends[-1]]))
    return [f for m in (PREFIX, MIDDLE, SUFFIX) for f in between(frames, ends, at[m] + len(m), stop[m])]


def framed(df: DataFrame, text: str = "text", result: str = "stored", frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """``df`` with its texts moved into frames: ``result`` takes the place of the column ``text``.

    frames are independent zstandard frames of at most ``frame_bytes`` bytes of text, units and chars the counts up to the end of
    each; marked says whether the text holds one of the marks. Put behind each other the frames are a zstandard file. A null text is
    an empty one: no frames. Equal rows stay, one each; other columns pass unchanged, and another column named ``result`` is
    replaced. An empty table gives an empty one. A unit may be longer than a frame. A task holds one Arrow batch of texts.
    """
    size = max(frame_bytes, 4)

    @F.arrow_udf(STORED)
    def store(column: pa.Array) -> pa.Array:
        rows = [encoded(x or b"", size) for x in column.cast(pa.binary()).to_pylist()]
        kinds = pa.list_(pa.binary()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.bool_()
        return texts.struct_of([(name, [r[i] for r in rows], kind) for i, (name, kind) in enumerate(zip(("frames", "units", "chars", "marked"), kinds))])

    others = [F.col(f"`{c}`") for c in df.columns if c not in (text, result)]
    return df.select(*others, store.asNondeterministic()(F.col(f"`{text}`")).alias(result))


def draws(key: Column, seed: str = "1") -> Column:
    """Four numbers below 2 ** 32 that follow from the key alone; a null key draws as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)])


def fill_in_middle(
    df: DataFrame, drawn: Column, stored: str = "stored", result: str = "middle", plain_from: int = 90, spm_below: int = 20
) -> DataFrame:
    """``df``, as :func:`framed` gives it, with a struct ``result`` in place of the frames: n, form, prefix_chars, middle_chars, output.

    The text's n units are cut after the smaller and the larger of two drawn counts from 0 to n. The output is the text itself
    (``plain``: empty, holding a mark, or a share of ``plain_from`` in 100 and above), ``<P>`` prefix ``<S>`` suffix ``<M>`` middle (``psm``)
    or ``<S>`` suffix ``<P>`` prefix ``<M>`` middle (``spm``: below ``spm_below`` in 100), as an array of zstandard frames; lengths
    in code points, null if plain. Equal rows get equal results. Other columns pass unchanged; an empty table gives an empty one.
    """

    @F.arrow_udf(MADE)
    def make(column: pa.Array, drawn: pa.Array) -> pa.Array:
        rows = [arranged(s, d, plain_from, spm_below) for s, d in zip(column.to_pylist(), drawn.to_pylist())]
        kinds = pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.binary())
        names = "n", "form", "prefix_chars", "middle_chars", "output"
        return texts.struct_of([(name, [r[i] for r in rows], kind) for i, (name, kind) in enumerate(zip(names, kinds))])

    others = [F.col(f"`{c}`") for c in df.columns if c not in (stored, result)]
    return df.select(*others, make.asNondeterministic()(F.col(f"`{stored}`"), drawn).alias(result))


def restored(output: Column, form: Column) -> Column:
    """The frames of the text that an output of :func:`fill_in_middle` was made of."""

    @F.arrow_udf("array<binary>")
    def restore(column: pa.Array, form: pa.Array) -> pa.Array:
        return pa.array([put_back(f, x) for f, x in zip(column.to_pylist(), form.to_pylist())], pa.list_(pa.binary()))

    return restore(output, form)


def digest(frames: Column) -> Column:
    """The sha256 of the text in the frames, as lower-case hex; frame after frame, never the whole text."""

    @F.arrow_udf("string")
    def hashed(column: pa.Array) -> pa.Array:
        out = []
        for row in column.to_pylist():
            state = hashlib.sha256()
            for frame in row:
                state.update(expanded(frame))
            out.append(state.hexdigest())
        return pa.array(out, pa.string())

    return hashed(frames)


def text_of(frames: Column) -> Column:
    """The text in the frames as one string."""

    @F.arrow_udf("string")
    def joined(column: pa.Array) -> pa.Array:
        return pa.array([b"".join(map(expanded, row)).decode() for row in column.to_pylist()], pa.string())

    return joined(frames)
