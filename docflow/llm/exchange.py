"""Chunks of documents that ask all others about hashes, and get answers as bits.

A corpus is written once as chunks of a few megabytes, in a table bucketed by chunk. Chunks *ask* about packed
arrays of hashes, dealt by hash into parts; a part holds the hashes of all chunks that fall into it and
*answers* each chunk; the answers come back to the chunk's own bucket, so that the texts are never shuffled. A
chunk asks about a hash once, however often it holds it, so that a text that fills a third of all documents costs a
few bytes per chunk. Everything is a written table or a Spark shuffle: a lost executor costs a re-read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.session import fresh_path

CHUNK_BYTES = 4 << 20
PART_BYTES = 8 << 20
LEAST_PARTS = 64
MOST_BUCKETS = 100_000  # what a bucketed table may have; chunks share buckets beyond it
ANSWER = "chunk long, part int, kind int, bits binary"

_GOLD, _ODD, _LOW = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xFFFFFFFF)
_HALF = np.uint64(32)


class Chunks:
    """The written chunks of a corpus: ``frame`` has chunk and blob; ``parts`` is the number of parts to ask."""

    def __init__(self, frame: DataFrame, parts: int, key_type: str):
        self.frame, self.parts, self.key_type = frame, parts, key_type

    def ask(self, schema: str, rows: Callable[[int, pa.Table], Iterator[pa.RecordBatch]], answers: DataFrame | None = None) -> DataFrame:
        """What ``rows(chunk, documents)`` makes of every chunk; with ``answers``, ``rows(chunk, documents, answers)``."""
        if answers is None:

            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    for chunk, blob in zip(batch.column("chunk").to_pylist(), batch.column("blob")):
                        yield from rows(chunk, unpack(blob.as_buffer()))

            return self.frame.mapInArrow(run, schema)

        def joined(key: tuple, mine: pa.Table, theirs: pa.Table) -> pa.Table:
            made = []
            for blob in mine.column("blob"):
                made += rows(key[0].as_py(), unpack(blob.as_buffer()), theirs)
            return pa.Table.from_batches(made) if made else pa.table({f.name: pa.array([], f.type) for f in kinds})

        from pyspark.sql.pandas.types import to_arrow_schema
        from pyspark.sql.types import StructType

        kinds = to_arrow_schema(StructType.fromDDL(schema))
        return self.frame.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(joined, schema)


def write_chunks(df: DataFrame, key: str, text: str) -> Chunks:
    """Write key and text of every row of ``df`` as compressed chunks; nulls stay nulls, repeated keys stay apart."""
    spark = df.sparkSession
    source = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    n_bytes = source.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    parts = max(LEAST_PARTS, -(-n_bytes // PART_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made, held, size = TaskContext.get().partitionId() << 33, 0, [], 0

        def blob() -> pa.RecordBatch:
            nonlocal made, held, size
            table = pa.Table.from_batches(held)
            out = pa.record_batch([pa.array([base + made], pa.int64()), pa.array([pack(table)], pa.binary())], names=["chunk", "blob"])
            made, held, size = made + 1, [], 0
            return out

        for batch in batches:
            lengths = pa.compute.binary_length(batch.column("text").cast(pa.large_binary())).fill_null(0).to_numpy(zero_copy_only=False)
            cut = 0
            for k, n in enumerate(lengths.tolist()):
                size += n
                if size >= CHUNK_BYTES:
                    held.append(batch.slice(cut, k + 1 - cut))
                    cut = k + 1
                    yield blob()
            if cut < len(lengths):
                held.append(batch.slice(cut))
        if held:
            yield blob()

    path, name = fresh_path(spark, "chunks"), f"docflow_chunks_{uuid.uuid4().hex}"
    buckets = min(MOST_BUCKETS, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // (4 * CHUNK_BYTES))))
    source.mapInArrow(run, "chunk long, blob binary").write.bucketBy(buckets, "chunk").option("path", path).saveAsTable(name)
    return Chunks(spark.table(name), parts, source.schema["key"].dataType.simpleString())


def pack(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as writer:
        writer.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


def unpack(blob: pa.Buffer) -> pa.Table:
    return pa.ipc.open_stream(blob).read_all()


def answered(asks: DataFrame, rows: Callable[[pa.Table], pa.Table], schema: str = ANSWER) -> DataFrame:
    """``rows`` of all that falls into a part; a part is about ``PART_BYTES`` of hashes."""

    def run(_: tuple, table: pa.Table) -> pa.Table:
        return rows(table)

    return asks.groupBy("part").applyInArrow(run, schema)


def mixed(x: np.ndarray) -> np.ndarray:
    """Numbers of 64 bits spread over all of them."""
    x = (x ^ (x >> _HALF)) * _ODD
    return x ^ (x >> _HALF)


def rolled(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each window of ``n`` numbers, by doubling."""
    power, size, out, done = h, 1, None, 0
    while True:
        if n & size:
            if out is None:
                out, done = power, size
            else:
                keep = len(h) - done - size + 1
                out = mixed(out[: max(keep, 0)] * _GOLD + power[done : done + max(keep, 0)])
                done += size
        if 2 * size > n:
            return out
        power = mixed(power[: max(len(power) - size, 0)] * _GOLD + power[size:])
        size *= 2


def part_of(h: np.ndarray, parts: int) -> np.ndarray:
    return ((h & _LOW) % np.uint64(parts)).astype(np.int64)


def dealt(part: np.ndarray, parts: int, *arrays: np.ndarray) -> Iterator[tuple[int, list[bytes]]]:
    """For each part that has any, the bytes of ``arrays`` there; ``part`` must be sorted."""
    edges = np.searchsorted(part, np.arange(parts + 1))
    for p in np.flatnonzero(edges[1:] > edges[:-1]).tolist():
        yield p, [a[edges[p] : edges[p + 1]].tobytes() for a in arrays]


def bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def flags(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


def answers_of(answers: pa.Table, kind: int) -> dict[int, bytes]:
    """Bits by part."""
    chosen = answers.filter(pa.compute.equal(answers.column("kind"), kind))
    return dict(zip(chosen.column("part").to_pylist(), chosen.column("bits").to_pylist()))


def flagged(part: np.ndarray, parts: int, answers: dict[int, bytes]) -> np.ndarray:
    """The answered bits of hashes sorted by part; no answer is false."""
    edges = np.searchsorted(part, np.arange(parts + 1))
    out = np.zeros(len(part), dtype=bool)
    for p, data in answers.items():
        out[edges[p] : edges[p + 1]] = flags(data, int(edges[p + 1] - edges[p]))
    return out


def squeezed(data: bytes, width: int) -> bytes:
    """Numbers of ``width`` bytes as differences, byte planes apart, compressed: sorted ones shrink by a third or more."""
    numbers = np.frombuffer(data, f"<u{width}")
    planes = np.diff(numbers, prepend=numbers.dtype.type(0)).view(np.uint8).reshape(-1, width).T
    return bytes([width]) + len(data).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(np.ascontiguousarray(planes).tobytes(), asbytes=True)


def widened(data: bytes) -> bytes:
    width, n = data[0], int.from_bytes(data[1:9], "little")
    planes = np.frombuffer(pa.Codec("zstd", 1).decompress(data[9:], n, asbytes=True), np.uint8).reshape(width, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(f"<u{width}").ravel(), dtype=f"<u{width}").tobytes()
