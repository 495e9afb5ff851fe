"""Sharding: groups of equal texts into shards of near equal bytes, best fit decreasing."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docflow.session import write_once


class RemainingTree:
    """Balanced (AA) tree of open bins, ordered by what they have left and then by number."""

    def __init__(self) -> None:
        self.root: list | None = None  # a node: [key, level, left, right]

    @staticmethod
    def _skew(n: list) -> list:
        if n[2] is not None and n[2][1] == n[1]:
            left = n[2]
            n[2], left[3] = left[3], n
            return left
        return n

    @staticmethod
    def _split(n: list) -> list:
        if n[3] is not None and n[3][3] is not None and n[3][3][1] == n[1]:
            right = n[3]
            n[3], right[2] = right[2], n
            right[1] += 1
            return right
        return n

    def insert(self, left: int, number: int) -> None:
        self.root = self._insert(self.root, (left, number))

    def _insert(self, n: list | None, key: tuple[int, int]) -> list:
        if n is None:
            return [key, 1, None, None]
        side = 2 if key < n[0] else 3
        n[side] = self._insert(n[side], key)
        return self._split(self._skew(n))

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the bin with the least room that still holds ``size``."""
        n, best = self.root, None
        while n is not None:
            if n[0][0] >= size:
                best, n = n[0], n[2]
            else:
                n = n[3]
        if best is not None:
            self.root = self._remove(self.root, best)
        return best

    def _remove(self, n: list | None, key: tuple[int, int]) -> list | None:
        if n is None:
            return None
        if key != n[0]:
            side = 2 if key < n[0] else 3
            n[side] = self._remove(n[side], key)
        elif n[2] is None or n[3] is None:
            return n[2] or n[3]
        else:
            heir = n[3]
            while heir[2] is not None:
                heir = heir[2]
            n[0] = heir[0]
            n[3] = self._remove(n[3], heir[0])
        level = min(n[2][1] if n[2] else 0, n[3][1] if n[3] else 0) + 1
        if level < n[1]:
            n[1] = level
            if n[3] is not None and n[3][1] > level:
                n[3][1] = level
        n = self._skew(n)
        if n[3] is not None:
            n[3] = self._skew(n[3])
            if n[3][3] is not None:
                n[3][3] = self._skew(n[3][3])
        n = self._split(n)
        if n[3] is not None:
            n[3] = self._split(n[3])
        return n


class BestFit:
    """Bins of one capacity; items must come largest first. An item above the capacity gets a bin of its own."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.count, self.open = capacity, 0, RemainingTree()

    def place(self, size: int) -> int:
        found = self.open.take_tightest(size)
        if found is None:
            found = (max(self.capacity, size), self.count)
            self.count += 1
        left, number = found[0] - size, found[1]
        if left > 0:
            self.open.insert(left, number)
        return number


def fewest(sizes: list[int], shards: int) -> list[int]:
    """Shard of each item (sizes largest first): least capacity, within one part in 4096, that needs no more than ``shards``.

    Items above the mean of what is left take a shard each before, as no packing can even them out.
    """
    alone, rest = 0, sum(sizes)
    while alone < min(len(sizes), shards - 1) and sizes[alone] * (shards - alone) > rest:
        rest -= sizes[alone]
        alone += 1
    tail, free = sizes[alone:], shards - alone

    def tried(capacity: int) -> list[int] | None:
        bins = BestFit(capacity)
        placed = [bins.place(s) for s in tail]
        return placed if bins.count <= free else None

    low = max([-(-rest // free), *tail[:1], 1])
    high = low
    while (best := tried(high)) is None:
        low, high = high + 1, high + max(1, high // 64)
    while high - low > high // 4096:
        middle = (low + high) // 2
        if (placed := tried(middle)) is None:
            low = middle + 1
        else:
            best, high = placed, middle
    return [*range(alone), *(alone + b for b in best)]


def best_fit_shards(df: DataFrame, text: str = "text", key: str = "doc_id", shards: int = 16, pallets_per_shard: int = 256) -> DataFrame:
    """One row per input row: doc_id (the key), size, text_crc32, shard and slot.

    size is the UTF-8 bytes of the text plus one; rows of equal texts are a group that stays together. Best fit
    decreasing runs at two levels, so that no task and not the driver sees all groups. Within each partition of
    the groups, sorted by size, they enter pallets of a ``pallets_per_shard``-th of a shard; the pallets, about
    ``shards * pallets_per_shard`` and one more per partition, and the groups above that size enter the
    shards, whose capacity is the least that makes them suffice. Slots count from 0 in each shard by salted
    counts, not by a window over the shard.

    A null text has size 1 and the checksum 0 of no bytes; nulls are a group, the empty text is another. Equal
    rows get slots of their own, null keys too. Other columns are left out. An empty table gives no row.
    """
    docs = df.select(
        F.col(key).alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col(text).cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.coalesce(F.unhex(F.sha2(text, 256)), F.lit(b"")).alias("group"),
    )
    groups = docs.groupBy("group").agg(F.sum("size").alias("bytes"))
    total = docs.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("s")).first()["s"]
    capacity = max(1, total // (shards * pallets_per_shard))

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, base = BestFit(capacity), TaskContext.get().partitionId() << 33
        for b in batches:
            placed = [base + bins.place(s) for s in b.column("bytes").to_pylist()]
            yield pa.record_batch([b.column("group"), b.column("bytes"), pa.array(placed, pa.int64())], names=["group", "bytes", "pallet"])

    loaded = groups.sortWithinPartitions(F.desc("bytes"), "group").mapInArrow(load, "group binary, bytes long, pallet long")
    loaded = write_once(loaded, "pallets")
    pallets = loaded.groupBy("pallet").agg(F.sum("bytes").alias("bytes")).collect()  # about shards * pallets_per_shard, and a few per partition
    pallets.sort(key=lambda r: (-r["bytes"], r["pallet"]))
    shard_of = list(zip([r["pallet"] for r in pallets], fewest([r["bytes"] for r in pallets], shards)))
    spark = df.sparkSession
    where = loaded.join(spark.createDataFrame(shard_of, "pallet long, shard int"), "pallet").select("group", "shard")
    placed = docs.join(where, "group")
    return slots(placed).select("doc_id", "size", "text_crc32", "shard", "slot")


def slots(df: DataFrame, salts: int = 1024) -> DataFrame:
    """``slot``: numbers from 0 without gaps in each ``shard``, in ``salts`` parts of it that are numbered apart."""
    salted = write_once(df.withColumn("part", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(salts))), "placed")
    counts = salted.groupBy("shard", "part").agg(F.count("*").alias("n"))  # shards * salts rows at most
    before = counts.withColumn("before", F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n"))
    order = Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32")
    numbered = salted.withColumn("k", F.row_number().over(order))
    return numbered.join(F.broadcast(before.drop("n")), ["shard", "part"]).withColumn("slot", F.col("before") + F.col("k") - 1)
