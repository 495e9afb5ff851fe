"""Merge-or-upload by key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.operators.pages import number_groups
from docflow.session import write_once
from docflow.sources.snapshots import Part, Store, ranges, to_fold

MERGE = "merge_seq"
#: Up to so many repeated keys are sent to every task, as 8 bytes each.
SENT_KEYS = 500_000


def latest_fields(changes: DataFrame, keys: list[str], *order: str, ties: bool = True) -> DataFrame:
    """One row per key: of every field the last value that was given, by the columns ``order``.

    Rows that are equal in ``order`` are ranked by a hash of the whole row, so that all fields of a tie follow
    one row where it gives them, whatever order the rows came in. Without ``ties`` no two rows of a key are equal in ``order``, and
    the hash is not shuffled beside every field.
    """
    fields = [c for c in changes.columns if c not in (*keys, *order)]
    if ties:
        rank = F.struct(*order, F.xxhash64(*[c for c in changes.columns if c not in order]).alias("_hash"))
    else:
        rank = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    ranked = changes.withColumn("_rank", rank)
    return ranked.groupBy(*keys).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_rank"))).alias(c) for c in fields])


def latest_stored(changes: DataFrame, keys: list[str], *order: str, most: int = SENT_KEYS) -> DataFrame:
    """:func:`latest_fields` of a written table, of which only rows whose key comes more than once are shuffled.

    Keys are counted by a hash of 8 bytes; a key that shares its hash with another takes the longer way, and nothing else comes of it.
    Where more than ``most`` hashes repeat, all rows are shuffled. ``changes`` is read twice or three times.
    """
    mark = F.xxhash64(*keys).alias("_mark")
    repeated = changes.groupBy(mark).agg(F.count("*").alias("_n")).filter(F.col("_n") > 1).select("_mark")
    often = write_once(repeated, "repeated-keys")
    found = often.count()
    if found > most:
        return latest_fields(changes, keys, *order)
    lone = changes.select(*keys, *[c for c in changes.columns if c not in (*keys, *order)])
    if not found:
        return lone
    again = changes.select("*", mark).join(F.broadcast(often), "_mark", "left_semi").drop("_mark")
    return lone.select("*", mark).join(F.broadcast(often), "_mark", "left_anti").drop("_mark").unionByName(latest_fields(again, keys, *order))


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Given fields overwrite, others stay, unknown keys and columns are added. Both sides are unique on ``keys``."""
    fields = [c for c in dict.fromkeys([*old.columns, *new.columns]) if c not in keys]
    o, n = old.alias("o"), new.alias("n")

    def field(c: str):
        sides = [f"{side}.{c}" for side, df in (("n", new), ("o", old)) if c in df.columns]
        return F.coalesce(*[F.col(s) for s in sides]).alias(c)

    return o.join(n, keys, "full").select(*keys, *[field(c) for c in fields])


def upload_batches(rows: DataFrame, keys: list[str], position: str, size: int = 900) -> DataFrame:
    """Number the batches in which the rows of a key are sent."""
    return number_groups(rows, keys, position, size, "batch")


def upload_report(results: DataFrame, keys: list[str], succeeded: str) -> DataFrame:
    """How many rows of each key (a batch, a document) were sent, and how many of them taken."""
    return results.groupBy(*keys).agg(
        F.count_if(F.col(succeeded)).alias("succeeded"), F.count("*").alias("sent")
    )


def upsert_table(
    spark: SparkSession, path: str, changes: DataFrame, keys: list[str], order: str, merge: int | None = None, stored: bool = False
) -> None:
    """Merge changes into a table that keeps its merges in folders, which a manifest names (:mod:`docflow.sources.snapshots`).

    Only the changes are written, in one pass, or by :func:`latest_stored` if they are ``stored`` as a written table; merges of like size are then folded, and all becomes the table by one rename: a
    stop before it changes nothing. ``merge`` numbers the merge (by default one above the highest stored). A merge that is
    repeated under its number replaces itself; one that has been folded since is known and left as it is. :func:`read_table` gives the
    merged rows from a logarithmic number of folders, :func:`compact_table` folds all into one.
    """
    store = Store(spark, path)
    now = store.load()
    number = now.last_write() + 1 if merge is None else merge
    holder = next((p for p in now.parts if p.holds(number)), None)
    if holder and holder.writes != [[number, number]]:
        return
    if any(p.writes[0][0] < number < p.writes[-1][1] for p in now.parts):
        raise ValueError(f"merge {number} comes after later ones have been folded with earlier ones")
    latest = latest_stored if stored else latest_fields
    mine = _written(store, latest(changes, keys, order), [[number, number]])
    parts = sorted([p for p in now.parts if p is not holder] + [mine], key=lambda p: p.writes[0])
    for start, stop in reversed(to_fold([p.size for p in parts])):
        parts[start:stop] = [_folded(store, parts[start:stop], keys)]
    store.commit(now, parts)
    if mine not in parts:  # folded at once, so no manifest names it
        store.drop(mine.folder)


def _written(store: Store, rows: DataFrame, writes: list[list[int]]) -> Part:
    folder = store.new_folder("data")
    rows.write.option("compression", "zstd").parquet(store.where(folder))
    return Part(folder, writes, store.size(folder))


def _folded(store: Store, parts: list[Part], keys: list[str]) -> Part:
    return _written(store, _merged(store, parts, keys), ranges(parts))


def _merged(store: Store, parts: list[Part], keys: list[str]) -> DataFrame:
    """The rows of some parts. Keys are unique within a part, so a single one is read as it is."""
    read = [store.spark.read.parquet(store.where(p.folder)) for p in parts]
    if len(read) == 1:
        return read[0].select(*keys, *[c for c in read[0].columns if c not in keys])
    numbered = [df.withColumn(MERGE, F.lit(k)) for k, df in enumerate(read)]
    return latest_fields(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), numbered), keys, MERGE, ties=False)


def read_table(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The rows of :func:`upsert_table`: columns of all merges, of each field the value given last."""
    store = Store(spark, path)
    parts = store.load().parts
    if not parts:
        raise ValueError(f"nothing has been merged into {path}")
    return _merged(store, parts, keys)


def compact_table(spark: SparkSession, path: str, keys: list[str]) -> None:
    """Fold all merges into one. Whoever reads in between, or after a stop in between, gets the same rows."""
    store = Store(spark, path)
    now = store.load()
    if len(now.parts) > 1:
        store.commit(now, [_folded(store, now.parts, keys)])
