"""Running values over ordered rows without putting a whole group into one task.

A plain window needs all rows of a key in one task. Here the rows of a key are
cut into blocks of neighbours; windows run inside the blocks, the blocks are
reduced to one row each, a window over those rows finds what every block
inherits, and an equi join hands it down. A key with a third of all rows is
thereby spread over as many tasks as it has blocks.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 32_768


@dataclass(frozen=True)
class Running:
    """A running value: ``last`` non-null value, ``max``, ``sum``, or ``join`` of texts."""

    kind: str
    value: Column
    inclusive: bool = True
    separator: str = ""


def _fold(r: Running, value: Column, order: Column) -> Column:
    """Aggregate that reduces a block to one value."""
    if r.kind == "last":
        return F.max_by(value, F.when(value.isNotNull(), order))
    if r.kind == "max":
        return F.max(value)
    if r.kind == "sum":
        return F.sum(value)
    pairs = F.array_sort(F.collect_list(F.when(value.isNotNull(), F.struct(order.alias("o"), value.alias("v")))))
    return F.when(F.count(value) > 0, F.array_join(F.transform(pairs, lambda p: p["v"]), r.separator))


def _slide(r: Running, value: Column, window) -> Column:
    if r.kind == "last":
        return F.last(value, ignorenulls=True).over(window)
    if r.kind == "max":
        return F.max(value).over(window)
    if r.kind == "sum":
        return F.sum(value).over(window)
    return F.when(
        F.count(value).over(window) > 0, F.array_join(F.collect_list(value).over(window), r.separator)
    )


def _combine(r: Running, carry: Column, local: Column) -> Column:
    if r.kind == "last":
        return F.coalesce(local, carry)
    if r.kind == "max":
        return F.greatest(local, carry)
    if r.kind == "sum":
        return F.coalesce(local, F.lit(0)) + F.coalesce(carry, F.lit(0))
    return F.when(carry.isNull(), local).when(local.isNull(), carry).otherwise(
        F.concat(carry, F.lit(r.separator), local)
    )


def running(
    df: DataFrame,
    keys: list[str],
    position: str,
    values: dict[str, Running],
    tie: list[str] | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """Add one column per entry of ``values``, running over ``position`` within ``keys``.

    ``position`` is a non-negative whole number. Rows of a key that share a
    position are ordered by ``tie``; there must be few of them, as a block spans
    ``block`` positions.
    """
    order = [position, *(tie or [])]
    rank = F.struct(*[F.col(c) for c in order])
    start = Window.unboundedPreceding

    blocked = df.withColumn("_block", F.floor(F.col(position) / F.lit(block)))
    inside = Window.partitionBy(*keys, "_block").orderBy(*order)
    frames = {True: inside.rowsBetween(start, 0), False: inside.rowsBetween(start, -1)}
    local = blocked.withColumns(
        {f"_local_{n}": _slide(r, r.value, frames[r.inclusive]) for n, r in values.items()}
    )

    folded = blocked.groupBy(*keys, "_block").agg(
        *[_fold(r, r.value, rank).alias(f"_fold_{n}") for n, r in values.items()]
    )
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(start, -1)
    carried = folded.select(
        *keys, "_block", *[_slide(r, F.col(f"_fold_{n}"), before).alias(f"_carry_{n}") for n, r in values.items()]
    ).filter(reduce(or_, [F.col(f"_carry_{n}").isNotNull() for n in values]))

    joined = local.join(carried, [*keys, "_block"], "left")
    return joined.select(
        *df.columns,
        *[_combine(r, F.col(f"_carry_{n}"), F.col(f"_local_{n}")).alias(n) for n, r in values.items()],
    )


def row_numbers(df: DataFrame, keys: list[str], position: str, name: str = "rn", block: int = BLOCK) -> DataFrame:
    """Dense row numbers from 1 within ``keys``, by a unique ``position``."""
    return running(df, keys, position, {name: Running("sum", F.lit(1).cast("bigint"))}, block=block)
