"""Connected components of links, as joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.session import write_once


def stars(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root``, the least node that links reach, for every node that has a link to another.

    Alternates two steps until nothing changes: every node hands the least of its neighbours to its larger ones, then
    to its smaller ones. Paths shrink by half or so each time, and every round is written to the shared folder.
    """
    pair = lambda u, v: F.struct(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
    links = links.filter(F.col(a) != F.col(b)).select(pair(F.col(a), F.col(b)).alias("p")).select("p.*").distinct()
    links = write_once(links, "links")
    state = _mark(links)
    while True:
        links = write_once(_small(_large(links)), "links")
        before, state = state, _mark(links)
        if before == state:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    joined = links.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return joined.union(least.select("u", F.col("m").alias("v"))).distinct()
