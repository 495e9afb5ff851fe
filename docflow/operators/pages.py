"""Pages of documents: numbering, groups, and sections that run across pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.functions.text import has_text, missing_to_null, page_file
from docflow.operators.scan import Running, row_numbers, running
from docflow.operators.skew import lookup
from docflow.session import write_once


def enumerate_pages(docs: DataFrame, pages: Column, file_name: Column, image_dir: str) -> DataFrame:
    """One row per element of the page array, numbered from 1, with the path of its image."""
    kept = [c for c in docs.columns]
    return (
        docs.select(*kept, file_name.alias("file_name"), F.posexplode(pages).alias("_pos", "page"))
        .withColumn("page_sequence_number", (F.col("_pos") + 1).cast("bigint"))
        .withColumn(
            "image_path",
            F.concat_ws("/", F.lit(image_dir), "file_name", page_file(F.col("file_name"), F.col("page_sequence_number"))),
        )
        .drop("_pos")
    )


def number_groups(df: DataFrame, keys: list[str], position: str, size: int, name: str = "grp") -> DataFrame:
    """Cut the rows of a key, ordered by a unique ``position``, into groups of ``size``; the last may be shorter."""
    numbered = row_numbers(df, keys, position, "_rn")
    return numbered.withColumn(name, F.floor((F.col("_rn") - 1) / F.lit(size)).cast("bigint")).drop("_rn")


def first_pages(pages: DataFrame, keys: list[str], seq: str, value: str, k: int = 3) -> DataFrame:
    """The values of the first ``k`` pages of each document, as one ordered array of at most ``k``."""
    return (
        pages.filter(F.col(seq) <= k)
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(F.struct(F.col(seq).alias("o"), F.col(value).alias("v")))).alias("_l"))
        .select(*keys, F.transform("_l", lambda p: p["v"]).alias(value + "s"))
    )


def group_values(pages: DataFrame, keys: list[str], seq: str, value: str) -> DataFrame:
    """Values per group of bounded size, in page order."""
    return (
        pages.groupBy(*keys)
        .agg(F.array_sort(F.collect_list(F.struct(F.col(seq).alias("o"), F.col(value).alias("v")))).alias("_l"))
        .select(*keys, F.transform("_l", lambda p: p["v"]).alias(value + "s"))
    )


def join_texts(
    df: DataFrame, keys: list[str], position: str, text: str, output: str, separator: str = " ", block: int = 1000
) -> DataFrame:
    """One text per key out of its rows in order; null texts leave no gap.

    Blocks of neighbours are joined first, so the last step sees one row per block.
    """
    def joined(position: str, text: str) -> Column:
        pairs = F.array_sort(
            F.collect_list(F.when(F.col(text).isNotNull(), F.struct(F.col(position).alias("o"), F.col(text).alias("v"))))
        )
        return F.when(F.count(text) > 0, F.array_join(F.transform(pairs, lambda p: p["v"]), separator))

    blocks = (
        df.withColumn("_block", F.floor(F.col(position) / F.lit(block)))
        .groupBy(*keys, "_block")
        .agg(joined(position, text).alias("_text"))
    )
    return blocks.groupBy(*keys).agg(F.coalesce(joined("_block", "_text"), F.lit("")).alias(output))


def fill_sections(pages: DataFrame, keys: list[str], seq: str = "page_sequence_number", block: int = 32_768) -> DataFrame:
    """Fill missing section names from the item or page before, and say which pages changed.

    The first page of a document is left alone. On every other page an item that
    lacks both names takes those of the item before; the first item, if it has text
    but no section, takes the section the page before ended with or, failing that
    and lacking a parent, its parent. Filled pages hand on what they were given.

    What a page hands on depends on earlier pages only if its first item is open
    and every later item follows it. All other pages settle it themselves, so the
    value that reaches a page is the last settled one, found by a running scan over
    one narrow row per page, written first as the scan reads it more than once.
    What it finds is written too: only pages that are given something, and first
    pages. Page contents are read twice in all, and meet nothing but that table.
    """
    names = F.transform(
        "page_content",
        lambda x: F.struct(
            missing_to_null(x["section_name"]).alias("s"), missing_to_null(x["parent_section_name"]).alias("p")
        ),
    )
    # position of the item whose names an item ends up with, on a page that is not the first
    heads = F.transform(
        "_names",
        lambda x, j: F.array_max(
            F.transform(
                F.slice(F.col("_names"), F.lit(1), j + 1),
                lambda y, k: F.when((k == 0) | y["s"].isNotNull() | y["p"].isNotNull(), k),
            )
        ),
    )
    first, last = F.get("_names", F.lit(0)), F.try_element_at("_names", F.lit(-1))
    filled = F.coalesce(F.size("page_content"), F.lit(0)) > 0
    narrow = write_once(
        pages.withColumn("_names", names)
        .withColumn("_heads", heads)
        .select(
            *keys,
            seq,
            (filled & has_text(F.get("page_content", F.lit(0))["text"]) & first["s"].isNull()).alias("_open"),
            F.coalesce(F.try_element_at("_heads", F.lit(-1)) > 0, F.lit(False)).alias("_turns"),
            first["p"].alias("_p0"),
            last.alias("_last"),
            F.get("_names", F.try_element_at("_heads", F.lit(-1))).alias("_settled"),
        ),
        "page-states",
    )
    firsts = narrow.groupBy(*keys).agg(F.min(seq).alias(seq)).withColumn("_first", F.lit(True))
    marked = narrow.join(firsts, [*keys, seq], "left").withColumn("_first", F.coalesce("_first", F.lit(False)))

    takes = F.col("_open") & ~F.col("_first")
    passes = takes & ~F.col("_turns")
    own = F.when(F.col("_first"), F.col("_last")).otherwise(F.col("_settled"))
    states = marked.select(
        *keys,
        seq,
        "_first",
        takes.alias("_takes"),
        "_p0",
        F.when(~passes, F.struct(own["s"].alias("s"), own["p"].alias("p"))).alias("_anchor"),
        F.when(~passes, F.struct(F.lit(None).cast("string").alias("p")))
        .when(F.col("_p0").isNotNull(), F.struct(F.col("_p0").alias("p")))
        .alias("_parent"),
        F.struct(F.when(passes, F.col("_p0")).otherwise(own["p"]).alias("p")).alias("_latest"),
    )
    before = {
        name: Running("last", F.col(column), inclusive=False)
        for name, column in (("_a", "_anchor"), ("_f", "_parent"), ("_l", "_latest"))
    }
    scanned = running(states, keys, seq, before, block=block)
    carried = write_once(
        scanned.withColumn("_in_s", F.col("_a")["s"])
        .withColumn(
            "_in_p",
            F.when(F.col("_in_s").isNotNull(), F.col("_l")["p"]).otherwise(
                F.coalesce(F.col("_f")["p"], F.col("_a")["p"])
            ),
        )
        .filter(F.col("_first") | (F.col("_takes") & (F.col("_in_s").isNotNull() | F.col("_in_p").isNotNull())))
        .select(*keys, seq, "_first", F.col("_in_s"), F.col("_in_p")),
        "page-gifts",
    )

    joined = (
        pages.join(carried, [*keys, seq], "left")
        .withColumn("_first", F.coalesce("_first", F.lit(False)))
        .withColumn("_names", names)
        .withColumn("_heads", heads)
    )
    given = ~F.col("_first") & (F.col("_in_s").isNotNull() | F.col("_in_p").isNotNull())

    def renamed(x: Column, j: Column) -> Column:
        head = F.get("_heads", j)
        source = F.get("_names", F.when(F.col("_first"), j).otherwise(head))
        carried_here = given & (head == 0)
        section = F.when(carried_here, F.coalesce(source["s"], F.col("_in_s"))).otherwise(source["s"])
        parent = F.when(carried_here & F.col("_in_s").isNull(), F.coalesce(source["p"], F.col("_in_p"))).otherwise(
            source["p"]
        )
        return x.withField("section_name", F.coalesce(section, x["section_name"])).withField(
            "parent_section_name", F.coalesce(parent, x["parent_section_name"])
        )

    follows = F.exists(
        F.slice("_names", F.lit(2), F.greatest(F.size("_names"), F.lit(1))),
        lambda y: y["s"].isNull() & y["p"].isNull(),
    )
    moved = given & (F.col("_in_s").isNotNull() | first["p"].isNull())
    return joined.select(
        *[F.transform("page_content", renamed).alias(c) if c == "page_content" else F.col(c) for c in pages.columns],
        (~F.col("_first") & (F.coalesce(follows, F.lit(False)) | moved)).alias("changed"),
    )


def missing_extracts(listed: DataFrame, loaded: DataFrame, keys: list[str]) -> DataFrame:
    """Listed pages that no loaded extract stands for."""
    return listed.join(loaded, keys, "left_anti")


def require_complete(listed: DataFrame, loaded: DataFrame, keys: list[str]) -> None:
    """Stop where a listed page has not been loaded; names one that is missing."""
    missing = missing_extracts(listed, loaded, keys).select(*keys).head()
    if missing is not None:
        raise ValueError(f"not loaded: {missing.asDict()}")


def enrich_pages(pages: DataFrame, documents: DataFrame, key: str, seq: str, block: int = 4096) -> DataFrame:
    """Hand title and summary of a document to each of its pages."""
    return lookup(pages, documents, [key], F.floor(F.col(seq) / F.lit(block)))
