"""Layout tables to HTML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.functions.text import html_escape


def table_html(cells: DataFrame, keys: list[str], row_counts: DataFrame | None = None, block: int = 1000) -> DataFrame:
    """One HTML text per table.

    ``cells`` has ``row_index, column_index, kind, column_span, row_span, content``
    beside ``keys``; ``row_counts`` (``keys, row_count``) adds rows without cells.
    A head is opened if row 0 is a header row and closed before the first row that
    is none, or at the end. Cells become rows, rows blocks of rows, blocks a table;
    a block is kept in two halves, above and from its first row that is no header,
    so that the table can put the close where it belongs. Without ``row_counts`` cells are dealt by
    block once: rows and blocks are then made where they lie, and cells are not sorted before they are dealt.
    """
    heading = F.coalesce(F.col("kind").isin("columnHeader", "rowHeader"), F.lit(False))
    tag = F.when(heading, F.lit("th")).otherwise(F.lit("td"))

    def span(label: str, column: str):
        return F.when(F.col(column) > 1, F.concat(F.lit(f" {label}="), F.col(column).cast("string"))).otherwise(F.lit(""))

    html = F.concat(
        F.lit("<"), tag, span("colSpan", "column_span"), span("rowSpan", "row_span"), F.lit(">"),
        html_escape(F.coalesce("content", F.lit(""))), F.lit("</"), tag, F.lit(">"),
    )
    head = F.coalesce(F.col("kind") == "columnHeader", F.lit(False))
    spot = F.floor(F.col("row_index") / F.lit(block)).alias("_block")
    placed = cells.select(*keys, "row_index", F.col("column_index").alias("o"), html.alias("v"), head.alias("_head"))
    if row_counts is None:
        placed = placed.select(*keys, spot, "row_index", "o", "v", "_head").repartition(*keys, "_block")
    rows = placed.groupBy(*placed.columns[:-3]).agg(
        F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("o", "v"))), lambda p: p["v"])).alias("_cells"),
        F.max("_head").alias("_header"),
    )
    if row_counts is not None:
        every = row_counts.filter(F.col("row_count") > 0).select(
            *keys, F.explode(F.sequence(F.lit(0), F.col("row_count").cast("int") - 1)).alias("row_index")
        )
        rows = every.join(rows, [*keys, "row_index"], "left").select(
            *keys, "row_index", F.coalesce("_cells", F.lit("")).alias("_cells"),
            F.coalesce("_header", F.lit(False)).alias("_header"), spot,
        )
    line = F.concat(
        F.when((F.col("row_index") == 0) & F.col("_header"), F.lit("<thead>")).otherwise(F.lit("")),
        F.lit("<tr>"), "_cells", F.lit("</tr>"),
    )
    blocks = (
        rows.select(*keys, "_block", "row_index", "_header", line.alias("_line"))
        .groupBy(*keys, "_block")
        .agg(
            F.array_sort(F.collect_list(F.struct(F.col("row_index").alias("o"), F.col("_line").alias("v")))).alias("_lines"),
            F.min(F.when(~F.col("_header"), F.col("row_index"))).alias("_body"),
            F.max((F.col("row_index") == 0) & F.col("_header")).alias("_open"),
        )
    )

    def joined(keep) -> Column:
        return F.array_join(F.transform(F.filter("_lines", keep), lambda p: p["v"]), "")

    halves = blocks.select(
        *keys, "_block", "_open", F.col("_body").isNotNull().alias("_turns"),
        joined(lambda p: F.col("_body").isNull() | (p["o"] < F.col("_body"))).alias("_above"),
        joined(lambda p: p["o"] >= F.col("_body")).alias("_below"),
    )
    tables = halves.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("_block", "_turns", "_above", "_below"))).alias("_parts"),
        F.max("_open").alias("_open"),
        F.min(F.when(F.col("_turns"), F.col("_block"))).alias("_first"),
    )
    close = F.when(F.col("_open"), F.lit("</thead>")).otherwise(F.lit(""))
    part = F.transform(
        "_parts",
        lambda p: F.concat(
            p["_above"], F.when(p["_block"] == F.col("_first"), close).otherwise(F.lit("")), p["_below"]
        ),
    )
    result = tables.select(
        *keys,
        F.concat(
            F.lit("<table>"), F.array_join(part, ""), F.when(F.col("_first").isNull(), close).otherwise(F.lit("")),
            F.lit("</table>"),
        ).alias("html"),
    )
    if row_counts is None:
        return result
    return row_counts.select(*keys).join(result, keys, "left").select(
        *keys, F.coalesce("html", F.lit("<table></table>")).alias("html")
    )
