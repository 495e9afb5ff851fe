"""Tables in databases. Secrets and drivers are the caller's."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def non_blank_query(table: str, column: str, top: int | None = None) -> str:
    """A subquery that the database runs, so that blank rows never leave it.

    ``LEN`` ignores trailing blanks; ``top`` is for previews only.
    """
    head = f"TOP {int(top)} " if top is not None else ""
    return f"(SELECT {head}* FROM {table} WHERE LEN([{column}]) > 0) AS source_rows"


def read_options(
    url: str, dbtable: str, partition_column: str | None = None, bounds: tuple | None = None,
    partitions: int = 1, fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of a read; with a partition column the table is read by many tasks at once."""
    options = {"url": url, "dbtable": dbtable, "fetchsize": str(fetch_size)}
    if partition_column is not None:
        if bounds is None:
            raise ValueError("a partitioned read needs the bounds of its column")
        options |= {
            "partitionColumn": partition_column, "lowerBound": str(bounds[0]), "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_table(spark: SparkSession, options: dict[str, str], secrets: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options, **secrets).load()


def overwrite_table(
    df: DataFrame, url: str, dbtable: str, secrets: dict[str, str], batch_size: int = 10_000, writers: int = 32
) -> None:
    """Replace a table through at most ``writers`` connections; keeps its definition. Errors are raised."""
    (
        df.write.format("jdbc").mode("overwrite")
        .options(url=url, dbtable=dbtable, truncate="true", batchsize=str(batch_size), numPartitions=str(writers), **secrets)
        .save()
    )
