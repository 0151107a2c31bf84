"""Relational database over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

POSTGRES_DRIVER = "org.postgresql.Driver"


def postgres_url(host: str, port: int, database: str) -> str:
    return f"jdbc:postgresql://{host}:{port}/{database}"


def write_table(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str],
    connections: int = 16,
    batch_size: int = 10_000,
    mode: str = "append",
) -> None:
    """Load rows with a bounded number of connections.

    ``mode="overwrite"`` empties the table and keeps its definition.
    """
    (
        df.write.mode(mode)
        .option("numPartitions", connections)
        .option("batchsize", batch_size)
        .option("truncate", "true")
        .jdbc(url, table, properties=properties)
    )


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    split_on: tuple[str, str, str] | None = None,
    connections: int = 16,
) -> DataFrame:
    """Read a table; ``split_on`` is a date or number column with its bounds."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **properties)
    if split_on:
        column, low, high = split_on
        reader = reader.options(
            partitionColumn=column, lowerBound=low, upperBound=high, numPartitions=connections
        )
    return reader.load()
