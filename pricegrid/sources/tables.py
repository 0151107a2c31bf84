"""Grid cells, feeds and archives."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from pricegrid import schemas

# An unquoted empty field is NULL, a quoted one is empty text. For that the
# reader's null text must be something that no file holds.
CSV = {"header": True, "multiLine": True, "escape": '"', "encoding": "UTF-8", "nullValue": "\x1f"}

def read_cells(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.CELLS).parquet(path)


def read_feed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV feed with a header, text quoted as written by ``write_feed``."""
    return spark.read.schema(schema).options(**CSV).csv(path)


def stream_feed(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """The same feed as a stream that picks up files as they come."""
    reader = spark.readStream.schema(schema).options(**CSV)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(path)


def read_archive(
    spark: SparkSession,
    path: str,
    first: datetime.date | None = None,
    last: datetime.date | None = None,
) -> DataFrame:
    """Archived rows; a date range reads the folders of those days only."""
    rows = spark.read.parquet(path)
    if first:
        rows = rows.filter(F.col("start_date") >= F.lit(first))
    if last:
        rows = rows.filter(F.col("start_date") <= F.lit(last))
    return rows
