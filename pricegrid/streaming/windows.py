"""Daily prices from a stream, in event time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

KEYS = ["day", "dataset", "vendor"]


def daily_prices(feed: DataFrame, ts: str = "ts") -> DataFrame:
    """Count, lowest, highest and total price of each day, dataset and vendor; batch or stream alike."""
    price = F.col("price").cast("decimal(18,4)")
    return (
        feed.groupBy(F.window(ts, "1 day").alias("window"), "dataset", "vendor")
        .agg(
            F.count("*").alias("n"),
            F.min(price).alias("min_price"),
            F.max(price).alias("max_price"),
            F.sum(price).cast("decimal(28,4)").alias("total"),
        )
        .select(F.col("window.start").cast("date").alias("day"), "dataset", "vendor", "n", "min_price", "max_price", "total")
    )


def stream_daily_prices(feed: DataFrame, delay: str, out: str, checkpoint: str, ts: str = "ts"):
    """Append each day once it can change no more: when a row ``delay`` past its end has come.

    Until then a day's sums are state, afterwards they are dropped. A row that
    comes in a batch after its day has been written is late and not counted; ``late_rows`` tells how many
    there were. Rows without a time belong to no day. Returns the finished query.
    """
    query = (
        daily_prices(feed.withWatermark(ts, delay), ts)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def open_days(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``day, dataset, vendor, n`` of the days that are state still, as of the last batch."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select(
        F.col("key.window.start").cast("date").alias("day"), F.col("key.dataset").alias("dataset"),
        F.col("key.vendor").alias("vendor"), F.col("value.count").alias("n"),
    )


def late_rows(arrived: DataFrame, written: DataFrame, still_open: DataFrame, ts: str = "ts") -> DataFrame:
    """How many rows of each day came too late: those that arrived, less those written or still open.

    ``arrived`` is the feed as a batch. Days without late rows are left out.
    """
    counted = arrived.filter(F.col(ts).isNotNull()).groupBy(F.col(ts).cast("date").alias("day"), "dataset", "vendor").agg(F.count("*").alias("n"))
    known = written.select(*KEYS, "n").unionByName(still_open.select(*KEYS, "n"))
    both = counted.unionByName(known.withColumn("n", -F.col("n")))
    return both.groupBy(*KEYS).agg(F.sum("n").alias("n_late")).filter("n_late <> 0")
