"""Daily feeds as a stream: pick up, clean, archive, load."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from pricegrid.sinks.files import write_archive


def archive_has_files(spark: SparkSession, path: str) -> bool:
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.exists(root) and bool(files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/dataset=*")))


def new_rows(batch: DataFrame, path: str) -> DataFrame:
    """Rows of a batch whose id the archive does not have, once each.

    The archive is only read for the days that the batch has rows of, at most
    one per calendar day however large the batch.
    """
    batch = batch.dropDuplicates(["id"])
    spark = batch.sparkSession
    if not archive_has_files(spark, path):
        return batch
    days = [row[0] for row in batch.select("start_date").distinct().collect()]
    known = spark.read.schema(batch.schema).parquet(path)
    wanted = F.col("start_date").isin([day for day in days if day is not None])
    known = known.filter(wanted | F.col("start_date").isNull() if None in days else wanted)
    return batch.join(known.select("id"), "id", "left_anti")


def load_increment(
    feed: DataFrame,
    archive: str,
    checkpoint: str,
    clean: Callable[[DataFrame], DataFrame],
    also: Callable[[DataFrame, str], None] | None = None,
):
    """Load what has come in since the last run, then stop.

    ``clean`` turns raw feed rows into rows with ``id, dataset, start_date``;
    it runs once a batch. The id decides what is new: a batch that is run again
    after a failure, or a file that is delivered twice, adds nothing.

    ``also`` gets the same new rows for a second sink, before the archive has
    them, and a name for the batch. If the archive cannot be written, the batch
    comes again: with the same rows under the same name. So ``also`` must
    replace what it holds under that name, as ``replace_batch`` does, or upsert
    by ``id``. Returns the finished query.
    """
    spark = feed.sparkSession

    def load(batch: DataFrame, batch_id: int) -> None:
        rows = clean(batch).persist()
        fresh = new_rows(rows, archive).persist()
        try:
            if also is not None:
                also(fresh, f"{_query_id(spark, checkpoint)}-{batch_id}")
            write_archive(fresh, archive)
        finally:
            fresh.unpersist()
            rows.unpersist()

    query = (
        feed.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a query keeps with its state: another state, other names."""
    return spark.read.json(f"{checkpoint}/metadata").first()["id"]


def replace_batch(rows: DataFrame, path: str, name: str) -> None:
    """Write a batch to a folder of its own, in place of an earlier try."""
    rows.write.mode("overwrite").parquet(f"{path}/batch={name}")
