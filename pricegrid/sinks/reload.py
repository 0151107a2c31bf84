"""Replace the rows of a date range."""

from __future__ import annotations

import datetime
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F

from pricegrid.session import stage
from pricegrid.sinks.files import by_folder

# Fixed value: the folder of rows whose key is missing or empty.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def replaced(
    old: DataFrame, new: DataFrame, first: datetime.date, last: datetime.date, column: str = "start_date"
) -> DataFrame:
    """``old`` with the range taken from ``new``. Rows without a date stay."""
    inside = F.col(column).between(F.lit(first), F.lit(last))
    return old.filter(~F.coalesce(inside, F.lit(False))).unionByName(new.filter(inside))


def replace_range(
    spark: SparkSession,
    path: str,
    new: DataFrame,
    first: datetime.date,
    last: datetime.date,
    column: str = "start_date",
) -> None:
    """Replace a range in an archive with one folder per day, in place.

    Only folders of the range are touched. A reader may see both loads while it
    runs; ``snapshots.reload_range`` does the same for all readers at once. Days that the new load
    has no rows for are removed, so the range afterwards is exactly the new
    load. Doing it twice, or again after a failure, gives the same result.
    ``new`` is evaluated once: what is written and what decides which folders
    stay are the same rows.
    """
    rows = stage(new.filter(F.col(column).between(F.lit(first), F.lit(last))), "reload")
    keys = [field for field in ("dataset", column) if field in new.columns]
    by_folder(rows, *keys).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(*keys).parquet(path)
    # at most one folder per dataset and day of the range
    names = [F.coalesce(F.nullif(F.col(key).cast("string"), F.lit("")), F.lit(NO_VALUE)) for key in keys]
    kept = {tuple(row) for row in rows.select(*names).distinct().collect()}
    for folder, values in _folders(spark, path, keys, first, last):
        if values not in kept:
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _folders(spark: SparkSession, path: str, keys: list[str], first: datetime.date, last: datetime.date):
    """Folders of the range that exist; each dataset's folder is listed once."""
    new_path = spark._jvm.org.apache.hadoop.fs.Path
    files = new_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    parents = f"{path}/{keys[0]}=*" if len(keys) > 1 else path
    for status in files.globStatus(new_path(f"{parents}/{keys[-1]}=*")) or []:
        folder = status.getPath()
        day = folder.getName().partition("=")[2]
        if first.isoformat() <= day <= last.isoformat():
            above = (unquote(folder.getParent().getName().partition("=")[2]),) if len(keys) > 1 else ()
            yield folder, (*above, day)
