"""Files: archives, report exports, feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pricegrid.operators.grid import BLOCK, row_block

# Text is written as it is, blanks at its ends included.
CSV = {
    "header": True,
    "escape": '"',
    "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}

def by_folder(df: DataFrame, *columns: str) -> DataFrame:
    """Bring rows of a folder together before a partitioned write.

    Rebalancing keeps small folders to one file and splits a folder that holds
    much of the data over several tasks.
    """
    return df.hint("rebalance", *columns)


def write_archive(df: DataFrame, path: str, mode: str = "append") -> None:
    keys = ["dataset", "start_date"]
    by_folder(df, *keys).write.mode(mode).partitionBy(*keys).parquet(path)


def write_report_csv(df: DataFrame, path: str, *keys: str) -> None:
    """One CSV folder per dataset and report (and variant); no rows, no folder.

    Writing a report again replaces its folder and no other.
    """
    keys = keys or ("dataset", "file_id")
    (
        by_folder(df, *keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**CSV)
        .partitionBy(*keys)
        .csv(path)
    )


def write_feed(df: DataFrame, path: str, name: str, run: str, fields: list[str]) -> str:
    """One folder per feed and run, fields in the order given."""
    target = f"{path.rstrip('/')}/{name}/run={run}"
    df.select(*fields).write.mode("errorifexists").options(**CSV).csv(target)
    return target


def write_laid_out_cells(cells: DataFrame, table: str, path: str, buckets: int = 64) -> None:
    """Cells as a table in buckets of page and row block, the way grids are read.

    ``grid`` then joins a page's layout to its body without shuffling the body.
    A long page lies in as many buckets as it has blocks. The table is known to
    the session's catalogue under its name and lies in ``path``.
    """
    laid = cells.withColumn("block", row_block()).repartition(buckets, *BLOCK)
    laid.write.mode("overwrite").bucketBy(buckets, *BLOCK).sortBy(*BLOCK).option("path", path).saveAsTable(table)
