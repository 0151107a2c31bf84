"""Links to reports: what is new, what arrived, what is done."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pricegrid.functions.urls import file_stem, stored_file_name


def report_links(links: DataFrame) -> DataFrame:
    """Add the stored name and the id of each linked file."""
    return links.withColumn("file_name", stored_file_name(F.col("file_url"))).withColumn(
        "file_id", file_stem(F.col("file_name"))
    )


def active_pages(pages: DataFrame, seeds: DataFrame) -> DataFrame:
    """Pages of active seeds, with the seed's dataset.

    No broadcast hint: Spark broadcasts the seeds if they turn out small.
    """
    return pages.join(seeds.filter("active").select("url", "dataset"), "url")


def not_stored(links: DataFrame, stored: DataFrame) -> DataFrame:
    """Links whose file is not in their dataset's store yet."""
    key = ["dataset", "file_name"]
    return links.join(stored.select(*key).distinct(), key, "left_anti")


def not_converted(reports: DataFrame, manifest: DataFrame) -> DataFrame:
    """Reports of which no variant has been converted for their dataset."""
    key = ["dataset", "file_id"]
    return reports.join(manifest.select(*key).distinct(), key, "left_anti")


def arrived(downloads: DataFrame) -> DataFrame:
    """Paths of the downloads that worked."""
    return downloads.filter("ok").select("item_id", "pos", "file_url", "path")


def items_with_files(items: DataFrame, downloads: DataFrame) -> DataFrame:
    """Items of which at least one file arrived."""
    return items.join(arrived(downloads).select("item_id").distinct(), "item_id", "left_semi")


def paired(links: DataFrame, downloads: DataFrame) -> DataFrame:
    """Each arrived path with the link it came from.

    Joined on the link itself, never on list positions, which shift as soon as
    one download fails.
    """
    return links.join(arrived(downloads), ["item_id", "pos", "file_url"])


def nested_items(files: DataFrame) -> DataFrame:
    """One row per item with its files as a list in page order.

    The list is as long as the links of one page, which came out of one row.
    """
    return files.groupBy("item_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", "file_url", "path"))).alias("files")
    )


def last_written(
    links: DataFrame, *key: str, order: tuple[str, ...] = ("pos", "file_url")
) -> DataFrame:
    """Keep one link per stored name: the last by ``order``.

    An aggregate rather than a window, so a name that very many links share is
    reduced before the shuffle.
    """
    key = key or ("dataset", "file_name")
    rest = [c for c in links.columns if c not in key]
    latest = F.max_by(F.struct(*rest), F.struct(*order))
    return links.groupBy(*key).agg(latest.alias("kept")).select(*key, "kept.*").select(*links.columns)
