"""The whole way from pages and grids to observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pricegrid.operators.grid import basket_prices
from pricegrid.operators.html import LINKS, parsed_links
from pricegrid.operators.medicines import medicine_prices
from pricegrid.operators.reports import active_pages, not_converted, not_stored, report_links


def new_reports(pages: DataFrame, seeds: DataFrame, stored: DataFrame) -> DataFrame:
    """Reports that active index pages link to and the store lacks."""
    index = active_pages(pages, seeds)
    links = parsed_links(index.filter(F.col("html").contains("filetitle")), LINKS)
    named = report_links(links).join(
        seeds.filter("active").select(F.col("url").alias("page_url"), "dataset"), "page_url"
    )
    return not_stored(named, stored)


def survey(cells: DataFrame, reports: DataFrame, manifest: DataFrame) -> DataFrame:
    """Observations of all basket-like reports that are not converted yet.

    A report that a dataset links to more than once is converted once; one that
    two datasets link to, once for each.
    """
    todo = not_converted(reports, manifest).select("file_url", "dataset").distinct()
    return basket_prices(cells, todo)


def medicine_survey(cells: DataFrame, reports: DataFrame, manifest: DataFrame) -> DataFrame:
    todo = not_converted(reports, manifest).select("file_url", "dataset").distinct()
    return medicine_prices(cells, todo)


def as_prices(observations: DataFrame, product: Column | str = "description") -> DataFrame:
    """Observations as ``(product, vendor, price, price_date)``; what has no price that the type holds is left out."""
    product = F.col(product) if isinstance(product, str) else product
    return observations.filter("price is not null").select(
        product.alias("product"), "vendor", "price", F.col("start_date").alias("price_date")
    )
