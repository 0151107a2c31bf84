"""Prices by merchant."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pricegrid.operators.stats import levels_before, price_bands, price_levels
from pricegrid.session import stage

KEYS = ["product", "vendor"]


def merchant_breakdown(prices: DataFrame) -> DataFrame:
    """Per product and vendor: count, lowest, highest, mean and latest price.

    The latest price is the lowest one of the last day. Day and price are put
    into one number, day first, so the aggregate stays a hash aggregate with
    partial results before its only shuffle.
    """
    day = F.unix_date("price_date").cast("decimal(8,0)") * F.lit(10**14).cast("decimal(15,0)")
    return prices.groupBy(*KEYS).agg(
        F.count("*").alias("n_prices"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.avg("price").alias("avg_price"),
        F.max_by("price", day - F.col("price")).alias("latest_price"),
    )


def offers(prices: DataFrame) -> DataFrame:
    """Best price of each vendor for each product."""
    return prices.groupBy(*KEYS).agg(F.min("price").alias("price"))


def merchant_rank(prices: DataFrame) -> DataFrame:
    """Vendors of a product ranked by price, with the gap to the best one.

    Ranks come from the counts of lower price levels, which hold numbers only, so
    a product with very many vendors is not one sort, and offers meet their
    level by product and price. ``is_cheapest`` marks a single vendor, the first by name among equals.
    """
    best = stage(offers(prices), "offers")
    levels = price_levels(best, ["product"])
    ranked = levels_before(levels, price_bands(levels, ["product"]), ["product"])
    first = best.groupBy("product").agg(F.min(F.struct("price", "vendor")).alias("first"))
    placed = best.join(ranked.select("product", "price", "before", "lowest"), ["product", "price"]).join(first, "product")
    return placed.select(
        *KEYS,
        "price",
        (F.col("before") + 1).alias("price_rank"),
        (F.col("price") - F.col("lowest")).alias("gap"),
        (F.col("vendor") == F.col("first.vendor")).alias("is_cheapest"),
    )


def cheapest_merchant(prices: DataFrame) -> DataFrame:
    """The cheapest vendor of each product, by name among equals.

    Two steps of ``min`` with partial results; nothing is sorted by product.
    """
    return (
        offers(prices)
        .groupBy("product")
        .agg(F.min(F.struct("price", "vendor")).alias("best"), F.count("*").alias("n_vendors"))
        .select("product", "best.vendor", "best.price", "n_vendors")
    )


def merchant_matrix(prices: DataFrame, vendors: list[str]) -> DataFrame:
    """One row per product, one column of lowest prices per named vendor."""
    return prices.groupBy("product").pivot("vendor", vendors).agg(F.min("price"))
