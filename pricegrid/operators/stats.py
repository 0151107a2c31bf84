"""Exact order statistics that do not need a whole group in one task.

Rows are first counted per distinct price. Prices are then grouped into bands
of a hundred currency units, at most a million distinct prices each, and what
lies below a band is found on the few rows per band. So neither a very frequent
product nor the total over everything is ever sorted as one group of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from pricegrid.session import stage

BAND_WIDTH = 100
#: tasks that levels are dealt to before they are added up to the coarser grains
PARTS = 256


def price_levels(prices: DataFrame, keys: list[str]) -> DataFrame:
    """``n`` rows per key and distinct price, with the price's band.

    Rows without a price are left out here, so that every later step reads the
    same aggregate and Spark can share its shuffle between them.
    """
    return (
        prices.withColumn("band", F.expr(f"cast(floor(price) as bigint) div {BAND_WIDTH}"))
        .filter("band is not null")
        .groupBy(*keys, "band", "price")
        .agg(F.count("*").alias("n"))
    )


def price_bands(levels: DataFrame, keys: list[str]) -> DataFrame:
    """Per key and band: rows below the band, rows in it, and the key's totals."""
    bands = levels.groupBy(*keys, "band").agg(
        F.sum("n").alias("band_n"), F.min("price").alias("band_low")
    )
    group = W.partitionBy(*keys)
    below = group.orderBy("band").rowsBetween(W.unboundedPreceding, -1)
    return bands.select(
        *keys,
        "band",
        "band_n",
        F.coalesce(F.sum("band_n").over(below), F.lit(0)).alias("band_before"),
        F.sum("band_n").over(group).alias("total"),
        F.min("band_low").over(group).alias("lowest"),
    )


def levels_before(levels: DataFrame, bands: DataFrame, keys: list[str]) -> DataFrame:
    """Add to each level the number of rows of its key with a lower price."""
    within = W.partitionBy(*keys, "band").orderBy("price")
    lower = F.coalesce(
        F.sum("n").over(within.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
    )
    return (
        levels.join(bands, [*keys, "band"])
        .withColumn("before", F.col("band_before") + lower)
        .drop("band", "band_before", "band_n")
    )


def _holds(position: Column, start: str, count: str) -> Column:
    return (F.col(start) <= position) & (position < F.col(start) + F.col(count))


def medians(levels: DataFrame, keys: list[str]) -> DataFrame:
    """Exact median per key: mean of the one or two middle rows.

    Only the bands that hold a middle row go on to the second step.
    """
    low, high = F.floor((F.col("total") - 1) / 2), F.floor(F.col("total") / 2)
    bands = price_bands(levels, keys).filter(
        _holds(low, "band_before", "band_n") | _holds(high, "band_before", "band_n")
    )
    lower = F.max(F.when(_holds(low, "before", "n"), F.col("price")))
    upper = F.max(F.when(_holds(high, "before", "n"), F.col("price")))
    return (
        levels_before(levels, bands, keys)
        .groupBy(*keys)
        .agg(((lower + upper) / 2).alias("median_price"))
    )


def modes(levels: DataFrame, keys: list[str]) -> DataFrame:
    """Most frequent price per key, the lowest of those if several are.

    Count and price are put into one number, count first, so that the aggregate
    needs no sort.
    """
    order = F.col("n").cast("decimal(18,0)") * F.lit(10**14).cast("decimal(15,0)")
    return levels.groupBy(*keys).agg(F.max_by("price", order - F.col("price")).alias("mode_price"))


def _by_grain(df: DataFrame, product: str, dataset: str, more: list[str], *measures: Column) -> DataFrame:
    """Aggregate by product, by dataset and over all, as ``grain`` and ``key``."""
    sets = [[product, *more], [dataset, *more], more]
    return df.groupingSets(
        [[F.col(c) for c in columns] for columns in sets], product, dataset, *more
    ).agg(
        F.when(F.grouping(product) == 0, "product")
        .when(F.grouping(dataset) == 0, "dataset")
        .otherwise("all")
        .alias("grain"),
        F.coalesce(F.col(product), F.col(dataset), F.lit("*")).alias("key"),
        *measures,
    ).drop(product, dataset)


def spreads(levels: DataFrame, keys: list[str]) -> DataFrame:
    """Sample standard deviation per key, NULL for a single row.

    Squares are taken of the distance to the key's lowest price, never of the
    price itself, so prices that are large and close together lose nothing.
    Within a band the sums are exact decimals, which its width bounds.
    """
    inside = (F.col("price") - F.col("band") * BAND_WIDTH).cast("decimal(9,4)")
    n = F.col("n").cast("decimal(15,0)")
    bands = (
        levels.withColumn("x", inside)
        .groupBy(*keys, "band")
        .agg(
            F.sum("n").alias("band_n"),
            F.min("price").alias("low"),
            F.min("x").alias("d"),
            F.sum(F.col("x") * n).cast("decimal(25,4)").alias("s"),
            F.sum(F.col("x") * F.col("x") * n).alias("q"),
        )
    )
    d, s, count = F.col("d"), F.col("s"), F.col("band_n").cast("decimal(15,0)")
    lowest = F.min("low").over(W.partitionBy(*keys))
    away = (F.col("low") - lowest).cast("double")
    # distances to the band's lowest price, then to the key's
    own = bands.select(
        *keys,
        "band_n",
        away.alias("away"),
        (s - d * count).cast("double").alias("sums"),
        (F.col("q") - 2 * d * s + d * d * count).cast("double").alias("squares"),
    )
    moved = own.select(
        *keys,
        "band_n",
        (F.col("sums") + F.col("away") * F.col("band_n")).alias("sums"),
        (F.col("squares") + 2 * F.col("away") * F.col("sums") + F.col("away") * F.col("away") * F.col("band_n")).alias("squares"),
    )
    rows, total = F.sum("band_n"), F.sum("sums")
    variance = (F.sum("squares") - total * total / rows) / F.nullif(rows - 1, F.lit(0))
    return moved.groupBy(*keys).agg(F.sqrt(variance).alias("stddev_price"))


def price_stats(prices: DataFrame, product: str = "product", dataset: str = "dataset") -> DataFrame:
    """The summary columns of a survey, recomputed from its long rows.

    One row per product, per dataset, and one for everything; rows without a
    price do not count. The prices are read once: rows are counted per price
    level, levels are added up to the coarser grains and put down, and every
    statistic comes from there.
    """
    keys = ["grain", "key"]
    finest = price_levels(prices.filter("price is not null"), [product, dataset])
    # a level counts three times: in the task that counted it, the sums would need three times its memory again
    finest = finest.repartition(PARTS, product, dataset, "band", "price")
    levels = stage(_by_grain(finest, product, dataset, ["band", "price"], F.sum("n").alias("n")), "levels")
    moments = levels.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        (F.sum(F.col("price") * F.col("n")).cast("double") / F.sum("n")).alias("avg_price"),
    )
    return (
        moments.join(spreads(levels, keys), keys)
        .join(modes(levels, keys), keys)
        .join(medians(levels, keys), keys)
    )
