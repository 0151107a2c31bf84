"""Prices over time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from pricegrid.session import stage

KEYS = ["product", "vendor"]


def daily_prices(prices: DataFrame) -> DataFrame:
    """Lowest price per product, vendor and day.

    Partial results before the shuffle. From here on a product and vendor has
    at most one row per calendar day, which bounds every window below.
    """
    return prices.groupBy(*KEYS, "price_date").agg(F.min("price").alias("price"))


def price_history(prices: DataFrame) -> DataFrame:
    """Price steps: a row for each change, valid until the next one."""
    by_day = W.partitionBy(*KEYS).orderBy("price_date")
    return (
        daily_prices(prices)
        .withColumn("before", F.lag("price").over(by_day))
        .filter("before is null or before <> price")
        .select(
            *KEYS,
            "price",
            F.col("price_date").alias("valid_from"),
            F.lead("price_date").over(by_day).alias("valid_to"),
        )
    )


def price_on_days(history: DataFrame, days: DataFrame) -> DataFrame:
    """The price of every product and vendor on each of some days.

    ``days`` has one column, ``day``. Each step is laid out over the months it
    covers and meets the days of that month. ``days`` is evaluated once, to
    distinct days; Spark picks the join by what they turn out to be.
    """
    days = stage(days.select(F.col("day").cast("date").alias("day")).distinct(), "days")
    first, last = days.agg(F.min("day"), F.max("day")).first()
    if first is None:
        return history.select(*KEYS, F.lit(None).cast("date").alias("day"), "price").limit(0)
    by_month = days.withColumn("month", F.trunc("day", "month"))
    begin = F.greatest("valid_from", F.lit(first))
    end = F.least(F.coalesce(F.date_sub("valid_to", 1), F.lit(last)), F.lit(last))
    months = F.sequence(
        F.trunc(begin, "month"), F.trunc(end, "month"), F.make_interval(months=F.lit(1))
    )
    return (
        history.filter(begin <= end)
        .withColumn("month", F.explode(months))
        .join(by_month, "month")
        .filter("day >= valid_from and (valid_to is null or day < valid_to)")
        .select(*KEYS, "day", "price")
    )


def price_asof(probes: DataFrame, prices: DataFrame) -> DataFrame:
    """Add to each ``(product, vendor, day)`` probe the last price up to its day.

    Probes are reduced to distinct days, so a window holds at most two rows per
    calendar day however many probes ask for the same product and vendor. They
    are read twice, so they are put down once.
    """
    probes = stage(probes, "probes")
    asked = probes.select(*KEYS, "day").distinct().withColumn("price", F.lit(None).cast("decimal(18,4)"))
    known = daily_prices(prices).select(
        *KEYS, F.col("price_date").alias("day"), F.col("price").cast("decimal(18,4)")
    )
    both = asked.withColumn("asked", F.lit(1)).unionByName(known.withColumn("asked", F.lit(0)))
    so_far = W.partitionBy(*KEYS).orderBy("day", "asked").rowsBetween(W.unboundedPreceding, 0)
    answers = (
        both.withColumn("price", F.last("price", ignorenulls=True).over(so_far))
        .filter("asked = 1")
        .select(*KEYS, "day", "price")
    )
    return probes.join(answers, [*KEYS, "day"], "left")
