"""Statistics out of daily states that are kept beside an archive.

A state holds what can be put together again: counts, sums, moments around the
day's mean, extremes, and a sketch of the day's prices for quantiles. Statistics
of any range of days come from the states of these days; prices are not read
again. Counts, sums and extremes are exact, the deviation up to rounding,
quantiles within ``RANK_ERROR`` of their rank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

#: size parameter of the sketches, and how far from its rank a quantile may lie (at 99 % confidence)
SKETCH, RANK_ERROR = 400, 0.01
DAY = "start_date"


def daily_states(prices: DataFrame, keys: list[str], price: str = "price", day: str = DAY) -> DataFrame:
    """One state per key and day. Aggregates with partial results; prices that are NULL do not count."""
    value = F.col(price).cast("decimal(18,4)")
    return (
        prices.filter(F.col(price).isNotNull())
        .groupBy(*keys, F.col(day).alias(DAY))
        .agg(
            F.count("*").alias("n"),
            F.sum(value).cast("decimal(38,4)").alias("total"),
            F.min(value).alias("lowest"),
            F.max(value).alias("highest"),
            F.var_pop(value.cast("double")).alias("spread"),
            F.kll_sketch_agg_double(value.cast("double"), F.lit(SKETCH)).alias("sketch"),
        )
        .withColumn("spread", F.col("spread") * F.col("n"))
    )


def _merged(sketches: Column) -> Column:
    rest = F.slice(sketches, F.lit(2), F.greatest(F.size(sketches) - 1, F.lit(0)))
    return F.reduce(rest, F.get(sketches, F.lit(0)), lambda a, b: F.kll_sketch_merge_double(a, b))


def stats_of_states(states: DataFrame, keys: list[str], quantiles: tuple[float, ...] = (0.5,)) -> DataFrame:
    """``n, min_price, max_price, avg_price, stddev_price`` and ``q_<per cent>`` of each key over all its states.

    A key has one state per day, so what is gathered for it is bounded by the
    calendar. The spread is put together around the common mean, which does not
    suffer where prices are large and close together.
    """
    whole = W.partitionBy(*keys)
    mean = (F.sum("total").over(whole) / F.sum("n").over(whole)).cast("double")
    off = F.col("total").cast("double") / F.col("n") - F.col("mean")
    rows = states.withColumn("mean", mean).withColumn("around", F.col("spread") + F.col("n") * off * off)
    merged = rows.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        F.min("lowest").alias("min_price"),
        F.max("highest").alias("max_price"),
        F.first("mean").alias("avg_price"),
        F.sum("around").alias("around"),
        F.collect_list("sketch").alias("sketches"),
    )
    deviation = F.when(F.col("n") > 1, F.sqrt(F.col("around") / (F.col("n") - 1)))
    sketched = merged.withColumn("stddev_price", deviation).withColumn("sketch", _merged(F.col("sketches")))
    named = {f"q_{round(100 * q)}": F.kll_sketch_get_quantile_double("sketch", F.lit(q)) for q in quantiles}
    return sketched.withColumns(named).drop("sketch", "sketches", "around")
