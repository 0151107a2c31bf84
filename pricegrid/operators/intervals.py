"""Overlaps of intervals: which periods meet which, without comparing all with all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: buckets of 1, 4, 16 ... days; the last ones are longer than any calendar
LEVELS, GROWTH = 13, 4
#: stands for a start or an end that is open, in days from 1970
FIRST_DAY, LAST_DAY = -(2**24), 2**24


def _laid_out(rows: DataFrame, start: str, end: str, side: str) -> DataFrame:
    """Each interval at the level of buckets that is at least as long, and as a guest at all above: two buckets or one at each."""
    begin = F.coalesce(F.unix_date(start), F.lit(FIRST_DAY))
    stop = F.coalesce(F.unix_date(end), F.lit(LAST_DAY))
    widths = [GROWTH**level for level in range(LEVELS)]
    own = F.lit(LEVELS - 1)
    for level in reversed(range(LEVELS - 1)):
        own = F.when(F.col(f"{side}_to") - F.col(f"{side}_from") < widths[level], F.lit(level)).otherwise(own)
    timed = rows.select(F.struct(*(f"`{c}`" for c in rows.columns)).alias(side), begin.alias(f"{side}_from"), stop.alias(f"{side}_to"))
    leveled = timed.filter(F.col(f"{side}_to") >= F.col(f"{side}_from")).withColumn(f"{side}_level", own)
    laid = leveled.withColumn("level", F.explode(F.sequence(F.col(f"{side}_level"), F.lit(LEVELS - 1))))
    width = F.element_at(F.array(*map(F.lit, widths)), F.col("level") + 1)
    low, high = (F.floor(F.col(f"{side}_{x}") / width) for x in ("from", "to"))
    return laid.withColumn("bucket", F.explode(F.sequence(low, high)))


def overlaps(left: DataFrame, right: DataFrame, on: list[str], left_days: tuple[str, str], right_days: tuple[str, str]) -> DataFrame:
    """``left, right``: every pair of rows of the same key whose intervals share a day.

    Both ends belong to an interval; an end that is NULL is open, and an interval
    that ends before it starts meets nothing. NULL keys meet nothing.

    An interval lies in at most two buckets of its own level, and as a guest in
    at most two of each level above. Two of them meet at the level of the longer
    one, by an equality join on key, level and bucket; a pair is given in the
    first bucket that both share and no other. So neither long nor open
    intervals are multiplied, and hot keys come apart by time.
    """
    a, b = _laid_out(left, *left_days, "left"), _laid_out(right, *right_days, "right")
    for key in on:
        a, b = a.withColumn(f"key_{key}", F.col(f"left.{key}")), b.withColumn(f"key_{key}", F.col(f"right.{key}"))
    met = a.join(b, [*(f"key_{key}" for key in on), "level", "bucket"])
    first = F.floor(F.greatest("left_from", "right_from") / F.element_at(F.array(*[F.lit(GROWTH**n) for n in range(LEVELS)]), F.col("level") + 1))
    return met.filter(
        (F.col("left_from") <= F.col("right_to"))
        & (F.col("right_from") <= F.col("left_to"))
        & (F.col("level") == F.greatest("left_level", "right_level"))
        & (F.col("bucket") == first)
    ).select("left", "right")


def overlap_days(left_days: tuple[Column, Column], right_days: tuple[Column, Column]) -> Column:
    """How many days two intervals share; NULL if that is open."""
    start = F.greatest(left_days[0], right_days[0])
    return F.date_diff(F.least(left_days[1], right_days[1]), start) + 1
