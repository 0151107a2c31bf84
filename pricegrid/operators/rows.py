"""Bag unions and repeated rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

# Types whose values fit a hash aggregate's buffer.
PLAIN = (
    T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
    T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType,
)


def union_all(*frames: DataFrame) -> DataFrame:
    """All rows of all frames; columns a frame lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def drop_repeats(feed: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row per key, the first by ``order``.

    An aggregate with partial results, so a key that very many rows share is
    reduced in every task before the shuffle. With one number to order by and
    nothing but numbers and dates to keep it needs no sort: the values of a row
    then change hands together, at the same comparison.
    """
    rest = [c for c in feed.columns if c not in key]
    if len(order) == 1 and all(isinstance(feed.schema[c].dataType, PLAIN) for c in [*rest, *order]):
        kept = feed.groupBy(*key).agg(*[F.min_by(c, order[0]).alias(c) for c in rest])
        return kept.select(*feed.columns)
    first = F.min_by(F.struct(*rest), F.struct(*order))
    return feed.groupBy(*key).agg(first.alias("kept")).select(*key, "kept.*").select(*feed.columns)
