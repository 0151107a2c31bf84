"""Bags of rows compared: what got lost, what came twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def row_counts(left: DataFrame, right: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Each different row with ``n_left`` and ``n_right``, how often it is on either side.

    Columns go by name; NULLs are equal to each other. One shuffle over both sides
    together, with counts taken before it, so rows that are there very often
    cost no more than others.
    """
    names = columns or left.columns
    side = lambda df, a, b: df.select(*(f"`{c}`" for c in names), F.lit(a).alias("n_left"), F.lit(b).alias("n_right"))
    both = side(left, 1, 0).union(side(right, 0, 1))
    return both.groupBy(*(f"`{c}`" for c in names)).agg(F.sum("n_left").alias("n_left"), F.sum("n_right").alias("n_right"))


def differences(left: DataFrame, right: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows that are not there equally often, with ``n_lost`` and ``n_extra`` on the right."""
    return (
        row_counts(left, right, columns)
        .filter("n_left <> n_right")
        .withColumn("n_lost", F.greatest(F.col("n_left") - F.col("n_right"), F.lit(0)))
        .withColumn("n_extra", F.greatest(F.col("n_right") - F.col("n_left"), F.lit(0)))
    )


def _times(rows: DataFrame, n: Column, names: list[str]) -> DataFrame:
    return rows.withColumn("times", F.explode(F.sequence(F.lit(1), n))).select(*(f"`{c}`" for c in names))


def bag_except(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of the left without those of the right, each as often as it is there more."""
    more = F.col("n_left") - F.col("n_right")
    return _times(row_counts(left, right).filter(more > 0), more, left.columns)


def bag_intersect(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of both, each as often as it is on either side at least."""
    both = F.least("n_left", "n_right")
    return _times(row_counts(left, right).filter(both > 0), both, left.columns)


def reconciled(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """Per group how many rows there are, are the same, got lost and came in addition."""
    sums = {"n_left": "n_left", "n_right": "n_right", "n_same": "least(n_left, n_right)"}
    sums |= {"n_lost": "greatest(n_left - n_right, 0)", "n_extra": "greatest(n_right - n_left, 0)"}
    return row_counts(left, right).groupBy(*by).agg(*[F.sum(F.expr(text)).alias(name) for name, text in sums.items()])
