"""Product search, categories and spellings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pricegrid.functions.text import fingerprint, tokens


def product_search(products: DataFrame, query: str, k: int = 20, match_all: bool = False) -> DataFrame:
    """The ``k`` products that share most words with a query.

    Expects ``id`` and ``name``. Each task keeps its best ``k``; no shuffle.
    """
    wanted = tokens(F.lit(query))
    score = F.size(F.array_intersect(wanted, tokens(F.col("name"))))
    enough = F.size(wanted) if match_all else F.lit(1)
    return (
        products.withColumn("score", score)
        .filter(F.col("score") >= enough)
        .orderBy(F.desc("score"), "name", "id")
        .limit(k)
    )


def category(name: Column, rules: list[tuple[int, str, str]], default: str = "other") -> Column:
    """Category of the lowest-numbered rule ``(number, pattern, category)`` that matches.

    The rules become one expression, so no join takes place.
    """
    chosen = None
    for _, pattern, label in sorted(rules):
        hit = name.rlike(f"(?iu){pattern}")
        chosen = F.when(hit, label) if chosen is None else chosen.when(hit, label)
    return F.lit(default) if chosen is None else chosen.otherwise(default)


def categorise(products: DataFrame, rules: list[tuple[int, str, str]]) -> DataFrame:
    return products.withColumn("category", category(F.col("name"), rules))


def name_clusters(names: DataFrame, name: str = "name") -> DataFrame:
    """Spellings of the same name, with the most frequent one as canonical.

    Rows are counted per spelling before anything is grouped by fingerprint;
    equal counts go to the first spelling in order. A name without a letter or
    digit has an empty fingerprint and is a cluster of its own.
    """
    spellings = (
        names.groupBy(F.col(name).alias("name"))
        .agg(F.count("*").alias("n"))
        .withColumn("fingerprint", fingerprint(F.col("name")))
        .withColumn("cluster", F.when(F.col("fingerprint") == "", F.concat(F.lit("\x00"), "name")).otherwise(F.col("fingerprint")))
    )
    canonical = spellings.groupBy("cluster").agg(
        F.min_by("name", F.struct(-F.col("n"), F.col("name"))).alias("canonical"),
        F.sum("n").alias("cluster_n"),
    )
    return spellings.join(canonical, "cluster").select(
        "name", "fingerprint", "canonical", "n", "cluster_n"
    )
