"""An inverted index of product names, stored by word."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pricegrid.functions.text import tokens

#: folders that words are dealt to
BUCKETS = 64
POSTINGS = "token string, id bigint, name string, bucket int"


def _bucket(token, buckets: int):
    return F.pmod(F.xxhash64(token), F.lit(buckets)).cast("int")


def write_index(products: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """A row ``token, id, name`` for each different word of a product, in folders by the word's hash and sorted in files.

    A folder that holds a very frequent word is split over several files.
    """
    postings = products.select(F.explode(tokens(F.col("name"))).alias("token"), F.col("id").cast("bigint").alias("id"), "name")
    dealt = postings.withColumn("bucket", _bucket("token", buckets)).hint("rebalance", "bucket")
    dealt.sortWithinPartitions("bucket", "token", "id").write.mode("overwrite").partitionBy("bucket").parquet(path)


def search_index(spark: SparkSession, path: str, query: str, k: int = 20, match_all: bool = False, buckets: int = BUCKETS) -> DataFrame:
    """What ``product_search`` gives, from the folders of the query's words alone.

    Within a folder the sorted files let the reader skip other words. Products
    are counted with partial results; ids and names must belong together.
    """
    wanted = [row[0] for row in spark.range(1).select(F.explode(tokens(F.lit(query)))).collect()]
    places = [row[0] for row in spark.createDataFrame([(w,) for w in wanted], "w string").select(_bucket("w", buckets)).collect()]
    found = spark.read.schema(POSTINGS).parquet(path).filter(F.col("bucket").isin(places) & F.col("token").isin(wanted))
    scored = found.groupBy("id", "name").agg(F.count_distinct("token").cast("int").alias("score"))
    scored = scored.filter(F.col("score") >= (len(wanted) if match_all else 1))
    return scored.select("id", "name", "score").orderBy(F.desc("score"), "name", "id").limit(k)
