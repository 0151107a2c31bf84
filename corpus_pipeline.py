"""A training corpus from raw documents: quality, near copies, leaks, secrets, packing.

``STAGES`` are ``(name, function)``; a function takes ``(spark, docs, sf_dir)``
and returns what its successor reads. All but the last return the columns of
``docs``. Decisions are joined to documents by a digest of the whole row, so
null and repeated ids are treated row by row; equal rows share a fate. Lists of
decisions grow with the corpus, so their joins are merges and never broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pricegrid.llm.decontamination import leaks
from pricegrid.llm.near_duplicates import Similarity, near_duplicates
from pricegrid.llm.packing import pack_documents
from pricegrid.llm.quality_rules import quality_rules
from pricegrid.llm.queries import TOKENIZER, VOCABULARIES, table
from pricegrid.llm.secret_scan import mask_secrets
from pricegrid.session import stage

def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a digest of the whole row, and the name of its column, which none of ``docs`` has."""
    taken, key = {c.lower() for c in docs.columns}, "__row_digest"
    while key in taken:
        key += "_"
    return docs.withColumn(key, F.sha2(F.to_json(F.struct(*(f"`{c}`" for c in docs.columns))).cast("binary"), 256)), key


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    keyed, key = _keyed(docs)
    kept = quality_rules(keyed, VOCABULARIES, key=(key,)).filter("kept").select(key).distinct()
    return keyed.join(kept.hint("merge"), key, "left_semi").drop(key)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, of the smallest id; null ids come last.

    Groups are of rows, whatever their ids: different texts under one id, or without
    one, are different documents. Of equal rows one stays.
    """
    keyed, key = _keyed(docs)
    # near copies are numbered by whole numbers: 64 bits of the digest
    number = F.conv(F.substring(key, 1, 16), 16, -10).cast("bigint").alias("__row")
    rows = keyed.select(number, F.col(key).alias("__key"), F.col("doc_id").alias("__id"), F.col("text").alias("__text"))
    found = near_duplicates(rows, Similarity(words=5, percent=80), text="__text", id_col="__row").select("__row", "component_id").distinct()
    first = F.min(F.struct(F.col("__id").isNull(), "__id", "__key"))["__key"].alias(key)
    kept = rows.drop("__text").distinct().join(found.hint("merge"), "__row").groupBy("component_id").agg(first).select(key)
    return keyed.dropDuplicates([key]).join(kept.hint("merge"), key, "left_semi").select(*(f"`{c}`" for c in docs.columns))


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item."""
    keyed, key = _keyed(docs)
    leaked = leaks(keyed, table(spark, sf_dir, "benchmark"), id_col=key).select(key).distinct()
    return keyed.join(leaked.hint("merge"), key, "left_anti").drop(key)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked; ``n_chars``, where there is one, follows the text."""
    masked = mask_secrets(docs)
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences."""
    return pack_documents(docs, TOKENIZER)


STAGES = [
    ("quality_rules", good_quality),
    ("near_duplicates", without_near_copies),
    ("decontamination", without_leaks),
    ("secret_scan", without_secrets),
    ("packing", packed),
]

#: trained models, hashed links and token ids: no stage can be said in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
