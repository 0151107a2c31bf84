"""Quality classifier: a regularised quadratic discriminant.

A text becomes a vector of transformed statistics (logs of sizes, square roots
of shares). Each class is a normal distribution; its covariance is shrunk to
the pooled one and then to a multiple of the identity. The Cholesky factors
are computed once and kept inverted, so a score is two small triangular
products: the difference of the class log-densities through a logistic.

Defined results. A null text scores like an empty one. Rows without a label,
or whose id has labels that disagree, are not learnt from. A null id is never
learnt from and not held out. With no rows of one class the score is 0.5
everywhere. Repeated rows stay repeated. Only the named columns are read, so
extra columns of any name do no harm. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pricegrid.llm import textbuf
from pricegrid.session import stage

FEATURES = [
    "log_bytes", "log_words", "word_length", "symbols", "capitals", "digits", "points", "marks", "bars",
    "lines", "same_as_last", "distinct_words", "non_ascii", "short_words",
]

_CLASSES = {
    "symbols": textbuf.byte_class(b"#*$%&<>@^~=_{}[]\\"),
    "capitals": textbuf.byte_class(bytes(range(65, 91))),
    "digits": textbuf.byte_class(b"0123456789"),
    "points": textbuf.byte_class(b".,;:"),
    "marks": textbuf.byte_class(b"!?"),
    "bars": textbuf.byte_class(b"|"),
    "lines": textbuf.byte_class(b"\n"),
    "non_ascii": textbuf.byte_class(bytes(range(0xC0, 0x100))),
}


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of ``FEATURES`` for each text of a slice."""
    found = textbuf.words(data, offsets)
    n_bytes, n_words = np.diff(offsets), np.diff(found.first)
    per_byte, per_word = np.maximum(n_bytes, 1), np.maximum(n_words, 1)
    hashed = textbuf.RangeHash(data, fold=True)(found.begin, found.end)
    owner = found.text()
    same = np.zeros(len(hashed), bool)
    for back in (1, 2, 3):
        same[back:] |= (hashed[back:] == hashed[:-back]) & (owner[back:] == owner[:-back])
    distinct = np.unique(textbuf.mix(hashed + owner.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), return_index=True)[1]
    length = found.end - found.begin
    share = {k: np.sqrt(textbuf.counts(table[data], offsets) / per_byte) for k, table in _CLASSES.items()}
    columns = {
        "log_bytes": np.log1p(n_bytes),
        "log_words": np.log1p(n_words),
        "word_length": np.log1p(np.bincount(owner, length, len(n_words)) / per_word),
        "same_as_last": np.sqrt(np.bincount(owner[same], minlength=len(n_words)) / per_word),
        # distinct words grow like a power of the words
        "distinct_words": np.log1p(np.bincount(owner[distinct], minlength=len(n_words))) - np.log1p(n_words) * 0.8,
        "short_words": np.sqrt(np.bincount(owner[length <= 3], minlength=len(n_words)) / per_word),
        **share,
    }
    return np.column_stack([columns[name] for name in FEATURES])


def features(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``id_col`` and an array of ``FEATURES`` for every row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in textbuf.slices(batch.column(1)):
                rows = statistics(data, offsets)
                values = pa.ListArray.from_arrays(np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32), rows.ravel())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), values], names=["id", "x"])

    return docs.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("__text")).mapInArrow(
        textbuf.released(extract), f"id {kind}, x array<double>"
    )


@dataclass
class Discriminant:
    """Means, inverted Cholesky factors and log terms of both classes."""

    means: list[np.ndarray]
    factors: list[np.ndarray]
    log_terms: list[float]

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not self.means:
            return np.full(len(x), 0.5)
        density = []
        for mean, factor, term in zip(self.means, self.factors, self.log_terms):
            z = (x - mean) @ factor.T
            density.append(term - 0.5 * (z * z).sum(1))
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -500, 500)))


def fit(labelled: DataFrame, to_pooled: float = 0.1, to_identity: float = 0.02) -> Discriminant:
    """Learn from ``(x, label)`` rows; all of them, by two aggregates of fixed size.

    The first gives the class means, the second the products of centred
    features, so no large squares cancel.
    """
    d = len(FEATURES)
    at = [F.col("x")[i] for i in range(d)]
    first = {r["label"]: r for r in labelled.groupBy("label").agg(F.count("*").alias("n"), F.array(*map(F.avg, at)).alias("mean")).collect()}
    if not {0, 1} <= first.keys():
        return Discriminant([], [], [])
    means = {k: np.array(first[k]["mean"]) for k in (0, 1)}
    centre = F.when(F.col("label") == 1, F.array(*map(F.lit, means[1].tolist()))).otherwise(F.array(*map(F.lit, means[0].tolist())))
    centred = labelled.filter("label in (0, 1)").select("label", F.zip_with("x", centre, lambda a, b: a - b).alias("x"))
    pairs = [(i, j) for i in range(d) for j in range(i + 1)]
    products = F.array(*(F.sum(F.col("x")[i] * F.col("x")[j]) for i, j in pairs)).alias("p")
    scatter = {}
    for row in centred.groupBy("label").agg(products).collect():
        matrix = np.zeros((d, d))
        for (i, j), value in zip(pairs, row["p"]):
            matrix[i, j] = matrix[j, i] = value
        scatter[row["label"]] = matrix
    n = {k: first[k]["n"] for k in (0, 1)}
    pooled = (scatter[0] + scatter[1]) / (n[0] + n[1])
    model = Discriminant([], [], [])
    for k in (0, 1):
        shrunk = (1 - to_pooled) * scatter[k] / n[k] + to_pooled * pooled
        shrunk = (1 - to_identity) * shrunk + to_identity * max(np.trace(shrunk) / d, 1e-9) * np.eye(d)
        lower = np.linalg.cholesky(shrunk)
        model.means.append(means[k])
        model.factors.append(np.linalg.inv(lower))
        model.log_terms.append(float(np.log(n[k] / (n[0] + n[1])) - np.log(np.diag(lower)).sum()))
    return model


def held_out(id_col: F.Column, folds: int = 5) -> F.Column:
    """Rows kept from learning: the checksum of the id as text is divisible by ``folds``."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds == 0, F.lit(False))


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    text: str = "text",
    id_col: str = "doc_id",
    threshold: float = 0.3,
) -> DataFrame:
    """``id_col, held_out, score, predicted`` of every row; see the module's text.

    Texts are read once; features go to the shared folder, where learning and
    scoring read them.
    """
    known = stage(features(docs, text, id_col), "features")
    sure = (
        labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("label"))
        .groupBy("id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .filter("label = other and id is not null")
    )
    model = fit(known.filter(~held_out(F.col("id"))).join(sure.select("id", "label"), "id").select("x", "label"))

    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.stack(x.to_numpy())) if len(x) else [], dtype="float64")

    scored = known.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), score("x").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
