"""Hard negatives of anchors: rows of another label that score almost like a positive.

A row's score is its integer inner product with the anchor. Every vector is
stored with the mean and the deviation of its segments, in levels of ever
shorter segments. Over one segment of ``l`` components the product of two
vectors is ``l * (mean * mean')`` give or take ``l * (deviation * deviation')``
(Cauchy-Schwarz), so the sums over a level's segments bound the score. A pair
of rows goes from level to level while its bounds leave open whether it is
among those wanted; what is left at the last level is scored exactly.

Anchors and rows are laid out in blocks; a task holds one block of each and
returns only its best rows per anchor, so neither labels nor vectors that many
rows share gather in a task. Blocks split work and change no result.

Defined results. Rows with a null id, label or vector, or with a null or
non-finite component, take no part. Vectors are filled up with zeros to the
longest one. Rows that share an id are one row, that of the lowest label and
vector. Higher scores come first, equal ones by id; ids and labels are whole
numbers. Scores that no long holds are compared exactly and given as the
nearest long. A positive without fitting negatives gives no rows, as does an
empty table. Only the named columns are read, so extra columns do no harm.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from pricegrid.session import stage

#: rows of a block, anchors or others; only splits work
BLOCK = 4096
#: pairs looked at together inside a task; only bounds memory
PAIRS = 1 << 20
#: rows of a block that are scored at once, for a first idea of the best
SEED = 128
#: segments of a vector at each level
LEVELS = (1, 4, 16)

LONG = np.iinfo(np.int64)
OUT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def segment_summaries(vectors: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of the segments of each row, both times the root of a segment's length."""
    width = vectors.shape[1]
    edges = np.unique(np.arange(segments) * width // segments)
    lengths = np.diff(np.append(edges, width))
    values = vectors.astype(np.float64)
    means = np.add.reduceat(values, edges, axis=1) / lengths
    around = values - np.repeat(means, lengths, axis=1)
    spread = np.add.reduceat(around * around, edges, axis=1)
    return means * np.sqrt(lengths), np.sqrt(spread)


def summarised(rows: DataFrame, width: int) -> DataFrame:
    """``id, label, anchor, v, summary``: the vector, and means and deviations of all levels, as bytes."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = np.asarray(batch.column(3).flatten(), np.int64).reshape(batch.num_rows, width)
            parts = [x for segments in LEVELS for x in segment_summaries(vectors, segments)]
            summary = np.concatenate(parts, axis=1)
            packed = [pa.array([r.tobytes() for r in table], pa.binary()) for table in (vectors, summary)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *packed], names=["id", "label", "anchor", "v", "summary"])

    return rows.mapInArrow(summarise, "id bigint, label bigint, anchor boolean, v binary, summary binary")


@dataclass
class Block:
    """Rows of a block as arrays."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray]]
    norms: np.ndarray

    @classmethod
    def of(cls, frame: pd.DataFrame) -> Block:
        vectors = np.frombuffer(b"".join(frame.v), np.int64).reshape(len(frame), -1)
        summary = np.frombuffer(b"".join(frame.summary), np.float64).reshape(len(frame), -1)
        levels, at = [], 0
        for segments in LEVELS:
            n = min(segments, vectors.shape[1])
            levels.append((summary[:, at : at + n], summary[:, at + n : at + 2 * n]))
            at += 2 * n
        norms = np.sqrt((vectors.astype(np.float64) ** 2).sum(1))
        return cls(frame.id.to_numpy(np.int64), frame.label.to_numpy(np.int64), vectors, levels, norms)

    def take(self, at: np.ndarray) -> Block:
        return Block(self.ids[at], self.labels[at], self.vectors[at], [(m[at], d[at]) for m, d in self.levels], self.norms[at])


def exact_scores(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Inner products of all rows of two blocks; Python's integers where a long may not hold them."""
    most = [float(np.abs(x.astype(np.float64)).max(initial=0)) for x in (one, other)]
    limit = most[0] * most[1] * one.shape[1]
    if limit < 2**53:
        return (one.astype(np.float64) @ other.astype(np.float64).T).astype(np.int64)
    if limit < 2**62:
        return one @ other.T
    return one.astype(object) @ other.astype(object).T


def _scores_of(anchors: Block, rows: Block, a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Exact scores of pairs: all of a strip at once if many are asked for, else pair by pair."""
    if 16 * len(a) >= len(anchors.ids) * len(rows.ids):
        return exact_scores(anchors.vectors, rows.vectors)[a, r]
    out = [np.zeros(0, np.int64)]
    for low in range(0, len(a), 1 << 16):
        one, other = anchors.vectors[a[low : low + (1 << 16)]], rows.vectors[r[low : low + (1 << 16)]]
        limit = float(np.abs(one.astype(np.float64)).max(initial=0)) * float(np.abs(other.astype(np.float64)).max(initial=0)) * one.shape[1]
        if limit >= 2**62:
            one, other = one.astype(object), other.astype(object)
        out.append((one * other).sum(1))
    return np.concatenate(out)


def open_pairs(
    anchors: Block, rows: Block, wanted: np.ndarray, undecided: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of ``wanted`` that the bounds of no level rule out.

    ``undecided(a, low, high)`` says which pairs may still matter, given each
    one's anchor and bounds.
    """
    a, r = np.nonzero(wanted)
    for (mean_a, dev_a), (mean_r, dev_r) in zip(anchors.levels, rows.levels):
        kept_a, kept_r = [], []
        for low in range(0, len(a), 1 << 17):
            i, j = a[low : low + (1 << 17)], r[low : low + (1 << 17)]
            middle = np.einsum("ij,ij->i", mean_a[i], mean_r[j])
            spread = np.einsum("ij,ij->i", dev_a[i], dev_r[j]) + 1e-9 * anchors.norms[i] * rows.norms[j] + 1e-6
            keep = undecided(i, middle - spread, middle + spread)
            kept_a.append(i[keep])
            kept_r.append(j[keep])
        if kept_a:
            a, r = np.concatenate(kept_a), np.concatenate(kept_r)
    return a, r


def _first(k: int, owner: np.ndarray, score: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which entries are among the ``k`` best of their owner, in order; higher scores first, then smaller ids."""
    if score.dtype == object:
        order = np.array(sorted(range(len(owner)), key=lambda i: (owner[i], -score[i], ids[i])), np.int64)
    else:
        order = np.lexsort((ids, ~score, owner))
    ordered = owner[order]
    rank = np.arange(len(order)) - np.searchsorted(ordered, ordered)
    return order[rank < k]


def _kth(k: int, owners: int, owner: np.ndarray, score: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The ``k``-th best score of each owner, minus infinity where there are fewer."""
    out = np.full(owners, -np.inf)
    best = _first(k, owner, score, ids)
    last = best[np.flatnonzero(np.bincount(owner[best], minlength=owners)[owner[best]] == k)][k - 1 :: k]
    out[owner[last]] = score[last].astype(np.float64)
    return out


def _as_long(scores: np.ndarray) -> np.ndarray:
    return np.array([min(max(int(s), LONG.min), LONG.max) for s in scores], np.int64) if scores.dtype == object else scores


def _strips(anchors: Block, rows: Block) -> Iterator[np.ndarray]:
    step = max(1, PAIRS // max(len(rows.ids), 1))
    for low in range(0, len(anchors.ids), step):
        yield np.arange(low, min(low + step, len(anchors.ids)))


def best_of_block(anchors: Block, rows: Block, k: int) -> pd.DataFrame:
    """The ``k`` best other rows of the same label for each anchor, among these rows."""
    found = []
    for label in np.unique(anchors.labels):
        mine, others = anchors.take(np.flatnonzero(anchors.labels == label)), rows.take(np.flatnonzero(rows.labels == label))
        for strip in _strips(mine, others):
            few = mine.take(strip)
            other = few.ids[:, None] != others.ids[None, :]
            a, r = np.nonzero(other[:, :SEED])
            least = _kth(k, len(few.ids), a, _scores_of(few, others, a, r), others.ids[r])
            a, r = open_pairs(few, others, other, lambda i, low, high: high >= least[i])
            score = _scores_of(few, others, a, r)
            best = _first(k, a, score, others.ids[r])
            found.append((few.ids[a[best]], others.ids[r[best]], _as_long(score[best])))
    return pd.DataFrame(_columns(found, 3), columns=["anchor_id", "other_id", "score"])


def negatives_of_block(anchors: Block, targets: list[tuple[np.ndarray, np.ndarray]], rows: Block, k: int, low: int, high: int) -> pd.DataFrame:
    """For each anchor and positive the ``k`` best rows of another label within the positive's bounds.

    ``targets`` holds the ids and scores of each anchor's positives.
    """
    found = []
    for strip in _strips(anchors, rows):
        few, most = anchors.take(strip), max((len(targets[i][0]) for i in strip), default=0)
        ids = np.zeros((most, len(strip)), np.int64)
        scores = np.zeros((most, len(strip)), np.int64)
        # whole-number bounds of fitting scores; an empty interval where there is no positive
        large = any(abs(int(s)) >= 2**53 for i in strip for s in targets[i][1])
        least = np.full((most, len(strip)), 1, object if large else np.int64)
        greatest = np.full((most, len(strip)), 0, object if large else np.int64)
        for column, i in enumerate(strip):
            for n, (who, score) in enumerate(zip(*targets[i])):
                ids[n, column], scores[n, column] = who, score
                least[n, column], greatest[n, column] = -(-low * int(score) // 100), high * int(score) // 100
        apart = few.labels[:, None] != rows.labels[None, :]
        a, r = np.nonzero(apart[:, :SEED])
        score = _scores_of(few, rows, a, r)
        floor = np.array([
            np.maximum(least[n].astype(np.float64), _kth(k, len(strip), a[fits], score[fits], rows.ids[r[fits]]))
            for n in range(most)
            for fits in [(score >= least[n][a]) & (score <= greatest[n][a])]
        ]).reshape(most, len(strip))

        def undecided(i: np.ndarray, lowest: np.ndarray, highest: np.ndarray) -> np.ndarray:
            some = np.zeros(len(i), bool)
            for n in range(most):
                some |= (lowest <= greatest[n][i]) & (highest >= floor[n][i]) & (least[n][i] <= greatest[n][i])
            return some

        a, r = open_pairs(few, rows, apart, undecided)
        score = _scores_of(few, rows, a, r)
        for n in range(most):
            fits = np.flatnonzero((score >= least[n][a]) & (score <= greatest[n][a]))
            best = fits[_first(k, a[fits], score[fits], rows.ids[r[fits]])]
            at = a[best]
            found.append((few.ids[at], ids[n][at], scores[n][at], rows.ids[r[best]], _as_long(score[best])))
    return pd.DataFrame(_columns(found, 5), columns=["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])


def _columns(found: list[tuple], n: int) -> np.ndarray:
    return np.concatenate([np.stack(f, 1) for f in found]).astype(np.int64) if found else np.zeros((0, n), np.int64)


def hard_negatives(
    rows: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: float = 256,
    id_col: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``anchors`` says of a row whether it is an anchor. Components become
    ``floor(scale * x)``. An anchor's positives are the best ``positives`` other
    rows of its label; a positive's hard negatives are the best ``negatives`` rows
    of other labels that score from ``low`` to ``high`` per cent of it. See the
    module's text for everything else.
    """
    spark = rows.sparkSession
    bad = F.exists("raw", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    named = rows.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(label).cast("bigint").alias("label"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"),
        F.col(vector).cast("array<double>").alias("raw"),
    )
    whole = named.filter("id is not null and label is not null and raw is not null").filter(~bad)
    whole = whole.withColumn("v", F.transform("raw", lambda x: F.floor(x * F.lit(float(scale)))))
    single = whole.groupBy("id").agg(F.min(F.struct("label", "v", "anchor")).alias("r")).select("id", "r.*")
    usable = stage(single.select("id", "label", "anchor", "v"), "vectors")
    sizes = usable.agg(F.max(F.size("v")), F.count("*"), F.count_if("anchor")).first()
    width, n_rows, n_anchors = max(sizes[0] or 0, 1), sizes[1], sizes[2]
    if not n_anchors:
        return spark.createDataFrame([], OUT)
    filled = usable.withColumn("v", F.concat("v", F.array_repeat(F.lit(0).cast("bigint"), F.lit(width) - F.size("v"))))
    stored = stage(summarised(filled, width), "summaries")

    blocks = {"ab": -(-n_anchors // BLOCK), "rb": -(-n_rows // BLOCK)}
    own = lambda name: F.pmod(F.xxhash64("id"), F.lit(blocks[name])).cast("int").alias(name)
    each = lambda name: F.explode(F.sequence(F.lit(0), F.lit(blocks[name] - 1))).alias(name)
    columns = ["id", "label", "v", "summary"]

    def cells(asking: DataFrame) -> DataFrame:
        """All of a block of anchors and a block of rows side by side."""
        extra = [c for c in asking.columns if c not in (*columns, "anchor")]
        there = stored.select(*columns, own("rb"), F.lit(False).alias("asks"), *[F.lit(None).cast(asking.schema[c].dataType).alias(c) for c in extra])
        there = there.select("*", each("ab"))
        asked = asking.select(*columns, own("ab"), F.lit(True).alias("asks"), *extra).select("*", each("rb"))
        return there.unionByName(asked).groupBy("ab", "rb")

    def best(cell: pd.DataFrame) -> pd.DataFrame:
        if cell.asks.nunique() < 2:  # blocks without anchors, or without rows
            return pd.DataFrame(columns=["anchor_id", "other_id", "score"], dtype=np.int64)
        return best_of_block(Block.of(cell[cell.asks]), Block.of(cell[~cell.asks]), positives)

    def fitting(cell: pd.DataFrame) -> pd.DataFrame:
        if cell.asks.nunique() < 2:
            return pd.DataFrame(columns=["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"], dtype=np.int64)
        asking = cell[cell.asks]
        targets = [(np.asarray(i, np.int64), np.asarray(s, np.int64)) for i, s in zip(asking.positive_ids, asking.positive_scores)]
        return negatives_of_block(Block.of(asking), targets, Block.of(cell[~cell.asks]), negatives, low, high)

    asking = stored.filter("anchor")
    near = cells(asking).applyInPandas(best, "anchor_id bigint, other_id bigint, score bigint")
    order = W.partitionBy("anchor_id").orderBy(F.desc("score"), "other_id")
    near = near.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= positives)
    listed = near.groupBy(F.col("anchor_id").alias("id")).agg(F.array_sort(F.collect_list(F.struct("n", "other_id", "score"))).alias("p"))
    listed = stage(listed.select("id", F.col("p.other_id").alias("positive_ids"), F.col("p.score").alias("positive_scores")), "positives")

    far = cells(asking.join(listed.hint("merge"), "id")).applyInPandas(
        fitting, "anchor_id bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint"
    )
    order = W.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = far.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
