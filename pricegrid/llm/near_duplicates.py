"""Near-duplicate documents: MinHash with tensored banding, then exact verification.

Two small collections of sub-keys, each from a few minhashes, are combined in
pairs: table ``(i, j)`` is keyed by sub-key ``i`` of the first and ``j`` of the
second collection. So ``s * s`` tables cost ``2 * s`` sub-keys, about a square
root of the minhashes. Two documents meet in some table as soon as they agree
on one sub-key of each collection. ``s`` follows from the similarity and the
share of links that may be missed at just that similarity.

No bucket is expanded into pairs. Its members are compared with its centre,
the smallest id, on full shingle sets. What a member shares with the centre is
kept as bits over the centre's shingles, the rest as a list; both together are
the full set. Members that miss the centre are then compared with every other
member of the centre, block by block and inside tasks; only links of a
spanning forest leave a task. Documents with equal sets are one document from
the start.

Defined results. A null or empty text has no shingles and is linked with
nothing. Fewer words than a shingle takes are one shingle. Rows that share an
id are one document; a null id is linked with nothing, has no component and is
kept. Only the named columns are read, so extra columns of any name do no
harm. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pricegrid.llm import textbuf
from pricegrid.llm.components import connected_components
from pricegrid.session import stage

#: rows of one block of a large group; only splits work
BLOCK = 1024


@dataclass(frozen=True)
class Similarity:
    """Shingles of ``words`` words; documents with a Jaccard index of ``percent`` or more are linked."""

    words: int = 5
    percent: int = 80
    hashes: int = 2
    missed: float = 1e-4

    @property
    def subkeys(self) -> int:
        """Sub-keys of a collection: either one misses with at most half the allowed chance."""
        agree = (self.percent / 100) ** self.hashes
        return max(1, math.ceil(math.log(self.missed / 2) / math.log(1 - agree))) if agree < 1 else 1

    def linked(self, both, one, other):
        return 100 * both >= self.percent * (one + other - both)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts of a slice, and where each text's begin."""
    found = textbuf.words(data, offsets)
    hashed = textbuf.RangeHash(data, fold=True)(found.begin, found.end)
    shingles, start = textbuf.windows(hashed, found, size)
    # the windows of a text are a run among all windows
    first = np.searchsorted(start, found.first)
    count = np.diff(found.first)
    out = []
    for i in range(len(offsets) - 1):
        if count[i] >= size:
            out.append(np.unique(shingles[first[i] : first[i + 1]]))
        elif count[i]:
            whole = hashlib.blake2b(hashed[found.first[i] : found.first[i + 1]].tobytes(), digest_size=8)
            out.append(np.frombuffer(whole.digest(), np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    bounds = np.zeros(len(out) + 1, np.int64)
    np.cumsum([len(x) for x in out], out=bounds[1:])
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), bounds


def _subkeys(shingles: np.ndarray, bounds: np.ndarray, like: Similarity) -> np.ndarray:
    """A row of ``2 * subkeys`` keys for each text; all texts have shingles."""
    parameters = np.random.default_rng(9).integers(1, 1 << 63, (2 * like.subkeys, like.hashes, 2), dtype=np.uint64)
    keys = np.empty((len(bounds) - 1, 2 * like.subkeys), np.uint64)
    for k, rows in enumerate(parameters):
        key = np.full(len(keys), k + 1, np.uint64)
        for factor, shift in rows:
            lowest = np.minimum.reduceat(shingles * (factor | np.uint64(1)) + shift, bounds[:-1])
            key = textbuf.mix(key * np.uint64(0x9E3779B97F4A7C15) + lowest)
        keys[:, k] = key
    return keys


def signatures(docs: DataFrame, like: Similarity, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``id, n_shingles, digest, keys``; the digest is that of the whole set."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in textbuf.slices(batch.column(1)):
                shingles, bounds = shingle_sets(data, offsets, like.words)
                size = np.diff(bounds)
                filled = np.flatnonzero(size)
                keys: list = [None] * len(size)
                if len(filled):
                    own = _subkeys(shingles, np.append(bounds[filled], len(shingles)), like).view(np.int64)
                    for i, row in zip(filled, own):
                        keys[i] = row
                digests = [hashlib.blake2b(shingles[a:b].tobytes(), digest_size=16).digest() if b > a else None for a, b in zip(bounds, bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), pa.array(size), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                    names=["id", "n_shingles", "digest", "keys"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("__text")).mapInArrow(
        textbuf.released(sign), f"id {kind}, n_shingles bigint, digest binary, keys array<bigint>"
    )


def candidate_pairs(signed: DataFrame, like: Similarity) -> DataFrame:
    """``x, c``: each document of a bucket with the bucket's smallest id. Expects ``id, keys``."""
    split = F.posexplode("keys").alias("pos", "key")
    rows = signed.select("id", split)
    # put down, so that both sides of the joins are shuffled and Spark can split a key that very many documents have
    shared = stage(rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key"), "shared")
    # sub-keys that nobody shares need no tables
    live = rows.join(shared.hint("merge"), "key").groupBy("id").agg(F.collect_set(F.struct("pos", "key")).alias("keys"))
    live = stage(live, "subkeys")
    of = lambda low: F.transform(F.filter("keys", lambda k: (k["pos"] < like.subkeys) == F.lit(low)), lambda k: k["key"])
    tables = live.select("id", F.explode(of(True)).alias("a"), of(False).alias("bs")).select("id", "a", F.explode("bs").alias("b"))
    tables = tables.select("id", F.xxhash64("a", "b").alias("table"))
    buckets = tables.groupBy("table").agg(F.min("id").alias("c"), F.max("id").alias("other")).filter("c <> other").select("table", "c")
    buckets = stage(buckets, "buckets")
    return tables.join(buckets.hint("merge"), "table").filter("id <> c").select(F.col("id").alias("x"), "c").distinct()


def compare_with_centres(pairs: DataFrame, texts: DataFrame, like: Similarity) -> DataFrame:
    """``c, x, size, linked`` and the full set of ``x`` as ``bits`` over the centre's set and ``rest``.

    ``texts`` has ``id, text``. The join leaves a centre's rows side by side,
    so its set is made once for a run of them.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, centre = None, np.zeros(0, np.uint64)
        for batch in batches:
            own_texts = batch.column(3)
            for low, high, data, offsets in textbuf.slices(batch.column(2)):
                shingles, bounds = shingle_sets(data, offsets, like.words)
                sizes, links, bits, rests = [], [], [], []
                for i in range(high - low):
                    text = own_texts[low + i].as_py() or ""
                    if text != known:
                        _, _, own, ends = next(textbuf.slices(pa.array([text])))
                        known, centre = text, shingle_sets(own, ends, like.words)[0]
                    mine = shingles[bounds[i] : bounds[i + 1]]
                    at = np.searchsorted(centre, mine)
                    inside = at < len(centre)
                    inside[inside] = centre[at[inside]] == mine[inside]
                    flags = np.zeros(-(-len(centre) // 64) * 64, bool)
                    flags[at[inside]] = True
                    sizes.append(len(mine))
                    links.append(bool(like.linked(int(inside.sum()), len(mine), len(centre))))
                    bits.append(np.packbits(flags).tobytes())
                    rests.append(mine[~inside].view(np.int64))
                columns = [batch.column(0).slice(low, high - low), batch.column(1).slice(low, high - low)]
                columns += [pa.array(sizes, pa.int64()), pa.array(links), pa.array(bits, pa.binary()), pa.array(rests, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["c", "x", "size", "linked", "bits", "rest"])

    kind = pairs.schema["x"].dataType.simpleString()
    mine = pairs.join(texts.select(F.col("id").alias("x"), F.col("text").alias("own")), "x")
    joined = mine.join(texts.select(F.col("id").alias("c"), F.col("text").alias("centre")), "c")
    return joined.select("c", "x", "own", "centre").mapInArrow(
        textbuf.released(compare), f"c {kind}, x {kind}, size bigint, linked boolean, bits binary, rest array<bigint>"
    )


def links_beside_centres(compared: DataFrame, like: Similarity) -> DataFrame:
    """Links between members of a centre of which one at least is not linked with it.

    Groups are cut into blocks; a task compares the unlinked members of one
    block with all members of another and returns a spanning forest of the links.
    """
    groups = compared.groupBy("c").agg(F.count("*").alias("n"), F.sum((~F.col("linked")).cast("int")).alias("u")).filter("n > 1 and u > 0")
    groups = stage(groups, "groups")
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    rows = compared.join(groups.select("c", blocks("n").alias("nd"), blocks("u").alias("nq")).hint("merge"), "c")
    own = lambda n: F.pmod(F.xxhash64("x"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    data = rows.withColumn("q", each("nq")).withColumn("d", own("nd")).withColumn("asks", F.lit(False))
    asking = rows.filter(~F.col("linked")).withColumn("d", each("nd")).withColumn("q", own("nq")).withColumn("asks", F.lit(True))
    cells = data.unionByName(asking).select("c", "q", "d", "asks", "x", "size", "bits", "rest")

    def compare(cell: pd.DataFrame) -> pd.DataFrame:
        ask, data = cell[cell.asks], cell[~cell.asks]
        x, size, bits, owner, rest = data.x.to_numpy(), data["size"].to_numpy(), _bit_rows(data.bits), _owners(data.rest), _flat(data.rest)
        links = []
        parent = {}

        def root(i):
            while parent.setdefault(i, i) != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        order = np.argsort(rest, kind="stable")
        rest, owner = rest[order], owner[order]
        for me, n, own, other in zip(ask.x.to_numpy(), ask["size"].to_numpy(), _bit_rows(ask.bits), ask.rest):
            both = np.bitwise_count(bits & own).sum(1, dtype=np.int64) if bits.shape[1] else np.zeros(len(x), np.int64)
            other = np.asarray(other, np.int64)
            low, high = np.searchsorted(rest, other, "left"), np.searchsorted(rest, other, "right")
            hits = [owner[a:b] for a, b in zip(low, high) if b > a]
            if hits:
                both += np.bincount(np.concatenate(hits), minlength=len(x))
            for partner in x[like.linked(both, n, size) & (x != me)].tolist():
                a, b = root(int(me)), root(partner)
                if a != b:
                    parent[a] = b
                    links.append((int(me), partner))
        return pd.DataFrame(links, columns=["u", "v"])

    # the join has left a group in one place: deal out its cells
    return cells.repartition("c", "q", "d").groupBy("c", "q", "d").applyInPandas(compare, "u bigint, v bigint")


def _bit_rows(bits: pd.Series) -> np.ndarray:
    joined = b"".join(bits)
    return np.frombuffer(joined, np.uint64).reshape(len(bits), -1) if joined else np.zeros((len(bits), 0), np.uint64)


def _flat(rest: pd.Series) -> np.ndarray:
    return np.concatenate([np.asarray(r, np.int64) for r in rest]) if len(rest) else np.zeros(0, np.int64)


def _owners(rest: pd.Series) -> np.ndarray:
    return np.repeat(np.arange(len(rest)), [len(r) for r in rest])


def near_duplicates(
    docs: DataFrame,
    like: Similarity = Similarity(),
    text: str = "text",
    id_col: str = "doc_id",
) -> DataFrame:
    """``id_col, n_shingles, component_id, kept`` of every row; see the module's text. Ids are whole numbers."""
    signed = stage(signatures(docs, like, text, id_col).withColumn("id", F.col("id").cast("bigint")), "signatures")
    usable = signed.filter("digest is not null and id is not null")
    equal = stage(usable.groupBy("digest").agg(F.min("id").alias("rep")), "equal")
    own_keys = F.when(F.col("id") == F.col("rep"), F.col("keys")).alias("keys")
    members = stage(usable.join(equal.hint("merge"), "digest").select("id", "rep", own_keys).distinct(), "members")
    pairs = stage(candidate_pairs(members.filter("keys is not null").select("id", "keys"), like), "pairs")
    needed = pairs.select(F.col("x").alias("id")).union(pairs.select("c")).distinct()
    own = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text).cast("string").alias("text"))
    # the ids grow with the corpus: never broadcast, the plan is the same at every size
    texts = stage(own.join(needed.hint("merge"), "id", "left_semi"), "texts")
    compared = stage(compare_with_centres(pairs, texts, like), "compared")
    edges = (
        members.select(F.col("id").alias("u"), F.col("rep").alias("v"))
        .union(compared.filter("linked").select("x", "c"))
        .union(links_beside_centres(compared, like))
    )
    roots = connected_components(edges)
    found = signed.select("id", "n_shingles").join(roots.withColumnRenamed("node", "id"), "id", "left")
    return found.select(
        F.col("id").alias(id_col),
        "n_shingles",
        F.coalesce("root", "id").alias("component_id"),
        F.coalesce(F.coalesce("root", "id") == F.col("id"), F.lit(True)).alias("kept"),
    )
