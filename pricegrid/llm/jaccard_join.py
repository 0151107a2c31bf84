"""Jaccard join of documents on word n-grams, by set relations; exact.

**Index.** Shingles have one order for all documents: rare before frequent,
told by a table of counters of fixed size. Linked documents share a shingle
among the first of both, so only those are indexed. An index list is laid out
in blocks by set size, a quarter of the allowed difference each. Where a
document's first shared shingle stands at a position, what is left behind it
bounds how large a partner may be; so a document is an entry of its own block
of a list and asks the blocks above it only up to that bound. The others are
skipped without a look.

**Answers from answers.** No block is expanded into pairs. Its members are
compared with its centre, the smallest id, on full sets. Members linked with
the centre need nothing else: the answer of the one is that of the other. For
two members of a centre of which one is not linked, what each shares with the
centre bounds what they share with each other from both sides, which settles
most pairs; for the rest only the difference to the centre is counted anew
(bits over the centre's set, and the shingles outside it). Groups are cut into
blocks that are compared inside tasks, from which only links of a spanning
forest come. Documents with equal sets are one from the start.

**Sketches of sets** go ahead of both steps: two to four bits for each shingle.
Every bit in which two of them differ is a shingle that the sets do not share,
so what they rule out is certain, and texts are only read for what they leave.

Defined results. A null or empty text has no shingles and is linked with
nothing. Fewer words than a shingle takes are one shingle. Rows that share an
id are one document, linked by any of its texts; a null id is linked with
nothing and has no component. Ids are whole numbers. Shingles are compared by
64-bit hashes. Only the named columns are read, so extra columns of any name do
no harm. An empty table gives an empty result.
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
from pricegrid.llm.near_duplicates import shingle_sets
from pricegrid.session import stage

#: counters of shingles, and those of one row while they are added up; their number is all that reaches the driver
COUNTERS, PART = 1 << 18, 1 << 12
#: blocks of sizes for each factor of the least similarity
STEPS = 4
#: members of a group in a block of comparisons; only splits work
BLOCK = 1024
#: bits that keep documents out of a shuffle, 8 MB at most; other documents of the same bit come along
KNOWN_BITS = 1 << 26


@dataclass(frozen=True)
class Overlap:
    """Shingles of ``words`` words; documents with a Jaccard index of ``percent`` or more are linked."""

    words: int = 3
    percent: int = 90

    def apart(self, one, other):
        """Most shingles that only one of two linked sets has."""
        return one + other - 2 * self.needed(one, other)

    def needed(self, one, other):
        """Shared shingles that it takes."""
        return -(-self.percent * (one + other) // (100 + self.percent))

    def prefix(self, size):
        """How many of a set's first shingles hold one shared with any linked set."""
        return size + self.percent * size // -100 + 1

    def largest(self, size, position):
        """Size of the largest set that can be linked if the first shared shingle stands at a position."""
        return (size - position) * (100 + self.percent) // self.percent - size

    def block(self, size):
        """Number of a size's block in a list."""
        step = math.log(100 / self.percent) / STEPS if self.percent < 100 else math.log(2)
        return np.floor(np.log(np.maximum(size, 1)) / step).astype(np.int32)


def _digest(shingles: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def sketch(shingles: np.ndarray) -> bytes:
    """A bit for each shingle's hash, two to four times as many bits as shingles."""
    bits = max(64, 1 << (2 * len(shingles) - 1).bit_length()) if len(shingles) else 64
    flags = np.zeros(bits, bool)
    flags[(textbuf.mix(shingles) & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(flags, bitorder="little").tobytes()


def _folded(bits: np.ndarray, width: int) -> np.ndarray:
    """Rows of bits over fewer bits: the upper half is laid over the lower one."""
    while bits.shape[1] > width:
        half = bits.shape[1] // 2
        bits = bits[:, :half] | bits[:, half:]
    return bits


def fewest_apart(one: bytes, others: np.ndarray) -> np.ndarray:
    """At least so many shingles does each of the others, of one width, not share with the one."""
    mine = np.frombuffer(one, np.uint64)[None, :]
    width = min(mine.shape[1], others.shape[1])
    return np.bitwise_count(_folded(mine, width) ^ _folded(others, width)).sum(1, dtype=np.int64)


def _counter(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - COUNTERS.bit_length() + 1)).astype(np.int64)


def _read(docs: DataFrame, text: str, id_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text).cast("string").alias("__text"))


def described(docs: DataFrame, like: Overlap) -> DataFrame:
    """``id, n_shingles, digest, sketch`` of each document, and for each task rows of ``part, counts``."""
    names = ["id", "n_shingles", "digest", "sketch", "part", "counts"]

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for low, high, data, offsets in textbuf.slices(batch.column(1)):
                shingles, bounds = shingle_sets(data, offsets, like.words)
                counts += np.bincount(_counter(shingles), minlength=COUNTERS)
                sets = [shingles[a:b] for a, b in zip(bounds, bounds[1:])]
                own = [pa.array([of(x) for x in sets], pa.binary()) for of in (_digest, sketch)]
                none = pa.nulls(high - low)
                columns = [batch.column(0).slice(low, high - low), pa.array(np.diff(bounds)), *own]
                yield pa.RecordBatch.from_arrays([*columns, none.cast(pa.int32()), none.cast(pa.binary())], names=names)
        parts = [(i, counts[i * PART : (i + 1) * PART]) for i in range(COUNTERS // PART)]
        parts = [(i, c.tobytes()) for i, c in parts if c.any()]
        if parts:
            none = pa.nulls(len(parts))
            columns = [none.cast(k) for k in (pa.int64(), pa.int64(), pa.binary(), pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array([i for i, _ in parts], pa.int32()), pa.array([c for _, c in parts], pa.binary())], names=names
            )

    return docs.mapInArrow(textbuf.released(describe), "id bigint, n_shingles bigint, digest binary, sketch binary, part int, counts binary")


def frequencies(counted: DataFrame) -> np.ndarray:
    """The counters, added up in tasks and again by part; a table of fixed size."""

    def total(counts) -> bytes:
        return sum((np.frombuffer(c, np.int64) for c in counts), np.zeros(PART, np.int64)).tobytes()

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, bytes] = {}
        for batch in batches:
            for part, counts in zip(batch.part, batch.counts):
                sums[part] = total([sums[part], counts]) if part in sums else counts
        yield pd.DataFrame({"part": list(sums), "counts": list(sums.values())})

    def finish(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": group.part[:1], "counts": [total(group.counts)]})

    kind = "part int, counts binary"
    sums = counted.select("part", "counts").mapInPandas(add, kind).groupBy("part").applyInPandas(finish, kind)
    out = np.zeros(COUNTERS, np.int64)
    for part, counts in sums.toLocalIterator():  # COUNTERS / PART rows
        out[part * PART : (part + 1) * PART] = np.frombuffer(counts, np.int64)
    return out


def index_entries(docs: DataFrame, frequent: np.ndarray, like: Overlap) -> DataFrame:
    """``id, digest, entries`` with the first shingles of each document; an entry is ``shingle, home, upto``:
    the block that it lies in, and the last one that it asks."""
    table = docs.sparkSession.sparkContext.broadcast(np.minimum(frequent, np.iinfo(np.uint32).max).astype(np.uint32))
    entry = pa.struct([("shingle", pa.int64()), ("home", pa.int32()), ("upto", pa.int32())])

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in textbuf.slices(batch.column(1)):
                shingles, bounds = shingle_sets(data, offsets, like.words)
                often = table.value[_counter(shingles)]
                first, homes, uptos = [], [], []
                for a, b in zip(bounds, bounds[1:]):
                    n = like.prefix(int(b - a)) if b > a else 0
                    # rare ones first, then by hash: the shingles of a set are sorted by hash
                    own = np.argsort(often[a:b], kind="stable")[:n]
                    first.append(shingles[a:b][own])
                    homes.append(np.full(n, like.block(b - a), np.int32))
                    uptos.append(like.block(like.largest(b - a, np.arange(n))))
                ends = np.zeros(len(first) + 1, np.int32)
                np.cumsum([len(x) for x in first], out=ends[1:])
                flat = [np.concatenate(x) for x in (first, homes, uptos)]
                entries = pa.StructArray.from_arrays([pa.array(flat[0].view(np.int64)), pa.array(flat[1]), pa.array(flat[2])], fields=list(entry))
                digests = [_digest(shingles[a:b]) for a, b in zip(bounds, bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), pa.array(digests, pa.binary()), pa.ListArray.from_arrays(pa.array(ends), entries)],
                    names=["id", "digest", "entries"],
                )

    return docs.mapInArrow(textbuf.released(select), "id bigint, digest binary, entries array<struct<shingle bigint, home int, upto int>>")


def centre_pairs(entries: DataFrame) -> DataFrame:
    """``x, c``: each member of a block of an index list with the block's smallest id.

    A member is an entry of the block, or a smaller set that asks it. A block
    that is asked but has no entry has no members.
    """
    rows = stage(entries.select("id", F.inline("entries")), "entries")
    # put down, so that both sides of the joins are shuffled and Spark can split a list that very many documents are in
    lists = rows.groupBy("shingle").agg(F.count("*").alias("n")).filter("n > 1").select("shingle")
    rows = stage(rows.join(stage(lists, "lists").hint("merge"), "shingle"), "shared")
    # a position can also bound partners below the own size: then the entry asks no block above, but is asked
    asked = F.sequence("home", F.greatest("home", "upto"))
    members = rows.select("id", "home", "shingle", F.explode(asked).alias("block"))
    members = members.select("id", F.xxhash64("shingle", "block").alias("key"), (F.col("block") == F.col("home")).alias("own"))
    blocks = members.groupBy("key").agg(F.min("id").alias("c"), F.max("id").alias("other"), F.bool_or("own").alias("filled"))
    blocks = stage(blocks.filter("filled and c <> other").select("key", "c"), "blocks")
    return members.join(blocks.hint("merge"), "key").filter("id <> c").select(F.col("id").alias("x"), "c").distinct()


def compare_with_centres(pairs: DataFrame, texts: DataFrame, like: Overlap) -> DataFrame:
    """``c, x, size, whole, common, linked`` and the set of ``x`` as ``bits`` over the centre's set and ``rest``.

    ``whole`` is the size of the centre's set. The joins leave a centre's rows
    side by side, so its set is made once for a run of them.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, centre = None, np.zeros(0, np.uint64)
        for batch in batches:
            centres = batch.column(3)
            for low, high, data, offsets in textbuf.slices(batch.column(2)):
                shingles, bounds = shingle_sets(data, offsets, like.words)
                rows = []
                for i in range(high - low):
                    text = centres[low + i].as_py() or ""
                    if text != known:
                        _, _, own, ends = next(textbuf.slices(pa.array([text])))
                        known, centre = text, shingle_sets(own, ends, like.words)[0]
                    mine = shingles[bounds[i] : bounds[i + 1]]
                    at = np.searchsorted(centre, mine)
                    inside = at < len(centre)
                    inside[inside] = centre[at[inside]] == mine[inside]
                    flags = np.zeros(-(-len(centre) // 64) * 64, bool)
                    flags[at[inside]] = True
                    common = int(inside.sum())
                    linked = bool(len(mine)) and common >= like.needed(len(mine), len(centre))
                    rows.append((len(mine), len(centre), common, linked, np.packbits(flags).tobytes(), mine[~inside].view(np.int64)))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.list_(pa.int64())]
                columns = [batch.column(j).slice(low, high - low) for j in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    columns + [pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)],
                    names=["c", "x", "size", "whole", "common", "linked", "bits", "rest"],
                )

    mine = pairs.join(texts.select(F.col("id").alias("x"), F.col("__text").alias("own")), "x")
    joined = mine.join(texts.select(F.col("id").alias("c"), F.col("__text").alias("centre")), "c")
    return joined.select("c", "x", "own", "centre").mapInArrow(
        textbuf.released(compare),
        "c bigint, x bigint, size bigint, whole bigint, common bigint, linked boolean, bits binary, rest array<bigint>",
    )


def _links_of_cell(cell: pd.DataFrame, like: Overlap) -> pd.DataFrame:
    """A spanning forest of the links between the asking and the other members in a cell."""
    asking, there = cell[cell.asks], cell[~cell.asks]
    ids, size, common = (there[c].to_numpy(np.int64) for c in ("x", "size", "common"))
    joined = b"".join(there.bits)
    bits = np.frombuffer(joined, np.uint64).reshape(len(there), -1) if joined else np.zeros((len(there), 0), np.uint64)
    rests = [np.asarray(r, np.int64) for r in there.rest]
    owner = np.repeat(np.arange(len(rests)), [len(r) for r in rests])
    outside = np.concatenate([np.zeros(0, np.int64), *rests])
    order = np.argsort(outside, kind="stable")
    outside, owner = outside[order], owner[order]
    nodes = np.unique(np.concatenate([ids, asking.x.to_numpy(np.int64)]))
    label, at = np.arange(len(nodes)), np.searchsorted(nodes, ids)
    links = []
    for x, n, shared, whole, own, rest in zip(asking.x, asking["size"], asking.common, asking.whole, asking.bits, asking.rest):
        need = like.needed(n, size)
        # bounds from what both share with the centre
        most = np.minimum(common, shared) + np.minimum(size - common, n - shared)
        least = np.maximum(common + shared - whole, 0)
        sure = least >= need
        open_ = np.flatnonzero((most >= need) & ~sure)
        if len(open_):
            both = np.bitwise_count(bits[open_] & np.frombuffer(own, np.uint64)).sum(1, dtype=np.int64)
            rest = np.asarray(rest, np.int64)
            low, high = np.searchsorted(outside, rest, "left"), np.searchsorted(outside, rest, "right")
            hits = [owner[a:b] for a, b in zip(low, high) if b > a]
            if hits:
                both += np.bincount(np.concatenate(hits), minlength=len(ids))[open_]
            sure[open_] = both >= need[open_]
        met = np.append(at[sure], np.searchsorted(nodes, x))
        groups = np.unique(label[met])
        if len(groups) > 1:
            for group in groups:
                if group != label[met[-1]]:
                    links.append((int(x), int(nodes[met[np.argmax(label[met] == group)]])))
            label[np.isin(label, groups)] = groups[0]
    return pd.DataFrame(links, columns=["u", "v"])


def _in_cells(rows: DataFrame) -> DataFrame:
    """Members of a centre, and those that ask about links with them, in cells ``c, q, d`` of blocks of either.

    Expects ``c, x, linked`` among the columns. A group in which nobody is alone and unlinked has no cells.
    """
    groups = rows.groupBy("c").agg(F.count("*").alias("n"), F.count_if(~F.col("linked")).alias("u")).filter("n > 1 and u > 0")
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    groups = stage(groups.select("c", blocks("n").alias("nd"), blocks("u").alias("nq")), "groups")
    joined = rows.join(groups.hint("merge"), "c")
    own = lambda n: F.pmod(F.xxhash64("x"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    there = joined.withColumn("q", each("nq")).withColumn("d", own("nd")).withColumn("asks", F.lit(False))
    asking = joined.filter(~F.col("linked")).withColumn("d", each("nd")).withColumn("q", own("nq")).withColumn("asks", F.lit(True))
    # the join has left a group in one place: deal out its cells
    return there.unionByName(asking).select("q", "d", "asks", *rows.columns).repartition("c", "q", "d")


def links_beside_centres(compared: DataFrame, like: Overlap) -> DataFrame:
    """Links between members of a centre of which at least one is not linked with it."""
    cells = _in_cells(compared).groupBy("c", "q", "d")
    return cells.applyInPandas(lambda cell: _links_of_cell(cell, like), "u bigint, v bigint")


def _rows_by_width(sketches: pd.Series) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Which sketches have one width, and their bits."""
    width = sketches.map(len).to_numpy(np.int64)
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        yield at, np.frombuffer(b"".join(sketches.iloc[at]), np.uint64).reshape(len(at), -1)


def perhaps_linked(members: DataFrame, like: Overlap) -> DataFrame:
    """``c, x`` of members for whom sketches do not rule out a link with another member, at least one of both unlinked.

    Expects ``c, x, size, sketch, linked``.
    """

    def look(cell: pd.DataFrame) -> pd.DataFrame:
        asking, there = cell[cell.asks], cell[~cell.asks]
        ids, size = there.x.to_numpy(np.int64), there["size"].to_numpy(np.int64)
        live = set()
        for at, bits in _rows_by_width(there.sketch):
            for x, n, own in zip(asking.x, asking["size"], asking.sketch):
                met = ids[at[(fewest_apart(own, bits) <= like.apart(n, size[at])) & (ids[at] != x)]]
                if len(met):
                    live.add(int(x))
                    live.update(met.tolist())
        return pd.DataFrame({"c": cell.c.iloc[0], "x": sorted(live)}, dtype=np.int64)

    return _in_cells(members).groupBy("c", "q", "d").applyInPandas(look, "c bigint, x bigint").distinct()


def members_of_centres(pairs: DataFrame, sets: DataFrame, like: Overlap) -> DataFrame:
    """``c, x, size, sketch, maybe`` of each pair; not ``maybe``, if the sketches rule out a link. ``sets`` has ``id, size, sketch``."""

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            limit = like.apart(batch["size"], batch.whole)
            bits = [np.frombuffer(b, np.uint64)[None, :] for b in batch.centre]
            apart = [int(fewest_apart(a, b)[0]) for a, b in zip(batch.sketch, bits)]
            yield batch[["c", "x", "size", "sketch"]].assign(maybe=np.array(apart, np.int64) <= limit)

    mine = pairs.join(sets.withColumnRenamed("id", "x").hint("merge"), "x")
    centre = sets.select(F.col("id").alias("c"), F.col("size").alias("whole"), F.col("sketch").alias("centre"))
    return mine.join(centre.hint("merge"), "c").mapInPandas(look, "c bigint, x bigint, size bigint, sketch binary, maybe boolean")


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Documents with these ids. A bitmap of bounded size keeps most of the others out of the shuffle."""
    place = F.pmod(F.xxhash64("id"), F.lit(KNOWN_BITS)) + 1
    bitmap = ids.select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("bit"))
    bitmap = bitmap.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))
    placed = docs.withColumns({"bucket": F.bitmap_bucket_number(place), "bit": F.bitmap_bit_position(place)})
    byte = F.conv(F.hex(F.expr("substring(bits, int(1 + bit div 8), 1)")), 16, 10).cast("int")
    known = F.expr("int(bit % 8)")
    likely = placed.join(F.broadcast(bitmap), "bucket").filter(F.getbit(byte, known) == 1).select(*docs.columns)
    return likely.join(ids.distinct().hint("merge"), "id", "left_semi")


def _ids(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("x").alias("id")).union(pairs.select("c"))


def compared_pairs(pairs: DataFrame, docs: DataFrame, like: Overlap) -> DataFrame:
    texts = stage(texts_of(docs, _ids(pairs)), "texts")
    return stage(compare_with_centres(pairs, texts, like), "compared")


def jaccard_components(docs: DataFrame, like: Overlap = Overlap(), text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``id_col, n_shingles, component_id`` of every row; see the module's text."""
    docs = _read(docs, text, id_col)
    rows = stage(described(docs, like), "described")
    sets = rows.filter("part is null").select("id", "n_shingles", "digest")
    usable = sets.filter("digest is not null and id is not null")
    equal = stage(usable.groupBy("digest").agg(F.min("id").alias("id")), "equal")
    entries = index_entries(docs, frequencies(rows.filter("part is not null")), like)
    # the ids grow with the corpus: never broadcast, the plan is the same at every size
    alone = entries.join(equal.hint("merge"), ["id", "digest"], "left_semi")
    pairs = stage(centre_pairs(alone), "pairs")

    sketches = rows.filter("digest is not null").select("id", F.col("n_shingles").alias("size"), "sketch")
    sketches = sketches.join(_ids(pairs).distinct().hint("merge"), "id", "left_semi").distinct()
    members = stage(members_of_centres(pairs, stage(sketches, "sketches"), like), "members")
    with_centres = compared_pairs(members.filter("maybe").select("c", "x").distinct(), docs, like)
    linked = stage(with_centres.filter("linked").select("c", "x").distinct(), "linked")
    known = members.join(linked.withColumn("linked", F.lit(True)).hint("merge"), ["c", "x"], "left").drop("maybe")
    open_ = stage(perhaps_linked(known.withColumn("linked", F.coalesce("linked", F.lit(False))), like), "open")
    beside = links_beside_centres(compared_pairs(open_, docs, like), like)

    copies = usable.join(equal.withColumnRenamed("id", "rep").hint("merge"), "digest").select(F.col("id").alias("u"), F.col("rep").alias("v"))
    edges = copies.union(linked.select("x", "c")).union(beside)
    found = sets.join(connected_components(edges).withColumnRenamed("node", "id"), "id", "left")
    return found.select(F.col("id").alias(id_col), "n_shingles", F.coalesce("root", "id").alias("component_id"))
