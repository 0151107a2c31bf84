"""Exact substring dedup with a sparse suffix array over a difference cover.

Every byte that lies in a string of ``length`` bytes which also starts anywhere
else, in the same text or another, is removed.

A difference cover is a sample of the suffixes so placed that any two suffixes
can be compared through sampled ones a few bytes further on. Residues modulo
three are the usual choice; they need the whole text in one numbering and keep
two thirds of its suffixes. Here the cover follows the content: of each
``reach`` neighbouring positions, the one with the smallest hash of its next
bytes is sampled. Equal strings then hold their sample at the same place,
wherever they start, and a sample stands for all starts up to it.

1. Each sample is named by the bytes after it that all its starts share. Names
   that occur once belong to no repeat and end here.
2. What remains of a sample is a triple: the bytes before it, the name, the
   bytes after the named ones. Triples are sorted by name.
3. The starts between samples are merged in: a start is its sample's triple,
   read from some bytes before the name to some bytes after it. Among sorted
   neighbours of one name, starts with equal strings are repeats.

Names are digests, not ranks: only equal prefixes matter here, so the order of
unequal ones may be any. That replaces the recursion that would rank them.

A name that more than ``TOGETHER`` samples carry is not gathered in a task: its
starts are counted by groups with partial counts instead, and give the same.

Defined results. A null text is empty. Texts shorter than ``length`` keep all.
Rows that repeat an id or a whole row are texts of their own, so a repeated
row of enough bytes loses everything. Ids may be null. Only the named columns
are read, so extra columns of any name do no harm. An empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pricegrid.llm import textbuf
from pricegrid.llm.chunk_dedup import gear_hashes
from pricegrid.session import stage

#: bytes that a sample's hash knows
GRAM = 16
#: samples of one name that one task compares
TOGETHER = 20_000


@dataclass(frozen=True)
class Repeats:
    """Strings of ``length`` bytes; one sample in each ``reach`` positions."""

    length: int = 400
    reach: int = 128

    @property
    def named(self) -> int:
        """Bytes after a sample that lie in the strings of all its starts."""
        return self.length - self.reach + 1

    def __post_init__(self):
        if not GRAM <= self.length - self.reach:
            raise ValueError("a string must be longer than the reach of its sample and its hash")


@dataclass
class Samples:
    """Sampled positions of a slice, with the first and last start that each stands for."""

    row: np.ndarray
    at: np.ndarray
    first: np.ndarray
    last: np.ndarray


def cover(data: np.ndarray, offsets: np.ndarray, repeats: Repeats) -> Samples:
    """The samples of all starts whose string lies in its text."""
    if len(data) < repeats.length:
        none = np.zeros(0, np.int64)
        return Samples(none, none, none, none)
    hashes = gear_hashes(data)[GRAM - 1 :].astype(np.uint64)
    # the place breaks ties, to the left
    least, width = (hashes << np.uint64(32)) | np.arange(len(hashes), dtype=np.uint64), 1
    while width * 2 <= repeats.reach:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if repeats.reach > width:
        rest = repeats.reach - width
        least = np.minimum(least[:-rest], least[rest:])
    counts = np.maximum(np.diff(offsets) - repeats.length + 1, 0)
    # starts with a whole string, text by text
    starts = np.repeat(offsets[:-1] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
    sample = (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    edge = np.flatnonzero(np.diff(sample)) + 1
    begin = np.concatenate([[0], edge]) if len(sample) else edge
    end = np.append(edge, len(sample)) - 1 if len(sample) else edge
    at = sample[begin]
    return Samples(np.searchsorted(offsets, at, "right") - 1, at, starts[begin], starts[end])


def _names(data: np.ndarray, samples: Samples, repeats: Repeats) -> np.ndarray:
    return textbuf.RangeHash(data)(samples.at, samples.at + repeats.named)


def named_samples(texts: DataFrame, repeats: Repeats) -> DataFrame:
    """``name, rid, at`` of every sample of every text. Expects ``rid, text``."""

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in textbuf.slices(batch.column(1)):
                found = cover(data, offsets, repeats)
                if len(found.at):
                    rid = batch.column(0).slice(low, high - low).take(pa.array(found.row))
                    names = _names(data, found, repeats).view(np.int64)
                    at = (found.at - offsets[found.row]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(names), rid, pa.array(at)], names=["name", "rid", "at"])

    long = texts.filter(F.octet_length("text") >= repeats.length)
    return long.select("rid", "text").mapInArrow(textbuf.released(sample), "name bigint, rid bigint, at int")


def triples(texts: DataFrame, repeats: Repeats) -> DataFrame:
    """``name, n, rid, th, at, low, high, near``: the samples that ``found`` lists, with the bytes around the named ones.

    Expects ``rid, th, text, found``, the latter with ``at`` and ``n``, how many
    samples carry the name. ``low`` and ``high`` are the least and most bytes
    that a start lies before the sample; ``near`` holds the bytes from ``high``
    before the sample up to it, and those after the name that its starts reach.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            for low, high, data, offsets in textbuf.slices(batch.column(2)):
                found = cover(data, offsets, repeats)
                wanted = lists.slice(low, high - low)
                bounds = np.asarray(wanted.offsets) - wanted.offsets[0].as_py()
                listed = wanted.flatten()
                row = np.repeat(np.arange(high - low), np.diff(bounds))
                place = np.asarray(listed.field("at")).astype(np.int64) + offsets[row]
                order = np.argsort(place, kind="stable")
                place, many = place[order], np.asarray(listed.field("n"))[order]
                # of rows that share an id, only samples of this text
                where = np.minimum(np.searchsorted(place, found.at), max(len(place) - 1, 0))
                kept = np.flatnonzero(place[where] == found.at) if len(place) else np.zeros(0, np.int64)
                if not len(kept):
                    continue
                found = Samples(found.row[kept], found.at[kept], found.first[kept], found.last[kept])
                nearest, farthest = found.at - found.last, found.at - found.first
                raw, named = data.tobytes(), repeats.named
                near = [
                    raw[a - f : a] + raw[a + named : a + repeats.length - n]
                    for a, n, f in zip(found.at.tolist(), nearest.tolist(), farthest.tolist())
                ]
                own = pa.array(found.row + low)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(_names(data, found, repeats).view(np.int64)), pa.array(many[where[kept]].astype(np.int64)),
                        batch.column(0).take(own), batch.column(1).take(own), pa.array((found.at - offsets[found.row]).astype(np.int32)),
                        pa.array(nearest.astype(np.int32)), pa.array(farthest.astype(np.int32)), pa.array(near, pa.binary()),
                    ],
                    names=["name", "n", "rid", "th", "at", "low", "high", "near"],
                )

    return texts.select("rid", "th", "text", "found").mapInArrow(
        textbuf.released(cut), "name bigint, n bigint, rid bigint, th bigint, at int, low int, high int, near binary"
    )


def _starts(batch: pa.RecordBatch, repeats: Repeats) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All starts of a batch of triples: row, bytes before the sample, string's digest, where rows begin."""
    low, high = np.asarray(batch.column("low")).astype(np.int64), np.asarray(batch.column("high")).astype(np.int64)
    near = batch.column("near")
    _, bounds, raw = near.buffers()
    bounds = np.frombuffer(bounds, np.int32)[near.offset : near.offset + len(near) + 1].astype(np.int64)
    data, begin = np.frombuffer(raw, np.uint8)[bounds[0] : bounds[-1]], bounds[:-1] - bounds[0]
    count = high - low + 1
    row = np.repeat(np.arange(len(low)), count)
    first = np.cumsum(count) - count
    before = high[row] - (np.arange(len(row)) - first[row])
    # a start's string is what it holds before the sample, the name, and what is left after it
    here = begin[row] + high[row] - before
    text = textbuf.RangeHash(data)(here, here + repeats.reach - 1)
    names = np.asarray(batch.column("name")).view(np.uint64)[row]
    digest = textbuf.mix(textbuf.mix(names + before.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) + text)
    return row, before, digest, first


def _repeated(batch: pa.RecordBatch, repeats: Repeats) -> pa.RecordBatch:
    """``rid, th, begin, end`` of what each sample's repeated starts cover; whole names only."""
    row, before, digest, first = _starts(batch, repeats)
    order = np.argsort(digest)
    same = digest[order][1:] == digest[order][:-1]
    again = np.zeros(len(digest), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    # strings of one sample overlap, so that they cover one stretch
    least = np.minimum.reduceat(np.where(again, before, 1 << 40), first)
    most = np.maximum.reduceat(np.where(again, before, -1), first)
    hit = np.flatnonzero(most >= 0)
    at = np.asarray(batch.column("at")).astype(np.int64)[hit]
    own = pa.array(hit)
    columns = [batch.column("rid").take(own), batch.column("th").take(own), pa.array(at - most[hit]), pa.array(at - least[hit] + repeats.length)]
    return pa.RecordBatch.from_arrays(columns, names=["rid", "th", "begin", "end"])


def repeated_stretches(cut: DataFrame, repeats: Repeats, together: int = TOGETHER) -> DataFrame:
    """``rid, th, begin, end``: stretches covered by repeated strings, a sample's at a time."""

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            names = np.asarray(batch.column("name"))
            # the last name may go on in the next batch
            whole = int(np.searchsorted(names, names[-1], "left")) if len(names) else 0
            if whole:
                yield from _portions(batch.slice(0, whole), repeats)
            held = batch.slice(whole)
        if held is not None and held.num_rows:
            yield from _portions(held, repeats)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 1 << 13):
                part = batch.slice(low, 1 << 13)
                row, before, digest, _ = _starts(part, repeats)
                own = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c).take(own) for c in ("name", "rid", "th", "at")]
                    + [pa.array(before.astype(np.int32)), pa.array(digest.view(np.int64))],
                    names=["name", "rid", "th", "at", "before", "digest"],
                )

    stretch = "rid bigint, th bigint, begin bigint, end bigint"
    sorted_triples = cut.filter(F.col("n") <= together).repartition("name").sortWithinPartitions("name")
    few = sorted_triples.mapInArrow(textbuf.released(neighbours), stretch)
    starts = cut.filter(F.col("n") > together).mapInArrow(
        textbuf.released(each), "name bigint, rid bigint, th bigint, at int, before int, digest bigint"
    )
    again = starts.groupBy("name", "before", "digest").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    again = stage(again, "starts")
    covered = (
        starts.join(again.hint("merge"), ["name", "before", "digest"])
        .groupBy("rid", "th", "at")
        .agg(F.min("before").alias("least"), F.max("before").alias("most"))
    )
    many = covered.select("rid", "th", (F.col("at") - F.col("most")).cast("bigint"), (F.col("at") - F.col("least") + repeats.length).cast("bigint"))
    return few.union(many)


def _portions(batch: pa.RecordBatch, repeats: Repeats, rows: int = 1 << 13) -> Iterator[pa.RecordBatch]:
    """Compare a batch in parts that end with a name."""
    names, low = np.asarray(batch.column("name")), 0
    while low < len(names):
        high = min(low + rows, len(names))
        if high < len(names):
            back = int(np.searchsorted(names, names[high], "left"))
            high = back if back > low else int(np.searchsorted(names, names[high], "right"))
        yield _repeated(batch.slice(low, high - low), repeats)
        low = high


def without_repeats(
    docs: DataFrame,
    repeats: Repeats = Repeats(),
    text: str = "text",
    id_col: str = "doc_id",
    with_text: bool = False,
) -> DataFrame:
    """``id_col, n_bytes, n_removed, n_spans, kept_sha256`` and, if wanted, ``kept_text``."""
    plain = docs.select(F.col(id_col).alias("own"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    # a row is known by its id (its text, where that is null) and its text
    rows = plain.withColumn("th", F.xxhash64("text")).withColumn("rid", F.coalesce(F.col("own").cast("bigint"), F.col("th")))
    named = named_samples(rows, repeats)
    # put down, so that both sides of the join are shuffled and Spark can split a name that very many samples carry
    shared = stage(named.groupBy("name").agg(F.count("*").alias("n")).filter("n > 1"), "names")
    lists = named.join(shared.hint("merge"), "name").groupBy("rid").agg(F.collect_set(F.struct("at", "n")).alias("found"))
    # the lists grow with the corpus: never broadcast, the plan is the same at every size
    texts = stage(rows.select("rid", "th", "text").join(lists.hint("merge"), "rid"), "repeats")
    stretches = repeated_stretches(triples(texts, repeats), repeats)
    spans = stretches.groupBy("rid", "th").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))
    names = ["rid", "th", "n_removed", "n_spans", "kept_sha256"] + ["kept_text"] * with_text

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            results = []
            for value, found in zip(batch.column(2), batch.column(3)):
                raw, kept, at, spans = memoryview(value.as_py().encode()), bytearray(), 0, 0
                for begin, end in sorted((s["begin"], s["end"]) for s in found.as_py()):
                    if begin > at or not spans:
                        kept += raw[at:begin]
                        spans += 1
                    at = max(at, end)
                kept += raw[at:]
                row = [len(raw) - len(kept), spans, hashlib.sha256(kept).hexdigest()]
                results.append(row + [kept.decode("utf-8", "ignore")] * with_text)
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(x, k) for x, k in zip(zip(*results), kinds))], names=names)

    changed = texts.select("rid", "th", "text").join(spans.hint("merge"), ["rid", "th"]).select("rid", "th", "text", "spans")
    schema = "rid bigint, th bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept_text string" * with_text
    changed = changed.mapInArrow(textbuf.released(remove), schema).dropDuplicates(["rid", "th"])
    whole = F.sha2(F.col("text").cast("binary"), 256).alias("whole")
    known = rows.select("own", "rid", "th", F.octet_length("text").cast("bigint").alias("n_bytes"), whole, *["text"] * with_text)
    return known.join(changed, ["rid", "th"], "left").select(
        F.col("own").alias(id_col), "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"), *[F.coalesce("kept_text", "text").alias("kept_text")] * with_text,
    )
