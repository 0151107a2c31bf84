"""Substring dedup: content-defined chunks from a gear rolling hash.

A gear hash runs over a text's bytes; it only knows the last sixteen. A chunk
ends where the hash is the smallest within ``reach`` bytes on either side, so
its ends depend on nearby bytes alone: after an insertion the next chunks are
the old ones again. Each text is cut on its own, so equal texts have equal
chunks whatever lies beside them. Chunks are compared by a 128-bit digest. Each digest is
kept where it occurs first, by document id and place; runs of later chunks of
at least ``least_run`` bytes, or that are a whole text, are removed. Stretches without a smallest hash,
such as one word over and over, are cut at ``longest`` bytes.

Digests are counted first, by half their bits and with partial counts, and
only chunks whose half digest occurs twice are looked at whole. A digest that
very many chunks share is one row where it is counted, and on one side only of
the joins, where Spark can split it.

Defined results. A null text is empty. Rows that share an id each lose the
chunks that were found in their own text. A null id takes no part: its text
stays whole and repeats nothing. Only the named columns are read, so extra
columns of any name do no harm. An empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from pricegrid.llm import textbuf
from pricegrid.session import stage

_GEAR = np.random.default_rng(5).integers(0, 1 << 32, 256, dtype=np.uint32)


@dataclass(frozen=True)
class Chunking:
    reach: int = 20
    longest: int = 60
    least_run: int = 120


def gear_hashes(data: np.ndarray, offsets: np.ndarray | None = None) -> np.ndarray:
    """The rolling hash ``h = 4 h + gear[byte]`` at every byte of a text, or of all as one: its last sixteen bytes, doubled up."""
    hashes, width = _GEAR[data], 1
    begins = np.unique(offsets[:-1]) if offsets is not None else np.zeros(0, np.int64)
    begins = begins[begins < len(data)]
    while width < 16:
        shifted = hashes.copy()
        shifted[width:] += hashes[:-width] << np.uint32(2 * width)
        # the first bytes of a text have none of their own that far before them
        alone = (begins[:, None] + np.arange(width)).ravel()
        alone = alone[alone < len(data)]
        shifted[alone] = hashes[alone]
        hashes, width = shifted, 2 * width
    return hashes


def _least_within(values: np.ndarray, reach: int) -> np.ndarray:
    """The least of the ``reach`` values before each place."""
    padded = np.concatenate([np.full(reach, 0xFFFFFFFF, np.uint32), values])
    out, width = padded, 1
    while width * 2 <= reach:
        out = np.minimum(out[:-width], out[width:])
        width *= 2
    rest = reach - width
    if rest:
        out = np.minimum(out[:-rest], out[rest:])
    return out[: len(values)]


def chunk_ends(data: np.ndarray, offsets: np.ndarray, chunking: Chunking) -> np.ndarray:
    """Where chunks end, in all texts of a slice; each text's end is among them."""
    hashes = gear_hashes(data, offsets)
    # texts laid out so far apart that no hash is compared with another text's
    at = np.arange(len(data)) + chunking.reach * np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    apart = np.full(len(data) + chunking.reach * len(offsets), 0xFFFFFFFF, np.uint32)
    apart[at] = hashes
    low = (apart < _least_within(apart, chunking.reach)) & (apart[::-1] < _least_within(apart[::-1], chunking.reach))[::-1]
    ends = np.unique(np.concatenate([np.flatnonzero(low[at]) + 1, offsets[1:]]))
    ends = ends[ends > 0]
    begins = np.concatenate([[0], ends[:-1]])
    wide = ends - begins > chunking.longest
    if wide.any():
        more = [np.arange(a + chunking.longest, b, chunking.longest) for a, b in zip(begins[wide], ends[wide])]
        ends = np.unique(np.concatenate([ends, *more]))
    return ends


def chunks(docs: DataFrame, chunking: Chunking, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``id, at, size, high, low``: every chunk with its digest in two halves."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in textbuf.slices(batch.column(1)):
                if not len(data):
                    continue
                ends = chunk_ends(data, offsets, chunking)
                begins = np.concatenate([[0], ends[:-1]])
                view = memoryview(data)
                digests = b"".join([xxhash.xxh3_128_digest(view[a:b]) for a, b in zip(begins.tolist(), ends.tolist())])
                halves = np.frombuffer(digests, "<i8").reshape(-1, 2)
                row = np.searchsorted(offsets, begins, "right") - 1
                columns = [
                    batch.column(0).slice(first, last - first).take(pa.array(row)),
                    pa.array((begins - offsets[row]).astype(np.int32)),
                    pa.array((ends - begins).astype(np.int32)),
                    pa.array(np.ascontiguousarray(halves[:, 0])),
                    pa.array(np.ascontiguousarray(halves[:, 1])),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "at", "size", "high", "low"])

    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text).cast("string").alias("__text")).filter("id is not null").mapInArrow(
        textbuf.released(cut), "id bigint, at int, size int, high bigint, low bigint"
    )


def repeated_chunks(cut: DataFrame) -> DataFrame:
    """``id, at, size, high, of``: chunks whose digest occurred before, and the id where it is kept."""
    # put down, so that both sides of the joins are shuffled and Spark can split a digest that very many chunks have
    shared = stage(cut.select("high").groupBy("high").agg(F.count("*").alias("n")).filter("n > 1").select("high"), "digests")
    several = stage(cut.join(shared.hint("merge"), "high"), "chunks")
    first = several.groupBy("high", "low").agg(F.min(F.struct("id", "at")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    first = stage(first.select("high", "low", "first"), "first")
    return several.join(first.hint("merge"), ["high", "low"]).filter("id <> first.id or at <> first.at").select(
        "id", "at", "size", "high", F.col("first.id").alias("of")
    )


def removed_runs(found: list[tuple[int, int]], least_run: int, size: int) -> list[tuple[int, int]]:
    """Runs of adjoining ``(begin, end)`` chunks, in order, of at least ``least_run`` bytes or a whole text of ``size``."""
    runs: list[list[int]] = []
    for begin, end in sorted(found):
        if runs and runs[-1][1] >= begin:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([begin, end])
    return [(a, b) for a, b in runs if b - a >= min(least_run, size)]


def without_repeats(
    docs: DataFrame,
    chunking: Chunking = Chunking(),
    text: str = "text",
    id_col: str = "doc_id",
    with_text: bool = False,
) -> DataFrame:
    """``id_col, n_bytes, n_repeated, n_removed, n_spans, repeats_of, kept_sha256`` and, if wanted, ``kept_text``.

    ``n_repeated`` counts the bytes of all chunks that occurred before, also of
    runs too short to be removed; ``repeats_of`` lists the other documents that
    keep what was removed here.
    """
    repeated = repeated_chunks(chunks(docs, chunking, text, id_col))
    lists = repeated.groupBy("id").agg(F.collect_list(F.struct("at", "size", "high", "of")).alias("found"))
    kind = docs.schema[id_col].dataType.simpleString()
    own = docs.select(F.col(id_col).alias("own"), F.col(id_col).cast("bigint").alias("id"), F.col(text).cast("string").alias("text"))
    # the lists grow with the corpus: never broadcast, the plan is the same at every size
    joined = own.join(lists.hint("merge"), "id", "left").select("own", "text", "found")
    names = ["id", "n_bytes", "n_repeated", "n_removed", "n_spans", "repeats_of", "kept_sha256"] + ["kept_text"] * with_text

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for own, value, found in zip(batch.column(0), batch.column(1), batch.column(2)):
                raw = memoryview((value.as_py() or "").encode())
                mine, keepers = [], []
                for chunk in found.as_py() or []:
                    begin, end = chunk["at"], chunk["at"] + chunk["size"]
                    # of rows that share an id, only those that hold this chunk here
                    if xxhash.xxh3_128_digest(raw[begin:end])[:8] == chunk["high"].to_bytes(8, "little", signed=True):
                        mine.append((begin, end))
                        keepers.append((begin, chunk["of"]))
                runs = removed_runs(mine, chunking.least_run, len(raw))
                kept, at = bytearray(), 0
                for begin, end in runs:
                    kept += raw[at:begin]
                    at = end
                kept += raw[at:]
                firsts = [a for a, _ in runs]
                others = set()
                for begin, keeper in keepers:
                    i = bisect.bisect_right(firsts, begin) - 1
                    if i >= 0 and begin < runs[i][1]:
                        others.add(keeper)
                others.discard(own.as_py())
                row = [len(raw), sum(b - a for a, b in set(mine)), len(raw) - len(kept), len(runs), sorted(others), hashlib.sha256(kept).hexdigest()]
                # a chunk may end inside a code point; what is left of one is dropped from the text
                rows.append(row + [kept.decode("utf-8", "ignore")] * with_text)
            kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())] + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, k) for x, k in zip(zip(*rows), kinds))], names=names)

    schema = f"id {kind}, n_bytes bigint, n_repeated bigint, n_removed bigint, n_spans bigint, "
    schema += "repeats_of array<bigint>, kept_sha256 string" + ", kept_text string" * with_text
    return joined.mapInArrow(textbuf.released(remove), schema).withColumnRenamed("id", id_col)
