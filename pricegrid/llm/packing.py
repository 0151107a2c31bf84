"""Packing: shortest pack first over the length histogram.

Documents become token ids with an end id, and are cut into pieces of at most
``max_length``. Only the histogram of piece lengths, at most ``max_length``
numbers however large the corpus, comes to the driver. There lengths are
placed longest first, each into the pack that is filled least, for all pieces
of that length at once: what changes are counts of packing patterns. A piece
finds its place by its length and its rank among pieces of that length.

Defined results. A null text is an empty text: one piece, the end id alone.
Repeated rows are packed each for itself; a null id is kept. Only the named
columns are read, so extra columns of any name do no harm. An empty table
gives an empty result.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from pricegrid.llm import textbuf
from pricegrid.llm.white_runs import encode_ordinary
from pricegrid.session import stage

#: pieces of one length that one task ranks; only splits work
RANKED_TOGETHER = 100_000


@dataclass(frozen=True)
class Tokenizer:
    """A byte-level vocabulary: the file of the tokenizers library, and the same as ranks.

    The ranks, about five times faster, read Latin text. The tokenizers library
    reads whatever has other scripts or a special token in it, so that ids
    never depend on the character tables of the faster library.
    """

    path: str
    ranks: str | None = None
    pattern: str | None = None
    specials: tuple[str, ...] = ("<|endoftext|>",)

    def reader(self):
        from tokenizers import Tokenizer as Reader

        whole = Reader.from_file(self.path)
        if not self.ranks:
            return lambda text: whole.encode(text, add_special_tokens=False).ids
        import tiktoken

        with open(self.ranks, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        fast = tiktoken.Encoding("own", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})

        def encode(text: str):
            if (text.isascii() or max(text) < "ɐ") and not any(x in text for x in self.specials):
                return encode_ordinary(fast, text)
            return whole.encode(text, add_special_tokens=False).ids

        return encode


def pieces(
    docs: DataFrame,
    tokenizer: Tokenizer,
    max_length: int = 2048,
    end_id: int = 1,
    text: str = "text",
    id_col: str = "doc_id",
    with_ids: bool = False,
) -> DataFrame:
    """``id_col, start, length, ids_crc32, doc_tokens`` and, if wanted, ``ids`` of every piece."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = "id " + kind + ", start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint" + ", ids array<int>" * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer.reader()
        for batch in batches:
            row, start, length, crc, total, kept = [], [], [], [], [], []
            for i, value in enumerate(batch.column(1)):
                ids = np.array([*encode(value.as_py() or ""), end_id], "<u4")
                for at in range(0, len(ids), max_length):
                    piece = ids[at : at + max_length]
                    row.append(i)
                    start.append(at)
                    length.append(len(piece))
                    crc.append(zlib.crc32(piece.tobytes()))
                    total.append(len(ids))
                    if with_ids:
                        kept.append(piece.astype(np.int32))
            arrays = [batch.column(0).take(pa.array(row, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))]
            names = ["id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                arrays.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("__text")).mapInArrow(textbuf.released(cut), schema)


def packing_patterns(histogram: dict[int, int], max_length: int) -> list[tuple[int, list[int]]]:
    """``(count, lengths)`` of each pattern."""
    open_packs: dict[int, list[tuple[int, list[int]]]] = {}  # by space left
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            space = max((s for s in open_packs if s >= length), default=max_length)
            if space < max_length:
                count, lengths = open_packs[space].pop()
                used, times = min(left, count), 1
                if used < count:
                    open_packs[space].append((count - used, lengths))
                elif not open_packs[space]:
                    del open_packs[space]
            else:
                # a new pack stays the least filled one until no more of this length fit
                times = min(max_length // length, left)
                lengths, used = [], left // times
            open_packs.setdefault(space - times * length, []).append((used, lengths + [length] * times))
            left -= used * times
    return [pattern for space in sorted(open_packs) for pattern in open_packs[space]]


@dataclass
class Places:
    """Where the pieces of each length go: runs of ranks that share a pattern and an offset."""

    key: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray

    RANKS = 1 << 48

    @classmethod
    def of(cls, patterns: list[tuple[int, list[int]]]) -> Places:
        taken: dict[int, int] = {}
        rows, sequences = [], 0
        for count, lengths in patterns:
            offset = 0
            for length in lengths:
                rank = taken.get(length, 0)
                taken[length] = rank + count
                rows.append((length * cls.RANKS + rank, sequences, offset))
                offset += length
            sequences += count
        rows.sort()
        key, sequence, offset = (np.array(x, np.int64) for x in zip(*rows)) if rows else (np.zeros(0, np.int64),) * 3
        return cls(key, sequence, offset)

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        wanted = length * self.RANKS + rank
        run = np.searchsorted(self.key, wanted, "right") - 1
        return self.sequence[run] + wanted - self.key[run], self.offset[run]


def pack(cut: DataFrame, max_length: int = 2048) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces; ``cut`` is read from the shared folder."""
    known = stage(cut, "pieces")
    histogram = {r["length"]: r["n"] for r in known.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = Places.of(packing_patterns(histogram, max_length))
    blocks = max(1, -(-sum(histogram.values()) // RANKED_TOGETHER))
    # rows are told apart by where the shared folder holds them: equal rows get ranks of their own
    at = [F.col("_metadata.file_name"), F.col("_metadata.row_index")]
    numbered = known.select("*", at[0].alias("__file"), at[1].alias("__row"))
    numbered = numbered.withColumn("__block", F.pmod(F.xxhash64("__file", "__row"), F.lit(blocks)))
    before = W.partitionBy("length").orderBy("__block").rowsBetween(W.unboundedPreceding, -1)
    first = numbered.groupBy("length", "__block").agg(F.count("*").alias("n")).select(
        "length", "__block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before")
    )
    inside = F.row_number().over(W.partitionBy("length", "__block").orderBy("__file", "__row"))
    ranked = numbered.withColumn("__rank", inside - 1).join(first, ["length", "__block"])

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = places.find(length.to_numpy(np.int64), rank.to_numpy(np.int64))
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    found = ranked.withColumn("__at", place("length", (F.col("__rank") + F.col("__before")).cast("bigint")))
    return found.select(*known.columns, "__at.sequence_id", "__at.offset")


def pack_documents(
    docs: DataFrame,
    tokenizer: Tokenizer,
    max_length: int = 2048,
    end_id: int = 1,
    text: str = "text",
    id_col: str = "doc_id",
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents with their places in sequences; see the module's text."""
    return pack(pieces(docs, tokenizer, max_length, end_id, text, id_col, with_ids), max_length).withColumnRenamed("id", id_col)
