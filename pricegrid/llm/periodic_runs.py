"""Periodic runs of words: passages that say the same few words again and again.

A run is a stretch of consecutive words in which words a period apart are the
same, taken at its smallest period, long enough, and as long as it can be.

Found by dynamic programming over diagonals, one pass over the words: an
earlier occurrence of the present word ``lag`` words ago lengthens the match on
the diagonal ``lag`` by one, and a diagonal that the next word does not
continue has ended: with enough matched words it is a run. Only active
diagonals are kept. What keeps them few and loses no run:

* Every run has at least ``context`` matched words in a row on its diagonal, so
  a diagonal becomes active with its first ``context`` words, at an earlier
  occurrence of these words in this order; other diagonals never matter.
* A context at least as long as the period occurs in a run once in a period.
  So a word's *latest* earlier occurrence, in its context, has the period as
  its lag, and longer lags need longer contexts: ``context`` words for lags up
  to ``context``, twice as many for lags up to twice as many, and so on. A word
  lengthens one diagonal for each of these sizes, at most the logarithm of the
  text's length, however often it occurs.
* Longer contexts are only looked at where both their halves occur again.

Work grows with the words, a little more where they repeat; a million times the
same word is no worse than other texts. Tasks read whole texts one beside the
other, nothing is shuffled.

Defined results. A null text has no words. Words are compared as they are
written, by 64-bit hashes. Each row is judged on its own, so repeated rows and
null ids are fine, and an empty table gives an empty result. Only the named
columns are read; extra columns of any name do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pricegrid.llm import textbuf

RUN = "struct<start bigint, length bigint, period bigint>"


@dataclass(frozen=True)
class Repetition:
    """Runs have ``min_words`` words or more, and ``min_periods`` periods or more."""

    min_words: int = 24
    min_periods: int = 3

    def __post_init__(self):
        if self.min_periods < 3 or self.min_words < 2:
            raise ValueError("runs take three periods and two words or more")

    @property
    def context(self) -> int:
        """Matched words in a row that every run has: for a period p, its length less p."""
        return -(-self.min_words * (self.min_periods - 1) // self.min_periods)

    def enough(self, matched: np.ndarray, lag: np.ndarray) -> np.ndarray:
        return matched + lag >= np.maximum(self.min_words, self.min_periods * lag)


def repeated(keys: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of contexts, those that occur more than once: their place, key, and how long ago the last one was (0: never)."""
    bits = max(12, int(8 * len(keys)).bit_length())
    slot = (keys >> np.uint64(64 - bits)).astype(np.int64)
    some = np.flatnonzero(np.bincount(slot, minlength=1 << bits)[slot] > 1)
    order = some[np.argsort(keys[some], kind="stable")]
    ordered = keys[order]
    same = ordered[1:] == ordered[:-1]
    again = np.zeros(len(order), bool)
    again[1:] = same
    again[:-1] |= same
    lag = np.zeros(len(order), np.int64)
    lag[1:][same] = at[order[1:][same]] - at[order[:-1][same]]
    order, lag = order[again], lag[again]
    back = np.argsort(order)
    return at[order[back]], keys[order[back]], lag[back]


def ended_diagonals(at: np.ndarray, lag: np.ndarray, context: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, lag and matched words of each diagonal, from its contexts' first words."""
    order = np.lexsort((at, lag))
    at, lag = at[order], lag[order]
    opens = np.ones(len(at), bool)
    opens[1:] = (lag[1:] != lag[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(opens)
    last = np.append(first[1:], len(at))[: len(first)] - 1
    return at[first], lag[first], at[last] - at[first] + context


def runs_of_words(hashes: np.ndarray, found: textbuf.Words, rule: Repetition) -> np.ndarray:
    """``start, length, period`` of all runs, by start and period; starts count all words of the slice."""
    size = rule.context
    keys, at = textbuf.windows(hashes, found, size)
    keys = textbuf.mix(keys + found.text()[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    out, shortest = [np.zeros((0, 3), np.int64)], 0
    while len(at):
        at, keys, lag = repeated(keys, at)
        near = (lag > shortest) & (lag <= size)
        begin, period, matched = ended_diagonals(at[near], lag[near], size)
        long = rule.enough(matched, period)
        out.append(np.stack([begin - period, matched + period, period], 1)[long])
        # contexts of twice the size, where both halves occur again
        there = np.searchsorted(at, at + size)
        there[there == len(at)] = 0
        both = np.flatnonzero(at[there] == at + size) if len(at) else there
        keys = textbuf.mix(keys[both] * np.uint64(0xD6E8FEB86659FD93) + keys[there[both]])
        at, shortest, size = at[both], size, 2 * size
    runs = np.concatenate(out)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _kept(runs: np.ndarray, n: int) -> np.ndarray:
    """Words that no run holds after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.flatnonzero(np.cumsum(change[:-1]) == 0)


def _joined(data: np.ndarray, found: textbuf.Words, kept: np.ndarray) -> pa.Array:
    """The kept words of each text with one space between them."""
    first = np.searchsorted(kept, found.first)
    size = (found.end - found.begin)[kept] + 1
    last = first[1:][first[1:] > first[:-1]] - 1
    size[last] -= 1
    ends = np.zeros(len(kept) + 1, np.int64)
    np.cumsum(size, out=ends[1:])
    place = np.arange(ends[-1]) + np.repeat(found.begin[kept] - ends[:-1], size)
    out = data[np.minimum(place, max(len(data) - 1, 0))]
    spaces = ends[1:] - 1
    spaces = np.delete(spaces, last)
    out[spaces] = ord(" ")
    return pa.Array.from_buffers(pa.large_string(), len(first) - 1, [None, pa.py_buffer(ends[first].tobytes()), pa.py_buffer(out.tobytes())])


def periodic_runs(docs: DataFrame, rule: Repetition = Repetition(), text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``id_col, n_words, runs, collapsed`` of every row.

    ``runs`` lists ``start, length, period`` in words, counted from 0, by start
    and period. ``collapsed`` holds the words that no run contains after its
    first period, with one space between them.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in textbuf.slices(batch.column(1)):
                found = textbuf.words(data, offsets)
                hashes = textbuf.RangeHash(data)(found.begin, found.end)
                runs = runs_of_words(hashes, found, rule)
                owner = np.searchsorted(found.first, runs[:, 0], "right") - 1
                bounds = np.searchsorted(owner, np.arange(high - low + 1)).astype(np.int32)
                columns = [pa.array(c) for c in (runs[:, 0] - found.first[owner], runs[:, 1], runs[:, 2])]
                listed = pa.ListArray.from_arrays(pa.array(bounds), pa.StructArray.from_arrays(columns, names=["start", "length", "period"]))
                collapsed = _joined(data, found, _kept(runs, len(hashes))).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), pa.array(np.diff(found.first)), listed, collapsed],
                    names=[id_col, "n_words", "runs", "collapsed"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text).cast("string").alias("__text")).mapInArrow(
        textbuf.released(find), f"`{id_col}` {kind}, n_words bigint, runs array<{RUN}>, collapsed string"
    )
