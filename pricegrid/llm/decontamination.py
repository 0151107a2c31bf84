"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit distance.

Texts are words (ASCII letters folded, ASCII punctuation dropped); in scripts
without spaces each code point is a word. A passage of
a document is a leak if turning it into a benchmark item takes at most a fifth
of the item's words as insertions, deletions or substitutions.

Windows of a document, as long as the items, take random walks over their
words: each step writes the word it stands on and a random bit of step and
word says whether it moves on. Two texts at a small edit distance write
sequences at a small Hamming distance (the embedding of Chakraborty, Goldenberg
and Koucky). A table keys a walk by a few sampled steps. Edits that shift words
part the walks of long items more, so each group of sizes has its own numbers of
walks, tables and steps: texts with as many edits as are allowed are made up,
substituted, deleted and inserted at random places, evenly and at the front, and
keys are added until each kind is met with the chance ``recall``. Windows also
begin before a document's first word, in case an item's first words are missing.
Whatever meets is verified by the exact edit distance.

Windows that can match no item are passed over first, without loss: an edit
changes at most two pairs of adjacent words, so a window within ``d`` edits of
an item of ``n`` words holds at least ``n - 1 - 2 d`` of the items' pairs.

Items are read in blocks of bounded size, and each block meets all documents;
nothing is shuffled.

Defined results. Null and empty texts match nothing. Every item with a word is
searched for; below five words no edit is allowed. ``min_words`` leaves shorter
items out, where passages that short occur anywhere. An item that stands in a
document several times is reported each time, back to back as well; passages of
one item do not overlap. Rows and items that repeat are reported each; null ids
stay null. Only the named columns are read, so extra columns of any name do no
harm. Empty tables give an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pricegrid.llm import textbuf

ITEM_BYTES = 1 << 23

_NORMAL = textbuf.LOWER.copy()
for _code in range(128):
    if not chr(_code).isalnum():
        _NORMAL[_code] = 32

OUTSIDE, END = 1, 0  # symbols: a word of no item, and past the end


@dataclass(frozen=True)
class Search:
    """``percent`` of an item's words must stand; leaks with as many edits as that are met with chance ``recall``."""

    percent: int = 80
    min_words: int = 1
    recall: float = 0.99

    def edits(self, words: int) -> int:
        return words * (100 - self.percent) // 100


# Code points of scripts without spaces (Thai, Lao, Tibetan, Myanmar, Khmer, Kana, Han and their signs).
_UNSPACED = np.zeros(1 << 16, bool)
for _low, _high in ((0x0E00, 0x1100), (0x1780, 0x1800), (0x1950, 0x1AB0), (0x2E80, 0x3130), (0x31A0, 0xA000), (0xF900, 0xFB00), (0xFE30, 0xFE50), (0xFF00, 0xFFA0)):
    _UNSPACED[_low:_high] = True


def _cuts(data: np.ndarray) -> np.ndarray:
    """Begins and ends of the code points of scripts without spaces."""
    three = np.flatnonzero((data >= 0xE0) & (data < 0xF0))
    a, b, c = (data[three + k].astype(np.int64) for k in range(3))
    three = three[_UNSPACED[(a & 15) << 12 | (b & 63) << 6 | c & 63]]
    # from U+20000 on all is Han
    four = np.flatnonzero(data >= 0xF0)
    four = four[(data[four] > 0xF0) | (data[four + 1] >= 0xA0)]
    return np.unique(np.concatenate([three, three + 3, four, four + 4]))


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[textbuf.Words, np.ndarray]:
    plain = _NORMAL[data]
    found = textbuf.words(plain, offsets)
    cuts = _cuts(data)
    if len(cuts):
        begin = np.union1d(found.begin, cuts[textbuf.IS_WORD[plain[np.minimum(cuts, len(plain) - 1)]] & (cuts < len(plain))])
        end = np.union1d(found.end, cuts[textbuf.IS_WORD[plain[cuts - 1]] & (cuts > 0)])
        found = textbuf.Words(begin, end, np.searchsorted(begin, offsets))
    return found, textbuf.RangeHash(plain)(found.begin, found.end)


def _pairs(hashes: np.ndarray) -> np.ndarray:
    return textbuf.mix(hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:])


def _walk(windows: np.ndarray, walks: int) -> Iterator[np.ndarray]:
    """At each step, the word each walk stands on: ``walks`` by windows."""
    length = windows.shape[1] - 1
    seeds = np.random.default_rng(10).integers(1, 1 << 62, walks, dtype=np.uint64)[:, None]
    at, rows = np.zeros((walks, len(windows)), np.int64), np.arange(len(windows))
    for j in range(2 * length):
        word = windows[rows, at]
        yield word
        bit = textbuf.mix(word.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(j) + seeds) >> np.uint64(63)
        at = np.minimum(at + bit.astype(np.int64), length)


@dataclass(frozen=True)
class Keys:
    """``walks`` times ``tables`` keys of ``sampled`` steps."""

    walks: int
    tables: int
    sampled: int


#: walks and texts a chance is measured on
TRIAL_WALKS, TRIAL_TEXTS = 16, 40


def _edited(words: np.ndarray, edits: int, kind: str, place: str, pick: np.random.Generator) -> list[int]:
    n = len(words)
    if place == "front":
        places = np.arange(edits)
    elif place == "even":
        places = np.arange(edits) * n // max(edits, 1) + pick.integers(0, max(n // max(edits, 1), 1))
    else:
        places = pick.choice(n, edits, replace=False)
    marked, out = set(places.tolist()), []
    for i, word in enumerate(words.tolist()):
        if i not in marked:
            out.append(word)
        elif kind != "del":
            out += [OUTSIDE] if kind == "sub" else [OUTSIDE, word]
    return out


def _agreement(n: int, longest: int, edits: int, kind: str, place: str) -> np.ndarray:
    """Share of steps at which walks over an item and over a window of its leak agree: walks, texts, starts."""
    pick = np.random.default_rng(n)
    starts = sorted({0, edits // 2, *range(max(0, edits - 2), edits + 3)})
    own, windows = np.full((TRIAL_TEXTS, longest + 1), END, np.int64), []
    for row in range(TRIAL_TEXTS):
        own[row, :n] = pick.integers(2, 1 << 40, n)
        text = [OUTSIDE] * edits + _edited(own[row, :n], edits, kind, place, pick) + [OUTSIDE] * (longest + 3)
        windows += [[*text[a : a + longest], END] for a in starts]
    together = np.concatenate([own, np.array(windows)])
    same = np.zeros((TRIAL_WALKS, TRIAL_TEXTS, len(starts)))
    for word in _walk(together, TRIAL_WALKS):
        same += word[:, TRIAL_TEXTS:].reshape(same.shape) == word[:, :TRIAL_TEXTS, None]
    return same / (2 * longest)


@cache
def keys_for(sizes: tuple[int, ...], items: int, search: Search, same: float = 0.01) -> Keys:
    """The cheapest keys by which ``items`` of these sizes are met with the wanted chance, whatever the kind of edit.

    ``same`` is the chance that a window's word is that of an item.
    """
    longest = max(sizes)
    hardest = {min(sizes), max(sizes, key=lambda n: (search.edits(n) / n, -n))}
    agreed = [
        _agreement(n, longest, search.edits(n), kind, place) for n in hardest for kind in ("sub", "del", "ins") for place in ("any", "even", "front")
    ]
    # half of what may be missed is kept for the error of the measurement
    target, best = (1 - search.recall) / 2, None
    for sampled in (1, 2, 3):
        for tables in (4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128, 192, 256, 384, 512):
            passed = [((1 - share**sampled) ** tables).min(2).mean(0) for share in agreed]
            # a walk's steps, its keys, and the items that meet by chance
            each = 8 * longest + tables * (4 + 2 * sampled + 40 * items * same**sampled)
            most = 256 if best is None else int(best[0] / each)
            walks = next((w for w in range(1, most + 1) if max((x**w).mean() for x in passed) <= target), None)
            if walks and (best is None or walks * each < best[0]):
                best = walks * each, Keys(walks, tables, sampled)
    if best is None:
        raise ValueError(f"no keys reach a recall of {search.recall} for items of {longest} words")
    return best[1]


def _sized(lengths: list[int]) -> list[tuple[int, int, list[int]]]:
    """Least and greatest size and items of each group: sizes within a tenth share their windows."""
    groups: list[tuple[int, int, list[int]]] = []
    for i in sorted(range(len(lengths)), key=lengths.__getitem__):
        if groups and lengths[i] * 10 <= groups[-1][0] * 11:
            groups[-1][2].append(i)
            groups[-1] = (groups[-1][0], lengths[i], groups[-1][2])
        else:
            groups.append((lengths[i], lengths[i], [i]))
    return groups


def _read(texts: list[str]) -> list[np.ndarray]:
    """Hashes of the words of each text."""
    hashes = []
    for _, _, data, offsets in textbuf.slices(pa.array([x or "" for x in texts], pa.string())):
        found, hashed = _words(data, offsets)
        hashes += [hashed[a:b] for a, b in zip(found.first, found.first[1:])]
    return hashes


def keys_of(texts: list[str], search: Search) -> list[Keys]:
    """Keys for each group of sizes of a block of items."""
    hashes = [h for h in _read(texts) if len(h) >= max(1, search.min_words)]
    if not hashes:
        return []
    lengths = [len(h) for h in hashes]
    often = np.unique(np.concatenate(hashes), return_counts=True)[1] / sum(lengths)
    # windows that are looked at hold the items' common words rather than the rare ones
    same = round(float((often**3).sum() / (often**2).sum()), 3)
    return [keys_for(tuple(sorted({lengths[i] for i in own})), len(own), search, same) for _, _, own in _sized(lengths)]


class Items:
    """A block of items: words as symbols, pairs of words, and tables by size."""

    FLAGS = 24

    def __init__(self, ids: list, texts: list[str], search: Search, wanted: list[Keys] | None = None):
        self.search = search
        self.wanted = keys_of(texts, search) if wanted is None else wanted
        hashes = _read(texts)
        kept = [i for i, h in enumerate(hashes) if len(h) >= max(1, search.min_words)]
        self.ids = [ids[i] for i in kept]
        hashes = [hashes[i] for i in kept]
        self.vocabulary = np.unique(np.concatenate(hashes)) if kept else np.zeros(0, np.uint64)
        self.words = [np.searchsorted(self.vocabulary, h).astype(np.int64) + 2 for h in hashes]
        self.lone = np.unique(np.array([h[0] for h in hashes if len(h) == 1], np.uint64))
        self.pairs = np.unique(np.concatenate([_pairs(h) for h in hashes])) if kept else np.zeros(0, np.uint64)
        self.flags = np.zeros(1 << self.FLAGS, bool)
        self.flags[self.pairs >> np.uint64(64 - self.FLAGS)] = True
        self.groups = _sized([len(w) for w in self.words])
        self.tables = [self._tables(g) for g in range(len(self.groups))]
        spans = [self._span(longest) for _, longest, _ in self.groups if longest > 1]
        self.least_span = min(spans, default=1)
        # of the sizes in a group: one word more may be an edit more, and then fewer pairs are needed
        self.needed = [min(self._needed(len(self.words[i])) for i in own) for _, _, own in self.groups]
        # a span with enough pairs has a part of the least span with its share of them
        self.least_pairs = min((-(-needed // -(-span // self.least_span)) for span, needed in zip(spans, self.needed[-len(spans) :])), default=1)

    def _needed(self, words: int) -> int:
        return max(1, words - 1 - 2 * self.search.edits(words))

    def _span(self, words: int) -> int:
        return words + self.search.edits(words)

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 2, OUTSIDE)

    def keys(self, g: int, windows: np.ndarray) -> np.ndarray:
        """Keys of each window for all walks and tables of a group: ``walks * tables`` by windows."""
        wanted, steps = self.wanted[g], 2 * (windows.shape[1] - 1)
        chosen = np.random.default_rng(steps // 2).integers(0, steps, (wanted.walks, wanted.tables, wanted.sampled))
        taken = defaultdict(set)
        for (w, t, _), j in np.ndenumerate(chosen):
            taken[int(j)].add((w, t))
        keys = np.zeros((wanted.walks, wanted.tables, len(windows)), np.uint64)
        for j, word in enumerate(_walk(windows, wanted.walks)):
            for w, t in taken[j]:
                keys[w, t] = textbuf.mix(keys[w, t] + word[w].astype(np.uint64) + np.uint64((j + 1) * 0x9E3779B1))
        return keys.reshape(-1, len(windows))

    def _tables(self, g: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Known keys, where their items begin, and the items."""
        _, longest, own = self.groups[g]
        windows = np.full((len(own), longest + 1), END, np.int64)
        for row, i in enumerate(own):
            windows[row, : len(self.words[i])] = self.words[i]
        tables = []
        for keys in self.keys(g, windows):
            order = np.argsort(keys, kind="stable")
            known, first = np.unique(keys[order], return_index=True)
            tables.append((known, np.append(first, len(own)), np.array(own, np.int64)[order]))
        return tables

    def starts(self, hashes: np.ndarray, owner_end: np.ndarray) -> list[np.ndarray]:
        """For each group of sizes, the words at which a window has enough of the items' pairs."""
        none = [np.zeros(0, np.int64)] * len(self.groups)
        if len(self.lone):
            # the first group: words as they are
            none[0] = np.flatnonzero(np.isin(hashes, self.lone))
        if len(hashes) < 2 or not len(self.pairs):
            return none
        pair = _pairs(hashes)
        hit = np.flatnonzero(self.flags[pair >> np.uint64(64 - self.FLAGS)])
        at = np.minimum(np.searchsorted(self.pairs, pair[hit]), len(self.pairs) - 1)
        hit = hit[(self.pairs[at] == pair[hit]) & (owner_end[hit] > hit + 1)]
        if len(hit) < self.least_pairs:
            return none
        # pairs within reach of a hit, among the hits alone
        reach = np.searchsorted(hit, hit + self.least_span - 1, "right") - np.arange(len(hit))
        dense = hit[reach >= self.least_pairs]
        if not len(dense):
            return none
        out = []
        for needed, (_, longest, _) in zip(self.needed, self.groups):
            if longest == 1:
                out.append(none[0])
                continue
            span = self._span(longest)
            # windows that reach a dense hit: hits are in order, so each adds what lies after the one before
            low = np.maximum(dense - span, np.append(0, dense[:-1] + 1))
            count = dense - low + 1
            near = np.arange(count.sum()) + np.repeat(low - (np.cumsum(count) - count), count)
            end = np.minimum(near + span, owner_end[near])
            held = np.searchsorted(hit, end - 1) - np.searchsorted(hit, near)
            out.append(near[held >= needed])
        return out


def edit_distance_inside(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Least word edit distance of an item to any part of a text, and that part's bounds."""

    def ends(pattern, where):
        steps = np.arange(len(where) + 1)
        row = np.zeros(len(where) + 1, np.int64)
        for i, word in enumerate(pattern, 1):
            fresh = np.empty_like(row)
            fresh[0] = i
            fresh[1:] = np.minimum(row[:-1] + (where != word), row[1:] + 1)
            row = np.minimum.accumulate(fresh - steps) + steps
        return row

    row = ends(item, text)
    end = int(row.argmin())
    back = ends(item[::-1], text[:end][::-1])
    return int(row[end]), end - int(back.argmin()), end


def _search(items: Items, rows: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """``(row of the batch, item, distance, item words, start, end)`` of each batch's leaks."""
    search = items.search
    for batch in rows:
        windows, places = [[] for _ in items.groups], [[] for _ in items.groups]
        texts: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for low, high, data, offsets in textbuf.slices(batch.column(1)):
            found, hashed = _words(data, offsets)
            owner = found.text()
            owner_end = found.first[1:][owner]
            for g, starts in enumerate(items.starts(hashed, owner_end)):
                if not len(starts):
                    continue
                length = items.groups[g][1]
                own = owner[starts]  # in order, as starts are
                for row in own[np.append(True, own[1:] != own[:-1])].tolist():
                    if low + row not in texts:
                        a, b = found.first[row], found.first[row + 1]
                        chars = np.cumsum(textbuf.IS_CHAR[data[offsets[row] : offsets[row + 1]]])
                        # code points before the first and up to the last byte of each word
                        begin = chars[found.begin[a:b] - offsets[row]] - 1
                        end = chars[found.end[a:b] - 1 - offsets[row]]
                        texts[low + row] = items.symbols(hashed[a:b]), begin, end
                # words that are missing at a document's begin shift the rest of an item
                first = starts[starts == found.first[owner[starts]]]
                ahead = np.arange(1, search.edits(length) + 1)
                before = np.concatenate([np.zeros(len(starts), np.int64), np.tile(ahead, len(first))])
                starts = np.concatenate([starts, np.repeat(first, len(ahead))])
                at = (starts - before)[:, None] + np.arange(length + 1)
                inside = (at >= starts[:, None]) & (at < np.minimum(owner_end[starts], starts - before + length)[:, None])
                symbols = np.where(at < starts[:, None], OUTSIDE, END).astype(np.int32)
                symbols[inside] = items.symbols(hashed[at[inside]])
                windows[g].append(symbols)
                places[g].append(np.column_stack([owner[starts] + low, starts - before - found.first[owner[starts]]]))
        met = [np.zeros((0, 3), np.int64)]
        for g, (own, where) in enumerate(zip(windows, places)):
            if own:
                met += _meet(items, g, np.concatenate(own), np.concatenate(where))
        held = np.zeros(len(items.vocabulary) + 2, bool)
        for row, i, starts in _by_item(np.concatenate(met)):
            word, allowed = items.words[i], search.edits(len(items.words[i]))
            symbols, begin, end = texts[row]
            for a, b in _regions(starts, len(word) + 2 * allowed):
                low = max(0, a - allowed)
                for distance, first, last in _passages(word, symbols[low : b + len(word) + 2 * allowed], allowed, held):
                    yield batch, row, i, distance, int(begin[low + first]), int(end[low + last - 1])


def _passages(item: np.ndarray, text: np.ndarray, allowed: int, held: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """``distance, first, last`` of the best passage within the limit, then of those before and after it.

    ``held`` is one false mark for each symbol, to be left so.
    """
    parts = [(0, len(text))]
    while parts:
        low, high = parts.pop()
        if high - low < len(item) - allowed:
            continue
        part = text[low:high]
        # each word of the item that is not there is an edit
        held[part] = True
        missing = len(item) - held[item].sum()
        held[part] = False
        if missing > allowed:
            continue
        distance, first, last = edit_distance_inside(item, part)
        if distance <= allowed and last > first:
            yield distance, low + first, low + last
            parts += [(low, low + first), (low + last, high)]


def _meet(items: Items, g: int, windows: np.ndarray, places: np.ndarray) -> Iterator[np.ndarray]:
    """``text, item, start`` of the windows that meet an item in a table; in bounded portions."""
    rows = max(1, min(1 << 13, (1 << 22) // max(len(items.tables[g]), windows.shape[1])))
    for low in range(0, len(windows), rows):
        part = windows[low : low + rows]
        pairs = []
        for keys, (known, first, own) in zip(items.keys(g, part), items.tables[g]):
            at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            window = np.flatnonzero(known[at] == keys)
            begin, count = first[at[window]], first[at[window] + 1] - first[at[window]]
            place = np.arange(count.sum()) + np.repeat(begin - (np.cumsum(count) - count), count)
            pairs.append(np.repeat(window, count) * len(items.ids) + own[place])
        pairs = np.sort(np.concatenate(pairs))
        pairs = pairs[np.append(True, pairs[1:] != pairs[:-1])] if len(pairs) else pairs
        where = places[low + pairs // len(items.ids)]
        yield np.column_stack([where[:, 0], pairs % len(items.ids), where[:, 1]])


def _by_item(met: np.ndarray) -> Iterator[tuple[int, int, list[int]]]:
    """Starts in order, by text and item."""
    met = met[np.lexsort(met.T[::-1])]
    edges = np.flatnonzero((met[1:, :2] != met[:-1, :2]).any(1)) + 1
    edges = [0, *edges.tolist(), len(met)] if len(met) else []
    rows, items, starts = met.T.tolist()
    for a, b in zip(edges, edges[1:]):
        yield rows[a], items[a], starts[a:b]


def _regions(starts: list[int], gap: int) -> Iterator[tuple[int, int]]:
    """Runs of starts that lie within ``gap`` of each other."""
    first = last = starts[0]
    for start in starts[1:]:
        if start - last > gap:
            yield first, last
            first = start
        last = start
    yield first, last


def _blocks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[tuple[list, list[str]]]:
    """Items in blocks of at most ``ITEM_BYTES``, one longer item apart."""
    ids, texts, size = [], [], 0
    for row in benchmark.select(F.col(item_id).alias("i"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t")).toLocalIterator():
        if ids and size + len(row["t"]) > ITEM_BYTES:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(row["i"])
        texts.append(row["t"])
        size += len(row["t"])
    if ids:
        yield ids, texts


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    search: Search = Search(),
    text: str = "text",
    id_col: str = "doc_id",
    item_id: str = "item_id",
) -> DataFrame:
    """``id_col, item_id, distance, item_words, start, end``: a row per leaked passage, in code points."""
    kind, item_kind = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_id].dataType
    item_type = pa.int64() if item_kind.simpleString() in ("bigint", "int", "smallint", "tinyint") else pa.string()
    names = ["id", "item", "distance", "item_words", "start", "end"]
    schema = f"id {kind}, item {'bigint' if pa.types.is_int64(item_type) else 'string'}, distance bigint, item_words bigint, start bigint, end bigint"
    own = docs.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("__text"))

    def finder(ids: list, texts: list[str]):
        wanted = keys_of(texts, search)

        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = Items(ids, texts, search, wanted)
            for batch in batches:
                found = list(_search(items, iter([batch])))
                if found:
                    _, rows, item, distance, start, end = zip(*found)
                    known = [items.ids[i] for i in item]
                    columns = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(known, item_type)]
                    columns += [pa.array(x, pa.int64()) for x in (distance, [len(items.words[i]) for i in item], start, end)]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

        return find

    parts = [own.mapInArrow(textbuf.released(finder(ids, texts)), schema) for ids, texts in _blocks(benchmark, item_id, text)]
    found = reduce(DataFrame.union, parts) if parts else docs.sparkSession.createDataFrame([], schema)
    return found.select(F.col("id").alias(id_col), F.col("item").cast(item_kind).alias(item_id), *names[2:])
