"""Quality rules from tokeniser fertility.

Public vocabularies are used as measuring rods. A text in a language that a
vocabulary knows needs few tokens for its characters, hardly any byte
fallbacks, and uses its tokens evenly. Shouting, symbol noise and broken
encodings need many short tokens; repetition uses few distinct ones.

Three measures a vocabulary: characters per token, share of byte-fallback
tokens, and the entropy of the text's tokens as a share of what as many tokens
can reach. Long texts repeat more of their tokens, so entropy is that of stretches
of at most ``STRETCH`` tokens, on average; with it no measure drifts as texts get
longer. Bands come from the whole corpus: in each language the quartiles of each
measure, read off a histogram of fixed bins, are widened by ``reach``
interquartile ranges. Short texts vary more, so texts are compared with those of
their language whose number of tokens has the same power of two, all texts of
``STRETCH`` tokens and more being one size. Texts outside a band are rejected.

Every size of every language has a band, by one rule at every count: its
quartiles lean on those of the language as if these were ``lean`` texts more, and
a language's on those of all languages. Where the two disagree the band is wider
by the deviation between them, since few texts prove neither.

Defined results. A null text is an empty text: zero counts, null measures,
``base_failed``. A null or unseen language is a group of its own. Bands only
judge texts of ``min_tokens`` tokens. Repeated rows stay repeated and
count each time. Only the named columns are read, so extra columns of any name
do no harm. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from pricegrid.llm import textbuf
from pricegrid.llm.white_runs import encode_ordinary
from pricegrid.session import stage

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
BINS = 1000
#: tokens that entropy is measured over, a power of two
STRETCH = 1024

# The characters counted as symbols.
SYMBOLS = textbuf.byte_class(b"#*$%&|<>")


@dataclass(frozen=True)
class Vocabulary:
    """A public vocabulary file. ``kind`` is the library that reads it."""

    name: str
    path: str
    kind: str = "sentencepiece"


@dataclass(frozen=True)
class Bands:
    reach: float = 2.25
    min_tokens: int = 30
    lean: float = 20.0


BASE = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"


def base_counts(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Words, characters in words, symbols, repeated lines and repeated words of each text."""
    found = textbuf.words(data, offsets)
    n_words = np.diff(found.first)
    in_words = textbuf.IS_WORD[data]
    hashed = textbuf.RangeHash(data)
    return [
        n_words,
        textbuf.counts(in_words & textbuf.IS_CHAR[data], offsets),
        textbuf.counts(SYMBOLS[data], offsets),
        _repeated_lines(data, offsets, in_words, hashed),
        _repeated_words(found, hashed),
    ]


def _repeated_lines(data, offsets, in_words, hashed) -> np.ndarray:
    texts = len(offsets) - 1
    breaks = np.flatnonzero(data == 10)
    begin = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    text = np.searchsorted(offsets, begin, "right") - 1
    # a break that ends a text opens an empty line in the next one's place: no word in it
    end = np.minimum(np.append(begin[1:], len(data)), offsets[np.minimum(text + 1, texts)])
    has_break = (end > begin) & (data[np.maximum(end, 1) - 1] == 10) if len(data) else np.zeros(len(begin), bool)
    end = end - has_break
    filled = np.zeros(len(data) + 1, np.int64)
    np.cumsum(in_words, out=filled[1:])
    keep = (end > begin) & (filled[end] > filled[begin])
    begin, end, text = begin[keep], end[keep], text[keep]
    key = textbuf.mix(hashed(begin, end) + text.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    _, first = np.unique(key, return_index=True)
    again = np.ones(len(key), bool)
    again[first] = False
    return np.bincount(text[again], minlength=texts)


def _repeated_words(found: textbuf.Words, hashed) -> np.ndarray:
    texts = len(found.first) - 1
    triples, start = textbuf.windows(hashed(found.begin, found.end), found, 3)
    owner = found.text()
    key = textbuf.mix(triples + owner[start].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(owner), bool)
    at = start[twice]
    for k in range(3):
        covered[at + k] = True
    return np.bincount(owner[covered], minlength=texts)


class _Measure:
    """Reads one vocabulary; gives a text's tokens, fallbacks and entropy share."""

    def __init__(self, vocabulary: Vocabulary):
        if vocabulary.kind == "sentencepiece":
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=vocabulary.path)
            self.fallback = np.array([model.is_byte(i) for i in range(model.get_piece_size())])
            self.encode = lambda texts: model.encode(texts, num_threads=1)
        elif vocabulary.kind == "tiktoken":
            import base64

            import tiktoken
            from public_tokenizers import PATTERN

            with open(vocabulary.path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            model = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
            # a lone byte outside ASCII stands for a part of a character
            self.fallback = np.zeros(max(ranks.values()) + 1, bool)
            self.fallback[[i for piece, i in ranks.items() if len(piece) == 1 and piece[0] > 127]] = True
            self.encode = lambda texts: [encode_ordinary(model, text) for text in texts]
        else:
            raise ValueError(f"no reader for vocabularies of kind {vocabulary.kind!r}")

    def __call__(self, texts: list[str]) -> tuple[list[int], list[int], list[float]]:
        tokens, fallbacks, entropy = [], [], []
        for ids in self.encode(texts):
            ids = np.array(ids, np.int64)
            tokens.append(len(ids))
            fallbacks.append(int(self.fallback[ids].sum()) if len(ids) else 0)
            entropy.append(_entropy_share(ids, len(self.fallback)))
        return tokens, fallbacks, entropy


def _entropy_share(ids: np.ndarray, vocabulary: int) -> float:
    """Entropy of stretches of about equal length, as a share of the highest; on average over all of them."""
    if len(ids) < 2:
        return 1.0
    stretches = -(-len(ids) // STRETCH)
    stretch = np.arange(len(ids)) * stretches // len(ids)
    key, seen = np.unique(stretch * vocabulary + ids, return_counts=True)
    size = np.bincount(stretch)
    bits = np.log2(size) - np.bincount(key // vocabulary, seen * np.log2(seen)) / size
    return float((bits / np.log2(size)).mean())


def measures(
    docs: DataFrame,
    vocabularies: list[Vocabulary],
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id", "lang"),
) -> DataFrame:
    """``keep`` columns, base counts, and tokens, fallbacks and entropy share by vocabulary."""
    fields = [f for f in docs.schema.fields if f.name in keep]
    fields = sorted(fields, key=lambda f: keep.index(f.name))
    own = ", ".join(f"`t{i}` bigint, `f{i}` bigint, `e{i}` double" for i in range(len(vocabularies)))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    schema = f"{columns}, n_chars_ bigint, {BASE}, {own}"

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rods = [_Measure(v) for v in vocabularies]
        for batch in batches:
            column = batch.column(len(fields))
            for low, high, data, offsets in textbuf.slices(column):
                own = [textbuf.counts(textbuf.IS_CHAR[data], offsets), *base_counts(data, offsets)]
                texts = [x or "" for x in column.slice(low, high - low).to_pylist()]
                arrays = [batch.column(i).slice(low, high - low) for i in range(len(fields))]
                arrays += [pa.array(x.astype(np.int64)) for x in own]
                for rod in rods:
                    tokens, fallbacks, entropy = rod(texts)
                    arrays += [pa.array(tokens, pa.int64()), pa.array(fallbacks, pa.int64()), pa.array(entropy, pa.float64())]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    names = [f.name for f in fields] + ["n_chars_", *(x.split()[0] for x in BASE.split(", "))]
    names += [f"{x}{i}" for i in range(len(vocabularies)) for x in "tfe"]
    return docs.select(*(f"`{f.name}`" for f in fields), F.col(text).cast("string").alias("__text")).mapInArrow(textbuf.released(measure), schema)


def _ratios(i: int) -> dict[str, F.Column]:
    """The three measures of vocabulary ``i``, each on a scale from 0 to 1 for the histogram."""
    tokens = F.nullif(F.col(f"t{i}"), F.lit(0)).cast("double")
    return {
        f"chars_per_token_{i}": F.least(F.col("n_chars_") / tokens / 16, F.lit(1.0)),
        f"fallback_share_{i}": F.col(f"f{i}") / tokens,
        f"entropy_share_{i}": F.col(f"e{i}"),
    }


def _size() -> F.Column:
    """The power of two of a text's tokens, up to that of a stretch."""
    return F.floor(F.log2(F.least(F.greatest("t0", F.lit(1)), F.lit(STRETCH)))).cast("int")


def _quartiles(binned: DataFrame, *group: str) -> DataFrame:
    """``group, texts, q1, q3``: quartiles of each group's histogram."""
    by_group = W.partitionBy(*group)
    summed = binned.groupBy(*group, "bin").agg(F.sum("n").alias("n"))
    ranked = summed.withColumn("so_far", F.sum("n").over(by_group.orderBy("bin"))).withColumn("total", F.sum("n").over(by_group))
    at = lambda q: F.min(F.when(F.col("so_far") >= F.col("total") * q, F.col("bin")))
    return ranked.groupBy(*group).agg(at(0.25).alias("q1"), at(0.75).alias("q3"), F.max("total").alias("texts"))


def rejection_bands(measured: DataFrame, n: int, bands: Bands, lang: str) -> DataFrame:
    """``lang, size, measure, low, high`` of every language and size that occurs.

    Quartiles are those of a histogram with ``BINS`` bins over all texts, so
    what is shuffled is bounded by languages, sizes and bins.
    """
    ratios = {k: v for i in range(n) for k, v in _ratios(i).items()}
    long = F.explode(F.array(*(F.struct(F.lit(k).alias("measure"), F.floor(v * BINS).cast("int").alias("bin")) for k, v in ratios.items())))
    judged = measured.filter(F.col("t0") >= bands.min_tokens)
    binned = (
        judged.select(F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"), _size().alias("size"), long.alias("m"))
        .groupBy("lang", "size", "m.measure", "m.bin")
        .agg(F.count("*").alias("n"))
    )
    binned = stage(binned, "histograms")
    quartiles = F.struct("q1", "q3", "texts")
    own = _quartiles(binned, "lang", "size", "measure").select("lang", "size", "measure", quartiles.alias("own"))
    one = _quartiles(binned, "lang", "measure").select("lang", "measure", quartiles.alias("one"))
    every = _quartiles(binned, "measure").select("measure", quartiles.alias("every"))
    lean = F.lit(bands.lean)
    # how much a size's texts, and a language's, say for themselves
    of_size, of_lang = F.col("own.texts") / (F.col("own.texts") + lean), F.col("one.texts") / (F.col("one.texts") + lean)
    mixed = lambda share, a, b: share * a + (1 - share) * b
    q1, q3 = (mixed(of_size, F.col(f"own.{q}"), mixed(of_lang, F.col(f"one.{q}"), F.col(f"every.{q}"))) for q in ("q1", "q3"))
    middle = lambda x: (F.col(f"{x}.q1") + F.col(f"{x}.q3")) / 2
    # the deviation between the middles of what is mixed
    by_size = F.abs(middle("own") - middle("one")) * F.sqrt(of_size * (1 - of_size))
    by_lang = F.abs(middle("one") - middle("every")) * F.sqrt(of_lang * (1 - of_lang)) * (1 - of_size)
    # measures that hardly vary: at least three bins, and two hundredths for fallbacks, as a passage in
    # another script is no broken encoding
    least = F.when(F.col("measure").startswith("fallback_share"), BINS // 50).otherwise(3)
    spread = (F.greatest(q3 - q1 + 1, least) + by_size + by_lang) * bands.reach
    joined = own.join(one.hint("merge"), ["lang", "measure"]).join(F.broadcast(every), "measure")  # a row per measure
    return joined.select("lang", "size", "measure", ((q1 - spread) / BINS).alias("low"), ((q3 + 1 + spread) / BINS).alias("high"))


def quality_rules(
    docs: DataFrame,
    vocabularies: list[Vocabulary],
    bands: Bands = Bands(),
    text: str = "text",
    lang: str = "lang",
    key: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """Counts, measures and verdict of every document; see the module's text.

    Texts are read and tokenised once: what was measured is written to the
    shared folder, and both bands and verdicts come from there.
    """
    names = tuple(dict.fromkeys((*key, lang)))
    measured = stage(measures(docs, vocabularies, text, names), "fertility")
    n = len(vocabularies)
    limits = rejection_bands(measured, n, bands, lang)
    by_group = limits.groupBy("lang", "size").agg(F.map_from_entries(F.collect_list(F.struct("measure", F.struct("low", "high")))).alias("__limits"))
    # written, so that Spark knows its size: a small one is broadcast and documents are not shuffled by language
    by_group = stage(by_group.withColumnsRenamed({"lang": "__lang", "size": "__size"}), "bands")
    judged = (
        measured.withColumn("__lang", F.coalesce(F.col(lang).cast("string"), F.lit("")))
        .withColumn("__size", _size())
        .join(by_group, ["__lang", "__size"], "left")
    )
    inside = F.lit(True)
    for i in range(n):
        for name, value in _ratios(i).items():
            limit = F.col("__limits")[name]
            inside = inside & (limit.isNull() | value.between(limit["low"], limit["high"]))
    in_bands = (F.col("t0") < bands.min_tokens) | inside
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    shown = []
    for i, vocabulary in enumerate(vocabularies):
        tokens = F.nullif(F.col(f"t{i}"), F.lit(0))
        shown += [
            (F.col("n_chars_") / tokens).alias(f"chars_per_token_{vocabulary.name}"),
            (F.col(f"f{i}") / tokens).alias(f"fallback_share_{vocabulary.name}"),
            F.when(tokens.isNotNull(), F.col(f"e{i}")).alias(f"entropy_share_{vocabulary.name}"),
        ]
    return judged.select(
        *key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & F.coalesce(in_bands, F.lit(True))).alias("kept"), *shown,
    )
