"""Secret scans: fixed patterns, and character Markov models of random strings.

Three kinds come from patterns: ``assign`` (a key word with a value), ``access``
(access key ids) and ``hex``. A fourth, ``markov``, is any long run of token
characters that a Markov model of random strings explains better than one of
ordinary identifiers, by a log-likelihood ratio over its character pairs. Both
models are learnt from labelled samples. A sample's label is where it stands, not
whether it has digits: values that the patterns give away are random, other runs of
token characters are ordinary unless their classes of characters change too often. What the samples
of identifiers never show (a date in a path, a version, a capital inside a name) is
rated by classes of characters. A random string of lower-case letters alone differs
little from a word in each pair and takes some 30 characters to be told. All that leaves the cluster is one count per label
and pair of characters, at most twice 68 by 68 numbers.

Everything is DataFrame functions. A pattern's places come from the lengths of
what it matches and of what lies between, added up in two levels, so a text
with very many matches costs little more than its length.

Defined results. A null text is an empty text, without spans. Offsets count
code points; ends are exclusive. A markov span that overlaps a span of the
three kinds is left out. Rows stay as they are, repeated ones and null ids
included. Without any sample the random model is uniform and the other goes by
classes alone. Only the named columns are read; columns that the result adds replace
none of the others' names. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

# The patterns, their least lengths, and the order of kinds.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "markov")

# The characters of tokens.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-."
TOKEN = "[A-Za-z0-9+/_=-]"

#: chance that a letter or digit of an identifier is followed by one of its own class, where no sample tells
STAY = 0.7

MASK = "<secret>"


def _sums_before(lengths: Column) -> Column:
    def of_short(a: Column) -> Column:
        nothing = F.struct(F.lit(0).alias("sum"), F.expr("cast(array() as array<int>)").alias("out"))
        step = lambda acc, x: F.struct((acc["sum"] + x).alias("sum"), F.concat(acc["out"], F.array(acc["sum"])).alias("out"))
        return F.aggregate(a, nothing, step, lambda acc: acc["out"])

    block = 128
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / block).cast("int")), lambda b: F.slice(lengths, b * block + 1, block)
    )
    totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda s, x: s + x))
    return F.flatten(F.zip_with(blocks, of_short(totals), lambda b, before: F.transform(of_short(b), lambda x: x + before)))


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """Array of ``(start, end, found)``, leftmost and not overlapping; ``found`` is a group of the match."""
    between = F.transform(F.split(text, pattern, -1), F.length)
    whole = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length)
    # lengths in the order of the text: gap, match, gap, match, ...
    steps = F.zip_with(F.slice(between, 1, F.size(whole)), whole, lambda gap, size: F.struct(gap.alias("gap"), size.alias("size")))
    before = _sums_before(F.transform(steps, lambda s: s["gap"] + s["size"]))
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    placed = F.zip_with(before, steps, lambda b, s: F.struct((b + s["gap"]).alias("start"), (b + s["gap"] + s["size"]).alias("end")))
    spans = F.zip_with(placed, found, lambda p, f: F.struct(p["start"].alias("start"), p["end"].alias("end"), f.alias("found")))
    none = F.expr("cast(array() as array<struct<start:int,end:int,found:string>>)")
    return F.when(text.rlike(pattern), spans).otherwise(none)


def with_base_spans(docs: DataFrame, text: Column) -> DataFrame:
    """Add ``__text`` and the spans ``__assign``, ``__access`` and ``__hex``."""
    return docs.withColumns({"__text": F.coalesce(text.cast("string"), F.lit(""))}).withColumns(
        {
            "__assign": F.filter(matches(F.col("__text"), ASSIGN, 2), lambda m: F.length(m["found"]) >= ASSIGN_VALUE),
            "__access": matches(F.col("__text"), ACCESS),
            "__hex": matches(F.col("__text"), HEX),
        }
    )


# Models


@dataclass(frozen=True)
class MarkovPair:
    """Log-likelihood ratios of character pairs, row by row of the alphabet."""

    ratios: tuple[float, ...]

    def score(self, token: Column) -> Column:
        """Log-likelihood ratio of a token: above zero, it looks more like a random string."""
        table = F.split(F.lit(",".join(f"{x:.6f}" for x in self.ratios)), ",").cast("array<double>")
        # split by an empty pattern gives single characters
        codes = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c))
        n = F.size(codes)
        pairs = F.zip_with(
            F.slice(codes, 1, F.greatest(n - 1, F.lit(0))), F.slice(codes, 2, F.greatest(n - 1, F.lit(0))),
            lambda a, b: F.when((a > 0) & (b > 0), F.get(table, (a - 1) * len(ALPHABET) + b - 1)).otherwise(0.0),
        )
        return F.aggregate(pairs, F.lit(0.0), lambda s, x: s + x)


def labelled_samples(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(token, label)`` from documents: values that patterns give away, and other long runs of token characters."""
    found = with_base_spans(docs.select(F.col(text)), F.col(text))
    values = F.concat("__assign", "__access", "__hex")
    random = F.filter(F.transform(values, lambda m: m["found"]), lambda v: F.length(v) >= 16)
    rest = F.regexp_replace("__text", f"{ASSIGN}|{ACCESS}|{HEX}", " ")
    runs = F.regexp_extract_all(rest, F.lit(TOKEN + "{12,}"), F.lit(0))
    # a secret without a key word must not teach what is ordinary, so classes of characters have a say first
    words = F.filter(runs, lambda run: _pair_of({}).score(run) <= 0)
    labelled = lambda tokens, label: F.transform(tokens, lambda t: F.struct(t.alias("token"), F.lit(label).alias("label")))
    return found.select(F.explode(F.concat(labelled(random, 1), labelled(words, 0))).alias("s")).select("s.token", "s.label")


def _class_of(character: str) -> str:
    return "lower" if character.islower() else "upper" if character.isupper() else "digit" if character.isdigit() else "sign"


def _by_class(a: str, b: str) -> float:
    """Chance of ``b`` after ``a`` in an identifier, from their classes only."""
    mine, other = _class_of(a), _class_of(b)
    chance = 0.25 if mine == "sign" else STAY if mine == other else (1 - STAY) / 3
    return chance / sum(_class_of(c) == other for c in ALPHABET)


def _pair_of(seen: dict[tuple[int, str], int]) -> MarkovPair:
    """Both models from counts of ``(label, pair)``; without any, from what they assume."""
    size, ratios = len(ALPHABET), []
    for a in ALPHABET:
        totals = [sum(seen.get((label, a + b), 0) for b in ALPHABET) for label in (0, 1)]
        for b in ALPHABET:
            chance = []
            for label, (assumed, share) in enumerate([(_by_class(a, b), 0.1), (1 / size, 0.5)]):
                own = seen.get((label, a + b), 0) / totals[label] if totals[label] else assumed
                chance.append((1 - share) * own + share * assumed)
            ratios.append(math.log(chance[1] / chance[0]))
    return MarkovPair(tuple(ratios))


def train(samples: DataFrame) -> MarkovPair:
    """Learn both models from all ``(token, label)`` rows; label 1 is random.

    A model mixes what it saw after a character with what it assumes: half uniform
    for random strings, as a new generator may use other characters, a tenth by
    classes for identifiers. Where it saw nothing, the assumption stands alone.
    """
    letters = F.split("token", "")
    n = F.greatest(F.size("letters") - 1, F.lit(0))
    pairs = F.zip_with(F.slice("letters", 1, n), F.slice("letters", 2, n), lambda a, b: F.concat(a, b))
    counted = (
        samples.filter("token is not null")
        .withColumn("letters", letters)
        .select("label", F.explode(pairs).alias("pair"))
        .groupBy("label", "pair")
        .agg(F.count("*").alias("n"))
        .filter(F.col("pair").rlike(r"^[A-Za-z0-9+/_=.-]{2}$"))
    )
    seen = {(row["label"], row["pair"]): row["n"] for row in counted.collect()}
    return _pair_of(seen)


# Scan


def _in_order(spans: Column) -> Column:
    return F.array_sort(spans)


def _as_text(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    one = lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def scan(
    docs: DataFrame,
    model: MarkovPair,
    text: str = "text",
    min_length: int = 20,
    threshold: float = 12.0,
) -> DataFrame:
    """Add ``__text`` and the arrays ``__base`` and ``__spans`` of ``(start, kind, end)``, in order."""
    found = with_base_spans(docs, F.col(text))

    def of_kind(spans: Column, kind: int) -> Column:
        return F.transform(
            spans, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end"))
        )

    base = F.concat(*(of_kind(F.col(f"__{name}"), kind) for kind, name in enumerate(KINDS[:3])))
    likely = F.filter(matches(F.col("__text"), TOKEN + f"{{{min_length},}}"), lambda m: model.score(m["found"]) > threshold)
    apart = lambda m: ~F.exists("__base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"]))
    return (
        found.withColumn("__base", _in_order(base))
        .withColumn("__markov", F.filter(of_kind(likely, 3), apart))
        .withColumn("__spans", _in_order(F.concat("__base", "__markov")))
    )


def find_secrets(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Counts and spans of every document, with models learnt from all of them."""
    own = docs.select(F.col(id_col), F.col(text))
    found = scan(own, train(labelled_samples(own, text)), text)
    return found.select(
        id_col,
        *(F.size(f"__{kind}").cast("bigint").alias(f"n_{kind}") for kind in KINDS[:3]),
        F.sha2(_as_text(F.col("__base")).cast("binary"), 256).alias("base_sha256"),
        _as_text(F.col("__spans")).alias("spans"),
    )


def mask_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with every span replaced by ``MASK``; null texts stay null."""
    found = scan(docs, train(labelled_samples(docs, text)), text)
    nothing = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        kept = F.substring(F.col("__text"), acc["at"] + 1, s["start"] - acc["at"])
        # a span inside or across the last one only moves the end
        out = F.when(s["start"] >= acc["at"], F.concat(acc["out"], kept, F.lit(MASK))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    rest = lambda acc: F.concat(acc["out"], F.substring(F.col("__text"), acc["at"] + 1, F.length("__text")))
    masked = F.when(F.size("__spans") > 0, F.aggregate("__spans", nothing, step, rest)).otherwise(F.col(text))
    return found.withColumn(text, masked).select(*(f"`{c}`" for c in docs.columns))
