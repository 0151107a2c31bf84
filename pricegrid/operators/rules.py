"""Categories by a table of rules: thousands of patterns, each tried only where it can match."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from pricegrid.session import stage

# What may follow an element of a pattern, and how elements of more than one character start.
QUANTIFIER = re.compile(r"(?:[?*+]|\{(\d+)(?:,\d*)?\})[?+]?")
ESCAPE = re.compile(r"\\(?:[pPx]\{[^}]*\}|k<[^>]*>|x[0-9a-fA-F]{2}|u[0-9a-fA-F]{4}|c.|0[0-7]{1,3}|[0-9]+|.)", re.DOTALL)
GROUP = re.compile(r"\((?:\?(?:[idmsuU-]*:|>|<[a-zA-Z][a-zA-Z0-9]*>))?(?!\?)")
FLAGS = re.compile(r"\(\?[a-zA-Z-]+\)")
LOOK = re.compile(r"\(\?<?[=!]")

#: characters of the pieces that rules are kept under; a text goes by the largest that fits it
SIZES = (1, 2, 3, 4, 6)
#: parts that names are dealt to where a rule must be tried on all of them
PARTS = 64


def required_texts(pattern: str) -> list[list[str]]:
    """Lists of texts; every match holds at least one text of each list.

    The pieces of a sequence are all required, alternatives count together.
    Where a pattern is not understood, nothing is required.
    """
    if re.search(r"\\Q|\(\?[a-zA-Z]*x", pattern):
        return []
    pieces, end = _pieces(pattern, 0)
    if pattern[end : end + 1] == "|":
        found, end = _alternatives(pattern, 0)
        pieces = [found] if found else []
    return pieces if end == len(pattern) else []


def required_literals(pattern: str) -> list[str]:
    """The list of ``required_texts`` with the longest shortest text; none, if the pattern requires nothing."""
    return _longest(required_texts(pattern))


def _longest(pieces: list[list[str]]) -> list[str]:
    return max(pieces, key=lambda texts: min(map(len, texts)), default=[])


def _alternatives(pattern: str, at: int) -> tuple[list[str], int]:
    pieces, at = _pieces(pattern, at)
    known, texts = bool(pieces), set(_longest(pieces))
    while at < len(pattern) and pattern[at] == "|":
        pieces, at = _pieces(pattern, at + 1)
        known, texts = known and bool(pieces), texts | set(_longest(pieces))
    return (sorted(texts) if known else []), at


def _pieces(pattern: str, at: int) -> tuple[list[list[str]], int]:
    pieces, run = [], ""
    while at < len(pattern) and pattern[at] not in "|)":
        if pattern[at] in "^$":
            at += 1
            continue
        if flags := FLAGS.match(pattern, at):
            at = flags.end()
            continue
        if look := LOOK.match(pattern, at):
            at = _alternatives(pattern, look.end())[1] + 1
            continue
        element: str | list[str] = []
        if pattern[at] == "\\":
            escape = ESCAPE.match(pattern, at)
            if not escape:
                return [], len(pattern) + 1
            at, name = escape.end(), escape[0][1]
            if name in "bBAzZG":
                continue
            if not name.isalnum():
                element = name
        elif pattern[at] == "[":
            at = _class_end(pattern, at)
        elif group := GROUP.match(pattern, at):
            element, at = _alternatives(pattern, group.end())
            at += 1
        elif pattern[at] == "(":
            return [], len(pattern) + 1
        else:
            element = "" if pattern[at] == "." else pattern[at]
            at += 1
        times = QUANTIFIER.match(pattern, at)
        never = bool(times) and (times[0][0] in "?*" or times[1] is not None and int(times[1]) == 0)
        if times:
            at = times.end()
        if isinstance(element, str) and element and not never:
            run += element
        if times or not (isinstance(element, str) and element):
            pieces.append([run] if run else [])
            run = ""
        if isinstance(element, list) and element and not never:
            pieces.append(element)
    pieces.append([run] if run else [])
    return [p for p in pieces if p], at


def _class_end(pattern: str, at: int) -> int:
    """Where a character class ends; classes may lie in classes."""
    depth, at = 0, at
    while at < len(pattern):
        if pattern[at] == "\\":
            at += 1
        elif pattern[at] == "[":
            depth += 1
        elif pattern[at] == "]":
            depth -= 1
            if not depth:
                return at + 1
        at += 1
    return at


def _folded(text: Column) -> Column:
    """One form for all letters that a pattern without case takes for the same."""
    # Spark takes a change of case right after another one for needless; these are not
    return F.translate(F.lower(F.translate(F.upper(text), "İ", "I")), "ς", "σ")


def _grams(text: Column, size: int | Column) -> Column:
    """Distinct pieces of ``size`` characters; none, if the text is shorter."""
    starts = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - size + 1))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, F.lit(size) if isinstance(size, int) else size)))


def _with_literals(rules: DataFrame) -> DataFrame:
    """Rules with each text of each list they require, NULL where nothing is required."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [[(i, t) for i, found in enumerate(required_texts(p)) for t in found] or [(None, None)] for p in batch.pattern]
            rows = batch.assign(text=texts).explode("text", ignore_index=True)
            yield rows.assign(piece=rows.text.str[0].astype("Int32"), literal=rows.text.str[1]).drop(columns="text")

    return rules.mapInPandas(read, "rule_no bigint, pattern string, category string, piece int, literal string")


def _usable(rules: DataFrame) -> DataFrame:
    return rules.select(F.col("rule_no").cast("bigint"), "pattern", "category").filter("rule_no is not null and pattern is not null")


def matching_rules(names: DataFrame, rules: DataFrame) -> DataFrame:
    """``name, rule_no, category`` of all rules that match; names are taken as distinct.

    Of each text that a rule requires, the rarest piece among the names is taken,
    and of the lists of texts the one whose pieces fewest names hold. Under these
    pieces the rule is kept and meets the names that hold them by an equality
    join; of those it is tried on the ones that hold the whole text. Rules that
    require nothing are tried on all names, dealt out in parts.
    """
    read = stage(_with_literals(_usable(rules)).withColumn("literal", _folded(F.col("literal"))), "rules")
    known, unknown = read.filter("literal is not null"), read.filter("literal is null")

    length = F.length("literal")
    size = F.coalesce(*[F.when(length >= n, n) for n in reversed(SIZES)])
    keys = known.withColumn("gram", F.explode(_grams(F.col("literal"), size)))
    folded = names.select("name", _folded(F.col("name")).alias("folded"))
    pieces = F.array_distinct(F.flatten(F.array(*[F.coalesce(_grams(F.col("folded"), n), F.array().cast("array<string>")) for n in SIZES])))
    held = folded.select("name", F.explode(pieces).alias("gram"))
    # written, as it is read twice and so that a piece that very many names hold can be split in the join
    held = stage(held.join(keys.select("gram").distinct(), "gram", "left_semi"), "pieces")
    counts = held.groupBy("gram").agg(F.count("*").alias("n"))
    rule, n = ["rule_no", "pattern", "category"], F.coalesce("n", F.lit(0))
    rarest = F.min_by("gram", F.struct(n, F.col("gram"))).alias("gram")
    texts = keys.join(counts, "gram", "left").groupBy(*rule, "piece", "literal").agg(rarest, F.min(n).alias("n"))
    lists = texts.groupBy(*rule, "piece").agg(F.sum("n").alias("n"), F.collect_list(F.struct("literal", "gram")).alias("texts"))
    kept = lists.groupBy(*rule).agg(F.min_by("texts", F.struct("n", "piece")).alias("texts")).select(*rule, F.inline("texts"))
    met = stage(kept, "kept").join(held, "gram").filter(F.contains(_folded(F.col("name")), F.col("literal")))

    part = F.pmod(F.xxhash64("name"), F.lit(PARTS))
    everywhere = unknown.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    tried = names.select("name", part.alias("part")).join(everywhere.withColumn("part", F.col("part").cast("bigint")).hint("shuffle_hash"), "part")
    columns = ["name", "rule_no", "pattern", "category"]
    both = met.select(*columns).unionByName(tried.select(*columns))
    return both.filter(F.expr("name rlike concat('(?iu)', pattern)")).select("name", "rule_no", "category")


def categorise_by_rules(products: DataFrame, rules: DataFrame, default: str = "other") -> DataFrame:
    """Add the ``category`` of the lowest-numbered rule of a table ``rule_no, pattern, category`` that matches a product's ``name``.

    Each different name is looked at once, and each different pattern: of the
    rules that share one, only the lowest can hold. Patterns are those of
    ``rlike``, without regard to case. Rules without a number or a pattern do
    not count; of two with one number the lower category holds.
    """
    names = stage(products.filter("name is not null").select("name").distinct(), "names")
    lowest = _usable(rules).groupBy("pattern").agg(F.min(F.struct("rule_no", "category")).alias("rule"))
    best = matching_rules(names, lowest.select("rule.rule_no", "pattern", "rule.category"))
    best = best.groupBy("name").agg(F.min(F.struct("rule_no", "category")).alias("rule"))
    found = best.select("name", F.col("rule.category").alias("category"))
    return products.join(found, "name", "left").select(*products.columns, F.coalesce("category", F.lit(default)).alias("category"))
