import random
import re
import zlib
from fractions import Fraction

import pytest
from llm.conftest import docs_of, prose
from pricegrid.llm.periodic_runs import Repetition, periodic_runs
from pricegrid.llm.queries import op11_periodic_runs, repeated_tails

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def runs_of(words, rule=Repetition()):
    """Every diagonal, word by word."""
    out = {}
    for lag in range(1, len(words) // rule.min_periods + 1):
        matched = 0
        for i in range(lag, len(words) + 1):
            if i < len(words) and words[i] == words[i - lag]:
                matched += 1
                continue
            if matched + lag >= max(rule.min_words, rule.min_periods * lag):
                stretch = (i - matched - lag, matched + lag)
                out.setdefault(stretch, lag)  # the smallest lag comes first
            matched = 0
    return sorted((start, length, lag) for (start, length), lag in out.items())


def collapsed(words, runs):
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def check(spark, texts, rule=Repetition()):
    found = 0
    for r in periodic_runs(docs_of(spark, texts), rule).collect():
        words = WORD.findall(texts[r["doc_id"]] or "")
        expected = runs_of(words, rule)
        assert [tuple(x) for x in r["runs"]] == expected
        assert r["n_words"] == len(words)
        assert r["collapsed"] == collapsed(words, expected)
        found += len(expected)
    return found


def woven(seed, alphabet, size):
    """Words of a small alphabet with periodic stretches of all sizes, which overlap and follow one another."""
    pick, out = random.Random(seed), []
    while len(out) < size:
        kind = pick.random()
        if kind < 0.3:
            out += pick.choices(alphabet, k=pick.randint(1, 30))
        elif kind < 0.9:
            period = pick.choices(alphabet, k=pick.choice([1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 31, 33, 40, 70]))
            out += (period * 12)[: pick.randint(2 * len(period), 5 * len(period) + 9)]
        else:
            start = pick.randrange(len(out) + 1)
            out += out[start : start + pick.randint(5, 60)]
    return " ".join(out)


@pytest.mark.parametrize("rule", [Repetition(), Repetition(10, 3), Repetition(24, 5), Repetition(2, 3)])
def test_all_diagonals(spark, rule):
    texts = [woven(seed, list("abcdefgh"[: 2 + seed % 7]), 400) for seed in range(40)]
    assert check(spark, texts, rule) > 30


def test_borders(spark):
    """Lengths around the least one, runs at both ends and side by side, periods in periods."""
    texts = []
    for period in (1, 2, 5, 8, 9, 16, 17, 40):
        for more in (-1, 0, 1):
            unit = [f"w{i}" for i in range(period)]
            length = max(24, 3 * period) + more
            run = (unit * (length // period + 1))[:length]
            texts += [" ".join(run), " ".join(["x", *run, "y"]), " ".join(run + run[::-1] + run)]
    nested = (["a"] * 30 + ["b"]) * 4
    texts += [" ".join(nested), " ".join(nested + ["a"] * 24), " ".join((["a", "b"] * 13 + ["c"] * 25) * 3)]
    assert check(spark, texts) > 30


def test_very_long_repeats(spark):
    """A word, and a phrase, again and again: work must not grow with their number's square."""
    texts = ["again " * 400_000, "one two three " * 100_000, prose(1, 50_000), "a b " * 50_000 + prose(2, 500) + " a" * 50_000]
    rows = {r["doc_id"]: r for r in periodic_runs(docs_of(spark, texts)).collect()}
    assert [tuple(x) for x in rows[0]["runs"]] == [(0, 400_000, 1)] and rows[0]["collapsed"] == "again"
    assert [tuple(x) for x in rows[1]["runs"]] == [(0, 300_000, 3)]
    assert rows[2]["runs"] == [] and rows[2]["collapsed"] == " ".join(texts[2].split())
    assert [tuple(x)[1:] for x in rows[3]["runs"]] == [(100_000, 2), (50_000, 1)]


def test_undefined_input(spark, edge_docs, no_docs):
    assert check(spark, [None, "", " \t\n", "a", "É" * 100, "ab\x1ccd\x85ef " * 30, " a\n" * 24]) == 2
    rows = periodic_runs(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    assert periodic_runs(no_docs).collect() == []
    empty = docs_of(spark, [None, ""])
    assert [(r["n_words"], r["runs"], r["collapsed"]) for r in periodic_runs(empty).collect()] == [(0, [], "")] * 2


def test_contexts_need_three_periods():
    with pytest.raises(ValueError):
        Repetition(24, 2)


def test_query_against_brute_force(spark, sf_dir, documents):
    """The tails, and the digest columns of every document."""
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    tails = {r["doc_id"]: r["text"] for r in repeated_tails(documents).collect()}
    n_runs = 0
    for r in op11_periodic_runs(spark, sf_dir).collect():
        h = zlib.crc32(str(r["doc_id"]).encode())
        words = WORD.findall(texts[r["doc_id"]] or "")
        if h % 10 == 0 and words:
            g = h // 10
            a = g % len(words)
            p = 1 + (len(words) - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        assert WORD.findall(tails[r["doc_id"]] or "") == words
        runs = runs_of(words) if len(words) < 3000 or h % 10 == 0 else None
        if runs is not None:
            assert r["n_runs"] == len(runs)
            best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None,) * 3)
            assert (r["start"], r["length"], r["period"]) == best
            assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        n_runs += r["n_runs"]
    assert n_runs
