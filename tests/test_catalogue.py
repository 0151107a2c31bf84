import datetime
import random
import re

import pytest
from hypothesis import given, settings, strategies as st

from pricegrid.operators.catalog import categorise, product_search
from pricegrid.operators.intervals import overlaps
from pricegrid.operators import rules as rule_tables
from pricegrid.operators.rules import categorise_by_rules, matching_rules, required_literals
from pricegrid.operators.search_index import search_index, write_index
from pricegrid.session import scratch_dir

LITERALS = {
    r"\bring\b": ["ring"],
    r"\b(bolt|rod|plate)\b": ["bolt", "plate", "rod"],
    r"^(hot|cold)\b": ["cold", "hot"],
    "abc": ["abc"],
    "ab?c": ["a"],
    "ab+cd": ["ab"],
    "ab{0,3}cde": ["cde"],
    "a{2}b": ["a"],
    "(?i)milk": ["milk"],
    r"no\. 0*7\b": ["no. "],
    "(abc)?": [],
    "a|": [],
    "(abc|x)(longer|longest)": ["longer", "longest"],
    "[abc]def[^]]gh": ["def"],
    r"[a[b-d]&&[^x]]\]yz": ["]yz"],
    r"\p{L}\x41\u0041qu": ["qu"],
    "(?=abc)de(?!fgh)": ["de"],
    r"\Qa.b\E": [],
    "(?x) a b c": [],
    "a(b": [],
    ".*": [],
    "x.y": ["x"],
    "(?<name>one|two)": ["one", "two"],
}


@pytest.mark.parametrize("pattern", LITERALS)
def test_required_literals(pattern):
    assert required_literals(pattern) == LITERALS[pattern]


ATOMS = st.sampled_from(["a", "b", "ab", "ba", "a?", "b*", "a+", "(a|b)", "(ab|c)?", "[ab]", "\\b", "c{2}", "(?:a|bc)", "."])


@settings(max_examples=300, deadline=None)
@given(st.lists(ATOMS, min_size=1, max_size=5), st.text("abc ", max_size=12))
def test_every_match_holds_a_required_literal(atoms, text):
    pattern = "".join(atoms)
    found = required_literals(pattern)
    if found and re.search(pattern, text):
        assert any(f in text for f in found)


def test_rules_from_a_table(spark):
    pick = random.Random(4)
    words = ["bolt", "ring", "rod", "plate", "gear", "hot", "cold", "Ölkanne", "ſalt", "ΟΔΟΣ", "x", "7"]
    names = [" ".join(pick.choices(words, k=pick.randint(1, 4))) + pick.choice(["", " no. 17", "s"]) for _ in range(300)] + [None, "", "ring", "ring"]
    patterns = [r"\bring\b", r"^(hot|cold)\b", r"rods?$", r"ölk", r"salt\b", r"οδοσ", r"no\. \d*7", r"^\w{3}\s", r"x", r"plate ge", r"\d", "(gear|bolt) (gear|bolt)"]
    rules = [(n, patterns[n % len(patterns)] if n < 24 else f"plate {n}", f"c{n}") for n in pick.sample(range(100), 90)]
    rules += [(None, "ring", "no"), (200, None, "no"), (3, "ring", "c0")]
    table = spark.createDataFrame(rules, "rule_no int, pattern string, category string")
    products = spark.createDataFrame(list(enumerate(names)), "id bigint, name string")
    got = {r.id: r.category for r in categorise_by_rules(products, table).collect()}
    usable = [r for r in rules if None not in r]
    assert got == {r.id: r.category for r in categorise(products, sorted(usable, key=lambda r: (r[0], r[2]))).collect()}
    assert len(set(got.values())) > 5 and len(got) == len(names)
    assert categorise_by_rules(products, table.limit(0)).select("category").distinct().collect()[0][0] == "other"


def test_rules_meet_candidates_only(spark):
    """No nested loop, and a rule whose text no name holds is tried nowhere."""
    names = spark.createDataFrame([(f"name {i}",) for i in range(50)], "name string")
    rules = spark.createDataFrame([(i, f"name {i % 60}$", f"c{i}") for i in range(1200)], "rule_no int, pattern string, category string")
    found = matching_rules(names, rules)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert found.count() == sum(i % 60 < 50 for i in range(1200))


@settings(max_examples=300, deadline=None)
@given(st.lists(ATOMS, min_size=1, max_size=5), st.text("abc ", max_size=12))
def test_every_match_holds_a_text_of_every_list(atoms, text):
    pattern = "".join(atoms)
    if re.search(pattern, text):
        assert all(any(f in text for f in found) for found in rule_tables.required_texts(pattern))


def test_rules_are_kept_under_what_few_names_hold(spark, monkeypatch):
    """Not under the longer text that all names hold, and rules of one pattern once."""
    written, stage = {}, rule_tables.stage
    monkeypatch.setattr(rule_tables, "stage", lambda df, name: written.setdefault(name, stage(df, name)))
    products = spark.createDataFrame([(i, f"thing no. {i}") for i in range(100, 160)], "id bigint, name string")
    own = [(1000 + i, rf"\bNO\. 0*{i}\z", f"c{i}") for i in range(100, 140)]
    shared = [(n, r"thing no\. 150", f"s{n}") for n in range(5000, 5300)]
    table = spark.createDataFrame(shared + own, "rule_no int, pattern string, category string")
    got = {r.id: r.category for r in categorise_by_rules(products, table).collect()}
    assert got == {i: f"c{i}" if i < 140 else "s5000" if i == 150 else "other" for i in range(100, 160)}
    kept = written["kept"].collect()
    assert sorted(r.rule_no for r in kept) == [1000 + i for i in range(100, 140)] + [5000]
    assert all(r.gram == str(r.rule_no - 1000) for r in kept if r.rule_no < 5000)


def test_index_equals_the_scan(spark):
    pick = random.Random(1)
    words = "small red widget ring Łódź молоко 米 the".split()
    rows = [(i, " ".join(pick.choices(words, k=pick.randint(0, 6)) + ["the"])) for i in range(500)] + [(900, None), (901, ""), (902, "**")]
    products, path = spark.createDataFrame(rows, "id bigint, name string"), scratch_dir(spark, "index")
    write_index(products, path)
    for query in ("Small RÉD widget", "молоко lodz", "the", "absent", "", "ring ring"):
        for match_all in (False, True):
            if match_all and not query:
                continue
            want = product_search(products, query, 30, match_all) if query else None
            got = [tuple(r) for r in search_index(spark, path, query, 30, match_all).collect()]
            assert got == ([tuple(r) for r in want.select("id", "name", "score").collect()] if query else [])


def test_index_reads_only_the_words_folders(spark):
    path = scratch_dir(spark, "index")
    write_index(spark.createDataFrame([(i, f"word{i} common") for i in range(400)], "id bigint, name string"), path)
    found = search_index(spark, path, "word7 word8")
    assert [r.id for r in found.collect()] == [7, 8]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan and "PushedFilters: [In(token" in plan


PERIOD = "k string, n int, a date, b date"


def test_all_overlaps(spark):
    pick, day = random.Random(3), datetime.date(2020, 1, 1)

    def period(n):
        start = pick.choice([None, *[day + datetime.timedelta(pick.randint(-900, 900))] * 9])
        length = pick.choice([0, 0, 1, 3, 4, 15, 16, 64, 400, -2, 10**5])
        end = None if pick.random() < 0.1 or start is None and pick.random() < 0.5 else (start or day) + datetime.timedelta(length)
        return pick.choice(["x", "x", "x", "y", None]), n, start, end

    rows = [[period(n) for n in range(150)] for _ in range(2)]
    left, right = (spark.createDataFrame(r, PERIOD) for r in rows)
    got = [(r.left.n, r.right.n) for r in overlaps(left, right, ["k"], ("a", "b"), ("a", "b")).collect()]
    low, high = datetime.date.min, datetime.date.max
    fits = lambda p: (p[2] or low) <= (p[3] or high)
    want = [
        (p[1], q[1])
        for p in rows[0] for q in rows[1]
        if p[0] is not None and p[0] == q[0] and fits(p) and fits(q) and (p[2] or low) <= (q[3] or high) and (q[2] or low) <= (p[3] or high)
    ]
    assert sorted(got) == sorted(want) and len(want) > 500


def test_long_intervals_are_not_multiplied(spark):
    left = spark.createDataFrame([("x", i, datetime.date(1900, 1, 1), None) for i in range(200)], PERIOD)
    met = overlaps(left, left.limit(1), ["k"], ("a", "b"), ("a", "b"))
    assert met.count() == 200
    assert "NestedLoop" not in met._jdf.queryExecution().executedPlan().toString()
