import itertools
import random
import re

import pandas as pd
import pytest
from llm.conftest import docs_of, prose
from pricegrid.llm import near_duplicates as nd
from pricegrid.llm.components import connected_components
from pricegrid.llm.near_duplicates import Similarity, near_duplicates

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(zip(*(words[k:] for k in range(size))))


def components(sets, percent):
    """By all pairs."""
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        both = len(x & y)
        if x and y and 100 * both >= percent * (len(x) + len(y) - both):
            root[max(find(a), find(b))] = min(find(a), find(b))
    return {d: find(d) for d in sets}


def check(spark, texts, like):
    rows = near_duplicates(docs_of(spark, texts, 10), like).collect()
    sets = {10 + i: shingles(t, like.words) for i, t in enumerate(texts)}
    expected = components(sets, like.percent)
    assert {r["doc_id"]: r["component_id"] for r in rows} == expected
    for r in rows:
        assert r["n_shingles"] == len(sets[r["doc_id"]])
        assert r["kept"] == (r["doc_id"] == r["component_id"])
    return expected


def family(seed, copies, most):
    pick = random.Random(seed)
    base = prose(seed, 100).split()
    out = []
    for _ in range(copies):
        words = list(base)
        for _ in range(pick.randint(0, most)):
            words[pick.randrange(len(words))] = prose(pick.random(), 1)
        out.append(" ".join(words))
    pick.shuffle(out)
    return out


@pytest.mark.parametrize("like", [Similarity(3, 85), Similarity()])
def test_families(spark, like):
    texts = family(1, 60, 8) + family(2, 5, 3) + [prose(i + 500, 80) for i in range(20)]
    texts += [texts[0], texts[0].upper(), None, "", "a b", "A  b", "a", " "]
    found = check(spark, texts, like)
    assert len(set(found.values())) < len(texts) - 10


def test_large_group_in_blocks(spark, monkeypatch):
    """Members that miss the centre are compared across blocks."""
    monkeypatch.setattr(nd, "BLOCK", 8)
    check(spark, family(3, 90, 9), Similarity(3, 85))


def test_links_beside_a_centre(spark):
    """Two texts that both miss the smallest id but not each other."""
    base = prose(4, 60).split()
    other = base[:8] + prose(5, 10).split() + base[18:]
    near = [*other[:-1], "end"]
    found = check(spark, [" ".join(base), " ".join(other), " ".join(near)], Similarity(3, 85, missed=1e-12))
    assert found == {10: 10, 11: 11, 12: 11}


def test_whole_table(spark, documents):
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    rows = near_duplicates(documents, Similarity(3, 85)).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == components({d: shingles(t, 3) for d, t in texts.items()}, 85)


def test_subkeys_reach_the_wanted_share():
    for like in (Similarity(3, 85), Similarity(), Similarity(percent=90, missed=1e-6)):
        miss = (1 - (like.percent / 100) ** like.hashes) ** like.subkeys
        assert 1 - (1 - miss) ** 2 <= like.missed


def test_order_of_words_matters(spark):
    a = "one two three four five six seven"
    found = check(spark, [a, " ".join(reversed(a.split()))], Similarity(3, 85))
    assert found == {10: 10, 11: 11}


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    pick = random.Random(seed)
    edges = [(pick.randrange(60), pick.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(20)] + [(5, 5), (-3, 7)]
    root = {n: n for e in edges for n in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    got = connected_components(spark.createDataFrame(pd.DataFrame(edges, columns=["u", "v"]))).collect()
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert {r["node"]: r["root"] for r in got} == {n: root[n] for n in linked}
