import numpy as np
import pytest
from llm.conftest import docs_of, prose
from llm.test_near_duplicates import components, family, shingles
from pricegrid.llm import jaccard_join as jj
from pricegrid.llm.jaccard_join import Overlap, jaccard_components


def check(spark, texts, like):
    rows = jaccard_components(docs_of(spark, texts, 10), like).collect()
    sets = {10 + i: shingles(t, like.words) for i, t in enumerate(texts)}
    expected = components(sets, like.percent)
    assert {r["doc_id"]: r["component_id"] for r in rows} == expected
    assert {r["doc_id"]: r["n_shingles"] for r in rows} == {d: len(s) for d, s in sets.items()}
    return expected


@pytest.mark.parametrize("like", [Overlap(), Overlap(5, 80), Overlap(1, 50), Overlap(2, 100)])
def test_families(spark, like):
    texts = family(1, 60, 8) + family(2, 8, 3) + [prose(i + 500, 80) for i in range(20)]
    texts += [texts[0], texts[0].upper(), None, "", "a b", "A  b", "a", " ", "a b c", "a b c d"]
    check(spark, texts, like)


def test_sizes_at_the_limit(spark):
    """Sets cut short step by step: each is linked with those of at least nine tenths, over all blocks of sizes."""
    words = prose(7, 400).split()
    texts = [" ".join(words[:n]) for n in (400, 361, 360, 359, 326, 325, 324, 200, 180, 181, 30, 27, 22, 21, 20, 12, 11, 10, 4, 3, 2)]
    found = check(spark, texts, Overlap())
    assert len(set(found.values())) > 3


def test_large_group_in_blocks(spark, monkeypatch):
    """Members that miss the centre are compared across blocks."""
    monkeypatch.setattr(jj, "BLOCK", 8)
    check(spark, family(3, 90, 5), Overlap())


def test_common_passage(spark):
    """A passage that all texts hold makes no links by itself."""
    passage = prose(11, 60)
    texts = [f"{prose(100 + i, 5 + i)} {passage} {prose(200 + i, 3)}" for i in range(80)]
    texts += [f"{prose(300, 1)} {passage}", f"{passage} {prose(301, 1)}"]
    found = check(spark, texts, Overlap())
    assert found[10 + 80] == found[10 + 81]


def test_links_beside_a_centre(spark):
    """Two texts that both miss the smallest id but not each other."""
    base = prose(4, 60).split()
    other = base[:8] + prose(5, 10).split() + base[18:]
    near = [*other[:-1], "end"]
    assert check(spark, [" ".join(base), " ".join(other), " ".join(near)], Overlap()) == {10: 10, 11: 11, 12: 11}


def test_bounds_from_the_centre_settle_pairs(spark):
    """What both share with the centre decides without their bits, and never wrongly."""
    import pandas as pd

    pick = np.random.default_rng(5)
    centre = np.sort(pick.choice(10**6, 400, False)).astype(np.uint64)
    rows, sets = [], []
    for x in range(60):
        inside = pick.random(400) < pick.choice([0.2, 0.5, 0.97])
        rest = pick.choice(10**3, pick.integers(0, 30), False) + 10**7
        sets.append({*centre[inside].tolist(), *rest.tolist()})
        flags = np.zeros(448, bool)
        flags[:400] = inside
        rows.append((x, len(sets[-1]), 400, int(inside.sum()), np.packbits(flags).tobytes(), np.sort(rest).tolist()))
    members = pd.DataFrame(rows, columns=["x", "size", "whole", "common", "bits", "rest"])
    cell = pd.concat([members.assign(asks=True), members.assign(asks=False)])
    links = jj._links_of_cell(cell, Overlap()).to_numpy().tolist()
    root = {i: i for i in range(60)}
    for a, b in links:
        assert 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])
        low, high = sorted((root[a], root[b]))
        root = {k: low if v == high else v for k, v in root.items()}
    assert root == components(dict(enumerate(map(frozenset, sets))), 90)
    assert len(links) == 60 - len(set(root.values()))


def test_bounds():
    like = Overlap()
    for one in range(1, 120):
        for other in range(one, 140):
            need = next(k for k in range(one + other) if 100 * k >= 90 * (one + other - k))
            assert like.needed(one, other) == need
            if need <= one:
                # linked sets: the smaller one reaches the block of the larger one from any first position that is left
                for position in range(one - need + 1):
                    assert like.largest(one, position) >= other
                    assert position < like.prefix(one)


def test_whole_table(spark, documents):
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    rows = jaccard_components(documents).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == components({d: shingles(t, 3) for d, t in texts.items()}, 90)


def test_undefined_input(spark, edge_docs, no_docs):
    of = {}
    for r in jaccard_components(edge_docs).collect():
        of.setdefault(r["doc_id"], []).append(r["component_id"])
    assert of[1] == [1] and of[2] == [1] and of[3] == [3] and of[4] == [4]
    assert of[5] == [5, 5] and of[6] == [6, 6] and of[None] == [None, None]
    assert sum(map(len, of.values())) == edge_docs.count()
    assert jaccard_components(no_docs).collect() == []


def test_sketches_rule_out_only_what_is_not_linked():
    pick = np.random.default_rng(8)
    like, settled = Overlap(), 0
    for size in (1, 3, 40, 130, 1000):
        base = pick.choice(10**9, size, False)
        for changes in (0, 1, size // 20, size // 10, size // 4, size):
            other = np.unique(np.append(base[changes:], pick.choice(10**9, changes + pick.integers(0, 2 + size // 20), False)))
            one, two = np.unique(base).astype(np.uint64), other.astype(np.uint64)
            apart = jj.fewest_apart(jj.sketch(one), np.frombuffer(jj.sketch(two), np.uint64)[None, :])[0]
            assert apart <= len(set(base.tolist()) ^ set(other.tolist()))
            both = len(set(base.tolist()) & set(other.tolist()))
            if 100 * both >= 90 * (len(one) + len(two) - both):
                assert apart <= like.apart(len(one), len(two))
            settled += apart > like.apart(len(one), len(two))
    assert settled > 5


def test_texts_of(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(-40, 200)] + [(None, "n"), (7, "again")], "id bigint, __text string")
    ids = spark.createDataFrame([(i,) for i in (-40, -1, 0, 7, 7, 8, 63, 199, 500)], "id bigint")
    for bits in (1, 64, 1 << 16, 1 << 26):
        monkeypatch.setattr(jj, "KNOWN_BITS", bits)
        got = sorted((r["id"], r["__text"]) for r in jj.texts_of(docs, ids).collect())
        assert got == sorted([(7, "again")] + [(i, f"t{i}") for i in (-40, -1, 0, 7, 8, 63, 199)])
