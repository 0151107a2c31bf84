import math
import random

import numpy as np
import pandas as pd
import pytest
from pricegrid.llm import hard_negatives as hn
from pricegrid.llm.hard_negatives import hard_negatives, segment_summaries
from pricegrid.llm.queries import op12_hard_negatives
from pyspark.sql import functions as F

SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, v string, n int, `a.b` int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1, 2) for r in rows], SCHEMA)


def expected(rows, step, scale=256, low=50, high=95, positives=5, negatives=3):
    """All pairs, in whole numbers."""
    known = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = (label, [math.floor(scale * float(np.float32(x))) for x in v])
        known[i] = min(known.get(i, row), row)
    out = set()
    for a, (label, v) in known.items():
        if a % step:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other) for i, (other, w) in known.items() if i != a)
        for score, p, _ in [s for s in scored if s[2] == label][:positives]:
            fits = [(s, i) for s, i, other in scored if other != label and low * -score <= 100 * -s <= high * -score][:negatives]
            out |= {(a, p, rank + 1, i, -score, -s) for rank, (s, i) in enumerate(fits)}
    return out


def vectors(seed, n, width, labels, spread=1.0):
    pick = np.random.default_rng(seed)
    centres = pick.normal(size=(labels, width))
    out = []
    for i in range(n):
        label = int(pick.integers(labels))
        v = centres[label] * pick.random() + spread * pick.normal(size=width)
        out.append((i, [float(x) for x in v / np.linalg.norm(v)], label))
    return out


@pytest.mark.parametrize("width, labels, spread", [(64, 10, 1), (64, 3, 0.2), (5, 2, 1), (1, 2, 1), (17, 4, 0.5)])
def test_all_pairs(spark, width, labels, spread):
    rows = vectors(width, 300, width, labels, spread)
    got = hard_negatives(table(spark, rows), F.col("vec_id") % 10 == 0)
    assert {tuple(r) for r in got.collect()} == expected(rows, 10)


def test_blocks_and_strips(spark, monkeypatch):
    """Many blocks, strips of one anchor, hardly any seeds; ties and one vector that half the rows share."""
    for name, value in (("BLOCK", 40), ("PAIRS", 1), ("SEED", 2)):
        monkeypatch.setattr(hn, name, value)
    rows = vectors(3, 150, 16, 3)
    rows += [(1000 + i, rows[0][1], i % 3) for i in range(150)]
    got = hard_negatives(table(spark, rows), F.col("vec_id") % 10 == 0)
    assert {tuple(r) for r in got.collect()} == expected(rows, 10)


def test_bounds_hold():
    pick = np.random.default_rng(1)
    a, b = (pick.integers(-300, 300, (50, 37)) for _ in range(2))
    scores = a @ b.T
    last = np.inf
    for segments in hn.LEVELS:
        (ma, da), (mb, db) = segment_summaries(a, segments), segment_summaries(b, segments)
        middle, spread = ma @ mb.T, da @ db.T
        assert (np.abs(scores - middle) <= spread + 1e-6).all()
        assert spread.sum() <= last
        last = spread.sum()


def test_open_pairs_leave_out_what_the_bounds_settle():
    """Smooth vectors are told apart by their first summaries."""
    pick = np.random.default_rng(2)
    smooth = np.repeat(pick.integers(-256, 256, (200, 4)), 16, axis=1)
    parts = [x for s in hn.LEVELS for x in segment_summaries(smooth, s)]
    frame = pd.DataFrame({"id": range(200), "label": 0, "v": [r.tobytes() for r in smooth], "summary": [r.tobytes() for r in np.concatenate(parts, axis=1)]})
    block = hn.Block.of(frame)
    scores = smooth @ smooth.T
    least = np.sort(scores, axis=1)[:, -5]
    a, r = hn.open_pairs(block, block, np.ones((200, 200), bool), lambda i, low, high: high >= least[i])
    assert len(a) < 200 * 12
    assert set(zip(*np.nonzero(scores >= least[:, None]))) <= set(zip(a, r))


def test_undefined_input(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(5, 60, 4, 2)
    odd = [(100, None, 1), (110, [1.0, None, 0.0, 0.0], 1), (120, [nan, 0.0, 0.0, 0.0], 0), (130, [inf, 0.0, 0.0, 0.0], 0), (140, [0.5] * 4, None)]
    odd += [(None, [0.5] * 4, 1), (150, [], 1), (160, [0.7, 0.7], 0), (170, [0.1] * 4, 5), (10, [0.9, 0.1, 0.0, 0.0], 1), rows[20], rows[20]]
    padded = [(i, None if v is None else v + [0.0] * (4 - len(v)), label) for i, v, label in rows + odd]
    got = hard_negatives(table(spark, rows + odd), F.col("vec_id") % 10 == 0).collect()
    assert {tuple(r) for r in got} == expected(padded, 10)
    assert len(got) == len(set(got))
    for few in ([], odd[:5], rows[:1], [(1, [1.0], 0)]):
        assert hard_negatives(table(spark, few), F.col("vec_id") % 10 == 0).collect() == []


def test_large_numbers(spark):
    """Products beyond 2**53, and beyond a long, are exact in order and cut to a long at the end."""
    pick = random.Random(7)
    rows = [(i, [float(np.float32(pick.uniform(-1, 1) * 10**9)) for _ in range(6)], i % 2) for i in range(40)]
    got = {tuple(r) for r in hard_negatives(table(spark, rows), F.col("vec_id") % 10 == 0, scale=1).collect()}
    assert got == expected(rows, 10, scale=1)
    got = hard_negatives(table(spark, rows), F.col("vec_id") % 10 == 0, scale=16).collect()
    assert all(abs(r["negative_score"]) < 2**63 for r in got)


def test_query_against_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    moved = [(i, v, (label + 1) % 10 if i % 7 == 0 else label) for i, v, label in rows]
    assert {tuple(r) for r in op12_hard_negatives(spark, sf_dir).collect()} == expected(moved, 50)
