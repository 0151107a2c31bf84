import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pricegrid.llm import textbuf
from pricegrid.llm.quality_classifier import FEATURES, Discriminant, fit, held_out, quality_scores
from pricegrid.llm.quality_rules import _entropy_share, base_counts, quality_rules
from pricegrid.llm.queries import VOCABULARIES
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counted(text):
    words, seen, again = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    triples = collections.Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if triples[tuple(words[i : i + 3])] > 1 for k in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return [len(words), sum(map(len, words)), symbols, again, len(covered)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab \n\té|#\x0b "), max_size=60), min_size=1, max_size=5))
def test_base_counts(texts):
    got = [[] for _ in texts]
    for low, high, data, offsets in textbuf.slices(pa.array(texts), limit=40):
        for row, values in zip(range(low, high), zip(*base_counts(data, offsets))):
            got[row] = list(values)
    assert got == [counted(t) for t in texts]


def test_rules(spark, documents):
    rows = quality_rules(documents, VOCABULARIES).join(documents.select("doc_id", "text"), "doc_id").collect()
    for r in rows:
        expected = counted(r["text"])
        assert [r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] == expected
        assert r["base_failed"] == (expected[0] < 50 or 100 * expected[4] > 50 * expected[0])
        assert not (r["base_failed"] and r["kept"])


def test_clean_documents_are_kept(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rules = quality_rules(docs, VOCABULARIES).filter("not base_failed").join(labels, "doc_id")
    counts = {(r["quality"], r["kept"]): r["n"] for r in rules.groupBy("quality", "kept").agg(F.count("*").alias("n")).collect()}
    assert counts[1, True] >= 0.98 * (counts[1, True] + counts.get((1, False), 0))


def texts_of(seed, count, words, letters="abcdefghilmnoprstu", size=400):
    """Texts of words that have a made-up language's frequencies."""
    pick = random.Random(seed)
    stock = ["".join(pick.choices(letters, k=pick.randint(2, 8))) for _ in range(size)]
    weights = [1 / k for k in range(1, size + 1)]
    return [" ".join(pick.choices(stock, weights, k=words())) for _ in range(count)]


def noise(seed, words):
    pick = random.Random(seed)
    return " ".join("".join(pick.choices("#$%&~^QXZqxz0123456789{}[]", k=6)) for _ in range(words))


def kept(spark, rows):
    docs = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(rows)], "doc_id bigint, text string, lang string")
    found = quality_rules(docs, VOCABULARIES).collect()
    assert not any(r["base_failed"] for r in found)
    return [r["kept"] for r in sorted(found, key=lambda r: r["doc_id"])]


def test_bands_of_a_small_table(spark):
    pick = random.Random(1)
    clean = texts_of(2, 90, lambda: pick.randint(60, 900))
    assert kept(spark, [(t, "en") for t in [*clean, noise(3, 300), noise(4, 80)]]) == [True] * 90 + [False] * 2


def test_very_long_texts_are_judged(spark):
    pick = random.Random(5)
    clean = texts_of(6, 62, lambda: pick.randint(60, 900))
    long = [" ".join(clean[:30]) + " " + " ".join(clean[30:60])] * 2
    verdicts = kept(spark, [(t, "en") for t in [*clean, *long, noise(7, 60_000)]])
    assert verdicts == [True] * 64 + [False]


def test_a_rare_language_is_judged_by_its_own(spark):
    pick = random.Random(8)
    clean = texts_of(9, 150, lambda: pick.randint(60, 600))
    rare = texts_of(10, 6, lambda: pick.randint(60, 600), "бвгдежзиклмнопрстуя")
    verdicts = kept(spark, [(t, "en") for t in clean] + [(t, "xx") for t in rare])
    assert all(verdicts[150:]) and sum(verdicts[:150]) >= 148


def test_entropy_share_does_not_drift_with_length():
    ids = np.random.default_rng(0).zipf(1.3, 200_000) % 5000
    at = [_entropy_share(ids[:n], 5000) for n in (1024, 8192, 200_000)]
    assert max(at) - min(at) < 0.05
    seen = np.unique(ids[:700], return_counts=True)[1] / 700
    assert _entropy_share(ids[:700], 5000) == pytest.approx(-(seen * np.log2(seen)).sum() / np.log2(700))
    assert _entropy_share(ids[:1], 5000) == 1.0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    tested = quality_scores(docs, labels).filter("held_out").join(labels, "doc_id").select("predicted", "quality", "score").collect()
    assert len(tested) > 500
    assert sum(r["predicted"] == r["quality"] for r in tested) >= 0.97 * len(tested)
    assert all(0 <= r["score"] <= 1 for r in tested)


def test_held_out_fold(spark):
    import zlib

    rows = spark.range(200).select("id", held_out(F.col("id")).alias("out")).collect()
    assert all(r["out"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in rows)


def test_fit_is_a_quadratic_discriminant(spark):
    """Against densities worked out in full, without factors."""
    pick, d = np.random.default_rng(0), len(FEATURES)
    x = np.concatenate([pick.normal(0, 1, (400, d)), pick.normal(0.5, 2, (300, d))])
    y = [0] * 400 + [1] * 300
    rows = spark.createDataFrame([(v.tolist(), k) for v, k in zip(x, y)], "x array<double>, label int")
    model = fit(rows, to_pooled=0.2, to_identity=0.1)
    scatter = [np.cov(x[np.array(y) == k].T, bias=True) for k in (0, 1)]
    pooled = (400 * scatter[0] + 300 * scatter[1]) / 700
    log = []
    for k, n in ((0, 400), (1, 300)):
        s = 0.8 * scatter[k] + 0.2 * pooled
        s = 0.9 * s + 0.1 * np.trace(s) / d * np.eye(d)
        away = x - x[np.array(y) == k].mean(0)
        log.append(np.log(n / 700) - 0.5 * np.linalg.slogdet(s)[1] - 0.5 * np.einsum("ij,jk,ik->i", away, np.linalg.inv(s), away))
    assert np.allclose(model.scores(x), 1 / (1 + np.exp(log[0] - log[1])), atol=1e-6)


def test_one_class_scores_half():
    assert Discriminant([], [], []).scores(np.zeros((3, len(FEATURES)))) == pytest.approx([0.5] * 3)
