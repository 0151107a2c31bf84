import hashlib
import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st
from llm.conftest import docs_of, prose
from pricegrid.llm import chunk_dedup, suffix_dedup, textbuf
from pricegrid.llm.chunk_dedup import Chunking
from pricegrid.llm.suffix_dedup import Repeats, repeated_stretches, triples
from pyspark.sql import functions as F


def removed_by_hand(texts, length):
    """Bytes kept, bytes removed and runs of each text."""
    seen = {}
    raws = [(t or "").encode() for t in texts]
    for raw in raws:
        for i in range(len(raw) - length + 1):
            seen[raw[i : i + length]] = seen.get(raw[i : i + length], 0) + 1
    out = []
    for raw in raws:
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if seen[raw[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def texts_with_repeats(seed):
    pick = random.Random(seed)
    passages = [prose(seed * 100 + i, 30) for i in range(4)] + ["ab" * 90, "é" * 70]
    out = [None, "", "short"]
    for i in range(25):
        parts = [prose(pick.random(), pick.randint(0, 25)) for _ in range(3)]
        for _ in range(pick.randint(0, 3)):
            p = pick.choice(passages)
            cut = pick.randint(0, len(p) // 2)
            parts.insert(pick.randint(0, len(parts)), p[cut : cut + pick.randint(20, len(p))])
        out.append("".join(parts))
    return [*out, out[-1], out[-1]]


def test_every_repeated_string_goes(spark):
    for seed in (1, 2):
        texts = texts_with_repeats(seed)
        rows = suffix_dedup.without_repeats(docs_of(spark, texts), Repeats(60, 24)).orderBy("doc_id").collect()
        assert [tuple(r)[1:] for r in rows] == removed_by_hand(texts, 60)


def test_names_of_many_samples_give_the_same(spark):
    texts = texts_with_repeats(3)
    repeats = Repeats(60, 24)
    rows = spark.createDataFrame([(i, i, t or "") for i, t in enumerate(texts)], "rid bigint, th bigint, text string")
    named = suffix_dedup.named_samples(rows, repeats)
    found = named.groupBy("rid").agg(F.collect_set(F.struct("at", F.lit(10).cast("bigint").alias("n"))).alias("found"))
    cut = triples(rows.join(found, "rid"), repeats).persist()
    together = sorted(map(tuple, repeated_stretches(cut, repeats, together=100).collect()))
    apart = sorted(map(tuple, repeated_stretches(cut, repeats, together=1).collect()))
    assert together and together == apart


def test_whole_documents(spark, documents):
    rows = suffix_dedup.without_repeats(documents).orderBy("doc_id").collect()
    texts = [r["text"] for r in documents.orderBy("doc_id").collect()]
    assert [tuple(r)[1:] for r in rows] == removed_by_hand(texts, 400)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 400), min_size=1, max_size=4), st.integers(0, 9))
def test_cover_follows_content(cuts, seed):
    """Equal strings hold their sample at the same place, whatever stands around them."""
    repeats = Repeats(60, 24)
    body = prose(seed, 40).encode()
    where = []
    for extra in cuts:
        data = np.frombuffer(prose(extra, 30).encode()[:extra] + body + b"end", np.uint8)
        found = suffix_dedup.cover(data, np.array([0, len(data)]), repeats)
        lead = min(extra, len(prose(extra, 30)))
        inside = (found.first >= lead) & (found.last + 60 <= lead + len(body))
        where.append({int(a) - lead for a in found.at[inside]})
        assert (found.at >= found.last).all() and (found.at - found.first < 24).all()
    common = set.intersection(*where)
    assert all(w == common for w in where) or len(common) >= min(map(len, where)) - 2


def test_chunks_resist_shifts():
    body = prose(1, 400)
    moved = "An insertion in front. " + body
    digests = []
    for text in (body, moved):
        for _, _, data, offsets in textbuf.slices(pa.array([text])):
            ends = chunk_dedup.chunk_ends(data, offsets, Chunking())
            assert ends[-1] == len(data) and (np.diff(ends) <= Chunking().longest).all()
            digests.append({bytes(data[a:b]) for a, b in zip([0, *ends[:-1]], ends)})
    assert len(digests[0] & digests[1]) >= 0.9 * len(digests[0])


def test_copies_between_other_neighbours(spark):
    """Exact copies of any size go whole, whatever lies beside them, under every partitioning."""
    copies = [prose(i, 400)[:n] for i, n in enumerate([60, 100, 119, 130, 200, 400, 1000] * 4)]
    texts = [x for i, c in enumerate(copies) for x in (prose(500 + i, 5 + i), c)]
    texts += [x for i, c in enumerate(copies) for x in (c, prose(900 + i, 40 - i))]
    results = []
    for parts in (1, 7):
        docs = docs_of(spark, texts).repartition(parts)
        results.append(sorted(tuple(r) for r in chunk_dedup.without_repeats(docs).drop("repeats_of").collect()))
    assert results[0] == results[1]
    removed = {r[0]: r[3] for r in results[0]}
    for i, copy in enumerate(copies):
        assert removed[2 * i + 1] == 0
        assert removed[2 * len(copies) + 2 * i] == len(copy)


def test_texts_are_cut_alone():
    texts = [prose(i, 1 + i) for i in range(40)] + ["", "a", "bc" * 9]
    ((_, _, data, offsets),) = textbuf.slices(pa.array(texts))
    ends = chunk_dedup.chunk_ends(data, offsets, Chunking())
    for i, text in enumerate(texts):
        if text:
            ((_, _, own, bounds),) = textbuf.slices(pa.array([text]))
            mine = ends[(ends > offsets[i]) & (ends <= offsets[i + 1])] - offsets[i]
            assert mine.tolist() == chunk_dedup.chunk_ends(own, bounds, Chunking()).tolist()


def test_passages_go_and_clean_documents_stay(spark):
    passage = prose(7, 55)
    texts = [prose(i + 50, 90) for i in range(20)]
    planted = {3, 8, 9, 15}
    texts = [t + " " + passage + " " + prose(i, 40) if i in planted else t for i, t in enumerate(texts)]
    rows = {r["doc_id"]: r for r in chunk_dedup.without_repeats(docs_of(spark, texts), with_text=True).collect()}
    hit = {i for i, r in rows.items() if r["n_removed"]}
    assert hit == planted - {3}  # the first stays
    assert rows[3]["n_repeated"] == 0
    assert all(r["repeats_of"] == ([3] if i in hit else []) for i, r in rows.items())
    for i, r in rows.items():
        assert r["n_bytes"] == len(texts[i].encode())
        if not r["n_removed"]:
            assert r["kept_text"] == texts[i]
        assert hashlib.sha256(r["kept_text"].encode()).hexdigest() == r["kept_sha256"]


def test_one_word_over_and_over(spark):
    rows = chunk_dedup.without_repeats(docs_of(spark, ["and " * 500, prose(2)])).orderBy("doc_id").collect()
    assert rows[0]["n_removed"] > 1500 and rows[1]["n_removed"] == 0
