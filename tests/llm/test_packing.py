import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from llm.conftest import docs_of, prose
from pricegrid.llm import packing
from pricegrid.llm.packing import Places, Tokenizer, pack_documents, packing_patterns
from pricegrid.llm.queries import TOKENIZER
from tokenizers import Tokenizer as Reader


@pytest.fixture(scope="module")
def whole():
    return Reader.from_file(TOKENIZER.path)


def test_both_readers_agree(whole):
    """On every character that the faster one may read, in all kinds of company."""
    encode = TOKENIZER.reader()
    letters = [chr(c) for c in range(1, 0x250) if not 0xD800 <= c < 0xE000]
    company = ["{}", " {}", "a{}", "{}a", "a{}b", "1{}2", "{0}{0}", " {0}{0} ", "'{}", "{}'s", "\n{}", "{}\n\n x", ".{}.", "é{}é"]
    for form in company:
        text = " | ".join(form.format(c) for c in letters)
        assert list(encode(text)) == whole.encode(text, add_special_tokens=False).ids
        for c in letters[::7]:
            assert list(encode(form.format(c))) == whole.encode(form.format(c), add_special_tokens=False).ids


FAST, PLAIN = TOKENIZER.reader(), Tokenizer(TOKENIZER.path).reader()


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    assert list(FAST(text)) == list(PLAIN(text))


def test_special_tokens_and_scripts(whole):
    encode = TOKENIZER.reader()
    for text in ("a<|endoftext|>b", "<|endoftext|>", "Молоко 米 ok", "\U0001f600"):
        assert list(encode(text)) == whole.encode(text, add_special_tokens=False).ids


def one_by_one(lengths, size):
    """Shortest pack first, a piece at a time; returns how full each pack is."""
    packs = []
    for n in sorted(lengths, reverse=True):
        room = [p for p in packs if p + n <= size]
        if room:
            packs[packs.index(min(room))] += n
        else:
            packs.append(n)
    return sorted(packs)


@settings(max_examples=300, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 40), max_size=10))
def test_patterns(histogram):
    patterns = packing_patterns(histogram, 32)
    placed = Counter()
    for count, lengths in patterns:
        assert count > 0 and sum(lengths) <= 32
        for n in lengths:
            placed[n] += count
    assert placed == Counter(histogram)
    pieces = [n for n, k in histogram.items() for _ in range(k)]
    packs = sum(count for count, _ in patterns)
    assert packs == len(one_by_one(pieces, 32))
    places = Places.of(patterns)
    spots = set()
    for n, k in histogram.items():
        sequence, offset = places.find(np.full(k, n), np.arange(k))
        for s, o in zip(sequence.tolist(), offset.tolist()):
            assert 0 <= s < packs and o + n <= 32
            spots |= {(s, o + i) for i in range(n)}
    assert len(spots) == sum(pieces)


def check(rows, size):
    held = {}
    for r in rows:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    assert sorted(held) == list(range(len(held)))
    return sum(r["length"] for r in rows) / (len(held) * size)


def test_documents(spark, documents, whole):
    rows = pack_documents(documents, TOKENIZER, with_ids=True).collect()
    assert check(rows, 2048) > 0.95
    ids = {}
    for r in sorted(rows, key=lambda r: r["start"]):
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and len(r["ids"]) == r["length"]
        assert len(ids.setdefault(r["doc_id"], [])) == r["start"]
        ids[r["doc_id"]] += r["ids"]
        assert r["doc_tokens"] >= r["start"] + r["length"]
    for d in documents.collect():
        assert ids[d["doc_id"]] == whole.encode(d["text"], add_special_tokens=False).ids + [1]


def test_many_blocks(spark, monkeypatch):
    """Ranks go on from block to block; equal rows get places of their own."""
    monkeypatch.setattr(packing, "RANKED_TOGETHER", 7)
    docs = docs_of(spark, [prose(i % 5, 3 + i % 4) for i in range(60)])
    docs = docs.union(docs)
    rows = pack_documents(docs, TOKENIZER, 64).collect()
    assert len(rows) == 120 and check(rows, 64) > 0.5
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == len(rows)
