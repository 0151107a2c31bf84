import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st
from pricegrid.llm import textbuf

TEXTS = st.lists(st.one_of(st.none(), st.text(st.sampled_from("aB \n\t\x0bé \U0001f600"), max_size=40)), max_size=8)


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.integers(1, 60), st.booleans())
def test_slices_and_words(texts, limit, wide):
    column, seen = pa.array(texts, pa.large_string() if wide else pa.string()), []
    for part in (column, column.slice(len(texts) // 3)):
        seen = []
        for low, high, data, offsets in textbuf.slices(part, limit):
            assert high - low == len(offsets) - 1 and offsets[-1] == len(data)
            found = textbuf.words(data, offsets)
            raw = data.tobytes()
            for i in range(high - low):
                own = [raw[a:b] for a, b in zip(found.begin, found.end)][found.first[i] : found.first[i + 1]]
                text = raw[offsets[i] : offsets[i + 1]]
                assert own == re.findall(rb"[^\x20\x09-\x0D]+", text)
                seen.append(text)
            assert textbuf.counts(textbuf.IS_CHAR[data], offsets).tolist() == [len(t.decode()) for t in seen[low:high]]
        assert seen == [(t or "").encode() for t in part.to_pylist()]


def test_equal_ranges_have_equal_hashes():
    pick = np.random.default_rng(0)
    piece = pick.integers(0, 256, 500, dtype=np.uint8)
    data = pick.integers(0, 256, 400_000, dtype=np.uint8)
    places = [0, 1, 65_300, 66_000, 131_000, 200_001, 399_500]
    for p in places:
        data[p : p + 500] = piece
    data[1:500] = 7  # the first place is overwritten
    hashed = textbuf.RangeHash(data)
    at = np.array(places[2:])
    for n in (1, 3, 64, 499, 500):
        assert len(set(hashed(at, at + n).tolist())) == 1
    other = np.arange(0, 60_000)
    assert len(set(hashed(other + 600, other + 640).tolist())) > 59_900
    folded = textbuf.RangeHash(np.frombuffer(b"ABC abc", np.uint8), fold=True)
    assert folded(np.array([0]), np.array([3])) == folded(np.array([4]), np.array([7]))


def test_windows_know_the_order_of_words():
    data = np.frombuffer(b"a b c b a c a b c", np.uint8)
    found = textbuf.words(data, np.array([0, len(data)]))
    hashes, start = textbuf.windows(textbuf.RangeHash(data)(found.begin, found.end), found, 3)
    assert start.tolist() == list(range(7))
    assert hashes[0] == hashes[6] and len(set(hashes.tolist())) == 6
