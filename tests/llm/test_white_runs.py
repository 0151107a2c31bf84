import random

import public_tokenizers
import pytest
from llm.conftest import docs_of
from pricegrid.llm.packing import pack_documents
from pricegrid.llm.quality_rules import _Measure, quality_rules
from pricegrid.llm.queries import TOKENIZER, VOCABULARIES
from pricegrid.llm.white_runs import encode_ordinary


@pytest.fixture(scope="module")
def both():
    from tokenizers import Tokenizer

    return TOKENIZER.reader(), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_runs_of_any_length_give_the_same_ids(both):
    """Two million blanks, line ends, letters, digits and signs, alone and between words."""
    fast, whole = both
    for run in (" ", "\n", "x", "7", "-", "\t "):
        for text in (run * (2_000_000 // len(run)), "ab" + run * 1_200_000 + "cd", f"{run * 30_000}a{run * 12_000}\n{run * 11_000}"):
            assert fast(text) == whole.encode(text, add_special_tokens=False).ids


def test_cuts_change_nothing():
    """Short runs cut as long ones are, against the pattern itself."""
    import base64

    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    model = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    pick = random.Random(1)
    for _ in range(600):
        text = "".join(pick.choice([" ", "  ", "\n", "\t", "\xa0", "\u3000", "\u2003", "\x85", "\x1c", "a", "é", "7", "'s", "-", "ab c"]) for _ in range(pick.randint(1, 40)))
        for long in (1, 2, 3):
            assert encode_ordinary(model, text, long) == model.encode_ordinary(text)


def test_operators_take_long_runs(spark):
    docs = docs_of(spark, [" " * 1_500_000, "\n" * 1_200_000 + "end", "a " + "\u3000" * 1_200_000 + " b"])
    rows = {r["doc_id"]: r["kept"] for r in quality_rules(docs, VOCABULARIES).collect()}
    assert rows == {0: False, 1: False, 2: False}
    packed = pack_documents(docs, TOKENIZER).collect()
    assert {r["doc_id"] for r in packed} == {0, 1, 2}
    assert all(sum(r["length"] for r in packed if r["doc_id"] == d) == next(r["doc_tokens"] for r in packed if r["doc_id"] == d) for d in range(3))
    tokens, _, _ = _Measure(VOCABULARIES[1])([" " * 1_200_000])
    assert tokens[0] > 1000
