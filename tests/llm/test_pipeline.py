"""Every stage on what the one before it kept, against plain Python."""

import zlib

import corpus_pipeline
import numpy as np
import pytest
from llm.test_leaks_and_secrets import distance, spans_by_hand, words
from llm.test_near_duplicates import components, shingles
from pricegrid.llm.queries import ORACLES, QUERIES, TOKENIZER, VOCABULARIES
from pricegrid.llm.quality_rules import quality_rules
from tokenizers import Tokenizer as Reader


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs, kept = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, function in corpus_pipeline.STAGES:
        kept.append(docs.collect())
        docs = function(spark, docs, sf_dir).persist()
    return [*kept, docs.collect()]


def ids(rows):
    return {r["doc_id"] for r in rows}


def test_names():
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert ORACLES.keys() <= QUERIES.keys()


def test_quality(spark, sf_dir, stages):
    verdicts = quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"), VOCABULARIES).filter("kept").collect()
    assert ids(stages[1]) == ids(verdicts)
    assert 0 < len(stages[1]) < len(stages[0])
    assert set(stages[1]) <= set(stages[0])


def test_near_copies(stages):
    roots = components({r["doc_id"]: shingles(r["text"], 5) for r in stages[1]}, 80)
    assert ids(stages[2]) == set(roots.values())
    assert len(stages[2]) == len(ids(stages[2]))
    assert set(stages[2]) <= set(stages[1])


def test_rows_that_share_an_id(spark, sf_dir):
    """Different texts are different documents; clashing and missing columns do no harm."""
    a, b = (" ".join(f"{w}{i}" for i in range(80)) for w in "ab")
    rows = [(1, a, 5, "k"), (1, b, 5, "k"), (2, a, 5, "k"), (2, a, 5, "k"), (None, a, 5, "k"), (None, None, 5, "k")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, __n int, __row_digest string")
    kept = corpus_pipeline.without_near_copies(spark, docs, sf_dir)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([rows[0], rows[1], rows[5]], key=str)
    assert corpus_pipeline.without_leaks(spark, docs, sf_dir).columns == docs.columns
    assert sorted(map(tuple, corpus_pipeline.without_secrets(spark, docs, sf_dir).collect()), key=str) == sorted(rows, key=str)


def test_leaks(spark, sf_dir, stages):
    items = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    gone = ids(stages[2]) - ids(stages[3])
    for r in stages[2]:
        verbatim = any(i in r["text"] for i in items)
        if r["doc_id"] in gone:
            assert verbatim or any(distance(words(i), words(r["text"])) <= len(words(i)) // 5 for i in items)
        else:
            assert not verbatim


def test_secrets(stages):
    before = {r["doc_id"]: r for r in stages[3]}
    assert ids(stages[4]) == before.keys()
    for r in stages[4]:
        text, out, at = before[r["doc_id"]]["text"], "", 0
        for begin, _, end in spans_by_hand(text):
            if begin >= at:
                out += text[at:begin] + "<secret>"
            at = max(at, end)
        assert r["text"] == out + text[at:] and r["n_chars"] == len(r["text"])


def test_packing(stages):
    whole, rows = Reader.from_file(TOKENIZER.path), {}
    for r in sorted(stages[5], key=lambda r: r["start"]):
        rows.setdefault(r["doc_id"], []).append(r)
    assert rows.keys() == ids(stages[4])
    for d in stages[4]:
        tokens, at = np.array(whole.encode(d["text"], add_special_tokens=False).ids + [1], "<u4"), 0
        for r in rows[d["doc_id"]]:
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(tokens[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(tokens)


def test_run_gives_the_last_stage(spark, sf_dir, stages):
    found = {(r["doc_id"], r["start"], r["ids_crc32"]) for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert found == {(r["doc_id"], r["start"], r["ids_crc32"]) for r in stages[5]}


@pytest.mark.parametrize("name", ORACLES)
def test_sql(spark, sf_dir, name):
    from oracle import compare, connect

    problem, count = compare(spark, connect(sf_dir), sf_dir, QUERIES[name], ORACLES[name])
    assert not problem and count


def test_entry_registers_them():
    import __spark_entry__ as entry

    assert QUERIES.keys() | {"pipeline"} <= entry.queries().keys()
    assert ORACLES.keys() <= entry.oracle_sql().keys()
