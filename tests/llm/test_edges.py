"""Null, empty and long texts, ties, repeated rows, empty tables, extra columns of clashing names."""

import hashlib
import zlib

import corpus_pipeline
import pytest
from llm.conftest import edge_rows
from pricegrid.llm import chunk_dedup, suffix_dedup
from pricegrid.llm.decontamination import leaks
from pricegrid.llm.near_duplicates import near_duplicates
from pricegrid.llm.packing import pack_documents
from pricegrid.llm.quality_classifier import quality_scores
from pricegrid.llm.quality_rules import quality_rules
from pricegrid.llm.queries import TOKENIZER, VOCABULARIES
from pricegrid.llm.secret_scan import find_secrets
from pricegrid.llm.site_style import main_text
from pricegrid.llm.zip_archive import archive_round_trip

LABELS = "doc_id bigint, quality int"


def pages(docs):
    return docs.selectExpr("doc_id as page_id", "x as url", "text as html", "id", "n", "found", "name", "`a.b`")


def benchmark(spark):
    rows = [(1, edge_rows()[0][1]), (2, None), (3, ""), (None, edge_rows()[6][1]), (4, "one two")]
    return spark.createDataFrame(rows, "item_id bigint, text string")


def labels(spark):
    return spark.createDataFrame([(1, 1), (2, 0), (2, 1), (None, 1), (5, 1), (6, 0), (7, None)], LABELS)


ONE_ROW_EACH = {
    "op1": lambda spark, docs: find_secrets(docs),
    "op2": lambda spark, docs: quality_scores(docs, labels(spark)),
    "op3": lambda spark, docs: suffix_dedup.without_repeats(docs, with_text=True),
    "op4": lambda spark, docs: main_text(pages(docs)),
    "op5": lambda spark, docs: chunk_dedup.without_repeats(docs, with_text=True),
    "op7": lambda spark, docs: archive_round_trip(pages(docs)),
    "op8": lambda spark, docs: quality_rules(docs, VOCABULARIES),
    "op9": lambda spark, docs: near_duplicates(docs),
}


@pytest.mark.parametrize("name", ONE_ROW_EACH)
def test_one_row_each(spark, edge_docs, name):
    rows = ONE_ROW_EACH[name](spark, edge_docs).collect()
    key = "page_id" if name in ("op4", "op7") else "doc_id"
    assert sorted(str(r[key]) for r in rows) == sorted(str(r[0]) for r in edge_rows())


@pytest.mark.parametrize("name", ONE_ROW_EACH)
def test_no_rows(spark, no_docs, name):
    assert ONE_ROW_EACH[name](spark, no_docs).collect() == []


def test_scores_without_both_classes(spark, edge_docs):
    nothing = spark.createDataFrame([], LABELS)
    assert {r["score"] for r in quality_scores(edge_docs, nothing).collect()} == {0.5}


def test_leaks(spark, edge_docs, no_docs):
    found = leaks(edge_docs, benchmark(spark)).collect()
    assert sorted((str(r["doc_id"]), str(r["item_id"])) for r in found) == sorted(
        [("1", "1"), ("2", "1"), ("None", "1"), ("6", "None"), ("7", "4")]
    )
    assert {r["distance"] for r in found} == {0}
    assert leaks(no_docs, benchmark(spark)).collect() == []
    assert leaks(edge_docs, benchmark(spark).limit(0)).collect() == []


def test_packing(spark, edge_docs, no_docs):
    rows = pack_documents(edge_docs, TOKENIZER).collect()
    whole = sum(r["doc_tokens"] for r in rows if r["start"] == 0)
    assert sum(r["length"] for r in rows) == whole
    assert sum(r["start"] == 0 for r in rows) == len(edge_rows())
    empty = next(r for r in rows if r["doc_id"] == 3)
    assert (empty["length"], empty["ids_crc32"]) == (1, zlib.crc32(b"\x01\0\0\0"))
    assert pack_documents(no_docs, TOKENIZER).collect() == []


def test_components_and_repeated_ids(spark, edge_docs):
    rows = near_duplicates(edge_docs).collect()
    of = {}
    for r in rows:
        of.setdefault(r["doc_id"], set()).add((r["component_id"], r["kept"]))
    assert of[1] == {(1, True)} and of[2] == {(1, False)}
    assert of[3] == {(3, True)} and of[4] == {(4, True)}
    assert of[None] == {(None, True)}


def test_repeated_rows_are_repeats(spark, edge_docs):
    rows = suffix_dedup.without_repeats(edge_docs).collect()
    for r in rows:
        if r["doc_id"] in (1, 2, 5):
            assert r["n_removed"] == r["n_bytes"] > 400
        if r["doc_id"] in (3, 4):
            assert (r["n_bytes"], r["n_removed"], r["kept_sha256"]) == (0, 0, hashlib.sha256(b"").hexdigest())


def test_pipeline_stages(spark, sf_dir, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        for name, function in corpus_pipeline.STAGES:
            after = function(spark, docs, sf_dir)
            rows = after.collect()
            if name != "packing":
                assert after.columns == docs.columns
                assert len(rows) <= docs.count()
            if docs is no_docs:
                assert rows == []
    one = corpus_pipeline.without_near_copies(spark, edge_docs, sf_dir).collect()
    # copies of 1 go, that without an id too, and equal rows; different texts of one id stay
    assert sorted(str(r["doc_id"]) for r in one) == sorted(["1", "3", "4", "5", "6", "6", "7", "8", "9", "10", "11", "None"])
