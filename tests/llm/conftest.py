import random

import pytest

#: text, id, language: null and empty texts, ties, repeated rows, repeated and null ids, one long text
WORDS = "the of and a to in is on by it or be at as an we us if so do my he no up me go oh".split()
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars int, id bigint, x string, n string, found string, name string, `a.b` int"


def prose(seed, words=120):
    pick = random.Random(seed)
    return " ".join("".join(pick.choices("abcdefghiklmnoprstu", k=pick.randint(2, 9))) for _ in range(words))


def edge_rows():
    texts = [
        (1, prose(1), "en"),
        (2, prose(1), "en"),
        (3, None, "en"),
        (4, "", None),
        (5, prose(5), None),
        (5, prose(5), None),
        (6, prose(6), "fr"),
        (6, prose(7), "fr"),
        (None, prose(1), "en"),
        (None, None, None),
        (7, "one two", "en"),
        (8, " \t\n\r ", "en"),
        (9, prose(9, 60_000), "en"),
        (10, "é" * 3000 + "\U0001f600 ok", "xx"),
        (11, "\x00 zero �", "en"),
    ]
    return [(i, t, lang, "s", None if t is None else len(t), 1, "x", "n", "f", "nm", 3) for i, t, lang in texts]


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3).persist()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def docs_of(spark, texts, first=0):
    rows = [(first + i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars int")


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
