from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from pricegrid.functions import prices, text, urls
from pricegrid.functions.dates import add_report_dates, two_digit_days

D = lambda *ymd: date(*ymd)

DATES = {
    "sondeo-del-03-al-10-de-enero-2020.pdf": (D(2020, 1, 3), D(2020, 1, 10)),
    "sondeo-del-28-enero-al-03-febrero-2020.pdf": (D(2020, 1, 28), D(2020, 2, 3)),
    "del-28-diciembre-2019-al-04-enero-2020.pdf": (D(2019, 12, 28), D(2020, 1, 4)),
    # a day at the very start is not seen
    "28-de-diciembre-2019-al-04-de-enero-2020.pdf": (D(2019, 12, 4), D(2020, 1, 4)),
    # two days that share a dash: only the first is seen
    "del-15-20-de-marzo-2020.pdf": (D(2020, 3, 15), D(2020, 3, 15)),
    "canasta-abril-2020.pdf": (D(2020, 4, 1), D(2020, 4, 1)),
    "canasta-del-05-mayo.pdf": (D(2017, 5, 5), D(2017, 5, 5)),
    "del%2003%20al%2010%20de%20enero%202020.pdf": (D(2020, 1, 3), D(2020, 1, 10)),
    "del%252003%2520enero%25202020.pdf": (D(2020, 1, 3), D(2020, 1, 3)),
    "del-28-diciembre-al-03-enero-2020.pdf": (D(2020, 12, 28), D(2020, 1, 3)),
    "del_03_enero-2020.pdf": (None, None),
    "del-31-abril-2020.pdf": (None, None),
    "reporte-2020.pdf": (D(2020, 1, 1), D(2020, 1, 1)),
    "del-03-ENERO-2020.pdf": (D(2020, 1, 3), D(2020, 1, 3)),
    "del-03T-enero-2020.pdf": (None, None),
    "sondeo-20200115.pdf": (D(2020, 1, 1), D(115, 1, 1)),
    "reporte-0000.pdf": (None, None),
    "del-31-enero-al-febrero-2020.pdf": (None, None),
    "carpeta%2Fdel-03-enero-2020.pdf": (D(2020, 1, 3), D(2020, 1, 3)),
}


def column(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in df.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


def test_report_dates(spark):
    rows = [(f"https://example.org/a-2001/{name}", name) for name in DATES]
    df = add_report_dates(spark.createDataFrame(rows, "url string, name string"), "url")
    for r in df.collect():
        assert (r.start_date, r.end_date) == DATES[r.name], r.name
        assert r.date_error == (DATES[r.name][0] is None)
        assert r.range_inverted == (not r.date_error and r.end_date < r.start_date)


def test_days_are_taken_in_order(spark):
    assert column(spark, ["x-01-a-02-", "1-02 "], two_digit_days) == [["01", "02"], ["02 "]]


def test_prices(spark):
    cases = {
        "RD$1,250.00": "1250", "1.250": "1250", "1.250,50": "1250.5", "1,25": "1.25", "45": "45",
        "0.00": "0", "--": None, "nan": None, "": None, None: None, "1 250,5": "1250.5",
        "1 250": "1250", "-5.00": "5", "12.": "12", "3 x 4": "3", "1.2345": "1.2345",
        "1.23456": "1.2346", "1,234,567.89": "1234567.89", "1.234.567": "1234567",
        "9" * 30: None, "RD$ 7 ,": "7",
    }
    got = column(spark, cases, prices.parse_price)
    assert got == [None if v is None else Decimal(v) for v in cases.values()]
    kept = column(spark, cases, lambda c: prices.is_priced(prices.parse_price(c)))
    assert kept == [v is not None and Decimal(v) != 0 for v in cases.values()]


def test_stored_names(spark):
    cases = {
        "https://h.org/d/a.pdf": "a.pdf", "https://h.org/d/a.PDF": "a.pdf",
        "https://h.org/d/a.pdf?x=1": "a.pdf", "https://h.org/d/a.php": "a",
        "https://h.org/d/a%20b.pdf": "a%20b.pdf", "https://h.org/d/": "", "https://h.org/d/a": "a",
        "https://h.org/d/a.b.pdf": "a.b.pdf", "https://h.org/d/.hidden": ".hidden",
        "https://h.org/d/a.htm?x": "a.html", "https://h.org/d/a.htm": "a.htm",
        "https://h.org/a.pdf?u=b/c.d": "c.pdf", "https://h.org/r.pdf#p2": "r.pdf",
    }
    assert column(spark, cases, urls.stored_file_name) == list(cases.values())
    assert column(spark, ["s/a.b.pdf", "c"], urls.file_stem) == ["a.b", "c"]
    assert column(spark, ["s/a.pdf"], lambda c: urls.output_name(c)) == ["s/a.csv"]
    for variant, name in [("single", "s/a.csv"), ("generic", "s/a-generic.csv")]:
        assert column(spark, ["s/a.pdf"], lambda c: urls.output_name(c, F.lit(variant))) == [name]


def test_double_decoding(spark):
    from urllib.parse import unquote

    cases = ["a%2520b", "a+b", "100%", "caf%C3%A9", "%zz%20x", "x%2Fy.pdf", "x%252Fy.pdf", ""]
    assert column(spark, cases, urls.report_name) == [
        unquote(unquote(c)).rpartition("/")[2] for c in cases
    ]


def test_strip_like_python(spark):
    cases = ["\t a \n", " b　", "\x1cc\x1f", "d e", "", " ​ "]
    assert column(spark, cases, text.strip) == [c.strip() for c in cases]


def test_null_tokens_and_folding(spark):
    assert column(spark, ["NA", "na", "--", "", None, "#N/A"], text.null_token) == [
        None, "na", "--", None, None, None,
    ]
    names = ["Azúcar, Crema!", "crema AZUCAR", "crema azúcar crema"]
    assert column(spark, names, text.fingerprint) == ["azucar crema"] * 3
    assert column(spark, ["&amp;lt; &lt;&nbsp;&#39;"], text.decode_entities) == ["&lt; < '"]


def test_ids_depend_on_every_part(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("a", 1)], "x string, y int")
    assert df.select(prices.observation_id("x", "y").alias("id")).distinct().count() == 3


def test_ids_tell_missing_and_odd_parts_apart(spark):
    rows = [("a", None, "b"), ("a", "b", None), ("a|b", None, None), ("a", "b", ""), ("a,1:b", None, ""), ("a", "-", "b"), (None, None, None), ("", "", ""), ("3:a", "b", None)]
    df = spark.createDataFrame(rows, "x string, y string, z string")
    assert df.select(prices.observation_id("x", "y", "z").alias("id")).distinct().count() == len(rows)
    assert df.select(prices.observation_id("x", "y").alias("id")).distinct().count() == len({r[:2] for r in rows})


def test_entities(spark):
    got = column(spark, ["a&ntilde;o &#225;&#xe9;&#XE9;", "&amp;lt; &nope; & &;", "&#128;&#0;&#xD800;&#1114112;", None, "", "&lt;&lt;x&gt;"], text.decode_entities)
    assert got == ["año áéé", "&lt; &nope; & &;", "€\ufffd\ufffd\ufffd", None, "", "<<x>"]


def test_words_of_any_script(spark):
    names = ["Łódź, ŁÓDŹ", "Молоко 2%", "米", "e\u0301te\u0301 été", "***", "Straße-Øl"]
    assert column(spark, names, text.fingerprint) == ["lodz", "2 молоко", "米", "ete", "", "ol straße"]


def test_too_large(spark):
    texts = ["RD$ 1.00", "123456789012345", "00012345678901234.50", "1,234,567,890,123,456.00", "none", None]
    assert column(spark, texts, prices.too_large) == [False, True, False, True, False, False]
