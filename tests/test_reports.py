from decimal import Decimal

from pyspark.sql import functions as F

from grids import cell_rows, cells, headed
from pricegrid.operators import reports
from pricegrid.plans.surveys import as_prices, medicine_survey, new_reports, survey
from pricegrid.schemas import PAGES
from pricegrid.sources.pages import seeds

LINKS = "item_id long, pos int, file_url string"
DOWNLOADS = LINKS + ", ok boolean, path string"


def links(spark):
    rows = [(1, 0, "u/a.pdf"), (1, 1, "u/b.pdf"), (1, 2, "u/c.pdf"), (2, 0, "u/d.pdf")]
    return spark.createDataFrame(rows, LINKS)


def downloads(spark):
    rows = [
        (1, 0, "u/a.pdf", False, None),
        (1, 1, "u/b.pdf", True, "b.pdf"),
        (1, 2, "u/c.pdf", True, "c.pdf"),
        (2, 0, "u/d.pdf", False, None),
    ]
    return spark.createDataFrame(rows, DOWNLOADS)


def test_a_failed_download_does_not_shift_the_rest(spark):
    pairs = reports.paired(links(spark), downloads(spark)).collect()
    assert {(r.file_url, r.path) for r in pairs} == {("u/b.pdf", "b.pdf"), ("u/c.pdf", "c.pdf")}
    [item] = reports.nested_items(reports.paired(links(spark), downloads(spark))).collect()
    assert [(f.pos, f.path) for f in item.files] == [(1, "b.pdf"), (2, "c.pdf")]
    left = reports.items_with_files(links(spark), downloads(spark))
    assert {r.item_id for r in left.collect()} == {1}


def test_stored_and_converted_are_skipped(spark):
    named = reports.report_links(links(spark)).withColumn("dataset", F.lit("dairy"))
    # another dataset's file of the same name is another file
    stored = [("dairy", "a.pdf"), ("dairy", "a.pdf"), ("dairy", "z.pdf"), ("baskets", "d.pdf")]
    fresh = reports.not_stored(named, spark.createDataFrame(stored, "dataset string, file_name string"))
    assert {r.file_name for r in fresh.collect()} == {"b.pdf", "c.pdf", "d.pdf"}
    done = [("dairy", "b", "generic"), ("dairy", "b", "commercial"), ("baskets", "c", "single")]
    manifest = spark.createDataFrame(done, "dataset string, file_id string, variant string")
    assert {r.file_id for r in reports.not_converted(fresh, manifest).collect()} == {"c", "d"}


def test_last_written_wins(spark):
    rows = [("x", "a.pdf", 1, "u1"), ("x", "a.pdf", 5, "u2"), ("y", "a.pdf", 0, "u3")]
    df = spark.createDataFrame(rows, "dataset string, file_name string, pos int, file_url string")
    assert {r.file_url for r in reports.last_written(df).collect()} == {"u2", "u3"}


def test_from_page_to_observations(spark):
    site = "https://example.org"
    index = f"<div class='filetitle'><a href='{site}/f/canasta-abril-2020.pdf'>x</a></div>" * 2
    pages = spark.createDataFrame([(1, f"{site}/i", index), (2, f"{site}/old", index)], PAGES)
    seeds = spark.createDataFrame(
        [("text_books", f"{site}/i", True), ("x", f"{site}/old", False)],
        "dataset string, url string, active boolean",
    )
    none = spark.createDataFrame([], "dataset string, file_name string")
    found = new_reports(pages, seeds, none)
    assert found.count() == 2
    grid = headed(["P", "U", "A"], ["Libro", "Uno", "5.00"])
    url = f"{site}/f/canasta-abril-2020.pdf"
    table = cells(spark, cell_rows(grid, url=url), cell_rows(grid, url=f"{site}/f/other.pdf"))
    empty = spark.createDataFrame([], "dataset string, file_id string")
    [row] = survey(table, found, empty).collect()
    assert (row.dataset, row.file_id, row.price) == ("text_books", "canasta-abril-2020", Decimal(5))
    [price] = as_prices(survey(table, found, empty)).collect()
    assert (price.product, price.vendor, str(price.price_date)) == ("Libro", "A", "2020-04-01")
    done = spark.createDataFrame([("text_books", "canasta-abril-2020")], "dataset string, file_id string")
    assert survey(table, found, done).count() == 0
    assert medicine_survey(table, found, done).count() == 0


def test_a_file_of_two_datasets_is_a_report_of_each(spark):
    site = "https://example.org"
    index = f"<div class='filetitle'><a href='{site}/f/canasta-abril-2020.pdf'>x</a></div>"
    pages = spark.createDataFrame([(1, f"{site}/a", index), (2, f"{site}/b", index), (3, f"{site}/c", index)], PAGES)
    seeds = spark.createDataFrame(
        [("text_books", f"{site}/a", True), ("dairy", f"{site}/b", True), ("meat", f"{site}/c", True)], "dataset string, url string, active boolean"
    )
    stored = spark.createDataFrame([("meat", "canasta-abril-2020.pdf")], "dataset string, file_name string")
    found = new_reports(pages, seeds, stored)
    grid = headed(["P", "U", "A", "B"], ["Libro", "Uno", "5.00", "7.00"], ["Lápiz", "Uno", "1.00", "123456789012345678.00"])
    table = cells(spark, cell_rows(grid, url=f"{site}/f/canasta-abril-2020.pdf"))
    empty = spark.createDataFrame([], "dataset string, file_id string")
    rows = survey(table, found, empty).collect()
    assert sorted((r.dataset, r.description, r.vendor) for r in rows) == sorted(
        (d, p, v) for d in ("text_books", "dairy") for p in ("Libro", "Lápiz") for v in "AB"
    )
    assert len({r.id for r in rows}) == 8
    # an amount that the type cannot hold stays and says so
    assert [(r.price, r.price_too_large) for r in rows if (r.description, r.vendor) == ("Lápiz", "B")] == [(None, True)] * 2
    assert sum(r.price_too_large for r in rows) == 2
    assert as_prices(survey(table, found, empty)).count() == 6
    done = spark.createDataFrame([("dairy", "canasta-abril-2020")], "dataset string, file_id string")
    assert {r.dataset for r in survey(table, found, done).collect()} == {"text_books"}


def test_all_seeds(spark):
    rows = seeds(spark).collect()
    assert len(rows) == len({r.url for r in rows}) == 19
    assert {r.dataset for r in rows} == {
        "basic_baskets", "dairy_products", "hardware_products", "medicines", "text_books", "flowers", "transportation_fees",
    }
    assert {r.dataset for r in rows if r.active} == {r.dataset for r in rows}
