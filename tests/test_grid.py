from datetime import date
from decimal import Decimal

from grids import cell_rows, cells, headed
from pricegrid.operators import grid
from pricegrid.operators.grid import basket_prices
from pricegrid.operators.medicines import medicine_prices, written_variants
from pricegrid.session import scratch_dir
from pricegrid.sinks.files import write_laid_out_cells

BASKET = headed(
    ["Producto", "Unidad", "Super A", "Super\nB", "Promedio Global"],
    ["Arroz", "Libra", "30.50", "31.00", "30.75"],
    ["Leche", "Litro", None, "0.00", "0.00"],
    [" ", "Litro", "12.00", "13.00", "12.50"],
)


def basket(spark, *pages, **options):
    return basket_prices(cells(spark, *pages), **options)


def found(df):
    return sorted(
        (r.description, r.unit, r.vendor, r.price)
        for r in df.select("description", "unit", "vendor", "price").collect()
    )


def test_basket_grid(spark):
    rows = basket(spark, cell_rows(BASKET)).collect()
    assert sorted((r.description, r.unit, r.vendor, r.price) for r in rows) == [
        ("Arroz", "Libra", "Super A", Decimal("30.5")),
        ("Arroz", "Libra", "SuperB", Decimal("31")),
    ]
    assert {r.vendor_raw for r in rows} == {"Super A -- --", "SuperB -- --"}
    assert {(r.file_id, r.dataset, r.currency) for r in rows} == {
        ("sondeo-del-03-al-10-de-enero-2020", "basic_baskets", "DOP")
    }
    assert {(r.start_date, r.end_date) for r in rows} == {(date(2020, 1, 3), date(2020, 1, 10))}
    assert len({r.id for r in rows}) == 2


def test_ids_do_not_change(spark):
    ids = lambda parts: sorted(
        r.id for r in basket_prices(cells(spark, cell_rows(BASKET)).repartition(parts)).collect()
    )
    assert ids(1) == ids(7)


def test_tables_side_by_side(spark):
    left = headed(["Producto", "Unidad"], ["Arroz", "Libra"], ["Pan", "Uno"])
    right = headed(["A", "B"], ["1.50", "2.50"], ["3.00", None], ["4.00", "5.00"])
    assert found(basket(spark, cell_rows(left, right))) == [
        # the right table is longer: its last row has no attributes, only filler
        ("--", "--", "A", Decimal("4")),
        ("--", "--", "B", Decimal("5")),
        ("Arroz", "Libra", "A", Decimal("1.5")),
        ("Arroz", "Libra", "B", Decimal("2.5")),
        ("Pan", "Uno", "A", Decimal("3")),
    ]


def test_short_page_is_skipped(spark):
    assert found(basket(spark, cell_rows(BASKET[:2]))) == []
    assert found(basket(spark, cell_rows(BASKET[:3]))) == []
    both = basket(spark, cell_rows(BASKET[:2], page_no=0), cell_rows(BASKET, page_no=1))
    assert both.count() == 2


def test_placeholder_repeat_and_exclusion(spark):
    wide = [
        ["Producto", "Unidad", "", "Tienda", "Tienda", "Moreno", "Máximo", "MÍNIMO"],
        ["", "", "", "X", "X", "", "", ""],
        ["", "", "", "", "", "", "", ""],
        ["Arroz", "Libra", "1", "2", "3", "4", "5", "6"],
    ]
    rows = basket(spark, cell_rows(wide)).orderBy("price").collect()
    # "Moreno" contains an excluded term, as in the surveys' own rule
    assert [(r.vendor_raw, r.vendor) for r in rows] == [
        ("  ", ""),
        ("Tienda X ", "Tienda X"),
        # an empty third level is named after its column, so these two differ
        ("Tienda X ", "Tienda X"),
    ]
    same = [row[:2] + row[3:5] for row in wide]
    same[2] = ["", "", "Z", "Z"]
    rows = basket(spark, cell_rows(same)).orderBy("price").collect()
    assert [(r.vendor_raw, r.vendor) for r in rows] == [
        ("Tienda X Z", "Tienda X Z"),
        ("Tienda X Z.1", "Tienda X Z"),
    ]


def test_placeholder_of_column_100(spark):
    width = 101
    table = [["P", "U"] + [""] * (width - 2)] * 3 + [["Arroz", "Libra"] + ["7"] * (width - 2)]
    rows = basket(spark, cell_rows(table)).collect()
    assert len(rows) == width - 2
    assert {r.vendor for r in rows} == {""}


def test_missing_attribute_is_null_and_kept(spark):
    table = headed(["P", "U", "A"], ["", "Libra", "1"], ["NA", "x", "2"], ["y", " ", "3"])
    got = basket(spark, cell_rows(table)).orderBy("price").collect()
    assert [(r.description, r.unit) for r in got] == [(None, "Libra"), (None, "x")]


def test_long_page_is_split_over_blocks(spark, monkeypatch):
    body = [[f"p{i}", "u", str(i + 1)] for i in range(500)]
    page = cell_rows(headed(["P", "U", "A"], *body))
    whole = found(basket(spark, page))
    monkeypatch.setattr(grid, "ROWS_PER_BLOCK", 16)
    assert found(basket(spark, page)) == whole
    assert len(whole) == 500


def test_reports_select_and_name_the_dataset(spark):
    other = "https://example.org/files/libros-abril-2020.pdf"
    reports = spark.createDataFrame([(other, "text_books")], "file_url string, dataset string")
    df = basket(spark, cell_rows(BASKET), cell_rows(BASKET, url=other), dataset=reports)
    assert {(r.dataset, r.file_id, str(r.start_date)) for r in df.collect()} == {
        ("text_books", "libros-abril-2020", "2020-04-01")
    }


CASE_A = [
    "Genérico Nombre A", "Principio Activo", "Marca A", "Marca B", "Concentración",
    "Farmacia X", "Farmacia Y",
]
CASE_B = CASE_A[:5] + ["Forma", "Presentación"] + CASE_A[5:]


def medicines(spark, labels, *body):
    return medicine_prices(cells(spark, cell_rows(headed(labels, *body))))


def test_dual_page_too_narrow_gives_nothing(spark):
    row = ["g", "ibuprofeno", "Advil", "Motrin", "200mg", "10.00", "12.00"]
    assert medicines(spark, CASE_A, row).count() == 0


def test_dual_page(spark):
    row = ["g", "ibuprofeno", "Advil", "Motrin", "200mg", "tableta", "caja", "10.00", "12.00"]
    df = medicines(spark, CASE_B, row)
    got = sorted(
        (r.variant, r.medication_name, r.dosage, r.maker, r.unit, r.vendor, r.price)
        for r in df.collect()
    )
    assert got == [
        ("commercial", "Advil", "Motrin", "tableta", "caja", "Farmacia X", Decimal(10)),
        ("commercial", "Advil", "Motrin", "tableta", "caja", "Farmacia Y", Decimal(12)),
        ("generic", "ibuprofeno", "tableta", "caja", "10.00", "Farmacia Y", Decimal(12)),
    ]
    assert sorted(r.variant for r in written_variants(df).collect()) == ["commercial", "generic"]


def test_equally_wide_halves_share_labels(spark):
    labels = ["Principio Activo", "Activo 2", "Marca A", "Marca B", "F", "P", "Q", "Activo X"]
    labels[7] = "Farmacia X"
    row = ["a", "b", "c", "d", "e", "f", "g", "9"]
    df = medicines(spark, labels, row)
    got = {(r.variant, r.medication_name, r.dosage, r.maker, r.unit, r.vendor, r.price) for r in df.collect()}
    assert got == {
        ("generic", "a", "b", "e", "f", "Farmacia X", Decimal(9)),
        ("commercial", "c", "d", "e", "f", "Farmacia X", Decimal(9)),
    }


def test_single_page(spark):
    labels = ["Medicamento", "Dosis", "Laboratorio", "Unidad", "Farmacia X"]
    row = ["aspirina", "100mg", "Bayer", "caja", "5.00"]
    [r] = medicines(spark, labels, row).collect()
    assert (r.variant, r.medication_name, r.dosage, r.maker, r.unit, r.vendor, r.price) == (
        "single", "aspirina", "100mg", "Bayer", "caja", "Farmacia X", Decimal(5),
    )
    assert medicines(spark, labels[:4], row[:4]).count() == 0


def test_blank_and_missing_medicine_attributes(spark):
    labels = ["Medicamento", "Dosis", "Laboratorio", "Unidad", "Farmacia X"]
    df = medicines(spark, labels, [" ", " ", " ", " ", "5"], [None, " ", " ", " ", "6"])
    [r] = df.collect()
    assert (r.medication_name, r.dosage, r.price) == (None, "", Decimal(6))


def test_newline_in_medicine_label(spark):
    labels = ["Medicamento", "Dosis", "Laboratorio", "Unidad", "Farmacia\nX"]
    [r] = medicines(spark, labels, ["a", "b", "c", "d", "5"]).collect()
    assert r.vendor == "Farmacia|X"


def test_body_is_shuffled_once(spark):
    path = spark.conf.get("spark.checkpoint.dir") + "/cells-plan"
    cells(spark, cell_rows(BASKET)).write.mode("overwrite").parquet(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = basket_prices(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the body meets the layouts by block, and the window adds no exchange
    above_join = plan.split("SortMergeJoin")[0]
    assert "Window" in above_join and "Exchange" not in above_join
    assert "PushedFilters: [IsNotNull(row_no), IsNotNull(cell), GreaterThanOrEqual(row_no,3)" in plan


def test_cells_that_are_there_twice(spark):
    """The lowest text holds, in headers and in the body; nothing fails and no id repeats."""
    grid = headed(["P", "U", "A", "B"], ["Arroz", "lb", "5.00", "6.00"], ["Pan", "u", "7.00", "8.00"])
    rows = cell_rows(grid)
    again = [(*row[:-1], f"{row[-1]}9") for row in rows if row[-1]]
    once = sorted(tuple(r) for r in basket_prices(cells(spark, rows)).drop("id").collect())
    twice = basket_prices(cells(spark, rows, again))
    assert sorted(tuple(r) for r in twice.drop("id").collect()) == once
    assert twice.select("id").distinct().count() == len(once) == 4


def test_laid_out_cells_save_the_shuffle_of_the_body(spark):
    """Same rows from buckets, with one exchange fewer; a long page lies in several of them."""
    path, name = scratch_dir(spark, "laid-out"), "cells_of_a_test"
    long = [[f"p{i}", "u", "1.00", "2.00"] for i in range(5000)]
    plain = cells(spark, cell_rows(headed(["P", "U", "A", "B"], *long)), cell_rows(headed(["P", "U", "A"], ["x", "y", "3.00"]), page_no=1))
    write_laid_out_cells(plain, name, path, 4)
    hints = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in hints}
    try:
        for k, v in hints.items():
            spark.conf.set(k, v)
        both = [basket_prices(plain), basket_prices(spark.table(name))]
        # one line for each operator of the tree
        exchanges = [sum("Exchange hash" in line for line in df._jdf.queryExecution().executedPlan().treeString().splitlines()) for df in both]
        rows = [sorted(map(str, df.collect())) for df in both]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        spark.sql(f"drop table {name}")
    assert rows[0] == rows[1] and len(rows[0]) == 10001
    assert exchanges[1] < exchanges[0]
