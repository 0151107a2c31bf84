"""Price data made from the trade tables.

The trade tables hold what price surveys hold under other names: a part is a
product, a supplier or its region a vendor, an order line an observed price.
Everything here is derived from whole tables and grows with them.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from pricegrid.functions.dates import MONTHS

REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
PARTS_PER_PAGE = 40
PARTS_PER_FILE = 400
ROWS_PER_HTML_PAGE = 50


@cache
def _schema(spark: SparkSession, path: str) -> T.StructType:
    """Schema of a table, read once: the tables do not change during a run."""
    return spark.read.parquet(path).schema


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    return spark.read.schema(_schema(spark, path)).parquet(path)


def money(column: str) -> Column:
    return F.col(column).cast("decimal(12,2)")


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers with nation and region names."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    places = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return (
        table(spark, sf_dir, "supplier")
        .join(places, F.col("s_nationkey") == F.col("n_nationkey"))
        .select("s_suppkey", "s_name", "n_name", "r_name")
    )


def prices(spark: SparkSession, sf_dir: str, product: str, vendor: str) -> DataFrame:
    """Order lines as ``(product, vendor, price, price_date)``."""
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(suppliers(spark, sf_dir), F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.col(product).alias("product"),
            F.col(vendor).alias("vendor"),
            money("l_extendedprice").alias("price"),
            F.col("l_shipdate").cast("date").alias("price_date"),
        )
    )


def quantities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Like ``prices``, by brand and region, with the small numbers of
    quantities, which repeat from day to day."""
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(suppliers(spark, sf_dir), F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.col("p_brand").alias("product"),
            F.col("r_name").alias("vendor"),
            money("l_quantity").alias("price"),
            F.col("l_shipdate").cast("date").alias("price_date"),
        )
    )


def month_name(day: Column) -> Column:
    return F.get(F.array(*map(F.lit, MONTHS)), F.month(day) - 1)


def day_text(day: Column) -> Column:
    return F.date_format(day, "dd")


def parts_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with their place in a report and, per region, the lowest price."""
    lines = table(spark, sf_dir, "lineitem").join(
        suppliers(spark, sf_dir), F.col("l_suppkey") == F.col("s_suppkey")
    )
    by_part = lines.groupBy("l_partkey").agg(
        *[
            F.min(F.when(F.col("r_name") == region, money("l_extendedprice"))).alias(f"price_{i}")
            for i, region in enumerate(REGIONS)
        ],
        F.max(F.when(F.col("r_name") == REGIONS[0], money("l_extendedprice"))).alias("top_price"),
    )
    key = F.col("p_partkey")
    file_no = F.floor(key / PARTS_PER_FILE).cast("int")
    start = F.date_add(F.lit("2020-01-01").cast("date"), file_no % 300)
    end = F.date_add(start, 6)
    return (
        table(spark, sf_dir, "part")
        .join(by_part, F.col("p_partkey") == F.col("l_partkey"), "left")
        .withColumns(
            {
                "page_no": F.floor(key % PARTS_PER_FILE / PARTS_PER_PAGE).cast("int"),
                "row_no": (key % PARTS_PER_PAGE + 3).cast("int"),
                "file_url": F.concat_ws(
                    "-",
                    F.lit("https://example.org/files/sondeo"),
                    F.translate(file_no.cast("string"), "0123456789", "abcdefghij"),
                    F.lit("del"), day_text(start), month_name(start),
                    F.lit("al"), day_text(end), month_name(end), F.lit("2020.pdf"),
                ),
            }
        )
    )


def price_texts() -> list[Column]:
    """The region prices the way five different vendors write them."""
    price = [F.col(f"price_{i}") for i in range(len(REGIONS))]
    grouped = F.format_number(price[2], 2)
    return [
        F.format_number(price[0], 2),
        F.concat(F.lit("RD$ "), price[1].cast("string")),
        F.translate(grouped, ",.", ".,"),
        price[3].cast("string"),
        F.translate(price[4].cast("string"), ".", ","),
    ]


def _grid(parts: DataFrame, body: list[tuple], header: list[tuple], pages: Column | None = None) -> DataFrame:
    """Cells of body rows and, for every page, header rows.

    ``body`` has ``(table_no, col_no, text)``, ``header`` has
    ``(table_no, row_no, col_no, text)``.
    """
    if pages is not None:
        parts = parts.filter(pages)
    cells = parts.select(
        "file_url", "page_no", "row_no",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(t).alias("table_no"), F.lit(c).alias("col_no"), text.alias("cell"))
                    for t, c, text in body
                ]
            )
        ).alias("c"),
    ).select("file_url", "page_no", "c.table_no", "row_no", "c.col_no", "c.cell")
    text = lambda value: "null" if value is None else "'" + value.replace("\n", "\\n") + "'"
    structs = ", ".join(
        f"named_struct('table_no', {t}, 'row_no', {r}, 'col_no', {c}, 'cell', cast({text(value)} as string))"
        for t, r, c, value in header
    )
    heads = (
        parts.select("file_url", "page_no")
        .distinct()
        .select("file_url", "page_no", F.expr(f"inline(array({structs}))"))
    )
    return cells.unionByName(heads)


def _header(table_no: int, *rows: list) -> list[tuple]:
    return [
        (table_no, row_no, col_no, text)
        for row_no, row in enumerate(rows)
        for col_no, text in enumerate(row)
    ]


def basket_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Basket reports: two tables side by side on each page, with an average
    column that is no vendor and one vendor that appears twice."""
    texts = price_texts()
    parts = parts_by_region(spark, sf_dir)
    body = [
        (0, 0, F.col("p_name")),
        (0, 1, F.col("p_type")),
        (0, 2, texts[0]),
        (0, 3, texts[1]),
        (0, 4, texts[2]),
        (1, 0, texts[3]),
        (1, 1, texts[4]),
        (1, 2, F.col("p_retailprice").cast("decimal(12,2)").cast("string")),
        (1, 3, F.col("top_price").cast("string")),
    ]
    header = _header(
        0,
        ["Producto", "Unidad", "Super", "Super", "Super"],
        [None, None, "AFRICA", "AME\nRICA", "ASIA"],
        [None] * 5,
    ) + _header(
        1,
        ["", "Super", "Promedio\n Global", "Super"],
        ["EUROPE", "MIDDLE EAST", None, "AFRICA"],
        [None] * 4,
    )
    return _grid(parts, body, header)


def medicine_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medicine reports: even pages hold a generic and a commercial half."""
    parts = parts_by_region(spark, sf_dir)
    texts = price_texts()
    dual_body = ["p_name", "p_type", "p_brand", "p_name", "p_size", "p_type", "p_brand"]
    dual_head = [
        "Genérico A", "Principio Activo", "Marca A", "Marca B", "Concentración", "Forma",
        "Presentación",
    ]
    single_body = ["p_name", "p_type", "p_brand", "p_size"]
    single_head = ["Medicamento", "Dosis", "Laboratorio", "Unidad"]

    def grid(names: list[str], attributes: list[str], pages: Column) -> DataFrame:
        values = [F.col(a).cast("string") for a in attributes] + texts
        body = [(0, i, value) for i, value in enumerate(values)]
        blank = [None] * len(values)
        return _grid(parts, body, _header(0, names + REGIONS, blank, blank), pages)

    even = F.col("page_no") % 2 == 0
    return grid(dual_head, dual_body, even).unionByName(grid(single_head, single_body, ~even))


def _html_pages(rows: DataFrame, page: Column, order: str, cells: list[Column], head: str) -> DataFrame:
    """Pages with a table of ``ROWS_PER_HTML_PAGE`` rows each."""
    row = F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), c, F.lit("</td>\n")) for c in cells], F.lit("</tr>"))
    entries = F.array_sort(F.collect_list(F.struct(F.col(order), row.alias("tr"))))
    body = F.array_join(F.transform(entries, lambda entry: entry["tr"]), "\n")
    return (
        rows.groupBy(page.cast("bigint").alias("page_id"))
        .agg(body.alias("body"))
        .select(
            "page_id",
            F.concat(F.lit("https://example.org/precios/"), "page_id").alias("url"),
            F.concat(
                F.lit(
                    "<html><!-- <table class='table-striped'> --><body><div class='container'>"
                    f"<div class='impre'>{head}</div></div><div id=\"productos\"><div class='impre'><center>"
                    '<table class="table table-striped"><tr><th>a</th></tr>'
                ),
                "body",
                F.lit("</table></center></div></div></body></html>"),
            ).alias("html"),
        )
    )


def flower_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as flower price tables; the unit is set in bold for promotions."""
    unit = F.when(F.col("p_type") == "PROMO", F.lit("<b>PROMO</b>")).otherwise(F.col("p_type"))
    return _html_pages(
        table(spark, sf_dir, "part"),
        F.floor(F.col("p_partkey") / ROWS_PER_HTML_PAGE),
        "p_partkey",
        [
            F.concat("p_brand", F.lit(" &amp; Co")),
            F.concat(F.lit("\n  "), "p_name", F.lit(" ")),
            unit,
            F.concat(F.lit("RD$"), F.format_number(money("p_retailprice"), 2)),
        ],
        "<p> 03/01/2020 </p>",
    )


def fee_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as bus fare tables of nine columns."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    rows = (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    key = F.col("c_custkey").cast("string")
    return _html_pages(
        rows,
        F.floor(F.col("c_custkey") / ROWS_PER_HTML_PAGE),
        "c_custkey",
        [
            F.col("r_name"),
            F.col("n_name"),
            F.concat(F.lit("Ruta "), key),
            F.col("c_mktsegment"),
            F.concat(F.lit("809-"), F.lpad(key, 7, "0")),
            F.col("c_name"),
            F.concat("n_name", F.lit(" centro")),
            F.concat(F.lit("L"), key),
            F.abs(money("c_acctbal")).cast("string"),
        ],
        "<div id='fecha'>Enero 2020</div>",
    )


def link_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages' ids and addresses, with containers of links as people write them:
    either quote, none, entities, a quote inside, very long attributes, tags left
    open, inner containers, noise."""
    page = F.col("page_id").cast("string")
    link = lambda before, name, after: F.concat(F.lit(before), F.lit(name), page, F.lit(after))
    html = F.concat(
        F.lit("<html><script>var a = '<div class=\"filetitle\"><a href=no.pdf>';</script><body>"),
        F.lit('<div class="x"><a href="outside.pdf">o</a></div><div class="a filetitle"><b>n</b>'),
        link('<a class="x>y" href="', "it's-", '.pdf">1</a>'),
        link(f"<a data-x={'y' * 20_000} href=", "plain-", f".pdf title='{'>' * 20_000}'>2</a><a <b \"<a b"),
        link("<A HREF = '", 'say "so"-', ".pdf'>3</A>"),
        link('<a data-href="no.pdf" href="', "a&ntilde;o-&#225;&#xe9;&amp;lt;-", '.pdf">4</a><a name="no">no</a>'),
        # on every other page a container lies inside the container
        F.when(F.col("page_id") % 2 == 0, F.lit("<div><i>inner</i></div>")).otherwise(F.lit("<p>none</p>")),
        link("<a href='", "last-", ".pdf'>5</a>"),
        F.lit("</div><!-- <div class='filetitle'><a href='no.pdf'></a></div> --></body></html>"),
    )
    return table(spark, sf_dir, "pages").select("page_id", "url", html.alias("html"))


def index_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index pages that link to the basket reports, fifty reports a page."""
    reports = parts_by_region(spark, sf_dir).select("file_url", "p_partkey").groupBy("file_url").agg(
        F.floor(F.min("p_partkey") / PARTS_PER_FILE / 50).cast("bigint").alias("page_id")
    )
    link = F.concat(F.lit("<div class='filetitle'><b>n</b><a href='"), "file_url", F.lit("'>x</a></div>"))
    return (
        reports.groupBy("page_id")
        .agg(F.array_join(F.array_sort(F.collect_list(link)), "\n").alias("html"))
        .select("page_id", F.concat(F.lit("https://example.org/i/"), "page_id").alias("url"), "html")
    )


def spelled_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as ``(id, name)``, their names in four scripts by key: as they are,
    Polish, Cyrillic, Chinese, and without any letter."""
    name, key = F.col("p_name"), F.col("p_partkey")
    spelled = (
        F.when(key % 5 == 1, F.concat(F.lit("ŁÓDŹ "), name))
        .when(key % 5 == 2, F.concat(F.lit("Молоко, "), "p_type"))
        .when(key % 5 == 3, F.concat(F.lit("米 "), "p_brand"))
        .when(key % 5 == 4, F.concat(F.lit("** "), F.repeat(F.lit("*"), (key % 3).cast("int"))))
        .otherwise(name)
    )
    return table(spark, sf_dir, "part").select(key.alias("id"), spelled.alias("name"))


def uneven_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Basket reports with pages that the guards are for: every fifth page ends
    after two header rows, descriptions of promotions are blank, the first header
    cell, like every description, is there twice, and small parts cost more in
    one column than a price can be."""
    cells = basket_cells(spark, sf_dir)
    short = F.col("page_no") % 5 == 4
    promo = table(spark, sf_dir, "part").filter("p_type = 'PROMO'")
    place = [
        F.floor(F.col("p_partkey") / PARTS_PER_FILE).cast("int").alias("file_no"),
        F.floor(F.col("p_partkey") % PARTS_PER_FILE / PARTS_PER_PAGE).cast("int").alias("page_no"),
        (F.col("p_partkey") % PARTS_PER_PAGE + 3).cast("int").alias("row_no"),
    ]
    blank = promo.select(*place, F.lit(True).alias("blank"))
    small = table(spark, sf_dir, "part").filter("p_size <= 2")
    dear = small.select(*place, F.lit(True).alias("dear"))
    numbered = cells.withColumn(
        "file_no",
        F.translate(F.regexp_extract("file_url", "sondeo-([a-j]+)-del", 1), "abcdefghij", "0123456789").cast("int"),
    )
    first = (F.col("table_no") == 0) & (F.col("col_no") == 0)
    priced = (F.col("table_no") == 0) & (F.col("col_no") == 3)
    uneven = (
        numbered.join(blank, ["file_no", "page_no", "row_no"], "left")
        .join(dear, ["file_no", "page_no", "row_no"], "left")
        .withColumn("cell", F.when(F.col("dear") & priced & F.col("cell").isNotNull(), F.lit("RD$ 123,456,789,012,345,678.00")).otherwise(F.col("cell")))
        .filter(~short | (F.col("row_no") < 2))
        .withColumn("cell", F.when(first & F.col("blank"), F.lit("  ")).otherwise(F.col("cell")))
        .select(*cells.columns)
    )
    again = uneven.filter(first & F.col("cell").isNotNull()).withColumn("cell", F.concat("cell", F.lit(" bis")))
    return uneven.unionByName(again)


def narrow_medicine_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medicine reports of two columns, a name and the one vendor, and of three."""
    parts = parts_by_region(spark, sf_dir)
    price = F.col("price_0").cast("string")
    even = F.col("page_no") % 2 == 0
    two = _grid(parts, [(0, 0, F.col("p_name")), (0, 1, price)], _header(0, ["Medicamento", "AFRICA"], [None] * 2, [None] * 2), even)
    values = [F.col("p_name"), F.col("p_type"), F.col("p_brand"), F.col("p_size").cast("string"), price]
    names = ["Medicamento", "Dosis", "Laboratorio", "Unidad", "AFRICA"]
    wide = _grid(parts, [(0, i, v) for i, v in enumerate(values)], _header(0, names, [None] * 5, [None] * 5), ~even)
    return two.unionByName(wide)


def untidy_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a raw feed with stray blanks and several ways to say "none"."""
    segment, balance = F.col("c_mktsegment"), money("c_acctbal")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.concat(F.lit(" \t"), "c_name", F.lit("\u00a0 S.A.\n")).alias("vendor"),
        F.when(segment == "BUILDING", "N/A").when(segment == "MACHINERY", "  ").otherwise(segment).alias("unit"),
        F.when(balance < 0, "--").otherwise(F.concat(F.lit("RD$ "), balance.cast("string"))).alias("price"),
    )


def order_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as reports, named in one of five ways by their priority."""
    start = F.col("o_orderdate").cast("date")
    end = F.date_add(start, 7)
    year = lambda day: F.date_format(day, "yyyy")
    plain = [F.lit("sondeo-del"), day_text(start), F.lit("al"), day_text(end), F.lit("de"), month_name(start), year(start)]
    late = F.col("o_orderstatus") == "F"
    priority = F.col("o_orderpriority")
    name = (
        F.when(priority == "1-URGENT", F.concat_ws("-", *plain))
        .when(
            priority == "2-HIGH",
            F.concat_ws("-", F.lit("sondeo-del"), day_text(start), month_name(start), F.lit("al"), day_text(end), month_name(end), year(start)),
        )
        .when(
            priority == "3-MEDIUM",
            F.concat_ws("%20", F.lit("del"), day_text(start), month_name(start), year(start), F.lit("al"), day_text(end), F.upper(month_name(end)), year(end)),
        )
        .when(priority == "4-NOT SPECIFIED", F.concat_ws("-", F.lit("canasta"), month_name(start), year(start)))
        .when(late, F.concat(F.lit("del_"), day_text(start), F.lit("_"), month_name(start), F.lit("-"), year(start)))
        .otherwise(F.concat_ws("%2520", *plain))
    )
    return table(spark, sf_dir, "orders").withColumn(
        "file_url", F.concat(F.lit("https://example.org/files/"), name, F.lit(".pdf"))
    )
