"""Survey grids: cells in, one row per priced product and vendor out.

A survey page is one or more tables side by side. Three header rows name the
columns, the first columns describe the product, each further column is one
vendor. Column names differ from page to page, so nothing is ever pivoted to a
wide frame; cells stay long and meet their page's column layout in a join.

The layout of a page (its headers, three cells per column) is small whatever
the page's length, so it is worked out on one row per page with array
functions. The body is shuffled once, by page and row block. A page with very
many rows is thereby spread over many tasks: its layout row is copied to each
block, a normal page has exactly one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from pricegrid.functions.dates import add_report_dates
from pricegrid.functions.prices import currency, is_priced, observation_id, parse_price, too_large
from pricegrid.functions.text import null_token, squeeze, strip
from pricegrid.functions.urls import file_stem, stored_file_name

HEADER_ROWS = 3
ROWS_PER_BLOCK = 4096
PAGE = ["file_url", "page_no"]
BLOCK = [*PAGE, "block"]
REPORT = ["dataset", "file_id", "start_date", "end_date", "date_error", "range_inverted"]
FILLER = "--"
PLACEHOLDER = r"Unnamed:\s\d+_level_\d+"

# A column whose label contains one of these is no vendor.
BASKET_EXCLUDED = (
    "CASA EDITORIAL", "n0", "NO", "Orden", "Resumen General Media y/o",
    "Promedio Global", "Precios", "Mínimo", "Máximo", "Moda", "Mediana",
    "Desviación", "Estándar",
)


def row_block() -> Column:
    """The part of a page that a row lies in."""
    return F.floor(F.col("row_no") / ROWS_PER_BLOCK).cast("int")


def any_of(terms: tuple[str, ...]) -> str:
    """Pattern for "contains one of these, in any case"."""
    return f"(?iu)({'|'.join(terms)})"


def clean_cell(cell: Column) -> Column:
    """Cell text without line breaks; an empty cell gets the filler."""
    return F.coalesce(F.replace(cell, F.lit("\n"), F.lit("")), F.lit(FILLER))


def page_tables(cells: DataFrame) -> DataFrame:
    """One row per page: its tables with their widths, and its row count.

    Pages without a full header are left out. The first aggregate runs on
    integers only and is combined before its shuffle; what is collected
    afterwards is one entry per table on a sheet.
    """
    tables = cells.groupBy(*PAGE, "table_no").agg(
        (F.max("col_no") + 1).alias("n_cols"), (F.max("row_no") + 1).alias("n_rows")
    )
    return (
        tables.groupBy(*PAGE)
        .agg(
            F.array_sort(F.collect_list(F.struct("table_no", "n_cols"))).alias("tables"),
            F.max("n_rows").alias("n_rows"),
        )
        .filter(F.col("n_rows") >= HEADER_ROWS)
    )


def page_headers(cells: DataFrame) -> DataFrame:
    """One row per page with the cells of its header rows, each once.

    Of two texts for one cell the lowest holds, as in the body.
    """
    return (
        cells.filter(F.col("row_no") < HEADER_ROWS)
        .groupBy(*PAGE, "table_no", "col_no", "row_no")
        .agg(F.min("cell").alias("cell"))
        .groupBy(*PAGE)
        .agg(F.collect_list(F.struct("table_no", "col_no", "row_no", "cell")).alias("header"))
    )


def concat_tables(pages: DataFrame) -> DataFrame:
    """Put a page's tables side by side.

    ``first_col`` maps a table to the page column its column 0 becomes.
    """
    tables = F.col("tables")
    offsets = F.transform(
        tables,
        lambda table, i: F.aggregate(
            F.slice(tables, F.lit(1), i), F.lit(0), lambda total, left: total + left["n_cols"]
        ),
    )
    return pages.withColumn(
        "first_col", F.map_from_arrays(F.transform(tables, lambda t: t["table_no"]), offsets)
    ).withColumn(
        "width", F.aggregate(tables, F.lit(0), lambda total, table: total + table["n_cols"])
    )


def label_columns(pages: DataFrame, clean: bool) -> DataFrame:
    """Merge the header rows to one label per page column.

    An empty header cell gets a placeholder, a header that repeats an earlier
    one gets a running number (``label``; ``plain`` is without it).
    """
    text = F.map_from_entries(
        F.transform(
            F.coalesce("header", F.array()),
            lambda h: F.struct(
                (F.try_element_at("first_col", h["table_no"]) + h["col_no"]) * HEADER_ROWS
                + h["row_no"],
                h["cell"],
            ),
        )
    )

    def part(col: Column, level: int) -> Column:
        cell = F.try_element_at("header_text", col * HEADER_ROWS + level)
        if clean:
            cell = clean_cell(cell)
        return F.when(
            F.coalesce(cell, F.lit("")) == "",
            F.format_string(f"Unnamed: %d_level_{level}", col),
        ).otherwise(cell)

    parts = F.transform(
        F.sequence(F.lit(0), F.col("width") - 1),
        lambda col: F.struct(
            col.alias("gcol"), F.array(*[part(col, level) for level in range(HEADER_ROWS)]).alias("parts")
        ),
    )

    def label(column: Column, i: Column) -> Column:
        earlier = F.slice("named", F.lit(1), i)
        repeats = F.size(F.filter(earlier, lambda other: other["parts"] == column["parts"]))
        plain = F.translate(F.array_join(column["parts"], " "), "\n", "|")
        return F.struct(
            column["gcol"].alias("gcol"),
            F.when(repeats > 0, F.concat(plain, F.lit("."), repeats.cast("string")))
            .otherwise(plain)
            .alias("label"),
            plain.alias("plain"),
        )

    return (
        pages.withColumn("header_text", text)
        .withColumn("named", parts)
        .withColumn("columns", F.transform("named", label))
    )


def drop_columns(pages: DataFrame, excluded: tuple[str, ...]) -> DataFrame:
    """Keep the columns whose label contains none of the excluded terms."""
    pattern = any_of(excluded)
    return pages.withColumn(
        "columns", F.filter("columns", lambda column: ~column["label"].rlike(pattern))
    )


def vendor_raw(label: Column) -> Column:
    """Label without header placeholders, spaces kept."""
    return F.regexp_replace(label, PLACEHOLDER, "")


def vendor_name(label: Column) -> Column:
    """Vendor to show: no placeholders, no fillers, single spaces."""
    return squeeze(F.regexp_replace(vendor_raw(label), rf"(?<=^|\s){FILLER}(?=\s|$)", ""))


def number_columns(columns: Column, variant: str) -> Column:
    """Final columns of one report variant, numbered from 0."""
    return F.transform(
        columns,
        lambda column, i: F.struct(
            F.lit(variant).alias("variant"),
            column["gcol"].alias("gcol"),
            i.alias("kcol"),
            F.size(columns).alias("n_cols"),
            vendor_raw(column["label"]).alias("vendor_raw"),
            vendor_name(column["plain"]).alias("vendor"),
        ),
    )


def page_layouts(cells: DataFrame, excluded: tuple[str, ...], clean: bool) -> DataFrame:
    """One row per page with its kept, labelled columns."""
    pages = page_tables(cells).join(page_headers(cells), PAGE, "left")
    return drop_columns(label_columns(concat_tables(pages), clean), excluded)


def attach_layout(cells: DataFrame, layouts: DataFrame) -> DataFrame:
    """Body cells with their column's number, vendor and variant.

    ``layouts`` carries the numbered columns as ``slots``. A cell of a dropped
    column finds no slot and goes, one that belongs to two variants comes twice.

    Empty cells do not travel: an attribute that finds no cell is taken as empty
    anyway. Prices are read before the shuffle, once per cell. The join carries
    no hint, so that it may sort and spill. There is no filter on ``slots``
    itself: pushed down, it would work out the whole layout again for every
    array element.
    """
    by_column = F.transform(
        F.sequence(
            F.lit(0), F.array_max(F.transform("slots", lambda slot: slot["gcol"]))
        ),
        lambda col: F.filter("slots", lambda slot: slot["gcol"] == col),
    )
    last_block = F.floor((F.col("n_rows") - 1) / ROWS_PER_BLOCK).cast("int")
    layouts = (
        layouts.withColumn("by_column", by_column)
        .select(
            *PAGE,
            "first_col",
            "by_column",
            *REPORT,
            F.explode(F.sequence(F.lit(0), last_block)).alias("block"),
        )
    )
    body = cells.filter((F.col("row_no") >= HEADER_ROWS) & F.col("cell").isNotNull())
    if "block" not in cells.columns:  # cells that are laid out by block have it, and need no shuffle
        body = body.withColumn("block", row_block())
    body = body.withColumn("price", parse_price(null_token(F.col("cell"))))
    # only asked where there is no price
    body = body.withColumn("price_too_large", F.col("price").isNull() & too_large(null_token(F.col("cell"))))
    gcol = F.try_element_at("first_col", F.col("table_no")) + F.col("col_no")
    return (
        body.join(layouts, BLOCK)
        .withColumn("slot", F.explode(F.get("by_column", gcol)))
        .select(
            *BLOCK, "row_no", "cell", "price", "price_too_large", *REPORT,
            "slot.variant", "slot.gcol", "slot.kcol", "slot.n_cols",
            "slot.vendor_raw", "slot.vendor",
        )
    )


def unpivot(cells: DataFrame, n_attributes: int) -> DataFrame:
    """One row per vendor cell with a price, attributes alongside as ``attr_i``.

    Cells without a price go before the sort; one whose amount is too large for
    the type stays, flagged. The windows' partitions are one grid row of a
    dataset and one cell of it; they lie within the block the cells are already
    shuffled by and share its one sort. Of cells that are there twice the lowest
    text holds.
    """
    keys = ["row_no", "variant", "block", "page_no", "file_url", "dataset"]
    row, twice = W.partitionBy(*keys), W.partitionBy(*keys, "kcol").orderBy("cell")
    return (
        cells.filter((F.col("kcol") < n_attributes) | is_priced(F.col("price")) | F.col("price_too_large"))
        .withColumn("copy", F.row_number().over(twice))
        .filter("copy = 1")
        .drop("copy")
        .select(
            "*",
            *[
                F.max(F.when(F.col("kcol") == i, F.col("cell"))).over(row).alias(f"attr_{i}")
                for i in range(n_attributes)
            ],
        )
        .filter(F.col("kcol") >= n_attributes)
    )


def with_report(layouts: DataFrame, dataset: str | DataFrame) -> DataFrame:
    """Add what a page inherits from its report: dataset, file id and dates.

    ``dataset`` is a name, or a DataFrame ``(file_url, dataset)`` that also
    selects the reports to convert; a file of two datasets is a report of each.
    """
    if isinstance(dataset, DataFrame):
        layouts = layouts.join(dataset.select("file_url", "dataset"), "file_url")
    else:
        layouts = layouts.withColumn("dataset", F.lit(dataset))
    return add_report_dates(
        layouts.withColumn("file_id", file_stem(stored_file_name(F.col("file_url")))), "file_url"
    )


def observation_columns() -> list[Column]:
    """The columns every kind of observation ends with."""
    return [
        F.col("vendor"),
        F.col("vendor_raw"),
        F.col("price"),
        F.col("price_too_large"),
        currency().alias("currency"),
        F.col("start_date"),
        F.col("end_date"),
        F.col("date_error"),
        F.col("range_inverted"),
    ]


def basket_prices(
    cells: DataFrame,
    dataset: str | DataFrame = "basic_baskets",
    excluded: tuple[str, ...] = BASKET_EXCLUDED,
) -> DataFrame:
    """Price observations of product by vendor grids with two attributes.

    A missing description or unit is NULL and kept, a blank one drops the row.
    """
    layouts = with_report(page_layouts(cells, excluded, clean=True), dataset)
    layouts = layouts.withColumn("slots", number_columns(F.col("columns"), "single"))
    body = cells.withColumn("cell", F.replace("cell", F.lit("\n"), F.lit("")))
    rows = unpivot(attach_layout(body, layouts), n_attributes=2)
    attributes = [
        strip(null_token(F.coalesce(f"attr_{i}", F.lit(FILLER)))).alias(name)
        for i, name in enumerate(["description", "unit"])
    ]
    return rows.select(
        observation_id("dataset", "file_url", "variant", "page_no", "row_no", "gcol").alias("id"),
        "dataset",
        "file_id",
        *attributes,
        *observation_columns(),
    ).filter("coalesce(description, '?') <> '' and coalesce(unit, '?') <> ''")
