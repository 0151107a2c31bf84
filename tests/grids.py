"""Small survey grids written as rows of cells."""

from pricegrid.schemas import CELLS

URL = "https://example.org/files/sondeo-del-03-al-10-de-enero-2020.pdf"


def cell_rows(*tables, url=URL, page_no=0):
    return [
        (url, page_no, table_no, row_no, col_no, cell)
        for table_no, table in enumerate(tables)
        for row_no, row in enumerate(table)
        for col_no, cell in enumerate(row)
    ]


def cells(spark, *rows):
    return spark.createDataFrame([row for page in rows for row in page], CELLS)


def headed(labels, *body):
    """A table whose labels sit in the first of three header rows."""
    blank = [None] * len(labels)
    return [labels, blank, blank, *body]
