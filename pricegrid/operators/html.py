"""Links, texts and table rows out of web pages.

Two ways to the same relations. The native one is regular expressions inside
the JVM. The parsed one reads each page once with the standard library's HTML
parser in Arrow batches and follows element nesting. Both take time in
proportion to the page, whatever is left open or broken in it: patterns are
possessive, so they neither go back nor use the stack, a tag ends where the
next one starts, and comments, scripts and styles without an end go on to the
end of the page.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pricegrid.functions.text import decode_entities, strip

# Where the surveys keep their links, dates and rows.
LINKS = "div.filetitle a"
FLOWERS_DATE = "div.container div.impre p"
FEES_DATE = "div.container div.impre div#fecha"
TABLE_ROWS = "div#productos div.impre center table.table-striped tr"

NOISE = (
    r"(?i)<(?:(script|style)(?=[\s/>])[^<]*+(?:<(?!/\1\s*+>)[^<]*+)*+(?:</\1\s*+>)?+"
    r"|!--[^-]*+(?:-(?!->)[^-]*+)*+(?:-->)?+)"
)
# What stands in a tag. Only after an equals sign does a quote open a value, which may hold the end of a tag.
IN_TAG = r"""(?:[^=<>]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+"""
# The parser is only given whole tags; what is left of others is text.
MARKUP = re.compile(
    NOISE.replace("(?i)", "") + rf"|</?[a-z]{IN_TAG}>|<[!?][^<>]*+>|(<)", re.IGNORECASE
)
# Pages whose findings are handed on together.
PAGES = 64
# Marks that stand for tags; an anchor follows its mark.
OPEN, OTHER, END, ANCHOR = "\x01", "\x02", "\x03", "\x04"
VOID = frozenset(
    "area base br col embed hr img input link meta source track wbr".split()
)
# An open element on the right ends where the one on the left starts.
ENDS_OPEN = {
    "li": {"li"},
    "p": {"p"},
    "div": {"p"},
    "ul": {"p"},
    "center": {"p"},
    "table": {"p"},
}
# The same for parts of a table, whatever is left open inside them.
ENDS_PART = {
    "td": {"td", "th"},
    "th": {"td", "th"},
    "tr": {"tr"},
    "tbody": {"tr", "tbody", "thead"},
}


def without_noise(html: Column) -> Column:
    """Markup without scripts, styles and comments."""
    return F.regexp_replace(html, NOISE, "")


def attribute(tag: Column, name: str) -> Column:
    """Value of a tag's attribute as it is written, NULL if there is none."""
    any_value = r"""(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)"""
    value = r"""(?:"([^"]*+)"|'([^']*+)'|([^\s"'>][^\s>]*+))"""
    # all attributes before it, each with its value
    others = rf"(?:[\s/]*+(?!{name}\s*=)[^\s=<>/]++(?:\s*+=\s*+{any_value}?+)?+|=)*+"
    pattern = rf"(?is)^<[a-z][a-z0-9]*+{others}[\s/]*+{name}\s*+=\s*+{value}.*+"
    return F.when(tag.rlike(pattern), F.regexp_replace(tag, pattern, "$1$2$3"))


def has_class(tag: Column, name: str) -> Column:
    return F.coalesce(F.array_contains(F.split(attribute(tag, "class"), r"\s+"), name), F.lit(False))


def elements(html: Column, tag: str, class_name: str | None = None) -> Column:
    """Inner markup of every ``tag`` element up to its first end tag, or the page's end.

    For elements that do not hold others of their kind.
    """
    start = rf"(?is)<{tag}(?=[\s/>]){IN_TAG}>"
    whole = F.regexp_extract_all(html, F.lit(rf"{start}.*?(?:</{tag}\s*+>|\z)"), F.lit(0))
    if class_name:
        whole = F.filter(whole, lambda element: has_class(F.regexp_extract(element, start, 0), class_name))
    return F.transform(whole, lambda element: F.regexp_extract(element, rf"{start}(.*?)(?:</{tag}\s*+>)?\z", 1))


def links(pages: DataFrame, tag: str = "div", class_name: str | None = "filetitle") -> DataFrame:
    """Anchors' targets inside a container, in page order, natively where that is sure.

    Repeated and relative links stay as they are. A page whose container holds
    another element of its kind, or is left open, needs nesting and goes
    through the parser; so each page is read once, one way or the other.
    """
    tags = F.regexp_extract_all("plain", F.lit(rf"(?is)<(?:/?{tag}|a)(?=[\s/>]){IN_TAG}>"), F.lit(0))

    def mark(found: Column) -> Column:
        held = has_class(found, class_name) if class_name else F.lit(True)
        return (
            F.when(found.startswith("</"), END)
            .when(found.rlike(r"^<[aA][\s/>]"), F.concat(F.lit(ANCHOR), F.translate(found, OPEN + OTHER + END + ANCHOR, "")))
            .when(held, OPEN)
            .otherwise(OTHER)
        )

    count = lambda marks: F.length("marked") - F.length(F.translate("marked", marks, ""))
    # before a container's end another element of its kind starts, or the page ends
    unsure = F.col("marked").rlike(f"{OPEN}[^{OPEN}{OTHER}{END}]*+(?:[{OPEN}{OTHER}]|\\z)") | (count(OPEN + OTHER) != count(END))
    # what stands between a container's start and end: its anchors
    inside = F.regexp_extract_all("marked", F.lit(f"{OPEN}([^{OPEN}{OTHER}{END}]*+)"), F.lit(1))
    anchors = F.filter(F.split(F.array_join(inside, ""), ANCHOR), lambda found: found != "")
    targets = F.filter(F.transform(anchors, lambda found: attribute(found, "href")), lambda href: href.isNotNull())
    read = (
        pages.select("page_id", "url", "html", without_noise(F.col("html")).alias("plain"))
        .withColumn("marked", F.array_join(F.transform(tags, mark), ""))
        .withColumn("nested", F.coalesce(unsure, F.lit(False)))
        .select(
            "page_id", "url", "nested",
            F.when(~F.col("nested"), targets).alias("links"),
            F.when(F.col("nested"), F.make_valid_utf8("html")).alias("html"),
        )
    )
    selector = f"{tag} a" if class_name is None else f"{tag}.{class_name} a"

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("links")
            if found.null_count:
                pairs = zip(found.to_pylist(), batch.column("html").to_pylist())
                found = pa.array(
                    [given if html is None else PageReader(links=selector).read(html).links for given, html in pairs], pa.list_(pa.string())
                )
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], found], ["page_id", "url", "nested", "links"])

    hrefs = read.mapInArrow(parse, "page_id bigint, url string, nested boolean, links array<string>").select(
        "page_id", F.col("url").alias("page_url"), "nested", F.posexplode("links").alias("pos", "href")
    )
    target = F.when(F.col("nested"), F.col("href")).otherwise(decode_entities(F.col("href")))
    return hrefs.select("page_id", "page_url", "pos", target.alias("file_url"))


def first_text(html: Column, tag: str) -> Column:
    """Text of the first ``tag`` element that starts with text, else NULL."""
    found = F.regexp_extract(without_noise(html), rf"(?is)<{tag}(?=[\s/>]){IN_TAG}>([^<]++)", 1)
    return F.nullif(strip(decode_entities(found)), F.lit(""))


def cell_text(cell: Column) -> Column:
    """Leading text of a cell's markup, empty if it starts with an element."""
    return F.coalesce(strip(decode_entities(F.regexp_extract(cell, r"(?s)^([^<]*+)", 1))), F.lit(""))


def table_rows(pages: DataFrame, class_name: str = "table-striped") -> DataFrame:
    """Cell texts per table row, natively: ``(page_id, row_no, cells)``."""
    tables = F.array_join(elements(without_noise(F.col("html")), "table", class_name), " ")
    return (
        pages.select("page_id", "html", F.posexplode(elements(tables, "tr")).alias("row_no", "tr"))
        .select("page_id", "row_no", F.transform(elements(F.col("tr"), "td"), cell_text).alias("cells"))
    )


def grid_cells(rows: DataFrame, file_url: str = "page_url") -> DataFrame:
    """Table rows as grid cells, so that HTML tables and PDF grids go one way."""
    return rows.select(
        F.col(file_url).alias("file_url"),
        F.lit(0).alias("page_no"),
        F.lit(0).alias("table_no"),
        "row_no",
        F.posexplode("cells").alias("col_no", "cell"),
    )


class Selector:
    """A chain of descendants such as ``div#main ul.list a``."""

    def __init__(self, text: str):
        self.steps = []
        for step in text.split():
            head, _, class_name = step.partition(".")
            tag, _, ident = head.partition("#")
            self.steps.append((tag, ident, class_name))

    def advance(self, done: int, element: tuple) -> tuple[int, bool]:
        """Steps met down to an element, given those met above it, and whether it is selected.

        A descendant may lie at any depth, so meeting each step as early as
        possible loses nothing; a path is never walked again.
        """
        last = len(self.steps) - 1
        selected = done >= last and self._fits(self.steps[last], element)
        if done < last and self._fits(self.steps[done], element):
            done += 1
        return done, selected

    @staticmethod
    def _fits(step, element) -> bool:
        tag, ident, class_name = step
        return (
            tag == element[0]
            and (not ident or ident == element[1])
            and (not class_name or class_name in element[2])
        )


class PageReader(HTMLParser):
    """One pass over a page: selected links, first text, table rows.

    A cell's text is its first own piece of text. A cell belongs to every
    selected row it lies in. Work is in proportion to the page, however deep
    its elements lie and however many are left open.
    """

    def __init__(self, links: str | None = None, text: str | None = None, rows: str | None = None):
        super().__init__(convert_charrefs=True)
        self.selectors = [Selector(chain) if chain else None for chain in (links, text, rows)]
        #: open elements: name, steps met by each selector, and whether selected by each
        self.path: list[tuple[str, list[int], list[bool]]] = []
        self.open: Counter[str] = Counter()
        self.links: list[str] = []
        self.text: str | None = None
        self.rows: list[list[str]] = []
        self.open_rows: list[tuple[int, list]] = []
        self.open_cells: list[tuple[int, list]] = []

    def handle_starttag(self, tag, attrs):
        self._imply_ends(tag)
        values = dict(reversed(attrs))  # the first one of a name counts
        element = (tag, values.get("id"), (values.get("class") or "").split())
        above = self.path[-1][1] if self.path else [0, 0, 0]
        met, selected = [0, 0, 0], [False, False, False]
        for i, selector in enumerate(self.selectors):
            if selector:
                met[i], selected[i] = selector.advance(above[i], element)
        self.path.append((tag, met, selected))
        self.open[tag] += 1
        depth = len(self.path)
        is_link, _, is_row = selected
        if is_link and values.get("href") is not None:
            self.links.append(values["href"])
        if is_row:
            row: list = []
            self.rows.append(row)
            self.open_rows.append((depth, row))
        elif tag == "td" and self.open_rows:
            cell = [""]
            for _, row in self.open_rows:
                row.append(cell)
            self.open_cells.append((depth, cell))
        if tag in VOID:
            self._close()

    def _imply_ends(self, tag):
        while self.path and self.path[-1][0] in ENDS_OPEN.get(tag, ()):
            self._close()
        parts = ENDS_PART.get(tag)
        if parts and any(self.open[part] for part in parts):
            for depth in range(len(self.path) - 1, -1, -1):
                name = self.path[depth][0]
                if name == "table":
                    break
                if name in parts:
                    while len(self.path) > depth:
                        self._close()
                    break

    def handle_endtag(self, tag):
        if self.open[tag]:
            while self._close() != tag:
                pass

    def _close(self) -> str:
        depth = len(self.path)
        if self.open_rows and self.open_rows[-1][0] == depth:
            self.open_rows.pop()
        if self.open_cells and self.open_cells[-1][0] == depth:
            self.open_cells.pop()
        tag = self.path.pop()[0]
        self.open[tag] -= 1
        return tag

    def handle_data(self, data):
        if self.text is None and self.path and self.path[-1][2][1]:
            self.text = data.strip()
        if self.open_cells:
            depth, cell = self.open_cells[-1]
            if depth == len(self.path) and len(cell) == 1:
                cell[0] = data.strip()
                cell.append(True)

    def read(self, html: str) -> PageReader:
        whole = MARKUP.sub(lambda found: "&lt;" if found[2] else "" if found[1] or found[0].startswith("<!") else found[0], html)
        self.feed(whole)
        self.close()
        return self

    def found(self) -> tuple[list[str], str | None, list[list[str]]]:
        """Links, first text, and the cells' texts by row."""
        return self.links, self.text, [[cell[0] for cell in row] for row in self.rows]


def read_batches(batches: Iterator[pa.RecordBatch], **selectors: str) -> Iterator[pa.RecordBatch]:
    """What pages hold, from ``page_id, url, html``, a few pages at a time.

    Beside its batch a task keeps one page's text; a batch goes before the next one comes.
    """
    for batch in batches:
        for low in range(0, batch.num_rows, PAGES):
            part = batch.slice(low, PAGES)
            found = [PageReader(**selectors).read(html.as_py() or "").found() for html in part.column("html")]
            links, texts, rows = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [
                    *part.columns[:2],
                    pa.array(links, pa.list_(pa.string())),
                    pa.array(texts, pa.string()),
                    pa.array(rows, pa.list_(pa.list_(pa.string()))),
                ],
                ["page_id", "page_url", "links", "text", "rows"],
            )
        batch = part = None


def read_pages(pages: DataFrame, **selectors: str) -> DataFrame:
    """``(page_id, page_url, links, text, rows)`` of parsed pages.

    Works page by page without a shuffle. Give it only the pages you need: a
    filter on the page text stays in the JVM.
    """
    return pages.select("page_id", "url", F.make_valid_utf8("html").alias("html")).mapInArrow(
        lambda batches: read_batches(batches, **selectors),
        "page_id bigint, page_url string, links array<string>, text string, rows array<array<string>>",
    )


def parsed_links(pages: DataFrame, selector: str = LINKS) -> DataFrame:
    """Links of ``selector``, in page order, from parsed pages."""
    return read_pages(pages, links=selector).select(
        "page_id", "page_url", F.posexplode("links").alias("pos", "file_url")
    )


def parsed_rows(pages: DataFrame, date_selector: str, selector: str = TABLE_ROWS) -> DataFrame:
    """Table rows with their page's publishing date text."""
    return read_pages(pages, text=date_selector, rows=selector).select(
        "page_id",
        "page_url",
        F.nullif("text", F.lit("")).alias("last_published_at"),
        F.posexplode("rows").alias("row_no", "cells"),
    )
