import datetime
import time

import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from pricegrid.operators import feeds, html
from pricegrid.schemas import PAGES
from pricegrid.sources.pages import read_page_files, seeds

INDEX = """<html><head><script>var x = '<div class="filetitle"><a href="/no.pdf">';</script></head>
<!-- <div class="filetitle"><a href="/no2.pdf">x</a></div> -->
<body><div class="filetitle"><a class=c href="/a.pdf?x=1&amp;y=2">A</a></div>
<div class="x filetitle y"><div><b>new</b></div><a href='b.pdf'>B</a><a name="z">no link</a></div>
<div class="filetitles"><a href="/no3.pdf">n</a></div>
<div class="filetitle"><p><a href="/a.pdf?x=1&amp;y=2">again</a></div><a href="/no4.pdf">n</a></body></html>"""

FLOWERS = """<div class="container"><div class="impre"><p></p><p> 03/01/2020 <b>x</b></p></div></div>
<div id="productos"><div class="impre"><center><table class="table table-striped">
<tr><th>h</th></tr>
<tr><td> Flor&iacute;a </td><td>Rosa<br>roja</td><td><b>5</b></td><td><b>x</b>RD$1,250.00</td></tr>
<tr><td>B<td>Lirio<td>docena<td>
12.50
<tr><td>too</td><td>short</td></tr></table>
<table class="other"><tr><td>a</td><td>b</td><td>c</td><td>1</td></tr></table></center></div></div>"""


def pages(spark, *texts):
    rows = [(i, f"https://example.org/{i}", t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, PAGES)


def test_parsed_links(spark):
    got = html.parsed_links(pages(spark, INDEX)).orderBy("pos").collect()
    assert [(r.pos, r.file_url) for r in got] == [
        (0, "/a.pdf?x=1&y=2"), (1, "b.pdf"), (2, "/a.pdf?x=1&y=2"),
    ]


def test_native_links(spark):
    flat = INDEX.replace("<div><b>new</b></div>", "")
    got = html.links(pages(spark, flat, "", None)).orderBy("pos").collect()
    assert [r.file_url for r in got] == ["/a.pdf?x=1&y=2", "b.pdf", "/a.pdf?x=1&y=2"]


def test_native_links_leave_nesting_to_the_parser(spark):
    nested = INDEX
    marked = """<div class="filetitle"><b>n</b><a href="it's.pdf">1</a><div>inner</div><a href=plain.pdf>2</a>
    <a title="a>b" href='say "so".pdf'>3</a><a data-href=no.pdf>4</a><a href="">5</a></div>"""
    open_ended = '<div class="filetitle"><a href="x.pdf">x</a>'
    frame = pages(spark, nested, marked, marked.replace("<div>inner</div>", ""), open_ended, None)
    got = {}
    for r in html.links(frame).orderBy("page_id", "pos").collect():
        got.setdefault(r.page_id, []).append(r.file_url)
    each = ["it's.pdf", "plain.pdf", 'say "so".pdf', ""]
    assert got == {0: ["/a.pdf?x=1&y=2", "b.pdf", "/a.pdf?x=1&y=2"], 1: each, 2: each, 3: ["x.pdf"]}
    parsed = html.parsed_links(frame).count()
    assert parsed == sum(map(len, got.values()))


# what a page may be full of, each left open or broken
HOSTILE = [
    '<div "', "<a ", "</a ", "<!-- ", '<a b="', "<a b='x>", "<script ", "<script>", "<a href=x><b></i>", "<div><a href=x>", "<", "<![",
    '="', "<a =", " class='", "<tr><td>", "<h1 ", "&#", "<a b=\"'<p c='\"", "<div class='filetitle'>", "<div class='filetitle'><a href=x>",
]


def _seconds(run):
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


@pytest.mark.parametrize("broken", HOSTILE)
def test_reading_is_linear(broken):
    read = lambda n: html.PageReader(links="div a", text="h1", rows="table tr").read("<div>" + broken * n)
    assert _seconds(lambda: read(16_000)) < 10 * _seconds(lambda: read(4_000)) + 0.2


def test_native_patterns_are_linear(spark):
    """All hostile pages at two sizes; four times the text must not take much more than four times as long."""

    def run(n):
        df = pages(spark, *["<div class=filetitle><a " + broken * n + " href=x.pdf>l</a></div>" for broken in HOSTILE]).repartition(1)
        df.select(html.first_text(F.col("html"), "h1"), html.without_noise(F.col("html"))).collect()
        html.links(df).count()
        html.table_rows(df).count()

    run(10)
    assert _seconds(lambda: run(12_000)) < 10 * _seconds(lambda: run(3_000)) + 3


def test_tags_of_any_length(spark):
    """Neither long attributes nor many of them end the application, whichever way a page goes."""
    long = "y" * 300_000
    marks = f'<a data-x={long} href="a.pdf">1</a><a title="{">" * 300_000}" href=b.pdf>2</a><a {"k=v " * 50_000}href=\'c.pdf\'>3</a>'
    flat = f'<div data-y="{long}" class="x filetitle">{marks}</div>'
    nested = f"<div class=filetitle>{marks}<div></div></div>"
    frame = pages(spark, flat, nested)
    for found in (html.links(frame), html.parsed_links(frame)):
        got = [(r.page_id, r.file_url) for r in found.orderBy("page_id", "pos").collect()]
        assert got == [(i, f) for i in (0, 1) for f in ("a.pdf", "b.pdf", "c.pdf")]


def test_both_ways_agree_on_odd_tags(spark):
    odd = [
        "<a href=it's.pdf>1</a><a title=it's href=z.pdf>2</a>",
        '<a class="x"href="y.pdf">1</a><a/href=s.pdf>2</a><A HREF = "u.pdf">3</A>',
        '<a href="first.pdf" href="second.pdf">1</a><a href>none</a><abbr href=no.pdf>x</abbr>',
        "<a <a href=x.pdf>1</a> a < b <a href=w.pdf>2</a>",
        "<a href='q.pdf'>1</a><!-- <a href=no.pdf> --><script>'<a href=no.pdf>'</script><style><a href=no.pdf></style >",
        "<a href='q.pdf'>1</a></div><!-- <div class=filetitle><a href=no.pdf></div>",
        "<a\thref\n=\n'nl.pdf'\n>1</a><a data-href=no.pdf>x</a><a title='href=no.pdf'>x</a>",
        "<a href=x.pdf>1</a></div><div class='filetitles'><a href=no.pdf></a></div><div class=Filetitle><a href=no.pdf></a>",
    ]
    frame = pages(spark, *[f'<div class="filetitle">{o}</div>' for o in odd])
    native, parsed = ([tuple(r) for r in f.orderBy("page_id", "pos").collect()] for f in (html.links(frame), html.parsed_links(frame)))
    assert native == parsed
    assert [r[3] for r in native] == [
        "it's.pdf", "z.pdf", "y.pdf", "s.pdf", "u.pdf", "first.pdf", "x.pdf", "w.pdf", "q.pdf", "q.pdf", "nl.pdf", "x.pdf",
    ]


def test_flowers(spark):
    day = datetime.date(2020, 1, 15)
    rows = feeds.flowers(pages(spark, FLOWERS, "<p>no table</p>"), day).orderBy("vendor").collect()
    assert [tuple(r) for r in rows] == [
        ("Lirio", "docena", "B", "12.50", "DOP", "03/01/2020", day),
        # only a cell's own text counts, and of that the first piece
        ("Rosa", "", "Floría", "RD$1,250.00", "DOP", "03/01/2020", day),
    ]
    typed = feeds.typed(feeds.flowers(pages(spark, FLOWERS)), "price")
    assert sorted(str(r.price) for r in typed.collect()) == ["12.5000", "1250.0000"]


def test_rows_without_a_date_are_kept(spark):
    [r] = feeds.flowers(pages(spark, FLOWERS.replace("03/01/2020", "").replace("<td>B", "<th>B"))).collect()
    assert r.last_published_at is None


def test_fees(spark):
    cells = "".join(f"<td>{c}</td>" for c in "abcdefgh") + "<td>50</td>"
    page = FLOWERS.split("<table")[0].replace(
        "<p></p>", "<div id='fecha'> Enero </div>"
    ) + f"<table class='table-striped'><tr>{cells}</tr></table>"
    [r] = feeds.transport_fees(pages(spark, page), datetime.date(2020, 1, 15)).collect()
    assert (r.province, r.line, r.cost, r.currency, r.last_published_at) == ("a", "h", "50", "DOP", "Enero")


def test_native_rows_become_grid_cells(spark):
    rows = html.table_rows(pages(spark, FLOWERS.replace("<td>B<td>Lirio<td>docena<td>\n12.50\n", "")))
    rows = rows.withColumn("page_url", F.lit("u")).filter(F.size("cells") >= 4)
    got = html.grid_cells(rows).orderBy("col_no").collect()
    assert [r.cell for r in got] == ["Floría", "Rosa", "", ""]


def test_first_text(spark):
    got = pages(spark, "<h1>A &amp; B</h1><h1>C</h1>", "<h2>x</h2>", "<h1> </h1>").select(
        "page_id", html.first_text(F.col("html"), "h1").alias("t")
    )
    assert [r.t for r in got.orderBy("page_id").collect()] == ["A & B", None, None]


def test_selector_needs_the_whole_chain(spark):
    inside = "<div id='m'><ul class='l big'><li><a href='y'></a></li></ul></div>"
    read = html.PageReader(links="div#m ul.l a").read(inside + "<ul class='l'><a href='n'></a></ul>")
    assert read.links == ["y"]


def test_raw_files_and_seeds(spark, tmp_path):
    (tmp_path / "a.html").write_text("<h1>á</h1>")
    (tmp_path / "b.html").write_bytes(b"<h1>caf\xe9</h1>")
    files = read_page_files(spark, str(tmp_path))
    first, second = files.orderBy("url").collect()
    assert first.html == "<h1>á</h1>" and first.url.endswith("a.html")
    assert second.html == "<h1>caf�</h1>"
    texts = html.read_pages(files, text="h1").orderBy("page_url").collect()
    assert [r.text for r in texts] == ["á", "caf�"]
    # bytes that came in as text without a check
    raw = files.withColumn("html", F.expr("cast(unhex('3C68313EE93C2F68313E') as string)"))
    assert {r.text for r in html.read_pages(raw, text="h1").collect()} == {"�"}
    active = seeds(spark).filter("active")
    assert active.groupBy("dataset").count().filter("count > 1").count() == 0


PIECES = st.sampled_from(
    "<td> <tr> <table class=table-striped> </table> </td> <b> </b> <![foo x]> <!-- --> <! </ <p> & &#x; "
    "<a\thref=x> <div/> <script> </script> text <![CDATA[ ]]> <? ' \" = > <td".split(" ")
)


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES, max_size=25))
def test_any_text_can_be_read(pieces):
    html.PageReader(links="a", text="p", rows="table.table-striped tr").read("".join(pieces))


def test_open_elements_end_with_their_cell():
    page = "<table><tr><td><b>x<td>1<tr><td>y<td><table><tr><td>in</table></table>"
    rows = html.PageReader(rows="table tr").read(page).rows
    assert [[cell[0] for cell in row] for row in rows] == [["", "1"], ["y", "", "in"], ["in"]]


def test_marked_sections_are_skipped():
    read = html.PageReader(links="a").read("<![if x]><a href='1'></a><![bad [>]<a href='2'></a>")
    assert read.links == ["1", "2"]


def test_parser_keeps_no_batch_and_hands_on_few_pages():
    held, start = [], pa.total_allocated_bytes()

    def batches():
        for _ in range(3):
            held.append(pa.total_allocated_bytes() - start)
            page = "<div class='filetitle'><a href='a.pdf'>" + "x" * 20_000 + "</a></div>"
            yield pa.RecordBatch.from_pydict({"page_id": list(range(200)), "url": ["u"] * 200, "html": [page] * 199 + [None]})

    got = [(part.num_rows, sum(map(len, part.column("links").to_pylist()))) for part in html.read_batches(batches(), links=html.LINKS)]
    assert sum(n for n, _ in got) == 600 and sum(n for _, n in got) == 3 * 199
    assert max(n for n, _ in got) <= html.PAGES
    assert max(held) < 1_000_000  # a batch is 4 MB
