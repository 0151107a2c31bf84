import base64
import gzip
import hashlib
import json
import struct
import zipfile

import pytest
from hypothesis import given, settings, strategies as st
from pricegrid.llm import zip_archive
from pricegrid.llm.site_style import Page, main_text
from pricegrid.llm.zip_archive import archive_round_trip, members, read_records, write_packages


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


def text(spark, rows):
    return [r["text"] for r in main_text(pages_of(spark, rows)).orderBy("page_id").collect()]


FULL = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>x";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">Menu</a></ul></nav><div class="cookie-notice">We use cookies</div>
<!-- <p>no</p> --><div class="side sidebar">Side</div><article><header><h1>Title&nbsp;&amp; more</h1><p>by X</p></header>
<p>One  <b>bold</b>
text<br>goes on<p>Two &eacute;&#225;&lt;b&gt;<ul><li>first<li>second</ul><form><input value="1"><button>Go</button></form>
<div class="ad">Buy</div><table><tr><td>a<td>b<tr><td>c</table><section id="comments"><p>Nice!</p></section></article>
<aside>Aside</aside><footer>&copy; me</footer></body></html>"""


def test_one_page(spark):
    assert text(spark, [(1, "http://a/1", FULL)]) == ["Title & more\nOne bold text goes on\nTwo éá<b>\nfirst\nsecond\na\nb\nc"]


@pytest.mark.parametrize(
    "html, expected",
    [
        ("", ""),
        ("plain", "plain"),
        ("<p>a<p>b", "a\nb"),
        ("<div>a<div>b</div>c</div>", "a\nb\nc"),
        ("<p>x < y & z</p>", "x < y & z"),
        ("<p title='a>b'>q</p>", "q"),
        ("<p>open <b>never closed", "open never closed"),
        ("</div></p>stray<p>ok", "stray\nok"),
        ("<script>if (a<b) '</scr'</script>after", "after"),
        ("<script>never closed <p>x", ""),
        ("<p>a<!-- b <p>c -->d</p><!-- open <p>e", "ad"),
        ("<main><p>m</p></main><p>out</p>", "m"),
        ("<div hidden>h</div><div style='display: none'>h</div><p>v", "v"),
        ("<p>1</p><textarea><p>2</p></textarea>", "1"),
        ("<div role=navigation>n</div><div class='related-posts'>r</div><p>t", "t"),
        ("<p class=lead>download adverb</p><div class=shadow>address</div>", "download adverb\naddress"),
        ("<body class='has-sidebar'><p>story</p></body>", "story"),
        ("<div class='content no-sidebar'><p>story</p></div>", "story"),
        ("<article class='post comments-open'><p>story</p></article>", "story"),
        ("<body class=sidebar><main id=widget><article class=comment><p>story</p></article></main></body>", "story"),
        ("<article><p class='social-history'>past</p><p>now</p></article>", "past\nnow"),
        ("<div><p>A story that is long enough to matter.</p></div><article class=card>Teaser.</article>", "A story that is long enough to matter.\nTeaser."),
        ("<p>x</p><main><p>A story that is long enough to matter.</p><article class=card>Teaser.</article></main>", "A story that is long enough to matter.\nTeaser."),
        ("<div class='side-bar site-footer'>f</div><div class='ad-slot-3'>a</div><ul class='post-comments'><li>c</ul><p>t", "t"),
        ("<p>t<a title='it>s", "ts"),
        ("""<p>a<b title="x>y</b>z""", "ay" + "z"),
        ("<p>a<!-- never closed", "a"),
    ],
)
def test_markup(html, expected):
    assert Page(html).text() == expected


PIECES = ["<p>", "</p>", "<div class='", "'>", "<b", ">", "</b>", "<script>", "</script>", "<!--", "-->", "&amp;", "&#", "<", '"', "=", "a", " ", "<td>", "<table>", "</", "\x00", "é"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=40))
def test_any_markup_is_read(pieces):
    page = Page("".join(pieces))
    assert all(text == " ".join(text.split()) and text for _, text in page.blocks)


def test_branches_that_repeat_over_a_site_go(spark):
    """Nothing names these branches; only their host's tree tells."""
    page = "<body><div class=top><p>Welcome to our site</p></div><div class=body><h2>Story {0}</h2><p>Text {0} of the day.</p></div><div class=x>Read on</div></body>"
    rows = [(i, f"http://big.example/{i}", page.format(i)) for i in range(20)]
    rows += [(100, "http://small.example/1", "<body><div class=lead><p>Alone</p></div><p>here</p></body>")]
    rows += [(101, "http://other.example/1", page.format("other"))]
    # equal pages prove nothing: they count once
    rows += [(200 + i, "http://copies.example/", "<body><div class=c><h3>Same</h3></div></body>") for i in range(30)]
    found = text(spark, rows)
    assert found[:20] == [f"Story {i}\nText {i} of the day." for i in range(20)]
    assert found[20] == "Alone\nhere"
    assert found[21] == "Story other\nText other of the day."  # leans on the other host's tree
    assert set(found[22:]) == {"Same"}


@pytest.mark.parametrize(
    "piece, end",
    [
        ("<b><i>x</u><p>", ""), ('<div "', ""), ('<div "', ">"), ("<a ", ""), ("</a ", ""), ("<!x", ""), ("<!-- ", ""), ("<a", ""), ('<a ">"', '"'), ("<a '\">", ""),
        ("<script>", ""), ("</script ", ""), ("<script></script ", ">"), ("<", ""), ("<dt></dt><b>", ""), ("<li><ul><b>", "<li></li>" * 16_000), ("<p><td><b>", "<p>" * 16_000), ("<x a='", "<p>"),
    ],
)
def test_reading_is_linear(piece, end):
    import time

    took = []
    for n in (4_000, 16_000):
        start = time.perf_counter()
        Page(piece * n + end).text()
        took.append(time.perf_counter() - start)
    assert took[1] < 8 * took[0] + 0.5


def test_whole_table(spark, sf_dir):
    import html
    import re

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    sources = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in main_text(pages).collect():
        body = re.search("<article>(.*?)</article>", sources[r["page_id"]], re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", body)]
        assert r["text"] == "\n".join(b for b in blocks if b)
        assert r["n_chars"] == len(r["text"])


# Archives

LONG = "<p>" + "x" * 120


def test_round_trip(spark):
    rows = [(5, "http://a", LONG), (3, None, LONG), (9, "http://b\r\nX: y", LONG), (7, "c", "short"), (8, "c", "short"), (1, "d", None), (2, "é", "é\r\n\r\n" * 60)]
    rows += [(None, "e", LONG), (None, "f", LONG + "only null ids"), (3, None, LONG)]
    got = sorted(archive_round_trip(pages_of(spark, rows)).collect(), key=str)
    kinds = sorted((str(r["page_id"]), r["record_type"], str(r["refers_to"]), r["payload_bytes"]) for r in got)
    assert kinds == sorted(
        [("5", "revisit", "3", 123), ("3", "response", "None", 123), ("3", "response", "None", 123), ("9", "revisit", "3", 123)]
        + [("7", "response", "None", 5), ("8", "response", "None", 5), ("1", "response", "None", 0), ("2", "response", "None", 360)]
        + [("None", "revisit", "3", 123), ("None", "response", "None", 136)]
    )


@pytest.fixture(scope="module")
def packages(spark, sf_dir, tmp_path_factory):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return pages, write_packages(pages, str(tmp_path_factory.mktemp("warc")))


def test_payloads_come_back(packages):
    pages, written = packages
    rows = {int(r["page_id"]): r for r in read_records(written, with_payload=True).collect()}
    for page in pages.collect():
        r = rows[page["page_id"]]
        assert r["url"] == page["url"]
        assert r["record_type"] == "revisit" or bytes(r["payload"]).decode() == page["html"]


def test_other_readers_open_the_packages(packages):
    _, written = packages
    for row in written.collect():
        with zipfile.ZipFile(row["path"]) as package:
            assert package.testzip() is None
            assert {i.compress_type for i in package.infolist()} == {zipfile.ZIP_STORED}
            store, inner = zip_archive.open_store(row["path"])
            with store.open_input_file(inner) as source:
                own = members(source)
                for info in package.infolist():
                    first = zip_archive.begin_of(source, own[info.filename])
                    assert source.read_at(own[info.filename].size, first) == package.read(info)


def zip64(path, name, content, comment=b""):
    """A package whose sizes and places stand in ZIP64 fields only."""
    full = b"\xff" * 4
    local = b"PK\x03\x04" + struct.pack("<HHHHHI", 45, 0, 0, 0, 0, 0) + full * 2 + struct.pack("<HH", len(name), 20) + name
    local += struct.pack("<HHQQ", 1, 16, len(content), len(content))
    extra = struct.pack("<HH", 0x9999, 2) + b"zz" + struct.pack("<HHQQQ", 1, 24, len(content), len(content), 0)
    central = b"PK\x01\x02" + struct.pack("<HHHHHHI", 45, 45, 0, 0, 0, 0, 0) + full * 2
    central += struct.pack("<HHHHHI", len(name), len(extra), 0, 0, 0, 0) + full + name + extra
    begin = len(local) + len(content)
    end64 = b"PK\x06\x06" + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, 1, 1, len(central), begin)
    locator = b"PK\x06\x07" + struct.pack("<IQI", 0, begin + len(central), 1)
    end = b"PK\x05\x06" + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, len(comment)) + comment
    path.write_bytes(local + content + central + end64 + locator + end)


def test_zip64_directories(tmp_path):
    zip64(tmp_path / "a.zip", b"archive/data.warc.gz", b"stored bytes", b"a comment with PK\x05\x06 in it")
    store, inner = zip_archive.open_store(str(tmp_path / "a.zip"))
    with store.open_input_file(inner) as source:
        member = members(source)["archive/data.warc.gz"]
        assert source.read_at(member.size, zip_archive.begin_of(source, member)) == b"stored bytes"


def foreign_record(kind, uri, payload, digest, squeeze=True, more=""):
    block = payload if kind == "resource" else b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n" + payload
    content = "text/html" if kind == "resource" else "application/http; msgtype=response"
    head = f"WARC/1.0\r\nwarc-type:{kind}\r\nWARC-Record-ID: <urn:{uri}>\r\nWARC-Target-URI: {uri}\r\n{digest}{more}"
    raw = f"{head}Content-Type: {content}\r\nContent-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"
    return gzip.compress(raw) if squeeze else raw


def test_packages_of_other_writers(spark, tmp_path):
    """Several archive members, all kinds of indexes and digests, none of the own fields, and no records at all."""
    sha1 = base64.b32encode(hashlib.sha1(b"first").digest()).decode()
    sets = {
        "archive/a.warc.gz": [
            foreign_record("response", "r:1", b"first", f"WARC-Payload-Digest: sha1:{sha1}\r\n"),
            foreign_record("revisit", "r:2", b"", f"WARC-Payload-Digest: sha1:{sha1}\r\n", more="WARC-Refers-To: <urn:r:1>\r\n"),
        ],
        "archive/deep/b.warc": [foreign_record("resource", "r:3", b"third\r\n\r\nx", "", squeeze=False)],
        "archive/c.warc.gz": [foreign_record("response", "r:4", b"fourth", f"WARC-Payload-Digest: sha256:{hashlib.sha256(b'fourth').hexdigest()}\r\n")],
    }
    lines = {}
    for name, records in sets.items():
        at = 0
        for r in records:
            entry = {"offset": str(at), "length": len(r), "filename": name.rpartition("/")[2]}
            lines.setdefault(name, ['!meta 0 {"format": "cdxj"}'.replace("{", "[").replace("}", "]")]).append(f"com,r)/ 2024 {json.dumps(entry)}")
            at += len(r)
    index = {n: "\n".join(x).encode() for n, x in lines.items()}
    with zipfile.ZipFile(tmp_path / "a.wacz", "w") as z:
        for name, records in sets.items():
            z.writestr(name, b"".join(records))
        z.writestr("indexes/a.cdx.gz", gzip.compress(index["archive/a.warc.gz"][:40]) + gzip.compress(index["archive/a.warc.gz"][40:]))
        z.writestr("indexes/b.cdxj", index["archive/deep/b.warc"], zipfile.ZIP_DEFLATED)
        z.writestr("indexes/c.cdxj", index["archive/c.warc.gz"])
        z.writestr("datapackage.json", "{}")
    with zipfile.ZipFile(tmp_path / "b.wacz", "w") as z:
        z.writestr("datapackage.json", "{}")
    paths = spark.createDataFrame([(str(tmp_path / n),) for n in ("a.wacz", "b.wacz")], "path string")
    rows = {r["url"]: r for r in read_records(paths, with_payload=True).collect()}
    assert {u: (r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for u, r in rows.items()} == {
        "r:1": ("<urn:r:1>", "response", None, 5),
        "r:2": ("<urn:r:2>", "revisit", "<urn:r:1>", None),
        "r:3": ("<urn:r:3>", "resource", None, 10),
        "r:4": ("<urn:r:4>", "response", None, 6),
    }
    assert bytes(rows["r:3"]["payload"]) == b"third\r\n\r\nx" and rows["r:2"]["payload"] is None
    assert rows["r:1"]["payload_digest"] == hashlib.sha256(b"first").hexdigest()


def test_records_that_differ_or_are_not_indexed(tmp_path):
    wrong = foreign_record("response", "r:1", b"first", f"WARC-Payload-Digest: sha1:{hashlib.sha1(b'other').hexdigest()}\r\n")
    with pytest.raises(ValueError, match="differs"):
        zip_archive.result_of(wrong)
    chunked = gzip.compress(gzip.decompress(wrong).replace(b"Server: x", b"Transfer-Encoding: chunked").replace(b"Content-Length: 35", b"Content-Length: 52"))
    assert zip_archive.result_of(chunked)[1] == 5
    with zipfile.ZipFile(tmp_path / "a.wacz", "w") as z:
        z.writestr("archive/a.warc.gz", wrong)
    store, inner = zip_archive.open_store(str(tmp_path / "a.wacz"))
    with store.open_input_file(inner) as source, pytest.raises(ValueError, match="no index"):
        zip_archive.index_entries(source)


def test_broken_packages(tmp_path):
    (tmp_path / "a.zip").write_bytes(b"no package" * 10)
    store, inner = zip_archive.open_store(f"file:{tmp_path}/a.zip")
    with store.open_input_file(inner) as source, pytest.raises(ValueError):
        members(source)


def test_large_packages_are_split(spark, tmp_path, monkeypatch):
    rows = [(i, "u", f"{i} " * 400) for i in range(50)]
    monkeypatch.setattr(zip_archive, "PACKAGE_BYTES", 1000)
    written = write_packages(pages_of(spark, rows).coalesce(1), str(tmp_path / "w"))
    assert sum(r["n_records"] for r in written.collect()) == 50
    assert read_records(written).count() == 50
