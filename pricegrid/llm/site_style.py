"""Main text of pages by site style trees.

The pages of a host are merged into one tree: a node stands for a path of
tags, classes and ids. Each node has two entropies over the host's pages. That
of its presentations (the sequences of child tags) is high where pages differ
in layout. That of its content is low where few texts fill the node on all
pages. A node's importance joins both, each on a scale of the entropy that as
many different pages could reach. A menu that is the same on every page has
importance 0, an article's body 1. Pages with equal html count once. A node of
a host with few pages leans on the same path over all hosts. From each page the
branches of low importance are taken out; what is left, in blocks, is its text.

Two things no entropy tells: reader comments and sidebars differ on every page.
So nodes whose tag, role, class or id says that they are no content have
importance 0 from the start, and what is below them is in no tree. A class or id
says so if all its words do, fillers aside: ``site-footer`` does, ``has-sidebar``
and ``social-history`` do not. No name switches off a page's body, main or
article elements. Text inside articles weighs ``region`` times: if a page's
articles then weigh as much as the rest that the tree has left, only they count,
else the same holds for its main elements, else all that is left. So a teaser in
an article does not displace a story beside it.

Reading takes time in proportion to the page, whatever is broken in it.

Defined results. Null html gives an empty text. A null address is a host of its
own. Repeated rows stay repeated. Broken markup is read like browsers do: open
elements end with their parents. Only the named columns are read, so extra
columns of any name do no harm. An empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from pricegrid.llm import textbuf
from pricegrid.session import stage

# Kinds of elements in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table tbody "
    "td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: an opening tag ends these open elements, up to the first of the second set
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, {"html"}),
}
ENDS_P = BLOCK - {"body", "caption", "html", "legend", "li", "dd", "dt", "option", "optgroup", "summary", "tbody", "td", "tfoot", "th", "thead", "tr"}
SCOPE = frozenset("td th table article section div body html".split())

# What names an element that is no content.
NO_CONTENT_TAGS = frozenset(
    "nav aside form button select input textarea dialog noscript template svg canvas object iframe head script style menu footer".split()
)
NO_CONTENT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
NO_CONTENT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
    "footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices overlay pagination pager popup promo "
    "promoted recommended related replies respond share sharing sidebar sidebars signup skip social sponsor sponsored subscribe "
    "toolbar topbar widget widgets".split()
)
#: words that say nothing beside those
FILLERS = frozenset(
    "area article articles bar block body bottom box button buttons col column container content form group header icon "
    "icons inner item items js left link links list main module outer page panel post posts primary right row secondary section side "
    "site slot stories story top unit wrap wrapper".split()
)
#: elements that no name switches off
ALWAYS = frozenset("html body main article".split())

_TAG = re.compile(r"<(?:(?P<comment>!--)|(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)|[!?/])")
_COMMENT_END = re.compile("--!?>")
#: a tag's attributes, quotes in pairs
_REST = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")
_ATTRIBUTE = re.compile(r"""\b(class|id|role|style|hidden|aria-hidden|itemprop)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?""", re.IGNORECASE)
_NAME = re.compile(r"[a-z]+")
_MASK = (1 << 64) - 1

#: parts that a host's pages are dealt out in; a host's list of branches is copied to each
SALTS = 32


@dataclass(frozen=True)
class Importance:
    """Branches below ``least`` go. ``content`` weighs content against presentation;
    ``pages`` is how many pages the evidence of all hosts counts as; ``region`` is the
    weight of text in articles and main elements."""

    least: float = 0.3
    content: float = 0.9
    pages: float = 3.0
    region: float = 4.0


class _Element:
    __slots__ = ("tag", "path", "off", "region", "style", "text")

    def __init__(self, tag, path, off, region):
        self.tag, self.path, self.off, self.region = tag, path, off, region
        self.style, self.text = 0, 0


def _no_content(name: str) -> bool:
    """Whether a class or id says that its element is no content: all its words do, fillers aside."""
    words = set(_NAME.findall(name)) - FILLERS
    return bool(words) and words <= NO_CONTENT_NAMES


def _attributes(rest: str) -> tuple[str, bool, bool, bool]:
    """A label from classes and ids, whether the element is hidden, whether it is named no content, and whether it is the article."""
    label, hidden, against, article = [], False, False, False
    for match in _ATTRIBUTE.finditer(rest):
        name, value = match[1].lower(), (match[2] or "").strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
            hidden = True
        elif name == "role":
            against |= value in NO_CONTENT_ROLES
            article |= value == "main"
        elif name in ("class", "id"):
            # numbers tell nodes of one kind apart, not kinds
            label.append(name[0] + ".".join(_NAME.findall(value)))
            against |= any(map(_no_content, value.split()))
        elif name == "itemprop":
            article |= value == "articlebody"
    return "|".join(label), hidden, against, article


def _mixed(a: int, b: int) -> int:
    return ((a * 0x9E3779B97F4A7C15 & _MASK) + b * 0xBF58476D1CE4E5B9 + 1) & _MASK


class Page:
    """One page read from begin to end: the paths of its nodes, and its blocks."""

    def __init__(self, source: str, low: frozenset[int] | set[int] = frozenset()):
        self.low = low
        #: by path: presentation and content of its nodes in this page
        self.nodes: dict[int, list[int]] = {}
        #: text of each block, and the strongest region around it (2 article, 1 main, 0 neither)
        self.blocks: list[tuple[int, str]] = []
        self._pieces: list[str] = []
        self._stack = [_Element("", 0, False, 0)]
        #: by tag: depths of its open elements
        self._open: dict[str, list[int]] = defaultdict(list)
        self._read(source)

    def text(self, region: float = Importance.region) -> str:
        weight = [0, 0, 0]
        for own, text in self.blocks:
            weight[own] += len(text)
        least = 0
        if weight[2] * region > weight[0] + weight[1]:
            least = 2
        elif (weight[1] + weight[2]) * region > weight[0]:
            least = 1
        return "\n".join(text for own, text in self.blocks if own >= least)

    def _read(self, source: str) -> None:
        at, size = 0, len(source)
        last = source.rfind(">")
        paired = True
        while at < size:
            match = _TAG.search(source, at)
            if match and match["comment"]:
                self._characters(source[at : match.start()])
                end = _COMMENT_END.search(source, match.end())
                at = end.end() if end else size
                continue
            if not match or match.start() > last:
                # no tag ends from here on, but a comment may begin
                begin = source.find("<!--", at)
                self._characters(source[at : begin if begin >= 0 else size])
                break
            self._characters(source[at : match.start()])
            # a quote that is never closed is looked for once; from then on quotes are not paired
            rest = _REST.match(source, match.end()) if paired and match["tag"] else None
            paired = paired and (rest is not None or not match["tag"])
            at = rest.end() if rest else source.find(">", match.end()) + 1
            if match["tag"] is None:
                continue
            tag = match["tag"].lower()
            if match["end"]:
                self._close(tag)
                continue
            self._start(tag, source[match.end() : at - 1])
            if tag in RAW:
                # raw text runs to its own end tag, whatever stands in it
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.IGNORECASE).search(source, at)
                at = source.find(">", end.end()) + 1 if end else 0
                at = at or size
                self._close(tag)
        while len(self._stack) > 1:
            self._pop()
        self._flush()

    def _characters(self, raw: str) -> None:
        if not raw:
            return
        top = self._stack[-1]
        text = entities.unescape(raw)
        plain = " ".join(text.split())
        if plain:
            top.text = _mixed(top.text, xxhash.xxh3_64_intdigest(plain))
        if not top.off:
            self._pieces.append(text)

    def _flush(self) -> None:
        text = " ".join("".join(self._pieces).split())
        self._pieces.clear()
        if text:
            self.blocks.append((self._stack[-1].region, text))

    def _start(self, tag: str, rest: str) -> None:
        if tag in ENDS and self._open:
            self._end_open(*ENDS[tag])
        elif tag in ENDS_P and self._open.get("p"):
            self._end_open({"p"}, SCOPE)
        if tag in BLOCK:
            self._flush()
        elif tag == "br":
            self._pieces.append(" ")
        top = self._stack[-1]
        top.style = _mixed(top.style, xxhash.xxh3_64_intdigest(tag))
        if tag in VOID:
            return
        label, hidden, against, article = _attributes(rest) if rest else ("", False, False, False)
        path = xxhash.xxh3_64_intdigest(f"{top.path}/{tag}:{label}") - (1 << 63)
        region = max(top.region, 2 if tag == "article" else 1 if tag == "main" or article else 0)
        off = top.off or hidden or against and tag not in ALWAYS or tag in NO_CONTENT_TAGS or path in self.low
        if tag == "header":
            # of an article's own header the headings stay, of a page's nothing
            off = off or not region
        elif top.tag == "header" and tag not in HEADINGS and tag not in ("div", "hgroup"):
            off = True
        self._open[tag].append(len(self._stack))
        self._stack.append(_Element(tag, path, off, region))

    def _end_open(self, tags: set[str], scope) -> None:
        """End the innermost open element of ``tags`` unless one of ``scope`` stands inside it."""
        depth = self._innermost(tags)
        if depth and depth > self._innermost(scope):
            while len(self._stack) > depth:
                self._pop()

    def _innermost(self, tags) -> int:
        return max((self._open[tag][-1] for tag in tags if self._open.get(tag)), default=0)

    def _close(self, tag: str) -> None:
        if not self._open.get(tag):
            return
        while self._stack[-1].tag != tag:
            self._pop()
        self._pop()

    def _pop(self) -> None:
        if self._stack[-1].tag in BLOCK:
            self._flush()
        node = self._stack.pop()
        self._open[node.tag].pop()
        parent = self._stack[-1]
        parent.text = _mixed(parent.text, node.text)
        if node.text and not node.off and node.tag not in ("html", "body"):
            seen = self.nodes.setdefault(node.path, [0, 0])
            seen[0], seen[1] = _mixed(seen[0], node.style), _mixed(seen[1], node.text)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _host(url: F.Column) -> F.Column:
    return F.xxhash64(F.lower(F.regexp_extract(url.cast("string"), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)))


def page_nodes(pages: DataFrame) -> DataFrame:
    """``host, page, path, style, content``: the paths with text of every page. Expects ``host, html``."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, digest, path, style, content = [], [], [], [], []
            for i, value in enumerate(batch.column(1)):
                source = value.as_py() or ""
                page = _signed(xxhash.xxh3_64_intdigest(source))
                for own, (s, c) in Page(source).nodes.items():
                    row.append(i)
                    digest.append(page)
                    path.append(own)
                    style.append(_signed(s))
                    content.append(_signed(c))
            columns = [batch.column(0).take(pa.array(row, pa.int64())), *(pa.array(x, pa.int64()) for x in (digest, path, style, content))]
            yield pa.RecordBatch.from_arrays(columns, names=["host", "page", "path", "style", "content"])

    return pages.select("host", "html").mapInArrow(textbuf.released(read), "host bigint, page bigint, path bigint, style bigint, content bigint")


def _entropies(nodes: DataFrame, by: list[str]) -> DataFrame:
    """Pages ``m`` of each node, and both entropies as shares of ``log m``; partial counts come first."""

    def share(of: str) -> DataFrame:
        counted = nodes.groupBy(*by, of).agg(F.sum("n").alias("n"))
        sums = counted.groupBy(*by).agg(F.sum("n").alias("m"), F.sum(F.col("n") * F.log("n")).alias("s"))
        # one page has no entropy to reach: nothing is known of its nodes
        entropy = F.coalesce(1 - F.try_divide(F.col("s"), F.col("m") * F.log("m")), F.lit(1.0))
        return sums.select(*by, "m", entropy.alias(f"{of}_entropy"))

    return share("content").join(share("style").drop("m"), by)


def low_branches(nodes: DataFrame, importance: Importance) -> DataFrame:
    """``host, low``: the paths of each host's tree whose importance is too low.

    The list is as long as a host's templates have repeated nodes: a path gets
    here only where several pages fill it alike.
    """
    once = nodes.groupBy("host", "page", "path").agg(F.min("style").alias("style"), F.min("content").alias("content"))
    counted = once.groupBy("host", "path", "style", "content").agg(F.count("*").alias("n"))
    joint = F.col("content_entropy") * importance.content + F.col("style_entropy") * (1 - importance.content)
    own = _entropies(counted, ["host", "path"]).withColumn("own", joint)
    common = _entropies(counted, ["path"]).withColumn("common", joint)
    # of all hosts as well, a few pages prove nothing
    common = common.select("path", ((F.col("common") * F.col("m") + importance.pages) / (F.col("m") + importance.pages)).alias("common"))
    leaning = (F.col("own") * (F.col("m") - 1) + F.col("common") * importance.pages) / (F.col("m") - 1 + importance.pages)
    low = own.join(common, "path").filter(leaning < importance.least)
    return low.groupBy("host").agg(F.collect_list("path").alias("low"))


def main_text(
    pages: DataFrame,
    importance: Importance = Importance(),
    html: str = "html",
    id_col: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """``id_col, url, text, n_chars`` of every page; see the module's text."""
    own = pages.select(F.col(id_col).alias("id"), F.col(url).alias("url"), F.col(html).cast("string").alias("html"), _host(F.col(url)).alias("host"))
    own = own.withColumn("salt", F.pmod(F.xxhash64("html"), F.lit(SALTS)).cast("int"))
    low = low_branches(page_nodes(own), importance).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    low = stage(low, "trees")
    kinds = {f.name: f.dataType.simpleString() for f in own.schema.fields}

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            packed = [packer.compress(b"" if value is None else value.encode()) for value in batch.column(4).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(packed, pa.binary())], names=["host", "salt", "id", "url", "packed"])

    # pages are shuffled once, packed; hosts grow with the corpus: never broadcast, the plan is the same at every size
    packed = own.select("host", "salt", "id", "url", "html").mapInArrow(
        textbuf.released(pack), f"host bigint, salt int, id {kinds['id']}, url {kinds['url']}, packed binary"
    )
    joined = packed.join(low.hint("merge"), ["host", "salt"], "left").select("id", "url", "packed", "low")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            texts = []
            for source, paths in zip(batch.column(2), batch.column(3)):
                html = unpacker.decompress(source.as_py()).decode()
                texts.append(Page(html, set(paths.as_py() or ())).text(importance.region))
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "url", "text", "n_chars"])

    found = joined.mapInArrow(textbuf.released(extract), f"id {kinds['id']}, url {kinds['url']}, text string, n_chars bigint")
    return found.select(F.col("id").alias(id_col), F.col("url").alias(url), "text", "n_chars")
