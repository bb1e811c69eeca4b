"""Main-text extraction with a site style tree.

Each page becomes a tree of elements.  What is noise by its element (navigation,
footers, asides, scripts, ...), role or hidden state is left out at once.  What only
a whole class name (or the id of a plain container) says is judged with the
page in view, and the rest by the site: the trees of one host are merged, and
every node gets an importance.

* A container (a path of tags, classes and ids): the entropy of its presentations
  (sequences of child elements) and of its contents over the distinct pages that
  have it.
* A block of text at its path: how rare it is among the host's distinct pages,
  log(pages / pages with it) / log(pages).  Paragraphs and headings inside an article
  or main element are not judged on their own.

Either is shrunk towards 1 by the number of pages n, to 1 - (1 - importance) * n /
(n + 1), so that few pages say little and no host is left out.  Nodes of low importance
are cut from each page.

A page's own text limits what may go.  A named branch stays if the page's only article
or main element lies in it, or, without such an element, if it holds most of the text;
low nodes stay if they hold an article or main element or if little were left without
them.  The text is what lies in the article and main elements or, if that is empty or a
small part of what is left, all that is left.

Both passes parse the page; between them only hashes and counts are
shuffled, aggregated per host and node before that.  The pages meet their
host's low nodes in a join salted by page, so a host that has a third of
all pages is spread over SALTS parts.

Output: blocks in page order joined by a line end, white space inside a
block as one blank, character references decoded.

Defined cases: null or empty html gives an empty text; a null or hostless url
is a site of its own that nothing is learned from.  Rows sharing a page_id
are extracted each on its own.  Extra columns pass through; ``text`` and
``n_chars`` replace input columns of that name.
"""
from __future__ import annotations

import hashlib
import html as html_lib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import P, stage
from tidewell.session import ship_package

SALTS = 16
LOW = 0.3                 # importance up to which a node is cut
PRESENTATION = 0.1        # share of the presentation in a container's importance
SMALL = 0.2               # an article with a smaller share of the text left is not the main part
MOST = 0.5
MAX_DEPTH = 64            # elements nested deeper count as part of their ancestor (their text is kept)

# FIXED VALUES: element names of HTML and words that sites use in class, id and role
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var".split())
CONTAINERS = frozenset("div section ul ol dl table details center figure fieldset blockquote".split())
CLOSES = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)),
          "tr": ("tr td th", ("table",)), "td": ("td th", ("table", "tr")), "th": ("td th", ("table", "tr")),
          "option": ("option", ("select",))}
NOISE_TAGS = frozenset("nav footer aside form script style noscript template iframe button select textarea svg menu "
                       "dialog head title object canvas audio video map datalist".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar "
                        "toolbar tablist status".split())
NOISE_WORDS = frozenset("ad ads adv advert adverts advertisement advertisements adsense sponsor sponsored sponsors promo "
                        "promos promotion banner nav navbar navigation menu breadcrumb breadcrumbs sidebar footer "
                        "comment comments disqus replies respond cookie cookies consent gdpr notice notices popup "
                        "modal newsletter subscribe signup share sharing social related recommended widget widgets "
                        "login toolbar pagination pager copyright".split())
COMMENT_IDS = frozenset("comment comments disqus replies respond".split())
HEADER_WORDS = frozenset("header masthead topbar".split())
MAIN_ROLES = frozenset("main article".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")


def _attributes(raw: str) -> dict[str, str]:
    if not raw or raw.isspace():
        return {}
    return {m[1].lower(): html_lib.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(raw)}


def _certain(tag: str, attrs: dict[str, str], in_main: bool) -> bool:
    """Noise whatever it holds."""
    if (tag in NOISE_TAGS and tag != "form") or (tag == "header" and not in_main):
        return True
    return bool(attrs) and ("hidden" in attrs or attrs.get("aria-hidden") == "true"
                            or attrs.get("role", "").lower() in NOISE_ROLES)


def _named(tag: str, attrs: dict[str, str], in_main: bool) -> bool:
    """Noise by a whole class token, by the id of a plain container, or a form."""
    if tag in ("html", "body", "main", "article"):
        return False
    if tag == "form":
        return True
    names, own = set(attrs.get("class", "").lower().split()), attrs.get("id", "").lower()
    if tag in ("div", "ul", "ol", "dl", "table") or (tag == "section" and own in COMMENT_IDS):
        names.add(own)
    return bool(names & NOISE_WORDS) or (not in_main and bool(names & HEADER_WORDS))


class Node:
    """An element that is not inline."""

    __slots__ = ("up", "tag", "attrs", "container", "named", "holds_main", "size", "text", "shape", "_path")

    def __init__(self, up: "Node | None", tag: str, attrs: dict[str, str], named: bool, main: bool):
        self.up, self.tag, self.attrs = up, tag, attrs
        self.container, self.named, self.holds_main = tag in CONTAINERS, named, main
        self.size = 0                      # characters below it, once counted
        self.text: list[str] = []          # of a container, where it is learned from
        self.shape: list[str] = []
        self._path: str | None = None

    @property
    def path(self) -> str:
        if self._path is None:
            own = "".join(sorted("." + c for c in self.attrs.get("class", "").lower().split())) if self.attrs else ""
            self._path = (self.up.path if self.up else "") + "/" + self.tag + own + (
                "#" + self.attrs["id"].lower() if self.attrs.get("id") else "")
        return self._path

    def above(self):
        node = self
        while node is not None:
            yield node
            node = node.up


@dataclass(slots=True)
class _Open:
    tag: str
    noise: bool
    main: bool
    inline: bool
    node: Node | None


@dataclass(slots=True)
class Block:
    text: str
    node: Node | None
    main: bool

    def id(self) -> int:
        return _hash([self.node.path if self.node else "", self.text])


def parse(html: str, learn: bool = False) -> tuple[list[Block], list[Node]]:
    """(blocks, containers) of a page without what is certainly noise.  Contents
    and presentations of containers are gathered only to ``learn``."""
    stack: list[_Open] = []
    blocks: list[Block] = []
    buffer: list[str] = []
    containers: list[Node] = []
    counts: dict[str, int] = {}
    noise_depth = main_depth = 0

    nodes: list[Node | None] = [None]      # the open ones

    def flush() -> None:
        if buffer:
            text = " ".join("".join(buffer).split())
            buffer.clear()
            if text:
                blocks.append(Block(text, nodes[-1], main_depth > 0))
                if learn:
                    for n in nodes[1:]:
                        if n.container:
                            n.text.append(text)

    def pop(to: int) -> None:
        nonlocal noise_depth, main_depth
        while len(stack) > to:
            if not stack[-1].inline:
                flush()
            top = stack.pop()
            counts[top.tag] -= 1
            noise_depth -= top.noise
            main_depth -= top.main
            if top.node:
                nodes.pop()

    def find(names, stop=()) -> int:
        if not any(counts.get(x) for x in names):
            return -1
        for k in range(len(stack) - 1, -1, -1):
            if stack[k].tag in names:
                return k
            if stack[k].tag in stop:
                return -1
        return -1

    at, size = 0, len(html)
    while at < size:
        m = _TOKEN.search(html, at)
        text = html[at:m.start()] if m else html[at:]
        if text and not noise_depth:
            buffer.append(html_lib.unescape(text) if "&" in text else text)
        if not m:
            break
        at = m.end()
        name = m[2] or m[5]
        if not name:
            if m[0].startswith("<![CDATA[") and not noise_depth:
                buffer.append(m[0][9:].removesuffix("]]>"))
            continue
        tag = name.lower()
        if m[1] or m[4]:
            k = find((tag,))
            if tag in INLINE:
                # a formatting end tag doesn't close the block around it
                if k >= 0 and all(x.inline for x in stack[k:]):
                    pop(k)
            elif k >= 0:
                pop(k)
            elif tag in ("p", "br") and not noise_depth:
                flush() if tag == "p" else buffer.append(" ")
            continue
        raw = m[3] if m[2] else m[6]
        inline = tag in INLINE
        if tag in VOID:
            if not noise_depth:
                if tag == "hr":
                    flush()
                elif tag in ("br", "wbr"):
                    buffer.append(" " if tag == "br" else "")
            continue
        if not inline:
            k = find(("p",), ("article", "main", "section", "div", "li", "td", "th", "blockquote", "button"))
            if k >= 0:
                pop(k)
            if tag in CLOSES:
                names, stop = CLOSES[tag]
                k = find(names.split(), stop)
                if k >= 0:
                    pop(k)
            if not noise_depth:
                flush()
        attrs = _attributes(raw)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            at = end.end() if end else size
            continue
        if tag == "body":
            pop(find(("head",)) if find(("head",)) >= 0 else len(stack))
        noise = _certain(tag, attrs, main_depth > 0)
        if inline and not noise and _named(tag, attrs, main_depth > 0):
            noise = True                   # part of a block, which is not judged by halves
        live = not noise and not noise_depth
        main = live and (tag in ("article", "main") or attrs.get("role", "").lower() in MAIN_ROLES)
        named = live and not inline and _named(tag, attrs, main_depth > 0)
        node = None
        if live and (named or main or not inline) and len(stack) < MAX_DEPTH:
            if learn:
                for n in nodes[1:]:
                    if n.container:
                        n.shape.append(tag)
            if main:
                for n in nodes[1:]:
                    n.holds_main = True
            node = Node(nodes[-1], tag, attrs, named, main)
            nodes.append(node)
            if node.container:
                containers.append(node)
        if raw.rstrip().endswith("/") and tag not in ("p", "div", "article", "main", "section", "body", "html") and noise:
            continue                       # <svg/> and the like have no content
        stack.append(_Open(tag, noise, main, inline, node))
        counts[tag] = counts.get(tag, 0) + 1
        noise_depth += noise
        main_depth += main
    pop(0)
    flush()
    return blocks, containers


def _size(blocks: list[Block]) -> int:
    return sum(len(b.text) for b in blocks)


def judged(blocks: list[Block], low: frozenset[int] = frozenset()) -> list[Block]:
    """The blocks of the main text.  low: ids of the site's unimportant nodes."""
    def under(block: Block, test) -> bool:
        return block.node is not None and any(test(n) for n in block.node.above())

    left = blocks
    if low or any(under(b, lambda n: n.named) for b in blocks):
        for b in blocks:
            for n in b.node.above() if b.node else ():
                n.size += len(b.text)
        total = _size(blocks)
        # an article outside all named branches frees them to go
        has_main = any(b.main and not under(b, lambda n: n.named and n.holds_main) for b in blocks)
        left = [b for b in blocks if not under(b, lambda n: n.named and (
            has_main or not (n.holds_main or n.size > MOST * total)))]
        if has_main and not any(b.main for b in left):
            left = blocks                  # the article is all in named branches
    if low:
        tops = _size(left)
        rest = [b for b in left if not (not b.main and b.id() in low) and not under(
            b, lambda n: n.container and not n.holds_main and n.size <= MOST * tops and _hash([n.path]) in low)]
        if _size(rest) >= MOST * tops or any(b.main for b in rest):
            left = rest
    main = [b for b in left if b.main]
    return main if main and _size(main) >= SMALL * _size(left) else left


def main_text(html: str, low: frozenset[int] = frozenset()) -> str:
    return "\n".join(b.text for b in judged(parse(html)[0], low))


def _hash(parts: list[str]) -> int:
    raw = hashlib.blake2b("\n".join(parts).encode("utf-8", "replace"), digest_size=8).digest()
    return int.from_bytes(raw, "little", signed=True)


def host(url: Column) -> Column:
    found = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(found != "", found)


PAGE = 0                  # the node that every page has


def node_rows(pages: DataFrame) -> DataFrame:
    """(host, node, content, shape, page): hashes of each page's containers and
    blocks, and of the page itself; a block is its own node."""
    ship_package(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows: list[tuple[str, int, int, int, int]] = []
                part = batch.slice(at, 256)
                for h, doc in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    blocks, containers = parse(doc, learn=True)
                    page = _hash([b.text for b in blocks])
                    found = {(PAGE, 0, 0)} | {(b.id(), 0, 0) for b in blocks if not b.main} | {
                        (_hash([c.path]), _hash(c.text), _hash(c.shape)) for c in containers if c.text}
                    rows += [(h, *f, page) for f in found]
                names = ["host", "node", "content", "shape", "page"]
                columns = list(zip(*rows)) or [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.string()), *[pa.array(c, pa.int64()) for c in columns[1:]]], names)

    src = pages.select(host(pages["url"].cast("string")).alias("host"), F.coalesce(
        pages["html"].cast("string"), F.lit("")).alias("html")).filter("host is not null")
    return src.mapInArrow(run, "host string, node long, content long, shape long, page long")


def _entropy(rows: DataFrame, value: str) -> DataFrame:
    """Entropy of ``value`` over a container's pages, as a share of the most it could be."""
    cells = rows.groupBy("host", "node", value).agg(F.count("*").alias("c"))
    sums = cells.groupBy("host", "node").agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.log("c")).alias("s"))
    return sums.select("host", "node", "n", F.when(F.col("n") > 1, (F.log("n") - F.col("s") / F.col("n")) / F.log("n"))
                       .otherwise(1.0).alias(f"{value}_entropy"))


def style_tree(pages: DataFrame) -> DataFrame:
    """(host, node, n, importance) of every container and block of a site; n is
    the number of distinct pages it was judged by."""
    # copies of a page count once; stored, for the pages are parsed for it
    rows = stage(node_rows(pages).distinct(), "site-nodes")
    inner, whole = rows.filter("content <> 0"), rows.filter("content = 0")
    both = _entropy(inner, "content").join(_entropy(inner, "shape").drop("n"), ["host", "node"])
    containers = both.select("host", "node", "n", (PRESENTATION * F.col("shape_entropy")
                                                   + (1 - PRESENTATION) * F.col("content_entropy")).alias("raw"))
    counts = whole.groupBy("host", "node").agg(F.count("*").alias("c"))
    sites = counts.filter(F.col("node") == PAGE).select(F.col("host").alias("h"), F.col("c").alias("n"))
    blocks = counts.filter(F.col("node") != PAGE).join(sites, F.col("host") == F.col("h")).select(
        "host", "node", "n", F.when(F.col("n") > 1, F.log(F.col("n") / F.col("c")) / F.log("n")).otherwise(1.0).alias("raw"))
    shrunk = 1 - (1 - F.col("raw")) * F.col("n") / (F.col("n") + 1)
    return containers.unionByName(blocks).select("host", "node", "n", shrunk.alias("importance"))


def extract(pages: DataFrame, low: float = LOW) -> DataFrame:
    """``pages`` with ``text`` and ``n_chars``."""
    ship_package(pages.sparkSession)
    cut = (style_tree(pages).filter(F.col("importance") <= low)
           .groupBy(F.col("host").alias(P + "h")).agg(F.collect_set("node").alias(P + "low"))
           .withColumn(P + "s", F.explode(F.array([F.lit(k) for k in range(SALTS)]))))
    rows = pages.withColumns({P + "host": host(pages["url"].cast("string")),
                              P + "salt": F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")})
    both = rows.join(cut, (rows[P + "host"] == cut[P + "h"]) & (rows[P + "salt"] == cut[P + "s"]), "left")

    @F.pandas_udf("string")
    def run(docs: pd.Series, lows: pd.Series) -> pd.Series:
        return pd.Series([main_text(d or "", frozenset(x) if x is not None else frozenset())
                          for d, x in zip(docs, lows)], dtype=object)

    out = [c for c in pages.columns if c not in ("text", "n_chars")]
    done = both.select(*out, run(F.col("html").cast("string"), F.col(P + "low")).alias("text"))
    return done.withColumn("n_chars", F.char_length("text").cast("long"))
