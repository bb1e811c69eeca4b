import html
import re

import pytest
from helpers import DIR

from tidewell.llm import html_text as H
from tidewell.llm import queries

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{margin:0}</style><script>var t="</p>";</script></head>
<body class="home nav"><header><h1>Site</h1></header><nav><ul><li><a href="/x">menu</a></li></ul></nav>
<!-- ad > <p>no</p> --><div class="ad">Buy</div><article><header><h1>Title &amp; more</h1></header>
<p>First <b>bold</b>  text&nbsp;here<br>next <a title="a>b" href='x'>link</a>.<p><b>Unclosed one.<br><p>x &lt; y &#233; &bogus; &amp;lt;</p>
<ul><li>one<li>two</ul><div class="story"><pre>a
 b</pre></div><form><input name=q><label>Ask</label></form><section id="comments"><article>Reader</article></section>
</article><aside>side</aside><footer>&copy; foot</footer></body></html>"""


def test_one_page():
    assert H.main_text(PAGE).split("\n") == ["Title & more", "First bold text here next link.", "Unclosed one.",
                                            "x < y é &bogus; &lt;", "one", "two", "a b"]


@pytest.mark.parametrize("doc,want", [
    ("", ""), ("plain", "plain"), ("<p>a<p>b", "a\nb"), ("<div>a<div>b</div>c</div>", "a\nb\nc"),
    ("<div class='ad'>x</div>y", "y"), ("a</p>b", "a\nb"), ("<p class=\"x>broken</p>still", "broken\nstill"), ("a < b <", "a < b <"),
    ("<script>x", ""), ("<!-- open", ""), ("<b>a<p>b</b>c</p>d", "a\nbc\nd"), ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"),
    ("<main>a</main><p>b</p>", "a"), ("<div role=navigation>a</div><div hidden>h</div>b", "b"), ("<![CDATA[x]]>", "x"),
    ("<nav><div>a</nav>b", "b"), ("<SCRIPT>a</SCRIPT >b", "b"), ("<p>" * 3000 + "x", "x"), ("<div>" * 20000 + "x", "x"),
    ("x&amp;amp;y", "x&amp;y")])
def test_fragments(doc, want):
    assert H.main_text(doc) == want


OWN = "own words of a story that is longer than what is said on every page"


def site(n, host="h.example", promo="Same promotion on every page"):
    return [(i, f"http://{host}/{i}", f"<article><h1>Same heading</h1><div class='x7'>{promo}</div><div class='body'>"
             f"<p>{OWN} {i}</p></div></article>", "old") for i in range(n)]


@pytest.mark.parametrize("doc,want", [
    # names that only contain a noise word, or wrap everything
    ('<div class="content-sidebar-wrap"><p>the story</p></div>', "the story"),
    ('<div class="elementor-widget-container"><p>the story</p></div>', "the story"),
    ('<div id="page" class="no-sidebar"><article><p>the story</p></article></div>', "the story"),
    ('<div class="sidebar"><article><p>the story</p></article></div>', "the story"),
    ('<div class="widget"><p>the story</p></div><p>x</p>', "the story\nx"),
    ("<form><article><p>the story</p></article><label>Mail</label></form>", "the story"),
    # main parts that are empty or a teaser
    ("<main></main><p>the story</p>", "the story"),
    ("<article>Teaser</article><div><p>" + "a long story " * 9 + "</p></div>", "Teaser\n" + ("a long story " * 9).strip()),
    # ids of headings and sections inside the article
    ('<article><h2 id="market-share">Share</h2><section id="related-work"><p>Work</p></section></article>', "Share\nWork"),
    ('<article><h2 id="related">R</h2><section id="notice"><p>N</p></section></article>', "R\nN"),
    # still noise
    ('<article><p>the story</p><div class="ad">Buy this</div><span class="share">tweet</span></article>', "the story"),
    ('<article><p>the story</p></article><div class="sidebar"><article>Teaser of another story</article></div>', "the story"),
    ('<article><p>the story</p><section id="comments"><article>Reader</article></section></article>', "the story")])
def test_names_are_judged_with_the_page_in_view(doc, want):
    assert H.main_text(doc) == want


def test_low_branches_are_cut_by_site(spark):
    few = [(100 + i, "http://few.example/", p[2], "old") for i, p in enumerate(site(2))]
    copies = [(200 + i, "http://copies.example/", site(1)[0][2], "old") for i in range(30)]
    odd = [(300, None, None, "old"), (None, "nohost", "", "old"), (301, "http://h.example/q", None, "old"), (5, "http://h.example/5", "<p>twin", "old")]
    df = spark.createDataFrame(site(40) + few + copies + odd, "page_id long, url string, html string, text string")
    out = H.extract(df)
    assert out.columns == ["page_id", "url", "html", "text", "n_chars"]
    got = sorted(((r.page_id, r.text) for r in out.collect()), key=repr)
    kept = f"Same heading\nSame promotion on every page\n{OWN} %d"
    want = [(i, f"Same heading\n{OWN} {i}") for i in range(40)] + [(100 + i, kept % i) for i in range(2)] \
        + [(200 + i, kept % 0) for i in range(30)] + [(300, ""), (None, ""), (301, ""), (5, "twin")]
    assert got == sorted(want, key=repr)
    tree = {r.node: r.importance for r in H.style_tree(df).filter("host = 'h.example'").collect()}
    assert tree[H._hash(["/article/div.x7"])] < .05 < .8 < tree[H._hash(["/article/div.body"])]


def unmarked(i, menu="Home Products About Contact"):
    """A page that only its site can tell apart: no article, no nav, no telling class."""
    items = "".join(f"<li><a href='/{w}'>{w}</a></li>" for w in menu.split())
    story = " ".join(f"word{i}x{k}" for k in range(40))
    return (f"<html><body><div class='a1'><ul>{items}</ul></div><div class='b2'><h1>Title {i}</h1><p>{story}</p>"
            f"<p>This site uses cookies to serve you</p><p>closing of {i}</p></div><div class='c3'>All rights kept 2024</div></body></html>",
            f"Title {i}\n{story}\nclosing of {i}")


@pytest.mark.parametrize("n", [5, 40])
def test_unmarked_noise_is_found_by_the_tree_alone(spark, n):
    pages = [unmarked(i) for i in range(n)]
    df = spark.createDataFrame([(i, f"http://u.example/{i}", p[0]) for i, p in enumerate(pages)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in H.extract(df).collect()}
    assert got == {i: want for i, (_, want) in enumerate(pages)}
    # one page alone keeps all
    one = H.extract(df.limit(1)).first().text
    assert "Home" in one and "cookies" in one


def test_versions_of_one_story_are_not_cut_away(spark):
    story = "".join(f"<p>paragraph {k} of the one story of this site</p>" for k in range(8))
    df = spark.createDataFrame([(i, "http://v.example/", f"<body><div>{story}<p>version {i}</p></div></body>") for i in range(6)],
                               "page_id long, url string, html string")
    for r in H.extract(df).collect():
        assert r.text.split("\n") == [f"paragraph {k} of the one story of this site" for k in range(8)] + [f"version {r.page_id}"]


def test_empty(spark):
    assert H.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_query_against_brute_force(spark):
    """On the given pages the main text is the article's headings and paragraphs."""
    src = {r.page_id: r for r in spark.read.parquet(f"{DIR}/pages.parquet").collect()}
    out = queries.QUERIES["op5_html_extraction"](spark, DIR).collect()
    assert len(out) == len(src)
    for r in out:
        body = re.search("<article>(.*?)</article>", src[r.page_id].html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", " " if False else "", re.sub("<br>", " ", p))).split())
                 for p in re.split("</?(?:p|h1)>", body)]
        assert r.text == "\n".join(p for p in parts if p)
        assert r.n_chars == len(r.text) and r.url == src[r.page_id].url
