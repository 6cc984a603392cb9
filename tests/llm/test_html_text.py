"""Main text of pages: pages with a known article, malformed markup, scale."""

import html
import re

import pytest

from tidespan.llm import html_text, queries
from tidespan.llm.html_text import main_text

LONG = "A sentence of some length, with commas, that goes on; it ends here. Another one follows it."
MENU = "".join(f"<li><a href='/{i}'>Menu entry {i}</a></li>" for i in range(12))


def paragraphs(n):
    return [f"{LONG} Number {i}." for i in range(n)]


def p(lines):
    return "".join(f"<p>{t}</p>" for t in lines)


@pytest.mark.parametrize("page", [
    f"<body><nav><ul>{MENU}</ul></nav><article><h1>Title</h1>{{}}</article><footer>&copy; me. All rights, reserved.</footer>",
    f"<body><ul>{MENU}</ul><div><h1>Title</h1>{{}}</div><p>(c) me</p>",  # no names at all: by ratios alone
    f"<body><header><h2>Site</h2></header><main><header><h1>Title</h1></header>{{}}<aside>{LONG}</aside></main>",
    f"<body><div class='top-menu'>{MENU}</div><div id='content'><h1>Title</h1>{{}}</div><div class='sidebar'><p>{LONG * 4}</p></div>",
    f"<body><article><h1>Title</h1>{{}}<form><p>{LONG}</p></form></article><section id='Comments'><p>{LONG * 3}</p></section>",
    f"<body><div role='alert'>{LONG}</div><div class='cookie-notice'>{LONG}</div><article><h1>Title</h1>{{}}<div hidden>{LONG}</div>",
    f"<body><article><h1>Title</h1>{{}}<script>if (a<b) '</p>'</script><style>p{{{{}}}}</style><!-- {LONG} --></article><div class=ad>{LONG}",
])
@pytest.mark.parametrize("count", [1, 3, 40])
def test_article(page, count):
    lines = paragraphs(count)
    assert main_text(page.format(p(lines))) == "\n".join(["Title", *lines])


def test_short_blocks_of_an_article_stay():
    page = f"<article><h1>T</h1>{p(paragraphs(9))}<ul><li>a<li>b</ul><table><tr><td>1<td>2<tr><td>3</table><blockquote>q</blockquote></article>"
    assert main_text(page).split("\n") == ["T", *paragraphs(9), "a", "b", "1", "2", "3", "q"]


@pytest.mark.parametrize("page,want", [
    ("", ""),
    ("plain  text\n here", "plain text here"),
    ("a < b & c &lt; d &amp;amp; &#233;&eacute &nbsp; e", "a < b & c < d &amp; éé e"),
    ("<p>one<b>two</b> <i> three</i><br>four</p>", "onetwo three four"),
    ("<p>x</p><p></p><p> </p><p>x</p>", "x\nx"),
    ("<p title='a>b'>in</p><P CLASS=x>out</P>", "in\nout"),
    ('<p title="never closed>text</p><b>more', "text\nmore"),
    ("<div>a<div>b</div>c</div>", "a\nb\nc"),
    ("<p>a<!-- x > --><!doctype y><?php z ?>b<!-->c", "abc"),
    ("<p>kept<textarea><p>no</textarea><iframe><p>no</iframe><noscript>no</noscript></p>", "kept"),
    ("<p>text <a", "text"),
    ("<p>text </", "text </"),
    ("</p></div>stray", "stray"),
    ("<nav><p>only a menu</p></nav>", ""),
    ("<script>never closed <p>x</p>", ""),
])
def test_markup(page, want):
    assert main_text(page) == want


@pytest.mark.parametrize("page", ["<a " * 200_000, "<div>" * 100_000 + "x", "<ul><li>" * 20_000, "</p>" * 200_000, '<p a="' * 100_000, "<!--" * 100_000, "&" * 300_000])
def test_hostile_pages_take_linear_time(page):
    main_text(page)


def test_columns_and_nulls(spark):
    rows = [(1, None, "u", "t", 5), (2, "<p>a</p>", None, None, None), (2, "<p>a</p>", None, None, None), (None, "", "u", "t", 1)]
    pages = spark.createDataFrame(rows, "page_id long, html string, url string, text string, n int")
    out = html_text.extract(pages)
    assert out.columns == ["page_id", "url", "n", "text", "n_chars"]
    got = sorted(map(tuple, out.collect()), key=repr)
    assert got == sorted([(1, "u", 5, "", 0), (2, None, None, "a", 1), (2, None, None, "a", 1), (None, "u", 1, "", 0)], key=repr)
    assert html_text.extract(pages.select("html")).columns == ["text", "n_chars"]
    assert html_text.extract(pages.limit(0)).collect() == []


def test_query_returns_the_articles(spark):
    """The given pages mark up their articles, so expected texts can be cut out by patterns."""
    sf = "/root/testdata/sf0.01"
    want = {}
    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        inside = re.search(r"<article>(.*?)</article>", r.html or "", re.S)
        blocks = re.split(r"</?(?:p|h1|br)>", inside[1]) if inside else []
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in blocks]
        want[r.page_id] = "\n".join(b for b in blocks if b)
    got = queries.QUERIES["op12_html_extraction"](spark, sf).collect()
    assert {r.page_id: r.text for r in got} == want and len(got) == len(want)
    assert all(r.n_chars == len(r.text) for r in got)
