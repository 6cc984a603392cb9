"""Main text of web pages by tag-path ratios.

A page is read once, front to back, into blocks of text, and each block belongs to the path of open elements from the
root to it. Equal paths are one node of a small tree, in which text length, punctuation, link text and the number of
blocks are added up. Then, from the root down:

* smooth: the ratios of a path (characters and punctuation marks a block, share of link text) are mixed with those of the
  path above it, which count as `KIN` blocks, so that a path met once leans on its surroundings; below the body, where
  unlike things stand side by side, they are not;
* fuse: the geometric mean of both ratios, times the share of text that is no link, times what the names on the path say:
  nothing for navigation, notices, adverts, forms or comments, more for an article. Under an article or main element a
  path has at least half of that element's own ratio, so that its short blocks stay with it;
* threshold: a path is content if its fused ratio reaches `SHARE` of the mean, weighted by characters, over the page's
  paths, where an article or main element stands for all paths below it.

Everything is linear in the size of a page, and pages do not meet, so nothing is shuffled.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from math import sqrt

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .base import replacing

KIN = 4
SHARE = 0.4
#: What a path gains below an explicit content element, and below one whose names only suggest content.
MAIN_GAIN, HINT_GAIN = 8.0, 2.0

# Fixed values of the HTML standard: elements that begin and end blocks, that hold raw text, that are never shown or hold
# no text of a document, and that have no end tag.
BLOCKS = frozenset(
    """address article aside blockquote body caption center col colgroup dd details dialog dir div dl dt fieldset figcaption
    figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li listing main menu nav ol optgroup
    option p plaintext pre search section summary table tbody td tfoot th thead title tr ul xmp""".split()
)
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
HIDDEN = frozenset(
    """applet audio button canvas datalist dialog head iframe map math meter noembed noframes noscript object progress script
    select style svg template textarea title video""".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Which open elements a start tag ends, and the elements that it does not look beyond.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "body": ({"head"}, {"html"}),
}
#: Elements and words in class, id or role that mark what is not the article.
CHROME_TAGS = frozenset("aside dialog footer form menu nav search".split())
CHROME_WORDS = frozenset(
    """ad ads advert adverts advertisement advertising alert alertdialog banner breadcrumb breadcrumbs comment comments
    complementary consent contentinfo cookie cookies disqus footer form gdpr login masthead menu menubar modal nav navbar
    navigation newsletter notice notices notification pager pagination popup promo promoted promotion related replies
    reply respond search share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar topbar
    widget widgets""".split()
)
MAIN_TAGS = frozenset(["article", "main"])
MAIN_WORDS = frozenset(["main", "article", "articlebody"])
HINT_WORDS = frozenset("article articlebody body content entry main post story text".split())

TAG = re.compile(r"""</?([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
LOOSE_TAG = re.compile(r"</?([a-zA-Z][^\s/>]*+)([^>]*+)>")
ATTRIBUTE = re.compile(r"""([^\s=/"'<>]++)\s*+(?:=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?""")
WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")
MARKS = re.compile(r"[.,;:!?。、，；：！？؟،।…]")


def _names(attributes: str) -> tuple[set[str], set[str], bool]:
    """Words of class and id, values of role and itemprop, and whether the element is hidden."""
    words, roles, hidden = set(), set(), False
    for name, value in ATTRIBUTE.findall(attributes):
        name = name.lower()
        value = html.unescape(value.strip("\"'")) if value else ""
        if name in ("class", "id"):
            words.update(w.lower() for w in WORD.findall(value))
        elif name in ("role", "itemprop"):
            roles.update(value.lower().split())
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            hidden = True
        elif name == "style":
            style = re.sub(r"\s", "", value.lower())
            hidden = hidden or "display:none" in style or "visibility:hidden" in style
    return words, roles, hidden


class _Page:
    """Blocks of one page, and the tree of their tag paths."""

    def __init__(self) -> None:
        # of every path: the path above, its gain (0: not content), whether it is below an explicit content element, and
        # whether it is the page itself
        self.above, self.gain, self.main, self.page = [-1], [1.0], [False], [True]
        self.size, self.marks, self.link, self.count = [0], [0], [0], [0]
        self.below: dict[tuple, int] = {}
        self.blocks: list[tuple[int, str]] = []
        self.open: list[tuple[str, int, bool]] = [("", 0, True)]  # element, path, whether it is a block
        self.opened: dict[str, int] = {}
        self.parts: list[tuple[str, bool]] = []

    def path(self, tag: str, attributes: str) -> int:
        at = self.open[-1][1]
        words, roles, hidden = _names(attributes) if attributes.strip(" /\n\t") else ((), (), False)
        words = frozenset(words)
        key = (at, tag, words, frozenset(roles), hidden)
        if key not in self.below:
            self.below[key] = len(self.above)
            in_main = self.main[at]
            named = words | set(roles)
            main = tag in MAIN_TAGS or not MAIN_WORDS.isdisjoint(roles)
            chrome = tag in CHROME_TAGS or tag in HIDDEN or hidden or (tag == "header" and not in_main)
            if tag not in ("html", "body") and not main:
                chrome = chrome or not CHROME_WORDS.isdisjoint(named)
            gain = self.gain[at]
            if chrome:
                gain = 0.0
            elif main and not in_main:
                gain *= MAIN_GAIN
            elif gain == 1.0 and tag not in ("html", "body") and not HINT_WORDS.isdisjoint(named):
                gain = HINT_GAIN
            self.above.append(at)
            self.gain.append(gain)
            self.main.append(in_main or main)
            self.page.append(tag in ("html", "body"))
            for sums in (self.size, self.marks, self.link, self.count):
                sums.append(0)
        return self.below[key]

    def flush(self) -> None:
        """End the block at hand."""
        if not self.parts:
            return
        text = " ".join(html.unescape("".join(t for t, _ in self.parts)).split())
        if text:
            at = next(p for _, p, block in reversed(self.open) if block)
            linked = sum(len(t) for t, link in self.parts if link)
            written = sum(len(t) for t, _ in self.parts)
            self.blocks.append((at, text))
            self.size[at] += len(text)
            self.marks[at] += len(MARKS.findall(text))
            self.link[at] += len(text) * linked // written
            self.count[at] += 1
        self.parts = []

    def text(self, text: str) -> None:
        if text and self.gain[self.open[-1][1]]:
            self.parts.append((text, self.opened.get("a", 0) > 0))

    def start(self, tag: str, attributes: str) -> None:
        block = tag in BLOCKS
        if tag == "br":
            self.text(" ")
        if block:
            self.flush()
            if self.opened.get("p") and self.open[-1][0] != "button":
                self.end_until({"p"}, {"table", "td", "th", "caption", "object", "button"})
            elif tag in ("h1", "h2", "h3", "h4", "h5", "h6") and self.open[-1][0] in ("h1", "h2", "h3", "h4", "h5", "h6"):
                self.pop()
        if tag in ENDS:
            targets, scope = ENDS[tag]
            while any(self.opened.get(t) for t in targets) and self.end_until(targets, scope):
                pass
        if tag in VOID:
            return
        if tag == "a" and self.opened.get("a"):
            self.end_until({"a"}, BLOCKS)
        self.open.append((tag, self.path(tag, attributes), block))
        self.opened[tag] = self.opened.get(tag, 0) + 1

    def pop(self) -> None:
        tag, _, block = self.open[-1]
        if block:
            self.flush()
        self.open.pop()
        self.opened[tag] -= 1

    def end_until(self, targets, scope) -> bool:
        """End the nearest open element of the targets unless one of the scope lies before it."""
        for k in range(len(self.open) - 1, 0, -1):
            tag = self.open[k][0]
            if tag in targets:
                while len(self.open) > k:
                    self.pop()
                return True
            if tag in scope:
                return False
        return False

    def end(self, tag: str) -> None:
        if tag in BLOCKS:
            self.flush()
        if tag == "br":
            self.text(" ")
        if self.opened.get(tag):
            while self.open[-1][0] != tag:
                self.pop()
            self.pop()

    def content(self) -> list[str]:
        """The blocks whose paths pass the threshold."""
        n = len(self.above)
        size, marks, link, count = list(self.size), list(self.marks), list(self.link), list(self.count)
        for v in range(n - 1, 0, -1):  # a path's own blocks and those below it
            if self.gain[v]:
                for sums in (size, marks, link, count):
                    sums[self.above[v]] += sums[v]
        ratios, fused, roots = [(0.0, 0.0, 0.0)] * n, [0.0] * n, [0.0] * n
        for v in range(n):
            if not self.gain[v] or not count[v]:
                continue
            up = ratios[self.above[v]] if v else (0.0, 0.0, 0.0)
            kin = 0 if self.page[v] or self.page[self.above[v]] else KIN
            own = (size[v] - link[v], marks[v], link[v])
            ratios[v] = tuple((x + kin * u) / (count[v] + kin) for x, u in zip(own, up, strict=True))
            plain, mark, linked = ratios[v]
            fused[v] = sqrt(plain * (1 + mark)) * plain / (plain + linked or 1) * self.gain[v]
            if self.main[v]:
                root = roots[self.above[v]] if self.main[self.above[v]] else fused[v]
                roots[v], fused[v] = root, max(fused[v], root / 2)
        shown = sum(self.size[v] for v in range(n) if self.gain[v])
        total = sum(self.size[v] * (roots[v] or fused[v]) for v in range(n) if self.gain[v])
        return [text for at, text in self.blocks if self.gain[at] and fused[at] >= SHARE * total / (shown or 1)]


def main_text(page: str) -> str:
    """The page's content blocks in page order, one a line, with single spaces inside; empty if there are none.

    Character references are decoded. A line break element is white space. A tag that never ends hides what follows it,
    as in browsers.
    """
    out, at, size, exact = _Page(), 0, len(page), True
    while at < size:
        lt = page.find("<", at)
        if lt < 0:
            out.text(page[at:])
            break
        mark = page[lt + 1 : lt + 2]
        if mark == "/" and page[lt + 2 : lt + 3].isascii() and page[lt + 2 : lt + 3].isalpha() or mark.isascii() and mark.isalpha():
            out.text(page[at:lt])
            tag = TAG.match(page, lt) if exact else None
            if tag is None:
                exact = False  # a quote stays open: from here on, quotes do not hide the end of a tag
                tag = LOOSE_TAG.match(page, lt)
            if tag is None:
                break
            at, name = tag.end(), tag[1].lower()
            if mark == "/":
                out.end(name)
                continue
            out.start(name, tag[2])
            if name == "plaintext":
                out.text(html.escape(page[at:]))
                break
            if name in RAW:
                end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
                at = end.start() if end else size
        elif mark in ("!", "?", "/") and mark and (mark != "/" or lt + 2 < size):
            out.text(page[at:lt])
            if page.startswith("<!--", lt):
                short = re.compile(r"-?>").match(page, lt + 4)
                ends = short or re.compile(r"--!?>").search(page, lt + 4)
                at = ends.end() if ends else size
            elif page.startswith("<![CDATA[", lt) and (end := page.find("]]>", lt)) >= 0:
                at = end + 3
            else:
                end = page.find(">", lt)
                at = end + 1 if end >= 0 else size
        else:
            out.text(page[at : lt + 1])
            at = lt + 1
    out.flush()
    return "\n".join(out.content())


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """All columns of the pages but `html`, with the main `text` and its code points `n_chars`.

    A null or empty page, and one without content, has an empty text. Repeated rows are handled one by one, pages of any
    length whole. Columns of the input named `text` or `n_chars` are replaced; others are kept as they are, nulls too.
    """
    others = [c for c in pages.columns if c != html]
    kept = [c for c in others if c.lower() not in ("text", "n_chars")]
    fields = [T.StructField("_row", T.StructType([pages.schema[c] for c in kept]), False)] if kept else []
    schema = T.StructType([*fields, T.StructField("text", T.StringType(), False), T.StructField("n_chars", T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(p.as_py() or "") for p in b.column(b.num_columns - 1)]
            columns = [b.column(0)] if kept else []
            columns += [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["_row", "text", "n_chars"][-len(columns) :])

    row = [F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row")] if kept else []
    out = pages.select(*row, F.col(html).alias("_html")).mapInArrow(run, schema)
    return out.select(*replacing("_row", kept), "text", "n_chars") if kept else out
