"""Main text of HTML pages from flat text blocks and a decision tree.

A page is cut at block-level tags into flat blocks of text.  Each block is
described by its number of words and link density, those of its neighbours, and
what it stands in: an article, a part that is never article text by its tag,
role or class names, a heading, and its kin, the blocks of the same element.
Names that wrappers of whole pages have too ("content-sidebar-wrap", a form
around the page) decide nothing alone: the share of the page's words outside
links that such an element holds goes to the tree.  A decision tree, trained on
the blocks of the small labelled pages below, decides which blocks are article
text; those are joined in page order.

Defined cases: null or empty html, and a page without article text, give an
empty text; unclosed tags, scripts and comments end with the page; a page of any
length or depth is read whole; a null url or page_id stays null; repeated rows
give a row each; an empty table gives an empty result; other columns are not
looked at.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sub_batches, texts_of

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "article", "aside", "heading", "share", "kin", "kin_links")

#: Words outside links that are as good as a whole page's.
MANY = 40

# The labelled pages: "+5" stands for a block's five words of article text, "-5" for five of anything else.
PAGES = (
    # pages with an article
    """<nav><ul><li><a>-1</a></li><li><a>-2</a></li></ul></nav><div class=ad>-9</div><article><h1>+12</h1><p>+70</p><p>+2</p><p>+1</p><h2>+3</h2><p>+120</p>
    <p><a>+3</a></p><p>+18 <a>+12</a></p><aside>-35</aside></article><div class=comments><p>-15</p><p>-60</p></div><footer>-5</footer>""",
    "<header><h1>-6</h1></header><main><h1>+7</h1><div><p>+45</p><p>+9</p></div><ul><li>+4</li><li>+1</li></ul><form><p>-12</p></form></main><div>-25</div><footer><a>-2</a></footer>",
    "<div>-7</div><article><p>+30</p><div class=advert>-4</div><p>+200</p></article><div><p>-50</p><p>-140</p></div><div><a>-3</a></div><div class=related><article><p>-40</p></article></div>",
    "<article>+1</article><article class=comment>-24</article><div>-8</div>", "<div>-3</div><main><p>+4</p></main><div>-5</div>",
    "<article>+2</article><div>-1</div>", "<article>+1</article><div class=sidebar>-1</div>", "-2<article><p>+6</p><div class=widget>-2</div></article>",
    "<div>-4</div><article>" + "<section><h2>+3</h2><p>+16</p><p>+5</p></section><div><p>+30</p><p>+2</p></div>" * 6 + "<div><a>+2</a> <a>+4</a></div></article><div><p>-22</p></div><div><p>-85</p></div>",
    "<main>" + "<div><h3>+2</h3><div><p>+70</p></div><div>+1</div><ul><li>+4</li><li><a>+2</a></li></ul></div>" * 5 + "</main><div><p>-3</p><p>-2</p></div>",
    "<div><h3>-4</h3><p>-33</p></div><article><h1>+5</h1><p><a>+2</a></p><p>+14</p></article><aside><p>-90</p></aside><div>-12</div>",
    "<div><a>-2</a></div><article><h1><a>+5</a></h1><p>+12 <a>+9</a></p><p><a>+4</a></p><p>+20 <a>+16</a></p><ul><li><a>+3</a></li><li><a>+8</a></li></ul></article><div>-9</div>",
    "<main><p>+40 <a>+30</a></p><p>+25</p><div><p>+9 <a>+6</a></p><p><a>+11</a></p></div></main><div><p>-9 <a>-6</a></p></div>",
    # articles inside wrappers with names of parts
    "<div class=content-sidebar><article><h1>+4</h1><p>+40</p><p>+3</p></article><div class=sidebar><h3>-2</h3><p>-12</p><a>-3</a></div></div><div>-6</div>",
    "<form><div class=nav><a>-1</a><a>-2</a></div><div><p>+40</p><p>+55</p><p>+4</p></div><label>-2</label><div class=footer>-8</div></form>",
    "<div class=layout-sidebar><p>+35</p><p>+60</p><p>+2</p><div class=widget><p>-9</p><a>-4</a></div></div><div class=search>-3</div>",
    "<section class=search><h1>+3</h1><p>+80</p><p>+6</p><div class=social><a>-1</a>-2</div></section>",
    "<main><h1>+6</h1><div class=post-social><p>+90</p><p>+5</p><div class=share>-4</div></div></main>",
    # pages without an article
    "<div>-3</div><div><a>-1</a> <a>-1</a></div><div><h1>+6</h1><p>+75</p><p>+4</p><p>+48</p><p>+3</p></div><div>-6</div><div>-5 <a>-8</a></div>",
    "<h1>+5</h1><p>+4</p><p>+6</p><p>+3</p><p>+9</p><p>+2</p><p>+7</p><p>+1</p><p>+5</p>",
    "<div class=menu><a>-2</a></div><div><p>+12</p><ul><li>+3</li><li>+5</li><li>+2</li><li>+6</li></ul><p>+30</p><p>+3</p></div><div><div>-3</div><div>-4</div></div>",
    "<div><a>-2</a></div>" + "<div><h2>+4</h2><p>+60</p><p>+3</p></div><div><p>+25</p></div><div><p>+90</p><p>+40</p></div>" * 4 + "<div><p>-4</p><p>-3</p></div><div>-6 <a>-3</a></div>",
    "<div>-5</div><div>" + "<section><p>+33</p><p>+18</p></section>" * 8 + "</div><div><ul><li><a>-3</a></li><li>-2</li></ul></div>",
    "<div><a>-1</a></div>" + "<div><h2>+2</h2><p>+35</p><p>+6</p></div>" * 12 + "<div><p>+50</p><p>+20</p></div>" * 12 + "<div><p>-4</p><p>-2</p></div><div>-7</div>",
    "<p>+55</p><p>+4</p>", "<h1>+1</h1><p>+3</p><p>+4</p><p>+3</p><p>+3</p>", "<div><a>-3</a></div><div><h1>+2</h1><p>+44</p><p>+9</p><p>+3</p></div>",
    "<div>-2</div><div><p>+8</p><p>+6</p><p>+7</p><p>+3</p></div>", "<p>+10</p><ul><li>+1</li><li>+2</li><li>+1</li></ul><p>+3</p>",
    "<div><a>-1</a> | <a>-1</a></div><p>+5</p>", "<div>-1 <a>-1</a></div><div><p>+4</p></div><div><a>-1</a> | <a>-1</a> | <a>-2</a></div>",
    "<p>+5</p>", "<div>+1</div>", "<div><p>+9</p></div><div><a>-2</a> <a>-1</a></div>",
    "<ul><li><a>-2</a></li><li><a>-1</a></li><li><a>-3</a></li></ul><div><div><p>+60</p></div><div><p>+22</p></div><div><p>+110</p></div><div>+5</div><div>+26</div></div><div><div>-5</div><div>-3</div></div>",
    "<div><p>+80</p></div><div><p>+70</p></div><div><p>+60</p></div><div class=related><article><p>-6</p></article></div>",
    "<div><div>-4</div><div>-2</div></div><div><p>+150</p><p>+35 <a>+4</a></p><p>+17 <a>+3</a></p></div><div><p>-9 <a>-30</a></p><p><a>-12</a></p></div>",
    "<div><p>+50</p><p>+45</p></div><div><p>+65</p><p>+28</p></div><div><a>-1</a></div><div><p>-4 <a>-5</a></p><p>-6</p></div>",
    "<table><tr><td>+2</td><td>+1</td></tr><tr><td>+3</td><td>+4</td></tr></table><div><a>-6</a><a>-2</a></div>",
    "<div><p>-2 <a>-9</a></p><p>-1 <a>-14</a></p><p><a>-5</a></p></div><nav>-3</nav>",
    "<div><h3>-2</h3><ul><li><a>-4</a></li><li><a>-7</a></li></ul></div><div><p>+24</p><p>+40</p><blockquote>+8</blockquote><p>+2</p></div><aside><p>-45</p></aside>",
    "<div class=comments><p>-30</p><p>-44</p></div><div><p>+20</p><p>+13</p></div><div class=sidebar><p>-18</p></div>",
    # small pages of several sizes
    *(page.replace("m", str(m)).replace("n", str(n)) for m in (1, 6, 20) for n in (1, 3, 8) for page in (
        "<nav><a>-m</a></nav><article><h1>+n</h1><p>+m</p><p>+n</p></article><div>-m</div>", "<header>-m</header><section>-n</section><article>+n</article><div>-m</div>",
        "<div><a>-m</a> <a>-n</a></div><div><p>+n</p></div>", "<article><p>+n <a>+m</a></p><p><a>+n</a></p></article><div>-n</div>", "<div class=social>-n</div><article><p>+m</p><p>+n</p><div class=widget>-n</div></article>",
    )),
)

# Tags that end a block, tags whose content is never article text, and names of such parts.
BLOCK_TAGS = frozenset("""address article aside blockquote body button center dd details dialog dir div dl dt fieldset figcaption figure footer form
    frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe label legend li main menu nav ol optgroup option p pre search section select
    summary table tbody td textarea tfoot th thead title tr ul""".split())
ASIDE_TAGS = frozenset("aside button dialog footer head header iframe label menu nav option search select textarea title".split())
FOLDED_TAGS = frozenset("blockquote dd dl dt figcaption figure li ol table tbody td tfoot th thead tr ul".split())  # their blocks are kin of those around
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())
ASIDE_NAMES = frozenset("""ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr
    notice notices notification alert popup modal overlay nav navbar navigation menu breadcrumb breadcrumbs sidebar footer masthead toolbar share sharing
    social related recommended newsletter subscribe subscription signup login search comment comments commentlist disqus reply replies respond
    widget pagination pager skip copyright""".split())
SCOPED_NAMES = frozenset(("header", "aside"))  # of a page, not of an article
# Names that a wrapper of the whole page may have as well.
WRAPPER_NAMES = frozenset("sidebar search social share sharing nav menu banner widget login overlay modal toolbar header aside".split())
COMMENT_NAMES = frozenset("comment reply ad ads advert advertisement sponsored promo".split())  # all that an article may be instead
STATES = frozenset("has with no without is not hide show".split())  # "has-sidebar" describes the whole, it is not the part
LAST_STATES = frozenset("open closed on off enabled disabled".split())  # so does "comments-open"

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)
    | <(script|style|noscript|template|svg|math|object|canvas|audio|video)\b(?:[^>"']|"[^"]*"|'[^']*')*+>.*?(?:</\1\s*>|\Z)
    | <[!?][^>]*>
    | <(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>""", re.S | re.I | re.X)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|\b(hidden)\b""")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


#: What an element is by its tag and attributes: no part of its own, perhaps one, one for certain.
NO_PART, PERHAPS, PART = 0, 1, 2


def _part(tag: str, attributes: str, in_article: bool) -> int:
    if tag in ASIDE_TAGS and not (tag == "header" and in_article):
        return PART
    found = PERHAPS if tag == "form" else NO_PART
    for m in _ATTRIBUTE.finditer(attributes):
        if m[5]:
            return PART
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "role" and value.lower() in ASIDE_ROLES or name == "aria-hidden" and value.lower() == "true":
            return PART
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return PART
        if name in ("class", "id") and tag not in ("html", "body", "main"):
            for words in ([n.lower() for n in _NAME.findall(w)] for w in value.split()):
                if not words or words[0] in STATES or words[-1] in LAST_STATES:
                    continue
                if tag == "article":
                    if COMMENT_NAMES.intersection(words):
                        return PART
                    continue
                named = ASIDE_NAMES.intersection(words) | (frozenset() if in_article else SCOPED_NAMES.intersection(words))
                if named - WRAPPER_NAMES:
                    return PART
                if named:
                    found = PERHAPS
    return found


def blocks(page: str) -> tuple[list[str], list[list[float]]]:
    """The flat blocks of a page and their FEATURES."""
    texts: list[str] = []
    rows: list[list] = []  # words, words in links, inside an article, inside a part, heading, element
    # Elements by number, a parent before its children; 0 is the page.
    tags, parents, kinds, articles, asides = [""], [0], [NO_PART], [False], [False]
    open_tags: list[int] = []
    parts: list[tuple[str, bool]] = []  # pieces of the block and whether they are links
    links = heading = at_element = 0
    own = False  # the paragraph at hand is a part

    def close() -> None:
        whole = html.unescape("".join(p for p, _ in parts)).split()
        if whole:
            linked = sum(len(html.unescape(p).split()) for p, link in parts if link)
            texts.append(" ".join(whole))
            rows.append([len(whole), min(len(whole), linked), articles[at_element], asides[at_element] or own, heading > 0, at_element])
        parts.clear()

    at = 0
    for m in _TAG.finditer(page):
        if m.start() > at:
            parts.append((page[at : m.start()], links > 0))
        at = m.end()
        if m[3] is None:
            continue
        tag, ends = m[3].lower(), bool(m[2])
        if tag == "a":
            links = 0 if ends else 1
        elif tag == "br":
            parts.append((" ", False))
        elif tag in HEADINGS:
            close()
            heading = 0 if ends else 1
        elif tag in VOID_TAGS:
            if tag == "hr":
                close()
        elif tag in BLOCK_TAGS:
            close()
            heading, links, own = 0, 0, False
            if tag == "p":  # rarely closed, so it holds for one block only
                own = not ends and _part(tag, m[4], articles[at_element]) > NO_PART
            elif not ends:
                inside = articles[at_element] or tag in ("article", "main")
                if not m[4].rstrip().endswith("/"):
                    kind = _part(tag, m[4], inside)
                    tags.append(tag)
                    parents.append(at_element)
                    kinds.append(kind)
                    articles.append(inside)
                    asides.append(asides[at_element] or kind == PART)
                    at_element = len(tags) - 1
                    open_tags.append(at_element)
            elif any(tags[t] == tag for t in open_tags):
                while tags[open_tags.pop()] != tag:
                    pass
                at_element = open_tags[-1] if open_tags else 0
    if at < len(page):
        parts.append((page[at:], links > 0))
    close()
    return texts, _features(rows, tags, parents, kinds)


def _features(rows: list[list], tags: list[str], parents: list[int], kinds: list[int]) -> list[list[float]]:
    n = len(tags)
    prose, count = [0] * n, [0] * n  # words outside links and blocks, of an element and all inside it
    for words, linked, _, aside, _, e in rows:
        if not aside:
            prose[e] += words - linked
            count[e] += 1
    for e in range(n - 1, 0, -1):
        prose[parents[e]] += prose[e]
        count[parents[e]] += count[e]
    perhaps = [False] * n
    for e in range(1, n):
        perhaps[e] = perhaps[parents[e]] or kinds[e] == PERHAPS
    # Words of an article outside of anything that may be a part speak against the part's being the whole.
    article = sum(w - linked for w, linked, inside, aside, _, e in rows if inside and not aside and not perhaps[e])
    share, kin = [1.0] * n, [0] * n
    for e in range(1, n):
        whole = prose[e] / (prose[0] + article) if kinds[e] == PERHAPS and prose[0] else 1.0
        share[e] = min(share[parents[e]], whole)
        kin[e] = e if count[e] > 1 and tags[e] not in FOLDED_TAGS else kin[parents[e]]
    kin_words, kin_linked = [0] * n, [0] * n
    for words, linked, _, aside, _, e in rows:
        if not aside:
            kin_words[kin[e]] += words
            kin_linked[kin[e]] += linked
    has_article = any(inside and not aside and share[e] > 0.5 for _, _, inside, aside, _, e in rows)  # comments and teasers that are articles make no article of the page
    around = [[0, 0.0], *([r[0], r[1] / r[0]] for r in rows), [0, 0.0]]
    out = []
    for i, (_, _, inside, aside, heading, e) in enumerate(rows):
        k = kin[e]
        plain = kin_words[k] - kin_linked[k]
        own = (0.0, 0.0) if aside else (min(1.0, plain / max(1, min(MANY, prose[0]))), kin_linked[k] / kin_words[k])
        out.append([*around[i + 1], *around[i], *around[i + 2], 1 if inside else -has_article, aside, heading, share[e], *own])
    return out


def _labelled(pages=PAGES) -> tuple[tuple[float, ...], ...]:
    """Blocks of labelled pages as FEATURES describe them, then 1 for article text."""
    table = []
    for page in pages:
        filled = re.sub(r"([+-])(\d+)", lambda m: " ".join([m[1]] * int(m[2])), page)
        table += [(*map(float, row), float(text[0] == "+")) for text, row in zip(*blocks(filled))]
    return tuple(table)


LABELLED = _labelled()


@dataclass
class Tree:
    """A node: rows with ``column`` at most ``limit`` go to ``low``, the others to ``high``; a leaf has a value."""

    value: bool = False
    column: int = -1
    limit: float = 0.0
    low: Tree | None = None
    high: Tree | None = None

    def predict(self, x: np.ndarray) -> np.ndarray:
        if self.low is None:
            return np.full(len(x), self.value)
        out, low = np.empty(len(x), bool), x[:, self.column] <= self.limit
        out[low], out[~low] = self.low.predict(x[low]), self.high.predict(x[~low])
        return out


def _gini(ones: np.ndarray, count: np.ndarray) -> np.ndarray:
    share = ones / count
    return count * 2 * share * (1 - share)


def grow(x: np.ndarray, y: np.ndarray, depth: int = 12) -> Tree:
    """The tree of the splits that lower Gini impurity most, down to pure leaves or ``depth``."""
    if depth == 0 or y.all() or not y.any():
        return Tree(bool(2 * y.sum() > len(y)))
    best = (np.inf, -1, 0.0)
    for column in range(x.shape[1]):
        order = np.argsort(x[:, column], kind="stable")
        v, ones = x[order, column], np.cumsum(y[order])
        cut = np.flatnonzero(v[1:] > v[:-1])
        if len(cut):
            n = cut + 1
            cost = _gini(ones[cut], n) + _gini(ones[-1] - ones[cut], len(y) - n)
            k = int(cost.argmin())
            best = min(best, (float(cost[k]), column, float((v[cut[k]] + v[cut[k] + 1]) / 2)))
    if best[1] < 0:
        return Tree(bool(2 * y.sum() > len(y)))
    low = x[:, best[1]] <= best[2]
    return Tree(False, best[1], best[2], grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1))


def train(table=LABELLED) -> Tree:
    rows = np.array(table, float)
    return grow(rows[:, :-1], rows[:, -1] > 0)


TEXT_SCHEMA = "page_id long, url string, text string, n_chars long"


def extract(pages: DataFrame, table=LABELLED, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page; no shuffle."""
    tree = train(table)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, 2):
            found = [blocks(t.decode()) for t in texts_of(batch.column(2))]
            features = np.array([r for _, rs in found for r in rs], float).reshape(-1, len(FEATURES))
            keep = iter(tree.predict(features).tolist())
            texts = [" ".join(t for t in ts if next(keep)) for ts, _ in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    plain = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return plain.mapInArrow(rows, TEXT_SCHEMA)
