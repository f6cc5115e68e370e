"""Main text of HTML pages by tree scoring.

A page is read once into elements and text blocks.  Elements that never hold article text (scripts, menus,
headers, footers, forms, and whatever is named like an advert, notice, sidebar or comment section) are
dropped with all they contain.  Inside an ``article`` ids, which are often made of headings, never count, and of classes and roles those
that name side content (adverts, notices, comments, menus) and no part of an article; the same holds for headings, paragraphs, tables and sections anywhere, and ids of
blocks do not count inside the container that is kept.  Of a ``header`` inside an article only the headings stay.  Every remaining block passes points for its length and commas to its
ancestors, half as much with each level and less by its share of link text.  The container of the most points, again
discounted by its link density, is kept with its good siblings; inside an ``article`` (or ``main``) it grows to
that element, so among several articles the points decide; containers in it that are mostly links and have few points of their own go, a list that
nothing marks as a menu stays.  Its blocks are the result, in page order.

Pages are independent, so this is one Arrow UDF without shuffle.  Time is linear in the page's length: a tag that does not end is looked
for once, open elements are found by their kind, and sums over ancestors are one pass over the elements.

Defined results: null and empty pages and pages without text give an empty text; very long and very deep pages are read whole;
unclosed or crossed tags close as browsers close them; a quote in a tag counts only behind ``=``; a tag without an end is text; ties between
containers go to the first; repeated rows stay; an empty table gives no rows.
A column that is named like a result is replaced by it.
"""

from __future__ import annotations

import re
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NAME = re.compile(r"(/?)([a-zA-Z][a-zA-Z0-9:-]*+)")
PLAIN = re.compile(r"[^>\"']*+")
ATTR = re.compile(r"(?<![\w-])(?:([a-zA-Z-]++)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]++))|(hidden)\b)")

#: Elements whose content is no markup of the page.
RAW = {t: re.compile(rf"</{t}\s*+>", re.I) for t in "script style noscript template textarea title iframe svg object select".split()}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("head nav footer aside form button input label fieldset dialog menu canvas audio video datalist map annotation annotation-xml".split())
BLOCKS = frozenset(
    "html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption pre blockquote figure"
    " figcaption address header footer nav aside form fieldset hr center details summary hgroup search".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that a start tag of the same kind closes, and where the search for an open one ends.
CLOSES_P = BLOCKS - {"html", "body", "summary"}
#: Kinds of elements of which a start tag closes the open one, and the tags in which the search for it ends.
KIND = {"li": 0, "dt": 1, "dd": 1, "tr": 2, "td": 3, "th": 3}
ENDS = {"ul": (0,), "ol": (0,), "dl": (1,), "table": (2, 3), "tr": (3,)}
WEIGHT = {"article": 10, "main": 8, "div": 5, "section": 4, "pre": 3, "td": 3, "blockquote": 3, "ol": -3, "ul": -3, "dl": -3, "address": -3, "th": -5}
#: Names (class, id or role, split into words) of what is not the article.
UNLIKELY = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion promoted banner comment comments commentlist"
    " disqus discussion respond reply replies sidebar sidebars aside widget widgets rail menu menus nav navbar navigation navigational breadcrumb"
    " breadcrumbs pagination pager header masthead topbar footer foot colophon copyright cookie cookies consent gdpr notice notices alert"
    " popup modal overlay dialog newsletter subscribe subscription signup login form share sharing social related recommended recommendations"
    " outbrain taboola toolbar skip search contentinfo complementary legal disclaimer feedback responses adslot adbox adunit advertorial sidenav"
    " sidepanel menubar dropdown cookiebar notification notifications toast paywall privacy".split()
)
#: Those that have no other meaning, even inside an article, and roles like them.
SURE = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsored adslot adbox adunit advertorial comments commentlist disqus sidebar"
    " sidebars sidenav sidepanel share sharing cookie cookies cookiebar gdpr newsletter navbar breadcrumb breadcrumbs pagination outbrain taboola paywall".split()
)
#: Names of side content that blocks of running text have, too.
NAMED = SURE | frozenset(
    "alert banner comment consent footer login masthead menu menus modal nav navigation notice notices notification notifications overlay pager popup privacy promo promos promoted promotion"
    " recommended recommendations replies reply respond responses signup skip social sponsor subscribe subscription taboola toast toolbar topbar widget widgets".split()
)
HARD, HEADER, SOFT = 3, 2, 1
SURE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog menu menubar toolbar".split())
#: Words that tell that a container has, or lacks, one of these.
ABOUT = frozenset("has have with without no".split())
LIKELY = frozenset("article content main body post entry story text page".split())
LINK_LISTS = frozenset("ul ol dl div".split())
CONTAINERS = frozenset("html body article main section div center".split())
#: Elements of running text, which a class name alone does not make side content.
RUNNING = HEADINGS | frozenset("p section table pre blockquote figure".split())


#: Elements that such a name makes side content; a heading, a table or a listing is none by its name.
SIDE = BLOCKS - HEADINGS - frozenset("html body article main table thead tbody tfoot tr td th pre".split())


def _attrs(raw: str) -> dict[str, str]:
    return {(m[1] or m[5]).lower(): m[2] or m[3] or m[4] or "" for m in ATTR.finditer(raw)} if raw.strip(" /") else {}


def _words(attrs: dict[str, str], *keys: str) -> set[str]:
    return {w.lower() for k in keys for w in re.split(r"[\s_-]+|(?<=[a-z])(?=[A-Z])", attrs.get(k, "")) if w}


def _is_dropped(tag: str, attrs: dict[str, str], in_article: bool) -> int:
    """HARD if an element is dropped, HEADER if all but its headings is, SOFT if only outside the container that is kept, else 0."""
    if tag in DROPPED or tag == "header" and not in_article:
        return HARD
    head = HEADER if tag == "header" else 0
    if not attrs:
        return head
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in attrs.get("style", "").replace(" ", "").lower():
        return HARD
    if tag in ("html", "body"):
        return 0
    names, ids = _words(attrs, "class", "role"), _words(attrs, "id")
    if (names | ids) & ABOUT or tag in ("article", "main") and (names | ids) & LIKELY:
        return head
    if in_article or tag in RUNNING:
        side = NAMED if tag in SIDE else SURE
        return HARD if names & side or attrs.get("role", "").lower() in SURE_ROLES else head
    if names & UNLIKELY:
        return HARD
    return (SOFT if tag in BLOCKS else HARD) if ids & UNLIKELY else 0


def _tag_end(html: str, at: int) -> int:
    """Where the tag ends whose name ends at this place; -1 if it does not."""
    while True:
        at = PLAIN.match(html, at).end()
        if at == len(html) or html[at] == ">":
            return at if at < len(html) else -1
        before = at - 1
        while html[before].isspace():
            before -= 1
        close = html.find(html[at], at + 1) if html[before] == "=" else -1
        at = max(at, close) + 1


def _tokens(html: str):
    """(text, "", "", False) for text and ("", tag, attributes, whether an end tag) for tags, in page order."""
    at, look, quotes, last = 0, 0, True, html.rfind(">")
    while (i := html.find("<", look)) >= 0:
        end, tag = -1, None
        if html.startswith("<!--", i):
            end = html.find("-->", i + 2) + 3
            end = end if end > 2 else len(html)
        elif i > last:  # no tag ends from here on, but a comment may begin
            i = html.find("<!--", i)
            end = len(html)
            if i < 0:
                break
        elif m := NAME.match(html, i + 1):
            close = _tag_end(html, m.end()) if quotes else html.find(">", m.end())
            if close >= 0:
                tag, attrs, end = m[2].lower(), html[m.end() : close], close + 1
                if tag in RAW and not m[1]:
                    tag, over = None, RAW[tag].search(html, end)
                    end = over.end() if over else len(html)
            else:
                quotes = False  # so that the rest is not searched for every tag
        elif html[i + 1 : i + 2] in ("!", "?", "/"):
            end = html.find(">", i + 2) + 1 or -1
        if end < 0:
            look = i + 1
            continue
        if i > at:
            yield html[at:i], "", "", False
        if tag:
            yield "", tag, attrs, bool(m[1])
        at = look = end
    if at < len(html):
        yield html[at:], "", "", False


class _Page:
    """Elements (tag, parent, dropped) and blocks of text in page order."""

    def __init__(self, html: str):
        self.tag, self.parent, self.dropped, self.block_of = [], [], [], []
        self.articles: list[int] = []  # the outermost article around each element, else the outermost main
        self.blocks: list[tuple[int, str, int]] = []  # block element, text, letters in links
        self.links: list[int] = []  # links inside, own ones only
        self._parts: list[str] = []
        self._linked = self._anchors = 0
        self._stack: list[int] = []
        self._open: dict[str, list[int]] = {}  # places in the stack by tag
        self._open_blocks: list[int] = []
        self._near = [(-1, -1, -1, -1)]  # places of the open elements of each KIND
        self._push("html", -1, {})
        for text, tag, raw, is_end in _tokens(html):
            if not tag:
                self._text(text)
            elif tag == "br":
                self._parts.append(" ")
            elif is_end:
                self._close(tag)
            else:
                self._start(tag, raw)
        self._flush()

    def _start(self, tag: str, raw: str) -> None:
        if tag in CLOSES_P and self.tag[self._stack[self._open_blocks[-1]]] == "p":
            self._pop_to(self._open_blocks[-1])
        if tag in KIND:
            near = self._near[-1]
            at = max(near[2], near[3]) if tag == "tr" and near[2] < 0 else near[KIND[tag]]
            if at > 0:
                self._pop_to(at)
        if tag in BLOCKS:
            self._flush()
        if tag not in VOID:
            alone = raw.endswith("/") and tag not in BLOCKS and tag not in ("a", "b", "i", "em", "strong", "span")
            self._push(tag, self._stack[-1], _attrs(raw), alone)

    def _push(self, tag: str, parent: int, attrs: dict[str, str], alone: bool = False) -> None:
        i, place = len(self.tag), len(self._stack)
        around = self.articles[parent] if parent >= 0 else -1
        in_article = around >= 0 and self.tag[around] == "article"
        self.tag.append(tag)
        self.parent.append(parent)
        above = self.dropped[parent] if parent >= 0 else 0
        above = 0 if above == HEADER and tag in HEADINGS else above
        self.dropped.append(max(above, _is_dropped(tag, attrs, in_article)) if parent >= 0 else 0)
        self.block_of.append(i if tag in BLOCKS else self.block_of[parent])
        self.articles.append(i if tag == "article" and not in_article or tag == "main" and around < 0 else around)
        self.links.append(0)
        if tag == "a":
            self.links[self.block_of[i]] += 1
        if alone:
            return
        self._stack.append(i)
        self._open.setdefault(tag, []).append(place)
        if tag in BLOCKS:
            self._open_blocks.append(place)
        self._anchors += tag == "a"
        near = self._near[-1]
        if tag in KIND or tag in ENDS:
            near = tuple(place if KIND.get(tag) == k else -1 if k in ENDS.get(tag, ()) else x for k, x in enumerate(near))
        self._near.append(near)

    def _pop_to(self, place: int) -> None:
        """Closes the open elements from a place of the stack on."""
        while len(self._stack) > place:
            if self._open_blocks[-1] == len(self._stack) - 1:
                self._flush()
                self._open_blocks.pop()
            tag = self.tag[self._stack.pop()]
            self._open[tag].pop()
            self._near.pop()
            self._anchors -= tag == "a"

    def _close(self, tag: str) -> None:
        """An end tag closes the open element; an inline one must not lie outside the present block."""
        at = self._open.get(tag)
        if at and at[-1] > 0 and (tag in BLOCKS or at[-1] > self._open_blocks[-1]):
            self._pop_to(at[-1])
        elif tag in BLOCKS:
            self._flush()

    def _text(self, raw: str) -> None:
        if self.dropped[self._stack[-1]] < HEADER:
            self._parts.append(text := unescape(raw))
            if self._anchors:
                self._linked += len("".join(text.split()))

    def _flush(self) -> None:
        if self._parts:
            text = " ".join("".join(self._parts).split())
            if text:
                self.blocks.append((self.block_of[self._stack[-1]], text, self._linked))
            self._parts, self._linked = [], 0


def main_text(html: str | None) -> str:
    """The main text of one page, a line for each block."""
    page = _Page(html or "")
    if not page.blocks:
        return ""
    tag, parent, n = page.tag, page.parent, len(page.tag)
    points, size, linked, links = [0.0] * n, [0] * n, [0] * n, page.links
    for block, text, link in page.blocks:
        if page.dropped[block]:
            continue
        letters = len(text) - text.count(" ")
        own = 0.0 if tag[block] in HEADINGS else (1 + text.count(",") + min(len(text) / 100, 3)) * (1 - min(1, link / max(1, letters)))
        points[block if tag[block] in CONTAINERS else parent[block]] += own
        size[block] += letters
        linked[block] += link
    for i in range(n - 1, 0, -1):  # children come behind their parents
        up = parent[i]
        points[up] += points[i] / 2
        size[up] += size[i]
        linked[up] += linked[i]
        links[up] += links[i]
    density = [linked[i] / size[i] if size[i] else 0.0 for i in range(n)]
    score = [(points[i] + WEIGHT.get(tag[i], 0)) * (1 - density[i]) if points[i] else 0.0 for i in range(n)]
    best = max(range(n), key=lambda i: (score[i], -i))
    if score[best] <= 0:
        best = next((i for i in range(n) if tag[i] in ("article", "main") and size[i]), -1)
        if best < 0:
            return ""
    top = page.articles[best] if page.articles[best] >= 0 else best
    kept = {top}
    least = max(10.0, 0.2 * score[best])
    for i in range(n):
        if parent[i] == parent[top] and i != top and size[i]:
            good = tag[i] in ("p", "pre", "blockquote") and density[i] < 0.25 and (size[i] > 80 or density[i] == 0)
            if points[i] * (1 - density[i]) >= least or good or tag[i] in HEADINGS and tag[parent[top]] == "main":
                kept.add(i)
    spare = tag[top] not in ("html", "body") and not page.dropped[top]  # blocks named by an id inside the container stay
    within, inside = [False] * n, [False] * n
    for i in range(n):
        up = parent[i]
        within[i] = i == top or up >= 0 and within[up]
        around = page.articles[i]
        if around >= 0 and tag[around] == "article":  # a list that nothing marks as a menu belongs to the article
            menu = tag[i] in ("div", "section") and links[i] >= 2 and density[i] > 0.6 and score[i] < 0.2 * score[best]
        else:
            menu = tag[i] in LINK_LISTS and links[i] >= 2 and density[i] > (0.95 if around >= 0 else 0.6)
        menu = menu and i != top
        inside[i] = not menu and (i in kept or up >= 0 and inside[up])
    return "\n".join(text for block, text, _ in page.blocks if inside[block] and (not page.dropped[block] or spare and within[block]))


def main_text_udf():
    @F.pandas_udf("string")
    def extract(pages: pd.Series) -> pd.Series:
        return pd.Series([main_text(p) for p in pages], dtype=object)

    return extract


def extract_text(pages: DataFrame, html: str = "html", to: str = "text") -> DataFrame:
    """Adds the main text of each page."""
    return pages.withColumn(to, main_text_udf()(F.col(html)))


def op10(pages: DataFrame) -> DataFrame:
    out = extract_text(pages.select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
