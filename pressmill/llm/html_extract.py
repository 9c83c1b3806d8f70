"""Main text of web pages by composite text density.

Each page is parsed into a DOM (tags closed as browsers close them). Per node:
characters C, tags T, link characters LC and link tags LT of its subtree.
Its composite text density is

    CTD = C / T * log_b((C / LC) * (T / LT)),  b = ln((C / nLC) * LC + (LCb / Cb) * C + e)

(nLC non-link characters, LCb / Cb the link share of the body; zero LC, LT
and nLC count as 1, and b is at least e). A node's density sum adds the
densities of its children, text runs counting as children of one tag;
formatting tags inside a block (b, em, span, a, ...) count as no tag, so
wrapping a text changes nothing. The block node of largest density sum is the main subtree; the smallest density on the
path from body down to it is the threshold, and inside the subtree only
children below the threshold that are mostly link text are left out.

Before densities are taken, what is never main text goes: scripts, styles,
forms and their fields, comments, hidden nodes, and the page's menus, headers,
footers, sidebars, notices, adverts and reader comments, named by tag, role or
class (the fixed lists below). Text is cut into blocks at block tags, white
space in a block becomes one space, blocks are trimmed and joined by one \\n.

Pages are independent: one pass, no shuffle, parsing in Python inside Arrow
batches. Defined results: null or empty html, or no text, give ``""`` and 0;
a page without body is read as if all of it were the body; repeated rows give
repeated results; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill.llm.common import slices, small_batches

# Tags, roles and class words whose subtrees are never main text.
DROPPED_TAGS = frozenset(
    "script style noscript template head title iframe object embed svg canvas form button select option textarea input label nav aside footer dialog menu".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog menu menubar form".split())
DROPPED_CLASS_WORDS = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo banner cookie cookies consent notice gdpr sidebar comment comments "
    "respond reply replies disqus share sharing social newsletter subscribe signup popup modal breadcrumb breadcrumbs menu navbar nav "
    "related recommended masthead".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Formatting inside a block: not counted as tags, never a main subtree of their own.
INLINE_TAGS = frozenset("a abbr b bdi bdo br cite code data dfn em font i kbd mark q s samp small span strong sub sup time u var wbr".split())
#: Start tags that close an open paragraph, as browsers do.
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
#: Start tags that close an open one of the same group, up to the named boundary.
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
            "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
_CLASS_SPLIT = re.compile(r"[^a-z0-9]+")


class Page(HTMLParser):
    """A DOM as flat lists: tag, parent and content of every node; text runs are nodes with tag None."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tag: list[str | None] = ["#root"]
        self.parent: list[int] = [-1]
        self.text: list[str] = [""]
        self.dropped: list[bool] = [False]
        self.stack: list[int] = [0]

    def _open(self, tag: str, drop: bool) -> int:
        node = len(self.tag)
        self.tag.append(tag)
        self.parent.append(self.stack[-1])
        self.text.append("")
        self.dropped.append(drop or self.dropped[self.stack[-1]])
        return node

    def _close_to(self, tags: set[str] | frozenset[str], boundary: set[str] | frozenset[str]) -> None:
        for depth in range(len(self.stack) - 1, 0, -1):
            tag = self.tag[self.stack[depth]]
            if tag in boundary:
                return
            if tag in tags:
                del self.stack[depth:]
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in CLOSES_P:
            self._close_to({"p"}, {"button", "table", "td", "th"})
        if tag in SIBLINGS:
            self._close_to(*SIBLINGS[tag])
        node = self._open(tag, _boilerplate(tag, attrs, self._inside_article()))
        if tag not in VOID_TAGS:
            self.stack.append(node)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._open(tag, True)

    def handle_endtag(self, tag: str) -> None:
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.tag[self.stack[depth]] == tag:
                del self.stack[depth:]
                return

    def handle_data(self, data: str) -> None:
        node = self._open(None, False)
        self.text[node] = data

    def _inside_article(self) -> bool:
        return any(self.tag[n] in ("article", "main") for n in self.stack)


def _boilerplate(tag: str, attrs: list[tuple[str, str | None]], in_article: bool) -> bool:
    if tag in DROPPED_TAGS or (tag == "header" and not in_article):
        return True
    values = dict((k, v or "") for k, v in attrs)
    if "hidden" in values or "display:none" in values.get("style", "").replace(" ", "").lower():
        return True
    if values.get("aria-hidden", "").lower() == "true" or values.get("role", "").lower() in DROPPED_ROLES:
        return True
    words = set(_CLASS_SPLIT.split(f"{values.get('class', '')} {values.get('id', '')}".lower()))
    return bool(words & DROPPED_CLASS_WORDS)


def _density(c: float, t: float, lc: float, lt: float, link_share: float) -> float:
    if c <= 0:
        return 0.0
    nlc = c - lc
    base = max(math.log((c / (nlc or 1)) * lc + link_share * c + math.e), math.e)
    return c / max(t, 1) * math.log(max((c / (lc or 1)) * (max(t, 1) / (lt or 1)), 1.0)) / math.log(base)


def extract(html: str | None) -> str:
    """The main text of one page, blocks joined by one newline."""
    if not html:
        return ""
    page = Page()
    page.feed(html)
    page.close()
    n = len(page.tag)
    tag, parent, dropped = page.tag, page.parent, page.dropped
    # Text after the whitespace rule, per text node; link text is text below an <a>.
    words = [" ".join(page.text[i].split()) if tag[i] is None and not dropped[i] else "" for i in range(n)]
    in_link = [False] * n
    for i in range(1, n):
        in_link[i] = in_link[parent[i]] or tag[parent[i]] == "a"
    c, t, lc, lt = [0] * n, [0] * n, [0] * n, [0] * n
    children: list[list[int]] = [[] for _ in range(n)]
    for i in range(n - 1, 0, -1):  # children come after their parent: reversed order is bottom-up
        if dropped[i]:
            continue
        if tag[i] is None:
            c[i] = len(words[i])
            lc[i] = c[i] if in_link[i] else 0
        else:
            t[i] += 0 if tag[i] in INLINE_TAGS else 1
            lt[i] += 1 if tag[i] == "a" else 0
        p = parent[i]
        c[p] += c[i]
        t[p] += t[i]
        lc[p] += lc[i]
        lt[p] += lt[i]
        children[p].append(i)
    body = next((i for i in range(n) if tag[i] == "body" and not dropped[i]), 0)
    share = lc[body] / c[body] if c[body] else 0.0
    ctd = [_density(c[i], t[i] or 1, lc[i], lt[i], share) for i in range(n)]
    best, best_sum = body, -1.0
    order = [body]
    while order:  # document order, so ties go to the node met first (an ancestor before its children)
        i = order.pop()
        if tag[i] is None or tag[i] in INLINE_TAGS:
            continue
        total = sum(ctd[j] for j in children[i])
        if total > best_sum:
            best, best_sum = i, total
        order.extend(children[i])  # descending, so the first child comes out first
    path, i = [], best
    while i != -1 and i != parent[body]:
        path.append(ctd[i])
        i = parent[i]
    threshold = min(path) if path else 0.0

    blocks: list[list[str]] = [[]]
    todo = [best]
    while todo:
        i = todo.pop()
        if i < 0:
            blocks.append([])
            continue
        if tag[i] is None:
            if words[i]:
                blocks[-1].append(words[i])
            continue
        if i != best and tag[i] not in INLINE_TAGS and ctd[i] < threshold and lc[i] * 2 > c[i]:
            continue  # a list of links inside the main subtree
        block = tag[i] in BLOCK_TAGS
        if block:
            blocks.append([])
            todo.append(-1)
        todo.extend(children[i])
    lines = (" ".join(" ".join(parts).split()) for parts in blocks)
    return "\n".join(line for line in lines if line)


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "html"):
        texts = [extract(h) for h in part.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for every page."""
    small_batches(pages.sparkSession)
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(_run, "page_id bigint, url string, text string, n_chars bigint")
