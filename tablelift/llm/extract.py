"""Main text of HTML pages from flat text blocks.

A page is cut into text blocks at block-level tags. Each block has its word count and link density, those of the
blocks before and after it, and where it stands: inside an article, on a page without one, or outside, and whether a
tag or name around it says menu, advert, form, comment and so on. A decision tree, trained on the small labelled table
below, tells which blocks are main text. Only these are joined, in page order; nothing is capped.

A name says what an element is only by a whole word of its class, id or role, such as ``sidebar`` or ``cookie-notice``; ``has-sidebar`` says
nothing. Articles count as the page's articles only if they hold a good share of its words outside links; else a teaser
would outweigh the text.

Scripts, styles, comments, hidden elements, drawings (svg), what is shown only without scripts (noscript, a notice) and the head hold no blocks;
formulas (math) are text. An unfinished tag at the end of a cut-off page is dropped, and so is the rest of a page behind a script or style that
never ends; a drawing or noscript that never ends takes nothing with it. Null and empty pages give an empty text. Rows may repeat, ids and urls may be null and other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelift.llm.common import share_code

# Element names of HTML by their role for text blocks.
RAW = ["script", "style", "title", "textarea", "noscript", "template", "iframe", "svg", "xmp"]
# Those that a missing end tag does not stretch to the end of the page.
OPEN_ENDED = ["noscript", "template", "iframe", "svg"]
CONTAINERS = [
    "html", "head", "body", "main", "article", "section", "div", "nav", "header", "footer", "aside", "form", "fieldset", "menu", "dialog",
    "ul", "ol", "dl", "table", "thead", "tbody", "tfoot", "tr", "figure", "blockquote", "details", "address", "select", "button", "center", "hgroup", "search",
]
BLOCKS = [*CONTAINERS, "p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "td", "th", "caption", "pre", "hr", "figcaption", "summary", "legend", "option", "label"]
BOILER_TAGS = ["head", "nav", "header", "footer", "aside", "form", "fieldset", "menu", "dialog", "select", "button", "search"]
VOID = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"]

# Words in class, id and role names that mark what is not the article.
BOILER_NAMES = [
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner", "cookie", "cookies", "consent", "gdpr",
    "notice", "notices", "notification", "alert", "popup", "modal", "overlay", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "pagination", "pager",
    "sidebar", "aside", "complementary", "header", "masthead", "footer", "contentinfo", "copyright", "comment", "comments", "commentlist", "respond", "reply", "replies",
    "disqus", "discussion", "share", "sharing", "social", "related", "recommended", "recommendations", "teaser", "newsletter", "subscribe", "subscription", "signup",
    "login", "register", "search", "toolbar", "widget", "widgets", "form", "tags", "skip",
]
# Words that say where or how large something is, not what; they may stand beside one of the above.
PLAIN_NAMES = [
    "area", "bar", "block", "bottom", "box", "card", "container", "inner", "item", "items", "js", "left", "link", "links", "list", "main", "outer", "page", "panel",
    "primary", "right", "secondary", "section", "site", "slot", "top", "unit", "wrap", "wrapper",
]

_RAW, _OPEN_ENDED, _CONTAINERS, _BLOCKS, _BOILER_TAGS, _VOID, _NAMES, _PLAIN = (
    frozenset(x) for x in (RAW, OPEN_ENDED, CONTAINERS, BLOCKS, BOILER_TAGS, VOID, BOILER_NAMES, PLAIN_NAMES)
)
#: Share of a page's words outside links that its articles hold at least, if they are to be its articles.
ARTICLE_SHARE = 0.2

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>|[^>]*(?:>|\Z))",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)
_PART = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str
    words: int
    link_words: int
    boiler: bool
    place: int
    heading: bool


def _says_boiler(word: str) -> bool:
    """Whether a name, all its parts taken together, is one of the listed ones."""
    parts = _PART.findall(word.lower())
    return any(p in _NAMES for p in parts) and all(p in _NAMES or p in _PLAIN for p in parts)


def _named(rest: str, name: str) -> bool:
    """Whether an element's attributes hide it, or say that it isn't main text."""
    if "=" not in rest and "hidden" not in rest.lower():
        return False
    for key, *values in _ATTRIBUTE.findall(rest):
        key, value = key.lower(), "".join(values)
        if key == "hidden" or (key == "aria-hidden" and value.strip().lower() == "true") or (key == "style" and _NO_DISPLAY.search(value)):
            return True
        if name in ("html", "body", "main"):
            continue
        if key in ("class", "id", "role") and any(map(_says_boiler, value.split())):
            return True
        if key == "aria-label" and _says_boiler(value):
            return True
    return False


def blocks(page: str) -> list[Block]:
    """Text blocks in page order."""
    found: list[Block] = []
    stack: list[tuple[str, bool]] = []
    text: list[str] = []
    linked: list[str] = []
    boiler = article = links = 0
    marked = heading = False
    has_article = False

    def flush():
        nonlocal marked, heading
        if text:
            plain = " ".join(html.unescape("".join(text)).split())
            if plain:
                inside = len(html.unescape("".join(linked)).split())
                found.append(Block(plain, plain.count(" ") + 1, inside, boiler > 0 or marked, int(article > 0), heading))
            text.clear()
            linked.clear()
        marked = heading = False

    def put(piece: str):
        text.append(piece)
        if links:
            linked.append(piece)

    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        stop = m.start() if m else size
        if stop > at:
            put(page[at:stop])
        if m is None:
            break
        at = m.end()
        name = m["name"]
        if name is None:
            if m[0].startswith("<![CDATA["):
                put(html.escape(m[0][9:-3] if m[0].endswith("]]>") else m[0][9:]))
            continue
        name, rest = name.lower(), m["rest"]
        if m["close"]:
            if name == "a":
                links = max(0, links - 1)
                if links == 0 and linked:
                    linked.append(" ")
            if name in _BLOCKS:
                flush()
            if name in _CONTAINERS and any(n == name for n, _ in stack):
                while stack:
                    gone, bad = stack.pop()
                    boiler -= bad
                    article -= gone in ("article", "main")
                    if gone == name:
                        break
            continue
        if name in _RAW:
            end = re.compile(f"</{name}(?=[\\s/>]|\\Z)", re.I).search(page, at) if not rest.endswith("/>") else None
            if end is None and rest.endswith("/>"):
                continue
            if end is None and name in _OPEN_ENDED:
                continue
            if end is None:
                break
            close = page.find(">", end.end())
            at = size if close < 0 else close + 1
            continue
        if name == "br":
            put(" ")
            continue
        if name == "a":
            links = 1
        if name in _BLOCKS:
            flush()
            bad = name in _BOILER_TAGS or _named(rest, name)
            if name in _CONTAINERS:
                if name == "body":
                    # The body ends a head that was never closed.
                    while stack and stack[-1][0] == "head":
                        boiler -= stack.pop()[1]
                stack.append((name, bad))
                boiler += bad
                article += name in ("article", "main")
                has_article |= name in ("article", "main") and not boiler
            else:
                marked = bad
                heading = name[0] == "h" and name[1:].isdigit()
                if heading or name in ("p", "li"):
                    links = 0
    flush()
    plain = {place: sum(b.words - b.link_words for b in found if not b.boiler and b.place == place) for place in (0, 1)}
    has_article = has_article and plain[1] >= ARTICLE_SHARE * (plain[0] + plain[1])
    for b in found:
        b.place = 0 if not has_article else 1 if b.place else -1
    return found


FEATURES = ["words", "links", "words_before", "links_before", "words_after", "links_after", "boiler", "place", "heading"]

# The labelled table; columns as FEATURES, then 1 for main text.
LABELLED = [
    # inside an article
    (80, 0.00, 60, 0.0, 70, 0.0, 0, 1, 0, 1), (3, 0.00, 0, 0.0, 60, 0.0, 0, 1, 1, 1), (1, 0.00, 40, 0.0, 30, 0.0, 0, 1, 0, 1),
    (25, 0.10, 9, 0.0, 0, 0.0, 0, 1, 0, 1), (12, 0.40, 50, 0.0, 45, 0.0, 0, 1, 0, 1), (2, 0.00, 0, 0.0, 0, 0.0, 0, 1, 0, 1),
    (6, 0.00, 6, 1.0, 40, 0.0, 0, 1, 0, 1), (5, 0.00, 30, 0.0, 4, 1.0, 0, 1, 1, 1), (300, 0.05, 0, 0.0, 2, 0.5, 0, 1, 0, 1),
    (4, 1.00, 60, 0.0, 55, 0.0, 0, 1, 0, 1), (7, 0.90, 40, 0.1, 30, 0.0, 0, 1, 0, 1), (40, 0.20, 3, 1.0, 3, 1.0, 0, 1, 0, 1),
    (2, 1.00, 2, 1.0, 2, 1.0, 0, 1, 0, 0), (3, 1.00, 40, 0.0, 2, 1.0, 0, 1, 0, 0), (1, 1.00, 2, 1.0, 1, 1.0, 0, 1, 0, 0), (5, 0.95, 3, 1.0, 4, 0.9, 0, 1, 0, 0),
    # inside something that says it isn't main text
    (80, 0.00, 60, 0.0, 70, 0.0, 1, 1, 0, 0), (3, 1.00, 3, 1.0, 3, 1.0, 1, 1, 0, 0), (20, 0.00, 50, 0.0, 50, 0.0, 1, 1, 0, 0),
    (30, 0.00, 40, 0.0, 0, 0.0, 1, 0, 0, 0), (3, 0.00, 0, 0.0, 80, 0.0, 1, 0, 1, 0), (120, 0.10, 5, 0.0, 5, 0.0, 1, 0, 0, 0),
    (9, 0.00, 2, 1.0, 7, 0.0, 1, -1, 0, 0), (15, 0.00, 90, 0.0, 0, 0.0, 1, -1, 0, 0), (2, 1.00, 2, 1.0, 2, 1.0, 1, -1, 0, 0),
    # outside the page's article
    (7, 0.00, 2, 1.0, 5, 0.0, 0, -1, 0, 0), (60, 0.00, 40, 0.0, 0, 0.0, 0, -1, 0, 0), (4, 1.00, 4, 1.0, 4, 1.0, 0, -1, 0, 0), (5, 0.00, 0, 0.0, 90, 0.0, 0, -1, 1, 0),
    # pages without an article
    (70, 0.00, 50, 0.0, 60, 0.0, 0, 0, 0, 1), (40, 0.10, 2, 1.0, 55, 0.0, 0, 0, 0, 1), (25, 0.05, 30, 0.0, 3, 0.9, 0, 0, 0, 1), (11, 0.00, 5, 0.0, 12, 0.0, 0, 0, 0, 1),
    (4, 0.00, 2, 1.0, 60, 0.0, 0, 0, 1, 1), (6, 0.00, 50, 0.0, 45, 0.0, 0, 0, 0, 1), (3, 0.00, 30, 0.0, 25, 0.0, 0, 0, 1, 1), (20, 0.30, 35, 0.0, 40, 0.1, 0, 0, 0, 1),
    (5, 0.00, 0, 0.0, 0, 0.0, 0, 0, 0, 1), (2, 0.00, 0, 0.0, 30, 0.0, 0, 0, 1, 1), (8, 0.00, 6, 0.0, 7, 0.0, 0, 0, 0, 1),
    (2, 1.00, 3, 1.0, 2, 1.0, 0, 0, 0, 0), (6, 0.80, 5, 0.9, 7, 0.8, 0, 0, 0, 0), (15, 0.90, 12, 0.8, 10, 1.0, 0, 0, 0, 0), (3, 1.00, 0, 0.0, 2, 1.0, 0, 0, 0, 0),
    (30, 0.80, 3, 1.0, 4, 1.0, 0, 0, 0, 0), (4, 1.00, 40, 0.0, 3, 1.0, 0, 0, 0, 0), (2, 0.90, 2, 0.9, 50, 0.0, 0, 0, 0, 0),
]

Node = tuple[int, float, "Node", "Node"] | int


def grow_tree(x: np.ndarray, y: np.ndarray, depth: int = 6) -> Node:
    """Binary tree of (feature, threshold, at most, above), by the least mixed halves."""
    if depth == 0 or y.min() == y.max():
        return int(2 * y.sum() >= len(y))
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for t in (values[1:] + values[:-1]) / 2:
            low = x[:, f] <= t
            mixed = sum(side.sum() * (1 - side.mean()) for side in (y[low], y[~low]))
            if best is None or mixed < best[0] - 1e-12:
                best = (mixed, f, float(t))
    if best is None:
        return int(2 * y.sum() >= len(y))
    _, f, t = best
    low = x[:, f] <= t
    return f, t, grow_tree(x[low], y[low], depth - 1), grow_tree(x[~low], y[~low], depth - 1)


@cache
def tree() -> Node:
    table = np.array(LABELLED, dtype=float)
    return grow_tree(table[:, :-1], table[:, -1])


def classify(found: list[Block]) -> list[bool]:
    """Whether each block is main text."""
    shown = [(b.words, min(1.0, b.link_words / b.words)) for b in found]
    around = [(0, 0.0), *shown, (0, 0.0)]
    root, out = tree(), []
    for i, b in enumerate(found):
        row = (*around[i + 1], *around[i], *around[i + 2], b.boiler, b.place, b.heading)
        node = root
        while not isinstance(node, int):
            node = node[2] if row[node[0]] <= node[1] else node[3]
        out.append(bool(node))
    return out


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    return " ".join(b.text for b, good in zip(found, classify(found)) if good)


def extracted(pages: DataFrame, id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every row."""
    share_code(pages.sparkSession)

    def run(batches):
        for batch in batches:
            texts = [main_text(x) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=["page_id", "url", "text", "n_chars"]
            )

    rows = pages.select(F.col(id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(page).cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
