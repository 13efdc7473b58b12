"""Main text of web pages by tree scoring.

A page is read into a tree with HTML's own rules for omitted end tags. Elements that hold no article (scripts, menus,
forms, adverts, notices, comments, by tag, role, or a word of class or id) are cut. What may also be wrapped around a whole page
(a form, an aside, a dialog, a role of these, what is hidden until scripts run) stays if it holds most of the paragraphs'
points, and an article, main or h1 element if the page has any. A class or id cuts nothing that holds an
article, main or h1 element or, on pages without these, most of the paragraphs' points: it halves the points then. Each paragraph gives points for its
length and commas to its parent, half of them to the next ancestor and a third part less to each further one; an element's
points are discounted by its link density. The element of most points, or the article element around it, is the container;
siblings with a fair share of its points, and sentences among them, are kept with it.

Text is decoded, white space inside a block becomes one space, blocks are trimmed and joined by a newline in page order.
Null or empty html, or a page without text: the empty text. Broken markup is read as far as it goes: an end tag without a
start is dropped, a tag that never ends is text, open elements end with their parent. Where no element gets points, the
article, main or body element is the container. A row a page, repeated rows included; a null page_id or url stays null;
an empty table gives no rows; other columns are ignored. Nothing grows with anything but the page at hand.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>|[^<]+|<""",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript textarea title template iframe noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td"
    " tfoot th thead tr ul".split()
)
#: What a start tag ends, if it is open, and the elements that this doesn't reach beyond.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
        "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
for _group in ("thead", "tbody", "tfoot"):
    ENDS[_group] = ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"})
P_SCOPE = frozenset("button table td th caption".split())

CUT_TAGS = RAW | frozenset("head nav footer button select option input menu svg canvas object embed audio video map".split())
CUT_ROLES = frozenset("navigation banner contentinfo menu menubar toolbar".split())
#: What may be wrapped around a whole page.
WRAP_TAGS = frozenset("aside form dialog search".split())
WRAP_ROLES = frozenset("complementary search dialog alertdialog alert form note status".split())
CUT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies"
    " discussion disqus footer form gdpr header hidden login masthead menu modal nav navbar navigation newsletter notice notices notification overlay pager"
    " pagination paywall popup promo promoted promotion recommended related replies reply respond search share sharing sidebar sidebars"
    " signup skip social sponsor sponsored subscribe subscription toolbar tooltip topbar toast warning widget widgets".split()
)
KEEP_TAGS = frozenset("html body article main h1 h2 h3 h4 h5 h6 p".split())
PARAGRAPHS = frozenset("p pre td blockquote dd".split())
TAG_POINTS = {"article": 10, "main": 8, "section": 3, "div": 5, "blockquote": 3, "pre": 3, "td": 3, "ol": -3, "ul": -3, "dl": -3, "li": -3, "address": -3, "th": -5}
GOOD_WORDS = frozenset("article blog body content entry main page post story text".split())
LEAST_LENGTH = 25


class Node:
    __slots__ = ("tag", "parent", "children", "words", "role", "hidden", "points", "links", "length")

    def __init__(self, tag: str, parent: Node | None, attributes: str = ""):
        self.tag, self.parent, self.children = tag, parent, []
        self.words, self.role, self.hidden = (), "", False
        self.points, self.links, self.length = 0.0, 0, 0
        if attributes:
            found: dict[str, str] = {}
            for name, value in ATTRIBUTE.findall(attributes):
                found.setdefault(name.lower(), html.unescape(value.strip("\"'")))
            named = f"{found.get('class', '')} {found.get('id', '')}"
            self.words = tuple(re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", named).lower()))
            self.role = found.get("role", "").lower().strip()
            style = found.get("style", "").replace(" ", "").lower()
            self.hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in style or "visibility:hidden" in style


def parse(page: str) -> Node:
    root = at = Node("html", None)
    pos, end, lower = 0, len(page), None
    while pos < end:
        m = TOKEN.match(page, pos)
        pos = m.end()
        tag = m[2] or m[5]
        if tag is None:
            if m[0][0] != "<" or m[0] == "<":
                at.children.append(m[0])
            continue
        tag, closing, attributes = tag.lower(), m[1] or m[4], (m[3] if m[2] else m[6]) or ""
        if closing:
            node = at
            while node is not None and node.tag != tag:
                node = None if node.tag in P_SCOPE and tag in ("p", "li", "dt", "dd") else node.parent
            if node is not None and node.parent is not None:
                at = node.parent
            continue
        if tag == "html":
            continue
        if tag in BLOCK:  # an open paragraph ends where a block starts
            node = at
            while node is not None and node.tag != "p" and node.tag not in P_SCOPE and node.tag not in BLOCK:
                node = node.parent
            if node is not None and node.tag == "p":
                at = node.parent
        if tag in ENDS:
            ended, within = ENDS[tag]
            node, last = at, None
            while node is not None and node.tag not in within:
                last = node if node.tag in ended else last
                node = node.parent
            at = last.parent if last is not None else at
        node = Node(tag, at, attributes)
        at.children.append(node)
        if tag in RAW:
            lower = lower if lower is not None else page.lower()
            stop = lower.find("</" + tag, pos)
            if stop < 0:
                pos = end
            else:
                close = page.find(">", stop)
                pos = end if close < 0 else close + 1
        elif tag not in VOID and not attributes.endswith("/"):
            at = node
        elif tag not in VOID and tag in BLOCK:
            at = node  # a slash means nothing on a block
    return root


def in_article(node: Node) -> bool:
    up = node.parent
    while up is not None:
        if up.tag in ("article", "main"):
            return True
        up = up.parent
    return False


def unwanted(node: Node) -> bool:
    if node.tag in CUT_TAGS or node.role in CUT_ROLES:
        return True
    if node.tag == "header":
        return not in_article(node)
    return node.tag == "article" and any(w in ("comment", "comments", "reply") for w in node.words)


def wrapping(node: Node) -> bool:
    return node.hidden or node.tag in WRAP_TAGS or node.role in WRAP_ROLES


def named_unwanted(node: Node) -> bool:
    return node.tag not in KEEP_TAGS and any(w in CUT_WORDS for w in node.words)


def without(root: Node, refused: Callable[[Node], bool]) -> None:
    todo = [root]
    while todo:
        node = todo.pop()
        node.children = [c for c in node.children if isinstance(c, str) or not refused(c)]
        todo.extend(c for c in node.children if not isinstance(c, str))


def weighed(nodes: list[Node]) -> tuple[dict[Node, float], dict[Node, int]]:
    """The paragraphs' points in each element, and how many article, main and h1 elements."""
    measure(nodes)
    points: dict[Node, float] = {}
    heads: dict[Node, int] = {}
    for node in reversed(nodes):
        inner = [c for c in node.children if not isinstance(c, str)]
        own = 1 + min(node.length / 100, 3.0) if is_paragraph(node) else 0.0
        points[node] = max(own, sum(points[c] for c in inner))
        heads[node] = sum(heads[c] + (c.tag in ("article", "main", "h1")) for c in inner)
    return points, heads


def cut(root: Node) -> None:
    """By tag and role; then what wraps less than most of the page; then, by name, what holds neither an article nor most of it."""
    without(root, unwanted)
    nodes = in_order(root)
    if any(wrapping(node) for node in nodes):
        points, heads = weighed(nodes)
        whole = lambda node: 2 * points[node] > points[root] and (heads[node] + (node.tag in ("article", "main", "h1")) > 0 or not heads[root])
        without(root, lambda node: wrapping(node) and not whole(node))
        nodes = in_order(root)
    if not any(named_unwanted(node) for node in nodes):
        return
    points, heads = weighed(nodes)
    without(root, lambda node: named_unwanted(node) and not heads[node] and (heads[root] > 0 or 2 * points[node] <= points[root]))


def in_order(root: Node) -> list[Node]:
    """All elements, each before what it holds."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo.extend(c for c in reversed(node.children) if not isinstance(c, str))
    return out


def blocks(top: list[Node]) -> list[str]:
    out: list[str] = []
    run: list[str] = []

    def closed() -> None:
        text = " ".join(html.unescape("".join(run)).split())
        run.clear()
        if text:
            out.append(text)

    todo: list = list(reversed(top))
    while todo:
        node = todo.pop()
        if node is None:
            closed()
        elif isinstance(node, str):
            run.append(node)
        elif node.tag == "br":
            run.append("\n")
        elif node.tag in BLOCK:
            closed()
            todo.append(None)
            todo.extend(reversed(node.children))
        else:
            todo.extend(reversed(node.children))
    closed()
    return out


def is_paragraph(node: Node) -> bool:
    """It has text of its own, and enough of it (after ``measure``)."""
    holds_blocks = any(not isinstance(c, str) and c.tag in BLOCK for c in node.children)
    own = node.tag in PARAGRAPHS or (node.tag in ("div", "section", "article", "main") and not holds_blocks)
    return own and node.parent is not None and node.length >= LEAST_LENGTH


def measure(nodes: list[Node]) -> None:
    """Length of text and of linked text in each element."""
    for node in reversed(nodes):
        own = sum(len(" ".join(html.unescape(c).split())) for c in node.children if isinstance(c, str))
        parts = [c for c in node.children if not isinstance(c, str)]
        node.length = own + sum(c.length for c in parts)
        node.links = node.length if node.tag == "a" else sum(c.links for c in parts)


def main_nodes(root: Node) -> list[Node]:
    nodes = in_order(root)
    measure(nodes)
    for node in nodes:
        if not is_paragraph(node):
            continue
        text = " ".join(blocks([node]))
        points = 1 + text.count(",") + min(len(text) / 100, 3.0)
        up, level = node.parent if node.tag in PARAGRAPHS else node, 0
        while up is not None:
            up.points += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
            up, level = up.parent, level + 1
    best, most = None, 0.0
    for node in nodes:
        if node.points > 0:
            node.points += TAG_POINTS.get(node.tag, 0) + (5 if any(w in GOOD_WORDS for w in node.words) else 0)
            node.points *= (1 - node.links / max(1, node.length)) * (0.5 if named_unwanted(node) else 1)
            if node.points > most:
                best, most = node, node.points
    if best is None:
        for tag in ("article", "main", "body"):
            for node in nodes:
                if node.tag == tag and node.length:
                    return [node]
        return [root]
    up = best
    while up is not None and up.tag not in ("article", "main"):
        up = up.parent
    best = up or best
    if best.parent is None or best.tag in ("article", "main", "body"):
        return [best]
    kept = []
    for c in best.parent.children:
        if c is best:
            kept.append(c)
        elif not isinstance(c, str):
            density = c.links / max(1, c.length)
            sentence = c.tag == "p" and (c.length > 80 and density < 0.25 or (0 < c.length <= 80 and not c.links and re.search(r"[.!?](\s|$)", " ".join(blocks([c])))))
            if c.points >= max(10, 0.2 * most) or sentence or c.tag == "h1":
                kept.append(c)
    return kept


def extract(page: str | None) -> str:
    if not page:
        return ""
    root = parse(page)
    cut(root)
    return "\n".join(blocks(main_nodes(root)))


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages`` (page_id, url, html)."""

    @F.pandas_udf("string")
    def text_of(page: pd.Series) -> pd.Series:
        return page.map(extract)

    rows = pages.select("page_id", "url", text_of(F.coalesce("html", F.lit(""))).alias("text"))
    return rows.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
