"""Main text of web pages by consensus paths of hosts.

1. The text of a page's blocks, less its links, is the score of every container around them. An article
   or main element with most of the score wins; else the smallest container that holds nearly all of it, widened while
   only paragraphs and headings are added, so an article spread over sibling containers stays whole. The page votes for its generalised path (tags and
   classes, digits and ids left out).
2. Votes are counted per host in Spark. Paths with ``LEAST_SHARE`` of a host's pages win, the one with
   most votes first.
3. Each page is extracted again by the first winning path that holds at least ``COVERED`` of its score; a page
   without any falls back to its own best container, and one without containers to its whole body.

Menus, headers, footers, sidebars, forms, scripts and styles are told by tag and role. Words of class and id
only mark a part: what it holds decides. A marked part goes unless it is a wrapper (it has the
heading or the article, and most of the text); a part with a weaker mark goes if it is mostly links or if it is
a small part outside the article.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.frames import free, with_columns
from starloom.session import materialise

LEAST_SHARE = 0.1
#: Share of a page's score that a host's path must hold on it.
COVERED = 0.5
#: Share of the score that the container of an article without an element of its own holds.
NEARLY_ALL = 0.95
#: Shares of a page's text: a wrapper has at least the first, a small part less than the second.
WRAPPER, SMALL = 0.5, 0.25
#: A part is mostly links from this share of its text on.
MOSTLY_LINKS = 0.5

RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp"}
VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
DROPPED = {"head", "nav", "footer", "aside", "form", "button", "select", "svg", "dialog", "menu", "object", "canvas", "math"}
BLOCKS = {
    "html", "body", "main", "article", "section", "div", "header", "footer", "nav", "aside", "form", "p", "h1", "h2", "h3",
    "h4", "h5", "h6", "ul", "ol", "li", "dl", "dt", "dd", "table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption",
    "blockquote", "pre", "figure", "figcaption", "address", "details", "summary", "fieldset", "hr", "center", "hgroup", "menu",
    "dialog",
}
CONTAINERS = {"body", "main", "article", "section", "div", "td", "center"}
#: Words of class and id that mark a part as something else than the article.
MARKS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "sponsor", "sponsored", "promo", "promotion",
    "cookie", "cookies", "consent", "gdpr", "popup", "modal", "newsletter", "subscribe", "subscription", "signup", "login",
    "paywall", "sidebar", "sidenav", "aside", "widget", "widgets", "menu", "nav", "navbar", "navigation", "breadcrumb",
    "breadcrumbs", "footer", "masthead", "topbar", "comment", "comments", "commentlist", "disqus", "reply", "replies", "respond",
    "share", "sharing", "social", "related", "recommended", "recommendations", "pagination", "pager", "toolbar", "skip",
}
#: Words that as often stand on parts of the article.
WEAK_MARKS = {
    "banner", "notice", "notices", "notification", "alert", "overlay", "register", "header", "copyright", "search", "toc", "legal",
    "disclaimer",
}
#: Tags of text: a mark must be a whole class to count for them as more than a weak one.
TEXT_TAGS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "figure", "figcaption", "blockquote", "pre", "caption", "address"}
HEADINGS = {"h1": 100, "h2": 50, "h3": 30}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z][\w:-]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true")
_WORDS = re.compile(r"[a-z]+")
_DIGITS = re.compile(r"\d+")


@dataclass(eq=False)
class Node:
    tag: str
    path: str
    parent: Node | None
    dropped: bool
    inside: bool  # an article or main
    number: int
    mark: int = 0  # 1 for a weak mark, 2 for a strong one
    holds: bool = False  # the heading, an article or main
    size: int = 0  # characters of text below, and those in links
    linked: int = 0
    score: float = 0.0


@dataclass(eq=False)
class Block:
    node: Node
    text: str
    linked: int


@dataclass
class Page:
    blocks: list[Block] = field(default_factory=list)
    score: float = 0.0


def _above(node: Node | None) -> Iterator[Node]:
    """The node and its ancestors, without the root."""
    while node is not None and node.tag:
        yield node
        node = node.parent


def _is_dropped(tag: str, attributes: str, inside: bool) -> bool:
    if tag in DROPPED or (tag == "header" and not inside):
        return True
    if tag in ("html", "body") or not attributes.strip(" /"):
        return False
    if _HIDDEN.search(attributes):
        return True
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        value = (a or b or c).lower()
        name = name.lower()
        if name == "role" and value.strip() in ROLES:
            return True
        if name == "class" and tag == "article" and not {"comment", "reply", "ad", "advert"}.isdisjoint(_WORDS.findall(value)):
            return True
    return False


def _mark(tag: str, attributes: str) -> int:
    """2 for a class or id with a word of ``MARKS``, 1 for a weak mark, else 0."""
    if tag in ("html", "body", "main", "article") or not attributes.strip(" /"):
        return 0
    mark = 0
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        if name.lower() not in ("class", "id"):
            continue
        value = (a or b or c).lower()
        words = _WORDS.findall(value)
        if not MARKS.isdisjoint(words):
            whole = tag not in TEXT_TAGS or not MARKS.isdisjoint(value.split())
            mark = max(mark, 2 if whole else 1)
        elif not WEAK_MARKS.isdisjoint(words):
            mark = max(mark, 1)
    return mark


def _step(tag: str, attributes: str) -> str:
    if not attributes.strip(" /"):
        return tag
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        if name.lower() == "class":
            words = sorted({_DIGITS.sub("#", w) for w in (a or b or c).lower().split()})
            return ".".join([tag, *words])
    return tag


def parse(html: str) -> Page:
    """The blocks of a page in order, with the nodes they stand in."""
    page = Page()
    root = Node("", "", None, False, False, 0)
    stack, text, linked, links, numbers = [root], [], 0, 0, 0
    inline: list[str] = []

    def flush() -> None:
        nonlocal linked
        if text:
            joined = " ".join(unescape("".join(text)).split())
            if joined and not stack[-1].dropped:
                page.blocks.append(Block(stack[-1], joined, min(linked, len(joined))))
            text.clear()
        linked = 0

    at = 0
    length = len(html)
    while at < length:
        match = _TOKEN.search(html, at)
        if match is None:
            text.append(html[at:])
            break
        if match.start() > at:
            piece = html[at : match.start()]
            text.append(piece)
            if links:
                linked += len(piece)
        at = match.end()
        tag = match.group(2)
        if tag is None:
            continue
        tag = tag.lower()
        closing, attributes = match.group(1), match.group(3)
        if tag in RAW and not closing:
            end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(html, at)
            at = end.end() if end else length
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag == "a":
            links = 0 if closing else 1
        special = tag in BLOCKS or tag in DROPPED
        if not special:
            # Inline parts only matter if they are dropped.
            if closing or tag in VOID:
                if closing and inline and inline[-1] == tag and stack[-1].tag == tag:
                    text.clear()
                    inline.pop()
                    stack.pop()
                continue
            if attributes and not attributes.endswith("/") and (
                _is_dropped(tag, attributes, True) or _mark(tag, attributes) == 2
            ):
                flush()
                inline.append(tag)
                numbers += 1
                stack.append(Node(tag, stack[-1].path, stack[-1], True, stack[-1].inside, numbers))
            continue
        flush()
        if closing:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if stack[i].tag in ("article", "main", "body") and tag in ("p", "li"):
                    break
            continue
        if tag in VOID or attributes.endswith("/") and tag in ("hr",):
            continue
        while stack[-1].tag == "p" or (tag == "li" and stack[-1].tag == "li") or (
            tag in ("td", "th", "tr") and stack[-1].tag in ("td", "th") and tag != "table"
        ) or (tag == "tr" and stack[-1].tag == "tr") or (tag in ("dt", "dd") and stack[-1].tag in ("dt", "dd")):
            stack.pop()
        top = stack[-1]
        numbers += 1
        stack.append(
            Node(
                tag,
                f"{top.path}>{_step(tag, attributes)}",
                top,
                top.dropped or _is_dropped(tag, attributes, top.inside),
                top.inside or tag in ("article", "main"),
                numbers,
                _mark(tag, attributes),
            )
        )
        if tag in ("h1", "article", "main") and not stack[-1].dropped:
            for node in _above(top):
                if node.holds:
                    break
                node.holds = True
    flush()
    return _judged(page)


def _judged(page: Page) -> Page:
    """The page without the blocks of marked parts that hold something else than the article; nodes scored."""
    total = sum(len(b.text) for b in page.blocks)
    marked = [(block, [n for n in _above(block.node) if n.mark]) for block in page.blocks]
    for block, nodes in marked:
        for node in nodes:
            node.size += len(block.text)
            node.linked += block.linked

    def other(node: Node) -> bool:
        if node.holds and node.size >= WRAPPER * total:
            return False
        if node.mark == 2 or node.linked >= MOSTLY_LINKS * node.size:
            return True
        return not node.inside and node.size < SMALL * total

    page.blocks = [block for block, nodes in marked if not any(map(other, nodes))]
    for block in page.blocks:
        text = len(block.text) - 2 * block.linked + 20 * block.text.count(",")
        own = max(text, 0) + (HEADINGS.get(block.node.tag, 0) if text > 0 else 0)
        page.score += own
        for node in _above(block.node):
            node.score += own
    return page


def best_path(page: Page) -> str | None:
    """The path of the element that holds the article; None for a page without a score."""
    nodes = {n.number: n for block in page.blocks for n in _above(block.node)}
    own: dict[str, float] = {}
    for node in nodes.values():  # outermost articles, those of one path together
        if node.tag in ("article", "main") and not (node.parent and node.parent.inside):
            own[node.path] = own.get(node.path, 0.0) + node.score
    if page.score <= 0:
        return None
    best = min(own, key=lambda p: (-own[p], p), default=None)
    if best is not None and own[best] >= COVERED * page.score:
        return best
    whole = [n for n in nodes.values() if n.tag in CONTAINERS and n.score >= NEARLY_ALL * page.score]
    # Each of them holds the article, so they stand inside each other: the last one opened is the smallest.
    return _widened(page, max(whole, key=lambda n: n.number)).path if whole else None


def _widened(page: Page, node: Node) -> Node:
    """The widest part around the node, short of the body, that adds nothing but paragraphs and headings, such as a lead."""
    for wider in _above(node.parent):
        if wider.tag in ("html", "body"):
            break
        more = [b for b in page.blocks if wider in _above(b.node) and node not in _above(b.node)]
        if any(b.node.tag not in TEXT_TAGS or b.linked >= MOSTLY_LINKS * len(b.text) for b in more):
            break
        if more:
            node = wider
    return node


def _at(page: Page, path: str) -> tuple[list[str], float]:
    """The blocks inside the nodes of a path, and their share of the page's score."""
    found, score = [], {}
    for block in page.blocks:
        for node in _above(block.node):
            if node.path == path:
                found.append(block.text)
                score[node.number] = node.score
                break
    return found, sum(score.values()) / page.score if page.score > 0 else 1.0


def main_text(page: Page, paths: list[str]) -> str:
    """The text at the first of the paths that holds enough of the page, at its own best path, or of its body."""
    for path in paths:
        found, share = _at(page, path)
        if found and share >= COVERED:
            return "\n".join(found)
    path = best_path(page)
    found = _at(page, path)[0] if path else []
    return "\n".join(found or [b.text for b in page.blocks])


def host_of(url):
    """The host of a URL in lower case, or the empty text."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1)), F.lit(""))


def _row_key(url: str, html: str):
    """A hash that spreads the pages of a host; equal for equal pages only, but for collisions of 64 bits."""
    return F.xxhash64(F.col(url), F.col(html))


def page_votes(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """host, key and best path of every page, written."""
    own = pages.select(host_of(F.col(url)).alias("host"), _row_key(url, html).alias("key"), F.col(html).alias("html"))

    def make(batch: pa.RecordBatch) -> list:
        return [pa.array([best_path(parse(h)) if h else None for h in batch.column("html").to_pylist()], pa.string())]

    return materialise(
        with_columns(own, "html", [T.StructField("path", T.StringType())], make, ["host", "key"]), "votes"
    )


def host_paths(votes: DataFrame, least_share: float = LEAST_SHARE) -> DataFrame:
    """host and its winning ``paths``; at most 1 / ``least_share`` of them."""
    counted = votes.where("path is not null").groupBy("host", "path").agg(F.count("*").alias("votes"))
    totals = counted.groupBy("host").agg(F.sum("votes").alias("pages"))
    winners = counted.join(totals, "host").where(F.col("votes") >= least_share * F.col("pages"))
    ranked = winners.groupBy("host").agg(F.sort_array(F.collect_list(F.struct((-F.col("votes")).alias("n"), "path"))).alias("r"))
    return ranked.select("host", F.col("r.path").alias("paths"))


def extract(
    pages: DataFrame, url: str = "url", html: str = "html", out: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``pages`` with the main text of the whole html.

    Null and empty html give an empty text; a null URL counts as a host of its own. Repeated rows
    vote and are kept like any others, an empty table stays empty, and a column named ``out`` is
    replaced. A very long page is parsed whole, in time linear in its length.
    """
    names = pages.columns if keep is None else keep
    votes = page_votes(pages, url, html)
    # Paths reach the pages by the key of the page: narrow rows are joined by host, and the html
    # of a host with very many pages is spread.
    narrow = votes.select("host", "key").distinct().join(host_paths(votes), "host")
    of, of_key, paths = (free(name, pages.columns) for name in ("of", "of_key", "paths"))
    of_page = narrow.select(F.col("host").alias(of), F.col("key").alias(of_key), F.col("paths").alias(paths))
    same = (_row_key(url, html) == F.col(of_key)) & (host_of(F.col(url)) == F.col(of))
    joined = pages.join(of_page, same, "left")

    def make(batch: pa.RecordBatch) -> list:
        rows = zip(batch.column(html).to_pylist(), batch.column(paths).to_pylist())
        return [pa.array([main_text(parse(h), own or []) if h else "" for h, own in rows], pa.string())]

    return with_columns(joined, html, [T.StructField(out, T.StringType())], make, names, uses=(paths,))
