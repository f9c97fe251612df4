"""The main text of web pages by minimum-cut labelling of their blocks.

A page is read into blocks, runs of text between block elements. Each block has a score, the
log odds of content against boilerplate: a moderate prior from signs on its ancestors
(elements, roles, words of classes and ids) and the evidence of its text (length, links,
punctuation); scores become terminal capacities. Blocks that follow each other are joined by
smoothness edges, the stronger the fewer elements lie between them, and so are blocks with
the same parent. The minimum cut, found by maximum flow, is the cheapest labelling of all
blocks together, so a block whose own signs are weak goes with those around it.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from lakestay.llm.batches import prepare, slices
from lakestay.llm.max_flow import minimum_cut

# A tag with its attributes, a comment, or other markup. Runs are possessive: no text, however
# broken, is read twice.
_MARKUP = re.compile(
    r"""<!--.*?(?:--!?>|\Z)
    |<(/?)([a-zA-Z][^\s/>]*+)
      ((?:[\s/]++|[^\s/>=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)?+)?+|=)*+)(?:>|\Z)
    |<[!?/][^>]*+(?:>|\Z)""",
    re.S | re.X,
)
_ATTRIBUTE = re.compile(
    r"""(?<![^\s"'/])(class|id|role)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""", re.I
)
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

# Elements whose whole content is no text of the page.
_RAW = {
    "script", "style", "title", "textarea", "noscript", "iframe", "noembed", "noframes", "xmp", "template",
}
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in _RAW}
_VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr",
}
_BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir",
    "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "frameset", "h1", "h2", "h3", "h4",
    "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "optgroup",
    "option", "p", "pre", "search", "section", "select", "summary", "table", "tbody", "td", "tfoot", "th", "thead",
    "tr", "ul",
}
# Start tags that end an open element of these names, up to the nearest holder.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_ENDS_P = _BLOCKS - {"body", "html", "head", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "optgroup"}

# Zones of the page. Nothing leads out of FIRM; an article or main element leads out of SOFT.
NEUTRAL, LIKELY, CONTENT, SOFT, FIRM = range(5)
_FIRM_TAGS = {
    "nav", "aside", "footer", "menu", "dialog", "select", "button", "svg", "object", "canvas", "audio", "video",
    "datalist", "search", "applet", "map",
}
_FIRM_ROLES = {
    "navigation", "contentinfo", "complementary", "search", "alert", "alertdialog", "dialog", "menu", "menubar",
    "toolbar", "tablist", "status",
}
_COMMENT_WORDS = {"comment", "comments", "commentlist", "respond", "disqus"}
# Words of readers' comments or of a part of the article: comments if several entries of users are inside.
_DOUBTFUL_WORDS = {"discussion", "reply", "replies", "review", "reviews"}
_ENTRY_WORDS = {
    "reply", "review", "user", "username", "author", "avatar", "commenter", "reviewer", "vote", "votes", "rating", "stars",
}
_LEAST_ENTRIES = 2
_SOFT_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "sponsor", "sponsored", "sponsors",
    "promo", "promoted", "promotion", "promotions", "banner", "cookie", "cookies", "consent", "gdpr", "notice",
    "notices", "notification", "notifications", "alert", "warning", "sidebar", "sidenav", "menu", "menus", "nav",
    "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer", "masthead", "topbar", "toolbar", "share",
    "sharing", "social", "related", "recommended", "recommendations", "trending", "newsletter", "subscribe",
    "subscription", "signup", "signin", "login", "popup", "modal", "overlay", "widget", "widgets", "pagination",
    "pager", "search", "copyright", "tags", "tagcloud", "paywall", "form",
}
_GOOD_WORDS = {"article", "post", "entry", "story", "content", "maincontent", "main"}
# Names that begin with one of these are of a subject or kind, not of a place on the page.
_SUBJECT = re.compile(r"(?:tag|category|cat|type|status|format|topic|lang)[-_]")
# A name with one of these is of a frame around several parts, and says nothing of its text.
_FRAME_WORDS = {"with", "has", "no", "layout", "wrap", "wrapper", "container", "page", "site", "body", "row", "grid"}
# Ids that stand for the main part wherever they are.
_MAIN_IDS = {"main", "content", "main-content", "maincontent", "article", "post", "story", "primary"}
_NEVER_NAMED = {"html", "body", "head", "main", "article"}
_LEGAL = re.compile(r"©|\bcopyright\b|all rights reserved|\bcookies?\b|privacy policy|terms of (?:use|service)", re.I)
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}


class Block(NamedTuple):
    text: str
    zone: int
    tag: str  # the nearest block element
    parent: int  # a number of the element around that
    links: float  # share of the text in links
    depth: int = 0  # of the nearest block element
    lowest: int = 0  # depth of the deepest element around this block and the one before it
    doubt: int = 0  # number of the element around that may hold readers' comments


class _Open(NamedTuple):
    tag: str
    zone: int
    number: int
    doubt: int = 0


def _zone(tag: str, attributes: str, around: int) -> tuple[int, set[str]]:
    """The zone inside an element, from its own signs and the zone around it, and the words of its names."""
    if around == FIRM or tag in _FIRM_TAGS:
        return FIRM, set()
    names: set[str] = set()
    role, main_id = "", False
    alone: set[str] = set()  # names of a single word
    if attributes and "=" in attributes:
        for m in _ATTRIBUTE.finditer(attributes):
            value = m[2] or m[3] or m[4] or ""
            if m[1].lower() == "role":
                role = value.strip().lower()
                continue
            main_id |= m[1].lower() == "id" and value.strip().lower() in _MAIN_IDS
            for name in value.split():
                words = {w.lower() for w in _NAME_WORD.findall(name)}
                if not words & _FRAME_WORDS and not _SUBJECT.match(name.lower()):
                    names |= words
                    alone |= words if len(words) == 1 else set()
    return _zone_of(tag, role, main_id, names, alone, around), names


def _zone_of(tag: str, role: str, main_id: bool, names: set[str], alone: set[str], around: int) -> int:
    if role in _FIRM_ROLES or (names & _COMMENT_WORDS and tag not in ("html", "body", "main")):
        return FIRM
    if tag in ("article", "main") or role in ("main", "article"):
        return CONTENT
    if tag == "form":
        return SOFT
    if tag in _NEVER_NAMED:
        return around
    if main_id and around != CONTENT:
        return LIKELY
    # A whole name such as "entry" outweighs a word within another name of the same element.
    if (alone if alone & _GOOD_WORDS else names) & _SOFT_WORDS:
        return SOFT
    if around != CONTENT and (tag == "header" or role == "banner" or "header" in names):
        return SOFT
    if around == NEUTRAL and names & _GOOD_WORDS:
        return LIKELY
    return around


def read_blocks(page: str) -> list[Block]:
    """The blocks of a page in order, white space made single, empty ones left out."""
    blocks: list[Block] = []
    stack = [_Open("", NEUTRAL, 0)]
    numbers = 0
    links = 0  # open links
    parts: list[str] = []
    linked = 0
    lowest = 0
    entries: dict[int, int] = {}  # of users, by the element in doubt
    at, size = 0, len(page)

    def end_block():
        nonlocal parts, linked, lowest
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                k = len(stack) - 1
                while k > 0 and stack[k].tag not in _BLOCKS:
                    k -= 1
                parent = stack[max(k - 1, 0)].number
                share = min(1.0, linked / len(text))
                blocks.append(
                    Block(text, stack[-1].zone, stack[k].tag, parent, share, k, min(lowest, k), stack[-1].doubt)
                )
                lowest = k
            parts, linked = [], 0

    def add(text: str):
        nonlocal linked
        if text:
            parts.append(text)
            if links:
                linked += len(text.strip())

    def close(k: int):
        nonlocal links, lowest
        lowest = min(lowest, k - 1)
        links -= sum(x.tag == "a" for x in stack[k:])
        del stack[k:]

    while at < size:
        begin = page.find("<", at)
        if begin < 0:
            add(page[at:])
            break
        m = _MARKUP.match(page, begin)
        if m is None:  # a sign of the text
            add(page[at : begin + 1])
            at = begin + 1
            continue
        add(page[at:begin])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            k = len(stack) - 1
            while k > 0 and stack[k].tag != tag:
                k -= 1
            if tag in _BLOCKS or (k > 0 and any(x.tag in _BLOCKS for x in stack[k:])):
                # An inline end tag does not reach over an open block.
                if tag not in _BLOCKS:
                    continue
                end_block()
            if k > 0:
                if stack[k].zone != stack[k - 1].zone:
                    end_block()
                close(k)
            continue
        if tag in _RAW:
            end = _RAW_END[tag].search(page, at)
            at = size if end is None else end.start()
            continue
        if tag == "br":
            add(" ")
            continue
        if tag in _BLOCKS:
            end_block()
            if tag in _ENDS_P:
                _end_open(stack, {"p"}, {"button", "td", "th", "caption", "table", "object"}, close)
            if tag in _CLOSES:
                _end_open(stack, *_CLOSES[tag], close)
        if tag in _VOID:
            continue
        zone, names = _zone(tag, m[3], stack[-1].zone)
        if zone != stack[-1].zone:
            end_block()
        numbers += 1
        doubt = stack[-1].doubt
        if doubt:
            entries[doubt] += bool(names & _ENTRY_WORDS)
        elif zone < SOFT and tag in _BLOCKS and tag not in _NEVER_NAMED and names & _DOUBTFUL_WORDS:
            end_block()
            doubt = numbers
            entries[doubt] = 0
        stack.append(_Open(tag, zone, numbers, doubt))
        links += tag == "a"
    end_block()
    return [b._replace(zone=FIRM) if entries.get(b.doubt, 0) >= _LEAST_ENTRIES else b for b in blocks]


def _end_open(stack: list[_Open], names: set[str], holders: set[str], close) -> None:
    """Close the innermost open element of these names, if no holder is nearer."""
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag in names:
            close(k)
            return
        if stack[k].tag in holders:
            return


# Hundredths of the log odds of each zone: neutral, likely, content, soft, firm; without an
# article or main element a page's other parts are its text.
_PRIORS = {True: (-250, 0, 400, -300, -450), False: (0, 150, 400, -300, -450)}


def block_score(block: Block, has_article: bool) -> int:
    """Hundredths of the log odds that a block is content."""
    text, n = block.text, len(block.text)
    score = min(n, 300) // 3 - 40 - int(300 * block.links)
    score += 60 if text[-1] in ".!?…。！？\"”»" and n > 20 else 0
    score += 30 if block.tag in _HEADINGS else -30 if block.tag in ("li", "td", "th", "dt") else 0
    score -= 0 if any(c.isalpha() for c in text) else 60
    score -= 150 if n < 400 and _LEGAL.search(text) else 0
    return _PRIORS[has_article][block.zone] + score


# Costs of a cut between two blocks: next to each other with two elements between them (as two
# paragraphs have), and with the same parent; beyond the border of a zone a share of it.
_NEXT, _SIBLING, _BORDER_SHARE = 60, 40, 6
# What is added to the scores of plain text where a page would have no content otherwise.
_LAST_RESORT = 100


def smoothness(blocks: list[Block]) -> list[tuple[int, int, int]]:
    """The edges between blocks and what cutting them costs."""
    edges: list[tuple[int, int, int]] = []
    last_of: dict[int, int] = {}

    def join(i: int, j: int, weight: int):
        weight = weight if blocks[i].zone == blocks[j].zone else weight // _BORDER_SHARE
        if weight:
            edges.append((i, j, weight))

    for i, b in enumerate(blocks):
        if i:
            steps = blocks[i - 1].depth + b.depth - 2 * b.lowest
            join(i - 1, i, 2 * _NEXT // max(steps, 2))
        if b.parent in last_of:
            join(last_of[b.parent], i, _SIBLING)
        last_of[b.parent] = i
    return edges


def label(blocks: list[Block]) -> list[bool]:
    """Which blocks are content, by the minimum cut.

    A page without any content is cut once more, with the odds of blocks outside of menus,
    notices and the like that are not mostly links raised: some of its plain text is its text.
    """
    has_article = sum(len(b.text) for b in blocks if b.zone == CONTENT) > 0
    scores, edges = [block_score(b, has_article) for b in blocks], smoothness(blocks)
    found = minimum_cut(scores, edges)
    if any(found):
        return found
    plain = [b.zone < SOFT and b.links < 0.5 for b in blocks]
    return minimum_cut([s + _LAST_RESORT * p for s, p in zip(scores, plain)], edges)


def main_text(page: str | None) -> str:
    """The content blocks of a page, one to a line; empty for an empty page."""
    blocks = read_blocks(page or "")
    return "\n".join(b.text for b, keep in zip(blocks, label(blocks)) if keep)


def extract(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row, from its whole html.

    A null or empty page has the empty text; null ids and urls and repeated rows are kept;
    other columns are not read. Pages are worked on where they are read, without a shuffle.
    """
    prepare(pages.sparkSession)
    schema = pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            texts = [main_text(h.as_py()) for h in part.column("html")]
            columns = [part.column("page_id"), part.column("url"), texts, [len(t) for t in texts]]
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, schema.types)],
                schema=schema,
            )

    own = pages.select(
        pages[id_column].cast("bigint").alias("page_id"), pages[url_column].cast("string").alias("url"),
        pages[html_column].alias("html"),
    )
    return own.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
