"""Main text of web pages by scoring their element tree.

A page is read into a light tree of elements and text blocks. Each paragraph
passes points for its length and commas to its parent, half to the next
ancestor and less to those above (``LEVELS`` of them), discounted by the share of link text. The
container with the most points wins, together with its well-scored siblings.

Unwanted words of class and id names lower an element's prior points. A form, or an
element with a name of unwanted words only, is left out unless it holds most of the
page's text outside links: then it is a wrapper of the page.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from martkit.llm.frames import map_batches

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)|</(?:[^>]*>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"\b(class|id|role|style|hidden|aria-hidden|itemprop)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?", re.I)
WORDS = re.compile(r"[a-z]+")
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp noembed noframes iframe".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
DROPPED = set("head script style noscript template svg math canvas object embed iframe nav footer aside button select input textarea dialog menu audio video noframes title".split())
ROLES = set("navigation banner complementary contentinfo search dialog alert alertdialog menu menubar toolbar".split())
# Words of class and id names.
UNWANTED = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs footer foot sidebar "
    "sidebox aside comment comments commentlist disqus respond replies reply cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup "
    "login share sharing social related recommended widget pagination pager toolbar masthead skip hidden".split()
)
WANTED = set("article content main post entry story text body page blog".split())
KEPT_ROOTS = ("html", "body", "article", "main")
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "tbody": {"table"}, "option": {"select"}}
PARAGRAPH_SCOPE = set("button caption td th table article section body html div li blockquote".split())


LEVELS = 32  # ancestors that a paragraph's points reach


class Element:
    __slots__ = ("parent", "tag", "weight", "dropped", "outright", "points", "text", "linked", "link", "order", "block", "own")

    def __init__(self, parent: Element | None, tag: str, weight: float, dropped: bool, outright: bool, link: bool, order: int):
        self.parent, self.tag, self.weight, self.dropped, self.outright, self.link, self.order = parent, tag, weight, dropped, outright, link, order
        self.points = 0.0
        self.text = self.linked = 0
        self.block = self if parent is None or tag in BLOCK else parent.block
        self.own = 0  # characters outside links that stand in it directly, unless left out whatever they hold


class Stack:
    """Open elements, with the places of each tag, of blocks and of what ends the search for a paragraph."""

    def __init__(self, root: Element):
        self.items = [root]
        self.places: dict[str, list[int]] = defaultdict(list)
        self.blocks: list[int] = []
        self.scopes: list[int] = []

    def push(self, element: Element) -> None:
        for places in self._lists(element.tag):
            places.append(len(self.items))
        self.items.append(element)

    def cut(self, upto: int) -> None:
        for element in self.items[upto:]:
            for places in self._lists(element.tag):
                places.pop()
        del self.items[upto:]

    def _lists(self, tag: str) -> list[list[int]]:
        out = [self.places[tag]]
        if tag in BLOCK:
            out.append(self.blocks)
        if tag == "p" or tag in PARAGRAPH_SCOPE:
            out.append(self.scopes)
        return out

    def last(self, tag: str) -> int:
        """Place of the innermost element of a tag; 0 if none is open."""
        places = self.places.get(tag)
        return places[-1] if places else 0

    def has_block(self, upto: int) -> bool:
        return bool(self.blocks) and self.blocks[-1] >= upto


def _judge(tag: str, rest: str, in_article: bool) -> tuple[float, bool, bool]:
    """Prior points of an element, whether its subtree is left out, and whether it is unless most of the page stands there."""
    weight, doubtful = 25.0 if tag in ("article", "main") else 0.0, tag == "form"
    if tag in DROPPED or tag == "header" and not in_article:
        return weight, True, False
    if "=" not in rest and "hidden" not in rest.lower():
        return weight, False, doubtful
    for name, a, b, c in ATTRIBUTE.findall(rest):
        value, name = (a or b or c).lower(), name.lower()
        if name in ("class", "id"):
            names = [set(WORDS.findall(x)) for x in value.split()]
            if tag not in KEPT_ROOTS and any(words & UNWANTED for words in names):
                weight -= 5.0
                doubtful = doubtful or any(words and words <= UNWANTED for words in names)
            if any(words & WANTED for words in names):
                weight += 10.0
        elif name == "role" and value == "form" and tag not in KEPT_ROOTS:
            doubtful = True
        elif name == "role" and value in ROLES and tag not in KEPT_ROOTS:
            return weight, True, False
        elif name == "role" and value in ("main", "article") or name == "itemprop" and value == "articlebody":
            weight += 25.0
        elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return weight, True, False
    return weight, False, doubtful


def read_blocks(html: str, wrappers: frozenset[int] = frozenset()) -> list[tuple[Element, str, int]]:
    """Text blocks outside left-out subtrees, in page order: (element, text, characters of link text).

    Doubtful elements are left out, but for the wrappers. If any of them holds most of the text
    that is not left out anyway, the page is read once more with it as a wrapper. Takes time in
    proportion to the page, however deep its elements are nested.
    """
    root = Element(None, "html", 0.0, False, False, False, 0)
    stack, blocks, elements = Stack(root), [], [root]
    doubted: list[Element] = []
    pieces: list[str] = []
    linked = 0
    at = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(unescape("".join(pieces)).split())
        if text:
            blocks.append((stack.items[-1].block, text, min(linked, len(text))))
        pieces.clear()
        linked = 0

    def write(text: str) -> None:
        nonlocal linked
        top = stack.items[-1]
        if text and not wrappers and not top.outright and not top.link:
            top.own += len(" ".join(text.split()))
        if text and not top.dropped:
            pieces.append(text)
            if top.link:
                linked += len(" ".join(text.split()))

    def close(upto: int) -> None:
        if stack.has_block(upto) or stack.items[-1].dropped != stack.items[upto - 1].dropped:
            flush()
        stack.cut(upto)

    while True:
        found = TAG.search(html, at)
        if found is None:
            write(html[at:])
            break
        write(html[at : found.start()])
        at = found.end()
        if found["cdata"]:
            write(found["cdata"].replace("&", "&amp;"))
        name = (found["name"] or found["name2"] or "").lower()
        if not name:
            continue
        if found["close"] or found["close2"]:
            depth = stack.last(name)
            # An inline end tag does not close blocks opened after it.
            if depth and (name in BLOCK or not stack.has_block(depth)):
                close(depth)
            elif name == "p":
                flush()
            continue
        rest = found["rest"] or found["rest2"] or ""
        if name == "br":
            write(" ")
            continue
        if name in BLOCK:
            flush()
            depth = stack.scopes[-1] if stack.scopes else 0
            if depth and stack.items[depth].tag == "p":
                close(depth)
            if name in CLOSED_BY:
                scope = max(stack.last(tag) for tag in SCOPES[name])
                inner = [places[bisect_right(places, scope)] for tag in CLOSED_BY[name] if (places := stack.places.get(tag)) and places[-1] > scope]
                if inner:
                    close(min(inner))
        if name in VOID:
            continue
        top = stack.items[-1]
        weight, outright, doubtful = _judge(name, rest, bool(stack.places.get("article") or stack.places.get("main")))
        doubtful = doubtful and len(elements) not in wrappers
        dropped = outright or doubtful or top.dropped
        if dropped and not top.dropped:
            flush()
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(html, at)
            at = end.end() if end else len(html)
            continue
        if rest.endswith("/") and name in ("svg", "path"):
            continue
        element = Element(top, name, weight, dropped, outright or top.outright, top.link or name == "a", len(elements))
        stack.push(element)
        elements.append(element)
        if doubtful and not element.outright:
            doubted.append(element)
    flush()
    if wrappers or not doubted:
        return blocks
    whole = 0
    for element in reversed(elements):  # children come after their parents
        if element.parent is not None:
            element.parent.own += element.own
        else:
            whole = element.own
    found_wrappers = frozenset(e.order for e in doubted if 2 * e.own > whole)
    return read_blocks(html, found_wrappers) if found_wrappers else blocks


def extract(html: str | None) -> str:
    """Main text: blocks of the best container and its good siblings, one per line; '' if there is none."""
    blocks = read_blocks(html or "")
    if not blocks:
        return ""
    holders: dict[int, Element] = {}
    for element, text, linked in blocks:
        element.text += len(text)
        element.linked += linked
        up: Element | None = element
        while up is not None and up.order not in holders:
            holders[up.order] = up
            up = up.parent
    for order in sorted(holders, reverse=True):  # children before their parents
        element = holders[order]
        if element.parent is not None:
            element.parent.text += element.text
            element.parent.linked += element.linked
    scored: dict[int, Element] = {}
    for element, text, linked in blocks:
        points = (1 + text.count(",") + min(len(text) / 100, 3.0)) * (1 - linked / len(text))
        # A block that is a container itself keeps its points; a paragraph passes them on.
        paragraph = element.tag in ("p", "pre", "blockquote", "li", "td", "dd", "dt", "figcaption") or element.tag[0] == "h" and element.tag != "html"
        up = element.parent if paragraph and element.parent is not None else element
        for level in range(LEVELS):
            if up is None:
                break
            up.points += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
            scored[up.order] = up
            up = up.parent
    best = max(scored.values(), key=lambda e: (_total(e), -e.order))
    while best.parent is not None and best.tag in ("ul", "ol", "dl", "table", "tbody", "tr", "blockquote", "p"):
        best = best.parent  # a list or table is a part of its article
    floor = max(10.0, 0.2 * _total(best))
    # For each element the one below the best's parent that it stands in: the best, a sibling of it, or none.
    branch: dict[int, Element | None] = {best.order: best}

    def branch_of(element: Element) -> Element | None:
        path, up = [], element
        while up.order not in branch and up.parent is not None and up.parent is not best.parent:
            path.append(up)
            up = up.parent
        if up.order not in branch:
            branch[up.order] = up if up.parent is not None and up.parent is best.parent else None
        for e in path:
            branch[e.order] = branch[up.order]
        return branch[up.order]

    def kept(element: Element, text: str) -> bool:
        below = branch_of(element)
        if below is None or below is best:
            return below is best
        density = below.linked / max(1, below.text)
        if below.tag in ("h1", "h2") and below.order < best.order:
            return True
        if below.tag == "p":
            return density < 0.25 and (below.text > 80 or density == 0 and text[-1:] in ".!?")
        return below.points > 0 and _total(below) >= floor and density < 0.25

    return "\n".join(text for element, text, _ in blocks if kept(element, text))


def _total(e: Element) -> float:
    return (e.points + e.weight) * (1 - e.linked / max(1, e.text))


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page.

    Null, empty or text-free html gives '' and 0. Pages are read alone; repeated rows stay repeated. Very long and
    very deeply nested pages take time in proportion to their length. No rows: no result.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [extract(h) for h in batch.column(2).to_pylist()]
        sizes = pa.array([len(t) for t in texts], pa.int64())
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes], ["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    return map_batches(pages.select("page_id", "url", "html"), run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
