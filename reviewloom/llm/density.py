"""Main text of web pages by composite text density.

A page becomes a tree of its elements. Parts that are never the article (scripts, menus, forms,
notices and the like) are cut out by their tag, role or class. Every node that is left gets a
composite density, its characters per tag adjusted by the characters and tags of links, and
the sum of its children's densities. The node of the largest sum holds the article; the
least density on its path from the body is the threshold that other parts must reach to be taken as
well. All work on a page is linear in its length, and no recursion limits its depth.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from reviewloom.shipping import ship

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes noscript xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split()
)
# An element that its like closes, and the elements that this does not reach beyond.
CLOSES = {
    "li": ("li", "ul ol menu"),
    "dt": ("dt dd", "dl"),
    "dd": ("dt dd", "dl"),
    "option": ("option", "select"),
    "tr": ("tr td th", "table"),
    "td": ("td th", "tr table"),
    "th": ("td th", "tr table"),
    "thead": ("tr td th tbody tfoot", "table"),
    "tbody": ("tr td th thead tbody", "table"),
    "tfoot": ("tr td th thead tbody", "table"),
}
CLOSES = {tag: (frozenset(own.split()), frozenset(wall.split())) for tag, (own, wall) in CLOSES.items()}

# Parts that are not the article: by element, by role, and by a word of class or id.
NEVER = RAW | frozenset(
    "head nav footer aside form button select input template svg canvas object embed audio video dialog menu search "
    "map math applet datalist".split()
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar tablist "
    "status tooltip".split()
)
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
    "gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login sidebar rail "
    "widget widgets nav navbar navigation menu menus breadcrumb breadcrumbs footer masthead topbar comment comments "
    "discussion respond reply replies disqus share sharing social related recommended recommendations pagination pager "
    "toolbar skip hidden".split()
)
CONTENT = frozenset(["article", "main"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PROSE = HEADINGS | frozenset("p blockquote pre ul ol dl table figure".split())

LEAST_SHARE = 0.25  # of the largest sum that another part needs outside article elements
REACH = 512  # levels that an implied end looks up, so that deep pages take linear time

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|(?<=[=\s])"[^"]*"|(?<=[=\s])'[^']*'|["'])*+)>""")
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|([^\s"'<>/=]+)""")
_WORD = re.compile(r"[a-z]+|[0-9]+")


class Page:
    """Elements in page order, with texts between them.

    ``items`` lists (node, text) in page order; every element's parent comes before it.
    """

    def __init__(self, source: str):
        self.tags, self.parents, self.attributes = ["#page"], [0], [{}]
        self.items: list[tuple[int, str | None]] = []  # text of a node; None: a break inside it
        self._stack, self._open = [0], {}
        self._parse(source)

    def _parse(self, source: str) -> None:
        at, n = 0, len(source)
        while at < n:
            start = source.find("<", at)
            if start < 0:
                start = n
            if start > at:
                self._text(source[at:start])
            if start == n:
                break
            after = source[start + 1 : start + 2]
            if source.startswith("<!--", start):
                end = source.find("-->", start + 4)
                at = n if end < 0 else end + 3
            elif after in ("!", "?") or (after == "/" and not source[start + 2 : start + 3].isalpha()):
                end = source.find(">", start)
                at = n if end < 0 else end + 1
            elif after == "/" or (after.isascii() and after.isalpha()):
                found = _TAG.match(source, start)
                if not found:  # cut off inside a tag
                    break
                at = found.end()
                name = found[2].lower()
                if found[1]:
                    self._end(name)
                else:
                    self._start(name, found[3])
                    if name in RAW:
                        at = self._raw(source, at, name)
            else:
                self._text("<")
                at = start + 1

    def _raw(self, source: str, at: int, name: str) -> int:
        """Skip to the end of an element whose content is no markup."""
        found = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(source, at)
        if not found:
            return len(source)
        end = source.find(">", found.end())
        self._end(name)
        return len(source) if end < 0 else end + 1

    def _text(self, text: str) -> None:
        self.items.append((self._stack[-1], text))

    def _start(self, name: str, attributes: str) -> None:
        if name in ENDS_P and self._open.get("p"):
            self._close("p", CONTENT | frozenset(["table", "td", "th", "button"]))
        if name in CLOSES:
            own, wall = CLOSES[name]
            while any(self._open.get(o) for o in own) and self._close_any(own, wall):
                pass
        if name in HEADINGS and self.tags[self._stack[-1]] in HEADINGS:
            self._pop()
        if name == "a" and self._open.get("a"):
            self._close("a", ENDS_P | frozenset(["td", "th", "li"]))
        number = len(self.tags)
        self.tags.append(name)
        self.parents.append(self._stack[-1])
        found = {}
        for key, one, two, three, bare in _ATTRIBUTE.findall(attributes) if attributes.strip(" \t\n/") else ():
            found.setdefault((key or bare).lower(), one or two or three)
        self.attributes.append(found)
        self.items.append((number, None))
        if name not in VOID:
            self._stack.append(number)
            self._open[name] = self._open.get(name, 0) + 1

    def _pop(self) -> str:
        node = self._stack.pop()
        name = self.tags[node]
        self._open[name] -= 1
        self.items.append((node, None))
        return name

    def _close_any(self, names: frozenset[str], wall: frozenset[str]) -> bool:
        last = max(0, len(self._stack) - 1 - REACH) if wall else 0
        for depth in range(len(self._stack) - 1, last, -1):
            tag = self.tags[self._stack[depth]]
            if tag in names:
                while len(self._stack) > depth:
                    self._pop()
                return True
            if tag in wall:
                return False
        return False

    def _close(self, name: str, wall: frozenset[str]) -> None:
        self._close_any(frozenset([name]), wall)

    def _end(self, name: str) -> None:
        if self._open.get(name):
            # inline markup does not end the blocks that began in it
            self._close(name, ENDS_P | frozenset(["li", "td", "th", "body"]) if name in INLINE else frozenset())
        elif name == "p":
            self.items.append((self._stack[-1], None))


def _hinted(tag: str, attributes: dict[str, str]) -> bool:
    if tag in NEVER or attributes.get("role", "").lower() in ROLES or "hidden" in attributes:
        return True
    if attributes.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", attributes.get("style", ""), re.I):
        return True
    named = f"{attributes.get('class', '')} {attributes.get('id', '')}".strip()
    return bool(named) and not HINTS.isdisjoint(_WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1-\2", named).lower()))


def cut_nodes(page: Page) -> list[bool]:
    """Which nodes are cut out. Body and main stay, as does what a hint of class or id names but
    that holds an article; a header stays inside an article."""
    tags, parents, attributes = page.tags, page.parents, page.attributes
    hinted = [tag not in ("html", "body", "main", "#page") and _hinted(tag, a) for tag, a in zip(tags, attributes)]
    holds = [tag in CONTENT and not h for tag, h in zip(tags, hinted)]
    for node in range(len(tags) - 1, 0, -1):
        if holds[node]:
            holds[parents[node]] = True
    within, cut = [False] * len(tags), [False] * len(tags)
    for node in range(1, len(tags)):
        tag, up = tags[node], parents[node]
        within[node] = within[up] or tag in CONTENT
        drop = hinted[node] and (tag in NEVER or not holds[node])
        drop = drop or (tag == "header" and not within[up] and not holds[node])
        cut[node] = cut[up] or drop
    return cut


def densities(page: Page, cut: list[bool]) -> tuple[list[float], list[float]]:
    """Composite text density of every node, and the sum of its children's densities.

    Counted are characters other than white space, and tags other than inline markup, which
    gives a text no structure; links are tags. Text of a node between its children counts as
    a child of one tag. Zero link characters, link tags and other characters count as one.
    """
    tags, parents = page.tags, page.parents
    n = len(tags)
    chars, linked, count, links, own, own_linked = ([0] * n for _ in range(6))
    in_link = [False] * n
    body = 0
    for node in range(1, n):
        in_link[node] = in_link[parents[node]] or tags[node] == "a"
        if tags[node] == "body" and not body:
            body = node
    for node, text in page.items:
        if text is not None and not cut[node]:
            size = sum(map(len, html.unescape(text).split())) if "&" in text else sum(map(len, text.split()))
            own[node] += size
            own_linked[node] += size * in_link[node]
    for node in range(n - 1, -1, -1):
        if cut[node]:
            continue
        chars[node] += own[node]
        linked[node] += own_linked[node]
        if node:
            up = parents[node]
            chars[up] += chars[node]
            linked[up] += linked[node]
            count[up] += count[node] + (tags[node] not in INLINE or tags[node] == "a")
            links[up] += links[node] + (tags[node] == "a")
            if tags[node] in INLINE and tags[node] != "a":  # inline text is the text of what holds it
                own[up] += own[node]
                own_linked[up] += own_linked[node]
    share = linked[body] / max(1, chars[body])

    def density(c: int, lc: int, t: int, lt: int) -> float:
        if not c:
            return 0.0
        t, per_link = max(1, t), (c / max(1, lc)) * (max(1, t) / max(1, lt))
        base = math.log(c * max(1, lc) / max(1, c - lc) + share * c + math.e)
        return c / t * math.log(max(1.0, per_link)) / math.log(base)

    value, total = [0.0] * n, [0.0] * n
    for node in range(n - 1, -1, -1):
        if not cut[node]:
            value[node] = density(chars[node], linked[node], count[node], links[node])
            total[node] += density(own[node], own_linked[node], 1, 0)
            if node and (tags[node] not in INLINE or tags[node] == "a"):
                total[parents[node]] += value[node]
    return value, total


def chosen_nodes(page: Page, cut: list[bool]) -> list[bool]:
    """The nodes whose text is the main text; with a node, all that it holds.

    The node of the largest sum (the outermost of equals) is taken, inside an article or main
    element the whole element. Of each other node that is as dense as the threshold the node
    of the largest sum in it is taken too, if it reaches a quarter of the first sum; beside an
    article element only articles are. A taken node brings along the headings and prose beside it.
    """
    tags, parents = page.tags, page.parents
    value, total = densities(page, cut)
    n = len(tags)
    live = [node for node in range(n) if not cut[node] and value[node] > 0]
    chosen = [False] * n
    if not live:
        return chosen
    body = next((node for node in live if tags[node] == "body"), 0)
    top = max(live, key=lambda node: (total[node], -node))
    threshold, node = value[top], top
    while node and node != body:
        node = parents[node]
        threshold = min(threshold, value[node])
    peak = list(range(n))  # node of the largest sum at or below each node
    for node in reversed(live):
        if node:
            up = parents[node]
            if (total[peak[node]], -peak[node]) > (total[peak[up]], -peak[up]):
                peak[up] = peak[node]
    whole = list(range(n))  # the outermost article or main element around each node, else the node
    for node in range(1, n):
        if tags[whole[parents[node]]] in CONTENT:
            whole[node] = whole[parents[node]]
    chosen[whole[top]] = True
    for node in live:
        if value[node] >= threshold and node not in (0, body) and tags[node] != "html":
            other = whole[peak[node]]
            if tags[other] in CONTENT or (tags[whole[top]] not in CONTENT and total[peak[node]] >= LEAST_SHARE * total[top]):
                chosen[other] = True
    kept = [node for node in live if chosen[node]]
    beside = {parents[node] for node in kept if tags[node] not in CONTENT}
    for node in live:
        if parents[node] in beside and tags[node] in PROSE:
            chosen[node] = True
    for node in range(1, n):
        chosen[node] = not cut[node] and (chosen[node] or chosen[parents[node]])
    return chosen


def main_text(source: str | None) -> str:
    """Blocks of the main text in page order, joined by empty lines; empty if there is none."""
    page = Page(source or "")
    chosen = chosen_nodes(page, cut_nodes(page))
    blocks, words = [], []
    for node, text in page.items:
        if text is None:
            if page.tags[node] not in INLINE:
                blocks.append("".join(words))
                words = []
            elif page.tags[node] == "br" and chosen[node]:
                words.append(" ")
        elif chosen[node]:
            words.append(html.unescape(text) if "&" in text else text)
    blocks.append("".join(words))
    clean = (" ".join(b.split()) for b in blocks)
    return "\n\n".join(b for b in clean if b)


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = pa.array([main_text(source.as_py()) for source in batch.column(2)], pa.string())
        sizes = pa.array([len(text.as_py()) for text in texts], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts, sizes], names=["page_id", "url", "text", "n_chars"])


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row; no shuffle.

    A null or empty html, and a page without any text outside the cut parts, gives an empty
    text. Repeated rows and null ids are rows like others; other columns are ignored. A page that
    is cut off in a tag ends before it; unclosed elements end where others must begin.
    """
    ship(pages.sparkSession)
    kind = dict(pages.dtypes)["page_id"]
    rows = pages.select("page_id", F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(_run, f"page_id {kind}, url string, text string, n_chars bigint")
