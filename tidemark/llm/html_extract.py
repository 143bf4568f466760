"""Main text of web pages by minimum-cut labelling.

A page is split into blocks: runs of text between block-level tags. Each block
gets a score (log odds of being content) from its markup and its text. The
blocks are the nodes of a graph: a positive score is the capacity from the
source (content), a negative one the capacity to the sink (boilerplate).
Neighbouring blocks are joined by smoothness edges, stronger the closer they
stand in the document tree, and blocks with the same parent form a chain. A
minimum cut then is the labelling of least cost, where cost is the odds given
up plus the edges cut: a one-word paragraph between long ones stays in the
article, a long sentence inside a notice stays out.

The cut is found by augmenting along shortest paths in layered graphs, page by
page, inside Arrow batches; there is no shuffle and nothing is held beyond one
page.

A null or empty page has the empty text. Markup that is never closed ends with
the page. Whole pages are read; no text is cut off, and the work grows with the
page's length however deep its markup is. Repeated rows are read each by itself, an
empty table gives no rows, and only the three named columns are read, so that others
cannot clash.
"""

from __future__ import annotations

import re
from collections import deque
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of HTML: elements by their treatment.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCK = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend"
    " li main menu nav ol option p pre search section select summary table tbody td tfoot th thead"
    " title tr ul".split())
HIDDEN = frozenset("head template svg object math canvas audio video datalist".split())
CLOSES_P = BLOCK - {"br", "option", "head", "html", "body", "legend", "title", "tbody", "td",
                    "tfoot", "th", "thead", "tr"}
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}),
            "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
            "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
            "option": ({"option"}, {"select", "datalist"})}
SCOPES = ("article", "main", "body", "table", "td")

# Scores: what markup and text say about a block.
CONTENT_TAGS = frozenset(("article", "main"))
BOILERPLATE_TAGS = frozenset(
    "nav footer aside form menu dialog button select fieldset search label".split())
BOILERPLATE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert dialog menu menubar toolbar"
    " alertdialog status".split())
BOILERPLATE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo"
    " promotion banner sidebar side rail aside nav navbar navigation menu menus breadcrumb"
    " breadcrumbs footer foot header masthead topbar toolbar cookie cookies consent gdpr notice"
    " notices alert popup modal overlay subscribe subscription newsletter signup login share"
    " sharing social related recommended recommendations trending comment comments commentlist"
    " disqus reply replies respond discussion widget widgets pagination pager copyright legal"
    " disclaimer search form".split())
PLACE_WORDS = frozenset("left right top bottom container wrapper box block area inner outer list"
                        " item section group".split())
CONTENT_WORDS = frozenset("article content post entry story body text main".split())
IN_CONTENT, IN_BOILERPLATE, IN_HEADER, CLASS_CONTENT = 4.0, -9.0, -7.0, 1.0
# A class or id of listed words alone (`ad`, `cookie-notice`), and a listed word beside
# others (`legal-analysis`, `post-header`): the latter is evidence and no veto.
WHOLE_NAME, PART_OF_NAME = -9.0, -2.5
OUTSIDE, PER_WORD, MOST_WORDS, LINKS, PARAGRAPH, RIGHTS = -1.0, 0.06, 3.0, -4.0, 0.5, -2.0
# Smoothness: neighbours, by distance in the tree, and the chain of one parent.
NEIGHBOUR, SAME_PARENT = 0.8, 2.0

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*+>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.S)
_NAMES = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_RIGHTS = re.compile("©|all rights reserved", re.I)


class _Open:
    """An open element and what holds inside it."""

    __slots__ = ("tag", "content", "score", "link", "hidden", "depth", "block", "home")

    def __init__(self, tag, number, parent):
        self.tag = tag
        self.content = parent is not None and parent.content
        self.score = parent.score if parent else 0.0
        self.link = parent is not None and parent.link
        self.hidden = parent is not None and parent.hidden
        self.depth = parent.depth + 1 if parent else 0
        # the nearest block element, and the one around that
        self.block = parent.block if parent else number
        self.home = parent.home if parent else number


def _open(tag: str, attributes: str, number: int, parent: _Open | None) -> _Open:
    node = _Open(tag, number, parent)
    node.link = node.link or tag == "a"
    node.hidden = node.hidden or tag in HIDDEN
    if tag in BLOCK:
        node.block, node.home = number, node.block
    if tag in CONTENT_TAGS:
        node.content = True
    elif tag in BOILERPLATE_TAGS:
        node.score = min(node.score, IN_BOILERPLATE)
    elif tag == "header" and not node.content:
        node.score = min(node.score, IN_HEADER)
    named: list[str] = []
    if attributes and tag not in ("html", "body"):
        for m in _ATTRIBUTE.finditer(attributes):
            name, value = m[1].lower(), unescape(m[2] or m[3] or m[4] or "")
            if name in ("class", "id"):
                named += value.split()
            elif name == "role" and value.strip().lower() in BOILERPLATE_ROLES:
                node.score = min(node.score, IN_BOILERPLATE)
            elif name == "role" and value.strip().lower() in ("main", "article"):
                node.content = True
            elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden",
                                               value, re.I):
                node.hidden = True
            elif name == "aria-hidden" and value.strip().lower() == "true":
                node.hidden = True
        if re.search(r"(?:^|\s)hidden(?=[\s/=]|$)", attributes, re.I):
            node.hidden = True
    if named and tag not in CONTENT_TAGS:
        evidence = _evidence(named)
        if evidence < 0:
            node.score = min(node.score, evidence)
        elif not node.score:
            node.score = evidence
    return node


def _evidence(names: list[str]) -> float:
    """What the class names and ids of an element say about it."""
    score, content = 0.0, False
    for name in names:
        parts = set(_NAMES.findall(_CAMEL.sub(" ", name).lower())) - PLACE_WORDS
        listed = len(parts & BOILERPLATE_WORDS)
        score += WHOLE_NAME if listed and listed == len(parts) else PART_OF_NAME * listed
        content = content or bool(parts & CONTENT_WORDS)
    return max(IN_BOILERPLATE, score + CLASS_CONTENT * content)


def blocks(html: str) -> list[tuple[str, float, int, int]]:
    """(text, score, parent, depth) of the blocks of a page that can be seen."""
    stack: list[_Open] = [_Open("#root", 0, None)]
    places: dict[str, list[int]] = {}  # by tag, where its open elements stand in the stack
    block_places = [0]  # the same for block elements
    out, parts = [], []
    number, chars, linked, at, size = 0, 0, 0, 0, len(html)

    def text(piece: str) -> None:
        nonlocal chars, linked
        top = stack[-1]
        if top.hidden:
            return
        if "&" in piece:
            piece = unescape(piece)
        parts.append(piece)
        n = len(piece.strip())
        chars += n
        if top.link:
            linked += n

    def flush() -> None:
        nonlocal chars, linked
        if parts:
            joined = " ".join("".join(parts).split())
            if joined:
                top = stack[-1]
                words = joined.count(" ") + 1
                score = (IN_CONTENT if top.content else OUTSIDE) + top.score
                score += min(MOST_WORDS, PER_WORD * words) + LINKS * min(1.0, linked / max(1, chars))
                if top.content or words > 5:
                    score += PARAGRAPH if top.tag in ("p", "h1", "h2", "h3", "blockquote") else 0.0
                if _RIGHTS.search(joined) and words < 30:
                    score += RIGHTS
                out.append((joined, score, top.home, top.depth))
            parts.clear()
        chars = linked = 0

    def close_to(index: int) -> None:
        """Close all elements above and at `index`."""
        if block_places[-1] >= index:
            flush()
        while len(stack) > index:
            tag = stack.pop().tag
            places[tag].pop()
            if tag in BLOCK:
                block_places.pop()

    def nearest(tags) -> int:
        """Place of the innermost open element of some tags, 0 if there is none."""
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    for m in _TOKEN.finditer(html):
        if m.start() < at:  # inside raw text
            continue
        if m.start() > at:
            text(html[at:m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag = tag.lower()
        if m[1] or m[4]:
            i = nearest((tag,))
            if i and (tag in BLOCK or i > nearest(SCOPES)):
                close_to(i)  # a stray inline end tag closes nothing around its scope
            elif tag in BLOCK:
                flush()
            continue
        attributes = m[3] if m[2] else m[6]
        if tag in CLOSES_P:
            if stack[block_places[-1]].tag == "p":
                close_to(block_places[-1])
        if tag in SIBLINGS:
            ends, bounds = SIBLINGS[tag]
            i = nearest(ends)
            if i > nearest(bounds):
                close_to(i)
        if tag in BLOCK:
            flush()
        if tag in RAW and not attributes.rstrip().endswith("/"):
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(html, at)
            at = end.end() if end else size
            continue
        if tag in VOID:
            continue
        number += 1
        places.setdefault(tag, []).append(len(stack))
        if tag in BLOCK:
            block_places.append(len(stack))
        stack.append(_open(tag, attributes, number, stack[-1]))
    if at < size:
        text(html[at:])
    flush()
    return out


# ------------------------------------------------------------------ the cut
def min_cut(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay with the source. scores: capacity from the source, or,
    negative, to the sink; edges: (a, b, capacity) in both directions."""
    n = len(scores)
    left = list(scores)  # what is left of each terminal capacity
    to: list[int] = []
    room: list[float] = []
    near: list[list[int]] = [[] for _ in range(n)]
    for a, b, c in edges:
        near[a].append(len(to))
        to.append(b)
        room.append(c)
        near[b].append(len(to))
        to.append(a)
        room.append(c)
    tiny = 1e-9
    while True:
        layer = [-1] * n
        queue = deque(i for i in range(n) if left[i] > tiny)
        for i in queue:
            layer[i] = 0
        reached = False
        while queue:
            i = queue.popleft()
            for e in near[i]:
                if room[e] > tiny and layer[to[e]] < 0:
                    layer[to[e]] = layer[i] + 1
                    reached = reached or left[to[e]] < -tiny
                    queue.append(to[e])
        if not reached:
            return [x >= 0 for x in layer]
        at = [0] * n
        for start in range(n):
            while layer[start] == 0 and left[start] > tiny:
                path, i = [], start
                while left[i] >= -tiny:
                    while at[i] < len(near[i]):
                        e = near[i][at[i]]
                        if room[e] > tiny and layer[to[e]] == layer[i] + 1:
                            break
                        at[i] += 1
                    if at[i] < len(near[i]):
                        path.append(near[i][at[i]])
                        i = to[path[-1]]
                    elif path:
                        i = to[path.pop() ^ 1]
                        at[i] += 1
                    else:
                        break
                if left[i] >= -tiny:
                    break
                flow = min(left[start], -left[i], *(room[e] for e in path))
                left[start] -= flow
                left[i] += flow
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow


def label(page: list[tuple[str, float, int, int]]) -> list[bool]:
    """True for the content blocks of a page."""
    edges, last = [], {}
    for i, (_, _, parent, depth) in enumerate(page):
        if i:
            before = page[i - 1]
            if before[2] != parent:
                edges.append((i - 1, i, NEIGHBOUR / (1 + abs(before[3] - depth))))
        if parent in last:
            edges.append((last[parent], i, SAME_PARENT))
        last[parent] = i
    return min_cut([b[1] for b in page], edges)


def main_text(html: str | None) -> str:
    """The content blocks in page order, joined by one space."""
    if not html:
        return ""
    page = blocks(html)
    return " ".join(b[0] for b, keep in zip(page, label(page)) if keep)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """(id_col, url_col, text, n_chars) for every row of `pages`."""
    kinds = dict(pages.dtypes)
    source = pages.select(F.col(f"`{id_col}`"), F.col(f"`{url_col}`"),
                          F.col(f"`{html_col}`").cast("string").alias("__html"))

    def run(batches):
        for batch in batches:
            found = [main_text(v.as_py()) for v in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.string()),
                 pa.array([len(x) for x in found], pa.int64())],
                names=[id_col, url_col, "text", "n_chars"])

    return source.mapInArrow(
        run, f"`{id_col}` {kinds[id_col]}, `{url_col}` {kinds[url_col]}, text string, n_chars long")
