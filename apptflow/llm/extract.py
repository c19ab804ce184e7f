"""HTML main text by minimum-cut labelling.

A page is read into blocks (runs of text between block-level tags) with their path of
open elements. A linear classifier over tag, class, link and text features gives each
block the cost of calling it content or boilerplate; these are the capacities to the
two terminals. Neighbouring blocks and blocks with the same parent are joined by edges
that cost something to cut, the more the closer they are in the tree. The minimum cut
is the labelling of least total cost: a short paragraph between two long ones stays
with them, whatever its own features say.

Names such as ``sidebar`` speak for page furniture, but an element is judged by what it
holds as well: one around the article, or around most of the page's text where no article
is marked, is a wrapper, and so is a form. A page without markup is one block of content.
Reading takes time in proportion to the page, however deep its elements lie.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apptflow.llm.common import chunks, plain

# Element names of HTML by their role, and name parts of page furniture.
RAW = {"script", "style", "iframe", "head", "title", "textarea"}
#: elements that are left out if they are closed; their content is not raw text
INERT = {"noscript", "template", "object", "canvas", "svg", "audio", "video", "select", "annotation", "annotation-xml"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd", "details", "dialog", "div",
    "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header",
    "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "search", "section",
    "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
SECTION = {"article", "aside", "footer", "form", "header", "main", "nav", "dialog", "search", "menu", "fieldset"}
BOILERPLATE = {"aside", "footer", "form", "nav", "dialog", "search", "menu", "fieldset", "button", "label", "option", "legend"}
CONTENT = {"article", "main"}
#: an opening tag closes an open element of these
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}
FURNITURE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|commentlist|consent|cookies?|disqus|disclaimer|footer|"
    r"gdpr|login|masthead|menu|modal|nav|navbar|navigation|navigation|newsletter|notices?|overlay|pagination|pager|"
    r"popup|promo\w*|recommend\w*|related|replies|respond|search|share|sharing|sidebar|signup|skip|social|sponsor\w*|"
    r"subscribe|subscription|tagcloud|tags|teasers?|toolbar|topbar|widget|alert|responses?|discussion)(?:$|[\s_-])",
    re.I,
)
#: furniture that may hold articles of its own and is never a wrapper
FIRM = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|comments?|commentlist|discussion|disqus|promo\w*|recommend\w*|related|replies|respond|"
    r"responses?|sponsor\w*|teasers?|widget)(?:$|[\s_-])",
    re.I,
)
#: what a page has or has not, said of an element around it
MODIFIER = re.compile(r"(?<!\S)(?:has|hide|is|no|show|with|without)[_-]\S+", re.I)
_HUMP = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
#: elements that are wrappers if they hold the article
WRAPPERS = {"form", "fieldset"}
#: share of a page's text that makes an element its wrapper
MOST = 0.6
BODY_NAME = re.compile(
    r"(?:^|[\s_-])(?:article|articlebody|body|content|entry|main|maincontent|page-content|post|prose|story|text)(?:$|[\s_-])", re.I
)
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

#: weights of the classifier: over 0 speaks for content
BIAS = -0.6
IN_CONTENT = 3.0
IN_BODY_NAME = 1.2
IN_BOILERPLATE = -7.0
IN_FURNITURE = -6.0
IN_HEADER = -4.0
HEADING = 0.6
PARAGRAPH = 0.8
LINKS = -3.0
PER_LENGTH = 0.35
SENTENCE = 0.5
#: cost of a cut between neighbours, and between blocks of one parent
NEIGHBOUR = 1.5
SIBLING = 0.8

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[a-zA-Z/][^>]*(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_INERT = {
    t: re.compile(rf"<(/?){t}(?=[\s/>])((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.I) for t in INERT
}
_END_RAW = {t: re.compile(rf"</{t}\s*>", re.I) for t in RAW}


@dataclass
class _Element:
    """An open or closed element: what it says of itself, then what that means here."""

    tag: str
    #: places of the parent and of the nearest block element, itself included
    up: int
    holder: int
    named: bool = False
    furniture: bool = False
    firm: bool = False
    hides: bool = False
    #: characters in it, and articles that are not furniture
    size: int = 0
    articles: int = 0
    wrapper: bool = False
    section: int = 0
    content: bool = False
    boilerplate: bool = False
    header: bool = False
    #: whether it is, or is in, furniture or boilerplate of an article
    barred: bool = False


@dataclass
class Block:
    text: str
    tag: str
    parent: int
    section: int
    depth: int
    content: bool
    named: bool
    boilerplate: bool
    furniture: bool
    header: bool
    links: float
    edges: list[tuple[int, float]] = field(default_factory=list)


def _inert_ends(page: str, tag: str) -> dict[int, int]:
    """Where each closed element of a tag ends, by the end of its opening tag."""
    ends: dict[int, int] = {}
    open_: list[int] = []
    for m in _INERT[tag].finditer(page):
        if m.group(1):
            if open_:
                ends[open_.pop()] = m.end()
        elif not m.group(2).endswith("/"):
            open_.append(m.end())
    return ends


def _says(element: _Element, names: str) -> None:
    """What class, id, role, style and hidden say of an element."""
    for key, a, b, c in _ATTRIBUTE.findall(names):
        key, value = key.lower(), a or b or c
        if key in ("class", "id", "role"):
            # what names the whole page or article says nothing about its parts
            if element.tag in ("html", "body", "article", "main"):
                element.named = element.named or bool(BODY_NAME.search(value))
                element.firm = element.firm or (element.tag == "article" and bool(FIRM.search(value)))
                continue
            value = MODIFIER.sub("", _HUMP.sub("-", value))
            if FURNITURE.search(value):
                element.furniture = True
                element.firm = element.firm or bool(FIRM.search(value))
            elif BODY_NAME.search(value):
                element.named = True
        elif key == "style":
            element.hides = element.hides or bool(HIDDEN.search(value))
        elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            element.hides = True


def _judge(elements: list[_Element]) -> None:
    """Finds wrappers and hands down what elements mean for those in them."""
    root = elements[0]
    for e in reversed(elements[1:]):  # parts come after what holds them
        up = elements[e.up]
        # text of comments and the like does not make anything a wrapper
        if not (e.firm or e.hides):
            up.size += e.size
            up.articles += e.articles + (e.tag in CONTENT and not e.firm)
    for e in elements[1:]:
        up = elements[e.up]
        if (e.furniture or e.tag in WRAPPERS) and not (e.firm or e.hides or up.barred):
            most = e.size >= MOST * root.size and e.articles == root.articles
            e.wrapper = e.articles > 0 or most
        own_furniture = e.furniture and not e.wrapper
        own_boilerplate = (e.tag in BOILERPLATE and not e.wrapper) or e.hides
        inside = up.content or up.named
        # furniture of an article is none of its content, nor is an article in it
        e.barred = up.barred or (inside and (own_furniture or own_boilerplate))
        e.furniture = up.furniture or own_furniture
        e.boilerplate = up.boilerplate or own_boilerplate
        e.header = up.header or (e.tag == "header" and not up.content)
        e.content = (up.content or e.tag in CONTENT) and not e.barred
        e.named = (up.named or (e.named and not e.furniture)) and not e.barred


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order; blank ones are left out."""
    elements = [_Element("", 0, 0)]
    stack = [0]  # open elements by their places
    opened: dict[str, int] = {}
    found: list[tuple[str, int, int, float]] = []  # text, element, depth, linked characters
    linked, pieces, link_size, at = 0, [], 0, 0

    def flush() -> None:
        nonlocal link_size
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                found.append((text, stack[-1], len(stack), link_size))
                elements[stack[-1]].size += len(text)
            pieces.clear()
        link_size = 0

    def add(raw: str) -> None:
        nonlocal link_size
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            pieces.append(text)
            if linked:
                link_size += len(text.strip())

    def close(upto: int) -> None:
        nonlocal linked
        while len(stack) > upto:
            gone = elements[stack.pop()].tag
            opened[gone] -= 1
            if gone == "a":
                linked -= 1

    size = len(page)
    closed: dict[str, dict[int, int]] = {}
    while at < size:
        m = _TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        tag = m.group(2)
        if tag is None:
            continue
        tag = tag.lower()
        if m.group(1):  # an end tag
            if tag in BLOCK:
                flush()
            if opened.get(tag):
                for i in range(len(stack) - 1, 0, -1):
                    open_tag = elements[stack[i]].tag
                    if open_tag == tag:
                        close(i)
                        break
                    if open_tag in SECTION and tag not in SECTION:
                        break  # a stray end tag does not close a section
            continue
        if tag in RAW:
            if not m.group(0).endswith("/>"):
                end = _END_RAW[tag].search(page, at)
                if tag == "head" and end is None:
                    continue
                at = end.end() if end else size
            continue
        if tag in INERT:
            if tag not in closed:
                closed[tag] = _inert_ends(page, tag)
            at = closed[tag].get(at, at)
            continue
        if tag == "br":
            pieces.append(" ")
            continue
        if tag in BLOCK:
            flush()
            closes = CLOSES.get(tag, ())
            if any(opened.get(t) for t in ("p", "option", *closes)):
                for i in range(len(stack) - 1, 0, -1):
                    open_tag = elements[stack[i]].tag
                    if open_tag in ("p", "option") or open_tag in closes:
                        close(i)
                        break
                    if open_tag in BLOCK:
                        break
        if tag in VOID:
            continue
        up, place, names = stack[-1], len(elements), m.group(3)
        element = _Element(tag, up, place if tag in BLOCK else elements[up].holder)
        if names and ("=" in names or "hidden" in names):
            _says(element, names)
        if tag == "a":
            linked += 1
        elements.append(element)
        stack.append(place)
        opened[tag] = opened.get(tag, 0) + 1
    flush()

    _judge(elements)
    for place, e in enumerate(elements[1:], 1):
        new = e.tag in SECTION or e.furniture != elements[e.up].furniture
        e.section = place if new else elements[e.up].section
    out = []
    for text, place, depth, links in found:
        own, holder = elements[place], elements[elements[place].holder]
        out.append(
            Block(
                text, holder.tag, holder.up, own.section, depth, own.content, own.named,
                own.boilerplate, own.furniture, own.header, min(1.0, links / len(text)),
            )
        )
    if len(elements) == 1 and out:  # no markup: all of it is content
        out[0].content = True
    return out


def score(block: Block) -> float:
    """The classifier's value: log odds of content."""
    size = len(block.text)
    value = BIAS + IN_CONTENT * block.content + IN_BODY_NAME * block.named
    value += IN_BOILERPLATE * block.boilerplate + IN_FURNITURE * block.furniture + IN_HEADER * block.header
    value += LINKS * block.links
    if block.tag[:1] == "h" and block.tag[1:].isdigit():
        value += HEADING
    elif block.tag in ("p", "blockquote", "pre", "figcaption"):
        value += PARAGRAPH
    value += PER_LENGTH * min(4.0, size / 80)
    if block.text[-1] in ".!?…:;\"”»":
        value += SENTENCE
    return value


def connect(page: list[Block]) -> None:
    """Gives the blocks their edges: to the next one and to the last of the same parent."""
    last: dict[int, int] = {}
    for i, b in enumerate(page):
        near = {}
        if i:
            a = page[i - 1]
            apart = abs(a.depth - b.depth) + (a.parent != b.parent) + 4 * (a.section != b.section)
            near[i - 1] = NEIGHBOUR / (1 + apart)
        j = last.get(b.parent)
        if j is not None and page[j].section == b.section:
            near[j] = near.get(j, 0.0) + SIBLING
        for j, w in near.items():
            b.edges.append((j, w))
            page[j].edges.append((i, w))
        last[b.parent] = i


def minimum_cut(values: list[float], edges: list[list[tuple[int, float]]]) -> list[bool]:
    """Which nodes lie on the source's side of the minimum cut.

    A node whose own value outweighs all its edges is on its side in every minimum
    cut; such nodes are merged into the terminals first. Shortest augmenting paths
    settle the rest.
    """
    n = len(values)
    value = list(values)
    side: list[bool | None] = [None] * n
    queue = deque(range(n))
    while queue:
        i = queue.popleft()
        if side[i] is not None:
            continue
        free = sum(w for j, w in edges[i] if side[j] is None)
        if abs(value[i]) >= free:
            side[i] = value[i] > 0
            for j, w in edges[i]:
                if side[j] is None:
                    value[j] += w if side[i] else -w
                    queue.append(j)
    rest = [i for i in range(n) if side[i] is None]
    if not rest:
        return [bool(s) for s in side]

    source, sink = n, n + 1
    left: dict[int, dict[int, float]] = {i: {} for i in (*rest, source, sink)}
    for i in rest:
        for j, w in edges[i]:
            if side[j] is None:
                left[i][j] = left[i].get(j, 0.0) + w
        if value[i] > 0:
            left[source][i] = value[i]
            left[i].setdefault(source, 0.0)
        elif value[i] < 0:
            left[i][sink] = -value[i]
            left[sink].setdefault(i, 0.0)
    while True:
        came = {source: source}
        queue = deque([source])
        while queue and sink not in came:
            i = queue.popleft()
            for j, room in left[i].items():
                if room > 1e-9 and j not in came:
                    came[j] = i
                    queue.append(j)
        if sink not in came:
            for i in rest:
                side[i] = i in came
            return [bool(s) for s in side]
        path, j = [], sink
        while j != source:
            path.append((came[j], j))
            j = came[j]
        flow = min(left[i][j] for i, j in path)
        for i, j in path:
            left[i][j] -= flow
            left[j][i] = left[j].get(i, 0.0) + flow


def main_text(page: str) -> str:
    """The main text of a page: its content blocks, one a line."""
    found = blocks(page)
    if not found:
        return ""
    connect(found)
    keep = minimum_cut([score(b) for b in found], [b.edges for b in found])
    return "\n".join(b.text for b, k in zip(found, keep, strict=True) if k)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars for every row of ``pages``.

    A null or empty page, and one without content, has an empty text. Repeated rows
    each get a row, ids and urls may be null, an empty table gives an empty result and
    other columns are ignored.
    """

    def batch(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for part in chunks(whole, "html"):
                texts = [main_text(p) for p in plain(part.column("html")).cast(pa.large_string()).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("page_id"),
                        part.column("url"),
                        pa.array(texts, pa.string()),
                        pa.array([len(t) for t in texts], pa.int64()),
                    ],
                    ["page_id", "url", "text", "n_chars"],
                )

    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    return rows.mapInArrow(batch, "page_id long, url string, text string, n_chars long")
