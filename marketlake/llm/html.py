"""Main text of pages by composite text density.

Every element of a page has a density: its characters per tag, corrected by how much of it is
links, more so on pages that are mostly links. An element's score is the sum of its children's
densities; the element of the highest score holds the article. The density of the page body is
the threshold by which the way from there up to the body, and single blocks inside, are judged.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from .arrow import add_columns

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*)>",
    re.S,
)
LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)  # a quote that is never closed
NAMES = re.compile(r"""\b(class|id|role|hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
WORD = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

# What HTML says about its elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp"
    " small span strike strong sub sup time tt u var wbr".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dir div dl fieldset figcaption figure footer form h1 h2 h3 h4"
    " h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
SAME = {  # an element that a start tag of the group ends
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("thead", "tbody", "tr", "td", "th"),
}
SCOPE = frozenset("html body table ul ol dl article section div main aside nav form blockquote button select td th".split())

# What is no part of an article, by element, by role, and by words in class or id.
DROPPED = frozenset(
    "head nav header footer aside form script style noscript iframe button select template svg canvas object embed audio"
    " video dialog menu textarea title noembed noframes".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising sponsor sponsored promo promotion banner sidebar"
    " widget widgets related share sharing social breadcrumb breadcrumbs menu nav navbar navigation header masthead footer"
    " cookie cookies consent gdpr notice notices notification popup modal overlay newsletter subscribe subscription paywall"
    " login signup comment comments commentlist respond disqus reply replies pagination pager toolbar skip tags tagcloud".split()
)
KEPT = frozenset("html body main article".split())  # never dropped for an ambiguous word
# Names of reader comments and lists of other pages: dropped whatever their size and what they hold.
OTHERS = frozenset(
    "comment comments commentlist respond disqus reply replies related recommended recommendations".split()
)
# Words that say of a wrapper what it has: `has-related`, `comments-closed`.
ABOUT = frozenset("has no with without on off open closed enabled disabled".split())


class Node:
    __slots__ = ("tag", "parent", "inside", "chars", "tags", "link_chars", "link_tags", "density", "score", "drop", "weak", "other")

    def __init__(self, tag: str, parent: Node | None, drop: bool = False, weak: bool = False, other: bool = False):
        self.tag, self.parent, self.drop, self.weak, self.other = tag, parent, drop or other, weak, other and not drop
        self.inside: list[Node | str] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.score = 0.0


def _named(attributes: str) -> tuple[bool, bool, bool]:
    """Whether the element is dropped for sure, for a word unless it holds most of the page, or
    as comments or a list of other pages."""
    sure = weak = other = False
    for m in NAMES.finditer(attributes):
        name, value = m[1].lower(), (m[2] or "").strip("\"'")
        if name == "hidden":
            sure = True
        elif name == "style":
            sure = sure or "display:none" in value.replace(" ", "").lower()
        elif name == "role":
            sure = sure or value.strip().lower() in ROLES
        else:
            for one in value.split():
                words = frozenset(WORD.findall(CAMEL.sub(" ", one).lower()))
                other = other or (not OTHERS.isdisjoint(words) and ABOUT.isdisjoint(words))
                weak = weak or not WORDS.isdisjoint(words)
    return sure, weak, other


def parse(page: str) -> Node:
    """The tree of a page, however broken: what is not closed ends with its parent."""
    root = Node("html", None)
    here, at, size = root, 0, len(page)
    lower: str | None = None

    def text(piece: str) -> None:
        if piece:
            here.inside.append(html.unescape(piece) if "&" in piece else piece)

    while at < size:
        lt = page.find("<", at)
        if lt < 0:
            text(page[at:])
            break
        if lt > at:
            text(page[at:lt])
        m = TOKEN.match(page, lt) or LOOSE.match(page, lt)
        if m is None:
            if re.match(r"</?[a-zA-Z]", page[lt : lt + 3]):
                break  # a tag cut off by the end of the page
            text("<")
            at = lt + 1
            continue
        at = m.end()
        if m.lastindex is None:
            continue  # a comment or declaration
        tag = m[2].lower()
        if m[1]:
            node = here
            while node is not None and node.tag != tag:
                node = None if tag in INLINE and node.tag in SCOPE else node.parent
            if node is not None and node.parent is not None:
                here = node.parent
            continue
        if tag in ("html", "body"):
            if tag == "body" and not any(isinstance(x, Node) and x.tag == "body" for x in root.inside):
                here = Node("body", root)
                root.inside.append(here)
            continue
        if tag in CLOSES_P or tag in SAME:
            ends = SAME.get(tag, ("p",))
            node, last = here, None
            while node is not None and (node.tag in ends or node.tag not in SCOPE):
                if node.tag in ends:
                    last = node
                node = node.parent
            if last is not None and last.parent is not None:
                here = last.parent
        sure, weak, other = _named(m[3]) if m[3].strip() else (False, False, False)
        node = Node(tag, here, tag in DROPPED or sure, weak and tag not in KEPT, other and tag != "main")
        here.inside.append(node)
        if tag in RAW:
            lower = lower if lower is not None else page.lower()
            if len(lower) != size:  # a letter whose small form is longer
                lower = re.sub("[A-Z]+", lambda x: x[0].lower(), page)
            end = lower.find(f"</{tag}", at)
            at = size if end < 0 else end
        elif tag not in VOID and not m[3].rstrip().endswith("/"):
            here = node
    return root


def _in_order(root: Node, others: bool = False) -> list[Node]:
    """All elements that are not dropped, parents first; with ``others`` those named so as well."""
    nodes, stack = [], [root]
    while stack:
        node = stack.pop()
        nodes.append(node)
        stack.extend(x for x in reversed(node.inside) if isinstance(x, Node) and (not x.drop or others and x.other))
    return nodes


def _count(nodes: list[Node]) -> None:
    for node in nodes:
        node.chars = sum(len(x.strip()) for x in node.inside if isinstance(x, str))
        node.tags = node.link_chars = node.link_tags = 0
    for node in reversed(nodes):
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.tags + 1
        if node.parent is not None:
            up = node.parent
            up.chars += node.chars
            up.tags += node.tags + 1
            up.link_chars += node.link_chars
            up.link_tags += node.link_tags


def _weigh(nodes: list[Node], body: Node) -> None:
    """Composite density of every element, and the sum over its children as its score."""
    share = body.link_chars / body.chars if body.chars else 0.0
    for node in nodes:
        node.score = 0.0
        c, t = node.chars, max(node.tags, 1)
        if not c:
            node.density = 0.0
            continue
        links, plain = max(node.link_chars, 1), max(c - node.link_chars, 1)
        base = math.log(c / plain * node.link_chars + share * c + math.e)
        inner = max(c / links * t / max(node.link_tags, 1), 1.0)
        node.density = c / t * (math.log(inner) / math.log(base) if base > 1.0 + 1e-9 else math.log(inner))
    for node in nodes:
        if node.parent is not None:
            node.parent.score += node.density


def _article(body: Node, nodes: list[Node]) -> Node:
    """The element of the highest score, or the widest around it that is as dense as the body."""
    named = [n for n in nodes if n.tag in ("article", "main") and n.chars]
    best = max(nodes, key=lambda n: n.score)
    if best.score <= 0:
        best = max(nodes, key=lambda n: n.density)
    node = best
    while node.parent is not None and node is not body:
        if node in named and 2 * node.chars > body.chars:
            return node
        node = node.parent
    threshold = body.density
    node = best
    while node is not body and node.parent is not None and node.parent is not body and node.parent.density >= threshold:
        node = node.parent
    if 2 * node.chars < body.chars - body.link_chars:
        return body  # the article is in several places: what is no article was dropped by name
    return node


def _words(node: Node, threshold: float, top: Node) -> str:
    """The text below ``node``; blocks end words, inline elements do not."""
    out: list[str] = []
    stack: list[Node | str] = [node]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x)
            continue
        if x.drop or (
            x is not top and x.tag not in INLINE and x.tag not in ("p", "h1", "h2", "h3") and x.link_tags > 2
            and 2 * x.link_chars > x.chars and x.density < threshold
        ):
            out.append(" ")
            continue
        if x.tag not in INLINE:
            out.append(" ")
            stack.append(" ")
        stack.extend(reversed(x.inside))
    return " ".join("".join(out).split())


def main_text(page: str | None) -> str:
    """The article of a page: blocks in page order joined by one space, white space inside a
    block as one space. Empty for null and empty pages and for pages without text."""
    if not page:
        return ""
    root = parse(page)
    body = next((x for x in root.inside if isinstance(x, Node) and x.tag == "body"), root)
    nodes = _in_order(body)
    up, body.parent = body.parent, None
    _count(nodes)
    if body.chars == body.link_chars:  # a page of nothing but comments
        for node in _in_order(body, others=True):
            node.drop = node.drop and not node.other
        nodes = _in_order(body)
        _count(nodes)
    most = body.chars - body.link_chars
    big = max((n.chars - n.link_chars for n in nodes if n.tag in ("article", "main")), default=-1)
    for node in nodes:  # a word in a class must not cost the article itself
        if node.weak and big < 0:
            node.drop = 2 * node.chars <= most + 1
        elif node.weak:
            held = {x.tag for x in _in_order(node)}
            node.drop = "main" not in held and ("article" not in held or 2 * (node.chars - node.link_chars) < big)
    nodes = _in_order(body)
    _count(nodes)
    _weigh(nodes, body)
    top = _article(body, nodes)
    found = _words(top, body.density, top)
    body.parent = up
    return found


def extracted(df: DataFrame, page: str = "html") -> DataFrame:
    """``df`` without ``page``, with ``text`` and ``n_chars`` (its code points).

    Every page is read whole and on its own. Null pages give the empty text; repeated rows stay;
    columns of ``df`` called like the results are replaced.
    """

    def read(batch: pa.RecordBatch) -> list[pa.Array]:
        texts = [main_text(p) for p in batch.column(page).to_pylist()]
        return [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]

    return add_columns(df, "text string, n_chars long", read, drop=(page,))
