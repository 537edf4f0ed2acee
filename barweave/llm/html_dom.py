"""A small DOM of block elements and runs of text, and the features of its nodes."""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict

import numpy as np

# Fixed values of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title", "template", "noscript", "svg", "iframe", "select")
BLOCKS = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: A start tag of the key closes an open element of the value, up to an element of SCOPE.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}}
CLOSES |= {"td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"tr", "td", "th", "thead"}}
SCOPE = {"ul", "ol", "dl", "table", "body", "html", "article", "section", "div", "main", "nav"}

#: Attribute tokens that speak for content and for boilerplate.
CONTENT = "article body content entry main post story text page".split()
BOILER = (
    "ad ads advert advertisement aside banner bar breadcrumb breadcrumbs byline comment comments "
    "consent cookie copyright dialog discussion disqus feedback foot footer form gdpr head header "
    "login masthead menu meta modal nav navbar navigation newsletter notice pager pagination popup "
    "privacy promo promotion recommended related replies reply respond rss search share sharing "
    "sidebar signup site skip social sponsor sponsored subscribe tags teaser toc toolbar tools "
    "warning alert widget widgets".split()
)
_CONTENT, _BOILER = set(CONTENT), set(BOILER)

_MARK = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)

TEXT = "#text"


class Node:
    __slots__ = ("tag", "parent", "children", "good", "bad", "text", "links", "hidden")

    def __init__(self, tag: str, parent: Node | None):
        self.tag, self.parent = tag, parent
        self.children: list[Node] = []
        self.good = self.bad = 0
        self.text, self.links, self.hidden = "", 0, False
        if parent is not None:
            parent.children.append(self)


def _attributes(node: Node, raw: str) -> None:
    for name, value in _ATTRIBUTE.findall(raw):
        name = name.lower()
        value = value.strip("\"'")
        if name in ("class", "id", "role", "itemprop", "aria-label"):
            tokens = {t.lower() for t in _TOKEN.findall(html.unescape(value))}
            node.good += len(tokens & _CONTENT)
            node.bad += len(tokens & _BOILER)
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            node.hidden = True
        elif name == "style" and _HIDDEN.search(value):
            node.hidden = True


def parse(page: str) -> Node:
    """The page's block elements; each run of text between block borders is a leaf. Elements whose
    text is never shown as prose, comments and markup are left out; end tags that are missing or
    cross each other close what they can."""
    root = Node("html", None)
    stack = [root]  # open elements, inline ones as (name, None)
    names: list[str] = ["html"]
    opened: defaultdict[str, list[int]] = defaultdict(list)  # of each name, its places
    parts: list[str] = []
    linked = links = 0

    def flush() -> None:
        nonlocal links
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text:
            node = Node(TEXT, stack[-1])
            node.text, node.links = text, min(links, len(text))
        links = 0

    def close(at: int) -> None:
        """Closes the open elements from place ``at`` on."""
        nonlocal linked
        for name in names[at:]:
            opened[name].pop()
            if name in BLOCKS:
                stack.pop()
            elif name == "a":
                linked = max(0, linked - 1)
        del names[at:]

    def push(name: str) -> None:
        opened[name].append(len(names))
        names.append(name)

    def place_of(wanted: set[str]) -> int:
        return max((opened[name][-1] for name in wanted if opened[name]), default=0)

    def last(wanted: set[str], stop: set[str] = frozenset()) -> int:
        """The place of the last open element of those wanted, 0 if one to stop at is nearer."""
        place = place_of(wanted)
        return place if place >= place_of(stop) else 0

    at = 0
    while at < len(page):
        found = _MARK.search(page, at)
        if found is None:
            parts.append(page[at:])
            break
        if found.start() > at:
            run = page[at : found.start()]
            parts.append(run)
            if linked:
                links += len(run.strip())
        at = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue
        if found[1]:
            place = last({name})
            if name in BLOCKS:
                flush()
            elif name == "br":
                parts.append(" ")
            if place:
                close(place)
            continue
        if name in RAW and not found[3].rstrip().endswith("/"):
            end = re.compile(rf"</{name}\b[^>]*>", re.IGNORECASE).search(page, at)
            at = end.end() if end else len(page)
            continue
        if name in ("html", "body", "head"):
            if name == "body":
                flush()
            continue
        if name not in BLOCKS:
            if name in ("br", "img", "input", "wbr"):
                parts.append(" " if name == "br" else "")
            elif name not in VOID:
                push(name)
                linked += name == "a"
            continue
        flush()
        if place := last({"p"}, {"button", "td", "th", "table", "li"}):
            close(place)
        if name in CLOSES and (place := last(CLOSES[name], SCOPE)):
            close(place)
        if name == "hr":
            continue
        node = Node(name, stack[-1])
        if found[3]:
            _attributes(node, found[3])
        stack.append(node)
        push(name)
    flush()
    return root


TAGS = [
    {"p", "blockquote", "pre"},
    {"article"},
    {"main"},
    {"nav", "menu"},
    {"header"},
    {"footer"},
    {"aside"},
    {"form", "fieldset"},
    {"ul", "ol", "dl", "li", "dt", "dd"},
    {"h1", "h2", "h3", "h4", "h5", "h6"},
    {"table", "tr", "td", "th", "tbody"},
    {"div", "section"},
    {"figure", "figcaption"},
    {TEXT},
]
_KIND = {tag: at for at, tags in enumerate(TAGS) for tag in tags}
#: Elements that hold no article by themselves, wherever they stand.
_APART = {"nav", "menu", "header", "footer", "aside", "form", "dialog"}
N_FEATURES = 2 * len(TAGS) + 27


def features(root: Node) -> tuple[list[Node], np.ndarray, np.ndarray]:
    """All nodes in page order (each before its children), their features, and the index of each
    node's parent (-1 for the root)."""
    nodes: list[Node] = []
    parent, depth, place = [], [], []
    waiting = [(root, -1, 0, 0)]
    while waiting:
        node, above, level, index = waiting.pop()
        if node.hidden:
            continue
        here = len(nodes)
        nodes.append(node)
        parent.append(above)
        depth.append(level)
        place.append(index)
        for number in range(len(node.children) - 1, -1, -1):
            waiting.append((node.children[number], here, level + 1, number))
    n = len(nodes)
    chars, links, marks, words, blocks, below, paras = (np.zeros(n) for _ in range(7))
    before, after = np.zeros(n), 0.0
    for at, node in enumerate(nodes):
        before[at] = after
        if node.tag == TEXT:
            text = node.text
            chars[at], links[at] = len(text), node.links
            words[at], blocks[at] = text.count(" ") + 1, 1
            marks[at] = text.count(".") + text.count(",") + text.count("?") + text.count("!")
            after += len(text)
        elif node.tag == "p":
            paras[at] = 1
    for at in range(n - 1, 0, -1):
        up = parent[at]
        for sums in (chars, links, marks, words, blocks, paras):
            sums[up] += sums[at]
        below[up] += below[at] + 1
    total = max(after, 1.0)
    out = np.zeros((n, N_FEATURES))
    tags: dict[int, Counter[str]] = {-1: Counter([root.tag])}
    for at, node in enumerate(nodes):
        up = parent[at]
        if up not in tags:
            tags[up] = Counter(child.tag for child in nodes[up].children)
        row = out[at]
        kind = _KIND.get(node.tag)
        if kind is not None:
            row[kind] = 1
        if up >= 0:
            over = nodes[up]
            row[len(TAGS) : 2 * len(TAGS)] = out[up][: len(TAGS)]
            if over.tag == TEXT:
                raise AssertionError("text has no children")
        rest = row[2 * len(TAGS) :]
        above = out[up][2 * len(TAGS) :] if up >= 0 else np.zeros(27)
        siblings = nodes[up].children if up >= 0 else [node]
        rest[0] = np.log1p(chars[at])
        rest[1] = links[at] / max(chars[at], 1)
        rest[2] = chars[at] / (below[at] + 1)
        rest[3] = marks[at] / max(words[at], 1)
        rest[4] = words[at] / max(blocks[at], 1)
        rest[5] = np.log1p(paras[at])
        rest[6] = chars[at] / total
        rest[7] = before[at] / total
        rest[8] = depth[at]
        rest[9] = place[at] / len(siblings)
        rest[10] = np.log1p(len(siblings))
        rest[11] = tags[up][node.tag] / len(siblings)
        rest[12] = min(node.good, 3)
        rest[13] = min(node.bad, 3)
        rest[14] = above[14] + min(node.good, 3)  # on the way from the root
        rest[15] = above[15] + min(node.bad, 3)
        rest[16] = above[16] + (node.tag in _APART)
        rest[17] = above[17] + (node.tag in ("article", "main"))
        rest[18] = above[0]
        rest[19] = above[1]
        rest[20] = above[6]
        rest[21] = np.log1p(below[at])
        rest[22] = node.text[-1:] in ".!?" if node.tag == TEXT else 0
        rest[23] = above[12]
        rest[24] = above[13]
        rest[25] = above[2]
        rest[26] = np.log1p(words[at])
    return nodes, out, np.array(parent)
