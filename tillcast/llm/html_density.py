"""Main text of web pages by composite text density.

A page becomes a tree of its block elements; markup inside a block (bold, links, line breaks) belongs to the block.
Menus, headers and footers of the page, sidebars, notices, adverts, forms, comments, scripts and styles, by tag
or by the words of class, id and role, are taken out first. With C characters, T tags, LC characters and LT tags
in links below a node, and LC_b, C_b those of the body, the density of a node is

    C/T * log_b(C/LC * T/LT),   b = ln(C/(C-LC) * LC + LC_b/C_b * C + e)

(zero divisors count as 1). The density sum of a node adds the densities of its children. The node of
the largest density sum is the seed; the threshold is the smallest density on its path to the body. A seed inside an
`article` or `main` takes the whole of it, its lists of links too. From there the selection climbs towards the body
while each of the parent's other children reaches the threshold and is no list of links, or is a heading or running text
(`FLOW`) of few links, so a lead beside the text is not lost. Outside articles, lists of links are dropped.

Blocks are joined in page order by one line feed; white space in a block becomes one space. Character references are
decoded. Defined results: a null or empty html has an empty text; so has a page without text. Tags that are
not closed end with their parent. Repeated rows are extracted each; empty tables give empty tables.
"""

import math
import re
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import map_rows

# Fixed values of HTML: elements without content, elements of raw text, elements inside a line.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp", "noframes"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd",
    "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt",
    "u", "var", "wbr",
}
# Start tags that end an open paragraph, and elements that end an open one of their own kind.
ENDS_P = {
    "address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figcaption", "figure", "footer", "form",
    "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul",
}
SELF_ENDING = {
    "li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"},
    "option": {"select"},
}
# What is never main text, by tag and by words of class, id and role.
NEVER = {
    "nav", "footer", "aside", "form", "button", "select", "input", "dialog", "menu", "svg", "canvas", "object", "audio",
    "video", "head",
}
AWAY = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner|breadcrumbs?|comments?|cookies?|consent|disqus|footer|gdpr|login|masthead|menu|"
    r"modal|nav|navbar|navigation|newsletter|notices?|pagination|popup|promo\w*|related|replies|search|share|sharing|sidebar|"
    r"signup|social|sponsor\w*|subscribe|toolbar|topbar|widget|complementary|contentinfo)(?:$|[\s_-])",
    re.I,
)
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# Running text, which belongs to an article wherever it stands beside it.
FLOW = {"p", "blockquote", "pre", "figure", "ul", "ol", "dl", "table"}
_ATTRIBUTE = r"([^\s=\"'<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'<>]+)))?"
_WHOLE = r"[^\s=\"'<>/]+(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'<>]+))?"
# A tag with whole attributes; else, as after an odd quote, up to the next ">".
_TAG = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>"
    rf"|<(/?)([a-zA-Z][^\s/>]*)((?:[\s/]++(?:{_WHOLE})?+)*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S
)
_ATTRIBUTES = re.compile(_ATTRIBUTE)
_READ = {"class", "id", "role", "hidden", "aria-hidden", "style"}
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    __slots__ = ("tag", "parent", "parts", "away", "inner_tags", "links", "link_chars", "chars", "tags", "density", "sum")

    def __init__(self, tag, parent, away=False):
        self.tag, self.parent, self.away = tag, parent, away
        self.parts = []  # text (str) and block children (Node), in page order
        self.inner_tags = self.links = self.link_chars = 0

    def children(self):
        return [p for p in self.parts if isinstance(p, Node)]


def _is_away(tag, attributes, inside_article):
    if tag in NEVER or tag == "header" and not inside_article:
        return True
    if not attributes:
        return False
    for name, *values in _ATTRIBUTES.findall(attributes):
        name = name.lower()
        if name not in _READ:
            continue
        value = unescape("".join(values))
        if name in ("class", "id", "role") and tag not in ("body", "html", "article", "main") and AWAY.search(value):
            return True
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and _HIDDEN.search(value):
            return True
    return False


def parse(html: str) -> Node:
    """Tree of block elements. Elements taken out stay in it, marked, so that tags close where they should."""
    root = Node("body", None)
    open_tags = [("body", root)]  # all open elements with the block they are in
    at, link_depth = 0, 0

    def text(piece):
        node = open_tags[-1][1]
        if piece:
            piece = unescape(piece)
            node.parts.append(piece)
            if link_depth:
                node.link_chars += len(piece) - sum(map(str.isspace, piece))

    def close(index):
        nonlocal link_depth
        link_depth -= sum(tag == "a" for tag, _ in open_tags[index:])
        del open_tags[index:]

    while found := _TAG.search(html, at):
        text(html[at : found.start()])
        at = found.end()
        groups = found.groups()
        slash, tag, attributes = groups[:3] if groups[1] else groups[3:]
        if tag is None:
            continue
        tag = tag.lower()
        if slash:
            for index in range(len(open_tags) - 1, 0, -1):
                if open_tags[index][0] == tag:
                    close(index)
                    break
                # An end tag inside a line does not close the block around the line.
                if tag in INLINE and open_tags[index][0] not in INLINE:
                    break
            continue
        if tag in RAW and not attributes.endswith("/"):
            # Nothing in here is main text; a title belongs to the head.
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
            at = end.end() if end else len(html)
            continue
        if tag in ("html", "body"):
            continue
        if tag in ENDS_P:
            for index in range(len(open_tags) - 1, 0, -1):
                if open_tags[index][0] == "p":
                    close(index)
                    break
                if open_tags[index][0] not in INLINE:
                    break
        for index in range(len(open_tags) - 1, 0, -1) if tag in SELF_ENDING else ():
            if open_tags[index][0] == tag:
                close(index)
                break
            if open_tags[index][0] in SELF_ENDING[tag]:
                break
        block = open_tags[-1][1]
        away = _is_away(tag, attributes, any(t in ("article", "main") for t, _ in open_tags))
        if tag in INLINE and not away:
            block.inner_tags += 1
            if tag == "a":
                block.links += 1
                link_depth += 1
            open_tags.append((tag, block))
            continue
        if tag in VOID:
            block.inner_tags += 1
            block.parts.append(" ")
            continue
        node = Node(tag, block, away)
        block.parts.append(node)
        if not attributes.endswith("/"):
            open_tags.append((tag, node))
    text(html[at:])
    return root


def _lines(node: Node, drop) -> list[str]:
    """Text of the blocks below a node. Text around a child block is a block of its own."""
    out, run, stack = [], [], [iter(node.parts)]

    def flush():
        line = " ".join("".join(run).split())
        if line:
            out.append(line)
        run.clear()

    while stack:
        part = next(stack[-1], None)
        if part is None:
            flush()
            stack.pop()
        elif isinstance(part, str):
            run.append(part)
        else:
            flush()
            if not part.away and part not in drop:
                stack.append(iter(part.parts))
    flush()
    return out


def _count(root: Node) -> list[Node]:
    """Nodes that may be main text, parents first, with their sums."""
    nodes, stack = [], [root]
    while stack:
        node = stack.pop()
        nodes.append(node)
        stack.extend(c for c in node.children() if not c.away)
    for node in reversed(nodes):
        own = "".join(p for p in node.parts if isinstance(p, str))
        node.chars, node.tags = len("".join(own.split())), node.inner_tags
        for child in node.children():
            if not child.away:
                node.chars += child.chars
                node.tags += child.tags + 1
                node.link_chars += child.link_chars
                node.links += child.links
    ratio = root.link_chars / (root.chars or 1)
    for node in nodes:
        chars, tags, linked = node.chars, node.tags or 1, node.link_chars
        if not chars:
            node.density = 0.0
        else:
            base = math.log(chars / ((chars - linked) or 1) * linked + ratio * chars + math.e)
            value = (chars / (linked or 1)) * (tags / (node.links or 1))
            node.density = chars / tags * max(0.0, math.log(value) / math.log(base) if base > 1 else math.log(value))
    for node in nodes:
        node.sum = sum(c.density for c in node.children() if not c.away)
    return nodes


def _link_list(node: Node) -> bool:
    return node.tag in ("ul", "ol", "div", "table", "dl") and node.links > 1 and 2 * node.link_chars > node.chars


def _below(node: Node) -> set[Node]:
    """The node and all nodes below it."""
    found, stack = set(), [node]
    while stack:
        node = stack.pop()
        found.add(node)
        stack.extend(node.children())
    return found


def extract(html: str | None) -> str:
    """Main text of a page."""
    if not html:
        return ""
    root = parse(html)
    nodes = _count(root)
    seed = max(nodes, key=lambda n: (n.sum, n.chars))
    path = [seed]
    while path[-1].parent is not None:
        path.append(path[-1].parent)
    threshold = min(n.density for n in path)
    top = seed
    for kind in ("main", "article"):  # the outermost article, else main
        top = next((n for n in reversed(path) if n.tag == kind), top)
    held = top if top.tag in ("main", "article") else None

    def belongs(node):
        if _link_list(node):
            return False
        return node.tag in HEADINGS or node.density >= threshold or node.tag in FLOW and 2 * node.link_chars <= node.chars

    while top.parent is not None:
        others = [c for c in top.parent.children() if c is not top and not c.away and c.chars]
        if not all(map(belongs, others)):
            break
        top = top.parent
    inside = set() if held is None else _below(held)
    return "\n".join(_lines(top, {n for n in nodes if _link_list(n) and n is not top and n not in inside}))


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row."""

    def make():
        get = extract

        def each(page_id, url, html):
            text = get(html)
            yield page_id, url, text, len(text)

        return each

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return map_rows(rows, make, page_id="long", url="string", text="string", n_chars="long")
