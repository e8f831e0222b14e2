"""Main text of web pages by composite text density.

A page becomes a small tree of elements; scripts, styles, forms, and elements that tags, roles or
class names mark as navigation, adverts, notices or comments are left out. A mark that would take nearly
all text of the page is no use as one and is lifted, so that a form around the page or a telling name on
the article's own element does not lose it. Every node gets its
characters per tag, adjusted for links: link text and link tags lower it, more so on pages whose
text is mostly links. A node's sum of its children's densities says how much dense text it holds
together; the subtree with the largest sum is the article, and of the rest of the body those
subtrees count whose density reaches the least density on the path from the article up to the body.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot "
    "th thead tr ul".split()
)
DROPPED = frozenset(
    "head title script style noscript template iframe object svg math canvas audio video nav header footer aside form "
    "button select option textarea input label fieldset dialog menu".split()
)
RAW = frozenset("script style textarea title noscript iframe template xmp".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising sponsor sponsored promo promotion banner "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead footer sidebar sidebars aside rail widget "
    "widgets cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe "
    "subscription signup login comment comments disqus respond reply replies related recommended share sharing "
    "social pagination pager form search hidden".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Marked by these, an element never holds the article, whatever its text.
NEVER = frozenset("head title script style noscript template iframe object svg math canvas audio video nav footer aside button select option textarea input menu dialog".split())
#: A mark is lifted if the text outside all marks is less than this part of the text under it.
OUTSIDE = 0.25
#: Share of the path's least density that a subtree beside the path needs.
SLACK = 0.2
P_ENDERS = BLOCKS - {"html", "body", "td", "th", "caption"}
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*(?:\"[^\"]*\"|'[^']*')?+)*?)(?:>|\Z)|<[!?][^>]*(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
BLANKS = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "parts", "chars", "links", "tags", "link_tags", "density", "total", "dropped")

    def __init__(self, tag: str, dropped: bool):
        self.tag, self.dropped = tag, dropped
        self.parts: list = []  # texts and nodes, in page order
        self.chars = self.links = self.tags = self.link_tags = 0
        self.density = self.total = 0.0


def _marked(tag: str, attributes: str) -> bool:
    """Whether tag, role, class, id or state say that this is not the article."""
    if tag in DROPPED:
        return True
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next((v for v in values if v), "")
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "role" and value.lower() in ROLES:
            return True
        if name in ("class", "id") and any(w.lower() in MARKS for w in NAME.findall(value)):
            return True
        if name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return True
    return False


def parse(page: str) -> Node:
    """The tree of a page; elements that end is missing for are closed as browsers do."""
    root = Node("html", False)
    stack, at, n = [root], 0, len(page)

    def text(value: str) -> None:
        if value:
            stack[-1].parts.append(html.unescape(value))

    def close(down_to: int) -> None:
        del stack[max(down_to, 1) :]

    while at < n:
        found = TOKEN.search(page, at)
        if not found:
            text(page[at:])
            break
        text(page[at : found.start()])
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag or tag in ("html", "body"):
            if tag and not found[1]:
                close(1)
            continue
        if found[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    close(k)
                    break
                if tag not in BLOCKS and stack[k].tag in BLOCKS:
                    break  # an inline end does not close a block
            continue
        if tag in P_ENDERS:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    close(k)
                    break
                if stack[k].tag in BLOCKS:
                    break
        if tag in CLOSES:
            same, outer = CLOSES[tag]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in outer:
                    break
                if stack[k].tag in same:
                    close(k)
                    if tag != "tr":
                        break
        node = Node(tag, _marked(tag, found[3]))
        stack[-1].parts.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            if not node.dropped and tag != "template":
                node.parts.append(page[at : end.start() if end else n])
            at = end.end() if end else n
        elif tag not in VOID and not found[3].endswith("/"):
            stack.append(node)
    return root


def _lift_marks(root: Node) -> None:
    """Take the mark from the largest marked subtree as long as there is hardly any text outside of marks.

    A page with an ``article`` or ``main`` outside of them keeps its marks.
    """
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        if node.tag not in NEVER:
            order.append(node)
            todo += [c for c in node.parts if isinstance(c, Node)]
    if not any(n.dropped for n in order):
        return
    size: dict[int, int] = {}
    for node in reversed(order):
        size[id(node)] = sum(size.get(id(p), 0) if isinstance(p, Node) else len(p) - sum(map(len, BLANKS.findall(p))) for p in node.parts)
    while True:
        marked, todo = [], [root]
        while todo:
            for c in todo.pop().parts:
                if isinstance(c, Node) and id(c) in size:
                    if not c.dropped and c.tag in ("article", "main") and size[id(c)]:
                        return
                    (marked if c.dropped else todo).append(c)
        largest = max(marked, key=lambda n: size[id(n)], default=None)
        if largest is None or size[id(root)] - sum(size[id(n)] for n in marked) >= OUTSIDE * size[id(largest)]:
            return
        largest.dropped = False


def _measure(root: Node) -> None:
    """Counts and densities of all nodes, children before parents."""
    order, todo = [], [(root, False)]
    while todo:
        node, inside = todo.pop()
        order.append((node, inside))
        todo += [(c, inside or node.tag == "a") for c in node.parts if isinstance(c, Node) and not c.dropped]
    for node, inside in reversed(order):
        link = inside or node.tag == "a"
        for part in node.parts:
            if isinstance(part, Node):
                if not part.dropped:
                    node.chars += part.chars
                    node.links += part.links
                    node.tags += part.tags + 1
                    node.link_tags += part.link_tags + (part.tag == "a")
            else:
                size = len(part) - sum(map(len, BLANKS.findall(part)))
                node.chars += size
                node.links += size * link
    whole = root.links / root.chars if root.chars else 0.0
    for node, _ in reversed(order):
        chars, links = node.chars, max(node.links, 1)
        if chars:
            tags, link_tags = max(node.tags, 1), max(node.link_tags, 1)
            plain = max(chars - node.links, 1)
            base = math.log(chars / plain * links + whole * chars + math.e)
            share = max(chars / links * tags / link_tags, 1.0)
            node.density = chars / tags * math.log(share) / math.log(base) if base > 1 and share > 1 else 0.0
        # paragraphs do not hold blocks: their inline children do not make them candidates
        node.total = sum(c.density for c in node.parts if isinstance(c, Node) and not c.dropped and c.tag in BLOCKS)


def _children(node: Node) -> list[Node]:
    return [c for c in node.parts if isinstance(c, Node) and not c.dropped and c.chars]


def _chosen(root: Node) -> list[Node]:
    """The article's subtree, and what beside it is as dense as the path from it to the body asks.

    An ``article`` or ``main`` around the densest subtree is taken whole, and so are headings beside
    the path.
    """
    best, above, todo = root, {}, [root]
    while todo:
        node = todo.pop()
        if node.total > best.total:
            best = node
        for c in _children(node):
            above[id(c)] = node
            todo.append(c)
    path, article = [best], None
    while id(path[-1]) in above:
        if path[-1].tag == "article" or path[-1].tag == "main" and article is None:
            article = path[-1]
        path.append(above[id(path[-1])])
    threshold = SLACK * min(n.density for n in path)
    if article is not None:
        path = path[path.index(article) :]
    on_path, chosen, todo = set(map(id, path[1:])), [], [root]
    while todo:
        node = todo.pop()
        if id(node) in on_path:
            todo += reversed(_children(node))
        elif node is path[0] or node.tag in HEADINGS and 2 * node.links < node.chars or node.density > 0 and node.density >= threshold:
            chosen.append(node)
    return chosen


def main_text(page: str | None) -> str:
    """The blocks of the main text, blanks squeezed, joined by an empty line."""
    if not page:
        return ""
    root = parse(page)
    _lift_marks(root)
    _measure(root)
    blocks, current = [], []

    def flush() -> None:
        block = BLANKS.sub(" ", "".join(current)).strip()
        current.clear()
        if block:
            blocks.append(block)

    for top in _chosen(root):
        flush()
        todo: list = [top]
        while todo:
            part = todo.pop()
            if part is None:
                flush()
            elif isinstance(part, str):
                current.append(part)
            elif part.tag == "br":
                current.append(" ")
            elif not part.dropped:
                block = part.tag in BLOCKS
                if block:
                    flush()
                    todo.append(None)
                todo += reversed(part.parts)
    flush()
    return "\n\n".join(blocks)


def extract_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per page: (page_id, url, text, n_chars), from the whole html.

    A null or empty page, and one without any text, gives an empty text. Ids and addresses are passed
    on, null or not; repeated rows give repeated rows. Other columns are not read.
    """
    pages = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                texts = [main_text(page.as_py()) for page in part.column("html")]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    return pages.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
