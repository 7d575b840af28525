"""Main text of web pages by scoring the tree.

Paragraphs give points for their length and commas to their ancestors, less with every generation
and discounted by the share of their text that is links. The article or main element
around the best container is kept, or the container with all beside it that reads on; what is not
the article is left out of it.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalflow.llm.common import string_batches, text_of

# fixed values: element names of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre "
    "search section summary table tbody td tfoot th thead tr ul caption option".split()
)
NOT_TEXT = frozenset(
    "head script style noscript template title iframe object embed svg math canvas audio video "
    "noembed noframes meta link".split()
)
CONTROLS = frozenset("button select option input textarea".split())
NOT_ARTICLE = frozenset("nav header footer aside form menu fieldset dialog search".split())
# what an opening element closes, and where the search for it stops
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
}
# words in class, id or role that mark what is not the article: parts of a layout, and other texts
_MARK = r"(?:^|[\s_-])(?:{})(?:$|[\s_-]|\d)"
LAYOUT = re.compile(
    _MARK.format(
        r"banner|sidebar|side-bar|widget|menu|nav|navbar|navigation|breadcrumbs?|pagination|pager|toc|header|"
        r"masthead|footer|notice|notices|alert|popup|modal|overlay|skip|search|toolbar|complementary|"
        r"contentinfo|dialog"
    ),
    re.I,
)
OTHER_TEXT = re.compile(
    _MARK.format(
        r"ads?|adverts?|advertisement|advertising|sponsor(?:ed)?|promo(?:tion)?|cookies?|consent|newsletter|"
        r"subscribe|signup|login|comments?|comment-list|commentlist|disqus|replies|responses|respond|"
        r"discussion|share|sharing|social|related|recommended|recommendations|outbrain|taboola|legal|gdpr"
    ),
    re.I,
)
_NO_WIDGET = re.compile(r"widget", re.I)
WANTED = re.compile(r"(?:^|[\s_-])(?:article|body|content|entry|main|page|post|story|text|blog)(?:$|[\s_-])", re.I)
BASE_POINTS = {"article": 30.0, "main": 20.0, "section": 3.0, "div": 5.0, "td": 3.0, "blockquote": 3.0, "pre": 3.0}

#: Marks of a layout are not heeded where they leave less than this share of the text without them.
LITTLE = 0.1

# a quote opens a value only after the equals sign; anywhere else it is a character like others
_MARKUP = re.compile(
    r"<!--(?P<comment>.*?)(?:--!?>|\Z)"
    r"|<(?P<other>[!?])[^>]*(?:>|\Z)"
    r"|</(?P<end>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<(?P<start>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>=]+|=\s*(?:\"[^\"]*\"|'[^']*')|=)*)(?:>|\Z)",
    re.S,
)
_NAMED = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_SPACES = re.compile(r"[\x20\x09-\x0D]+")


class Node:
    __slots__ = (
        "children", "doubt", "length", "linked", "marks", "name", "parent", "points", "titled", "unwanted", "weight"
    )

    def __init__(self, name: str, parent: Node | None, marks: str = "", hidden: bool = False):
        self.name, self.parent, self.marks = name, parent, marks
        self.children: list[Node | str] = []
        self.points = 0.0
        self.length = self.linked = 0
        self.weight = 0.0
        self.titled = False
        self.unwanted = hidden or name in NOT_TEXT or name in CONTROLS
        # what may be no part of the article, which settle() decides by content
        self.doubt = ""
        if marks and name not in ("html", "body", "article", "main"):
            self.doubt = "other" if OTHER_TEXT.search(marks) else "layout" if LAYOUT.search(marks) else ""
        if name in NOT_ARTICLE and self.doubt != "other":
            self.doubt = "name"


def parse(page: str) -> Node:
    """The tree of a page. Ends that are left out are put where HTML has them; an end without its
    start is passed over; markup that breaks off ends with the page."""
    root = Node("html", None)
    at_node, at, size = root, 0, len(page)
    open_names: Counter[str] = Counter()

    def up_to(node: Node, here: Node) -> Node:
        """`node`, an ancestor of `here` or itself, with all between them closed."""
        while here is not node:
            open_names[here.name] -= 1
            here = here.parent
        return node

    while at < size:
        match = _MARKUP.search(page, at)
        if match is None:
            at_node.children.append(html.unescape(page[at:]))
            break
        if match.start() > at:
            at_node.children.append(html.unescape(page[at : match.start()]))
        at = match.end()
        if name := match["start"]:
            name = name.lower()
            at_node = up_to(_opened(at_node, name, open_names), at_node)
            attributes = match["attributes"]
            marks = " ".join(a or b or c for a, b, c in _NAMED.findall(attributes)) if "=" in attributes else ""
            node = Node(name, at_node, marks, bool(attributes and _HIDDEN.search(attributes)))
            at_node.children.append(node)
            if name in RAW:
                end = re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
                inner = page[at : end.start() if end else size]
                if name in ("title", "textarea"):
                    node.children.append(html.unescape(inner))
                at = end.end() if end else size
            elif name not in VOID:
                at_node = node
                open_names[name] += 1
        elif open_names[name := match["end"].lower() if match["end"] else ""] > 0:
            at_node = up_to(_closed(at_node, name), at_node)
    return root


def _opened(node: Node, name: str, open_names: Mapping[str, int]) -> Node:
    """Where an element that begins here goes, after those are closed that it ends."""
    if name in BLOCKS and name != "option" and open_names["p"] > 0:
        node = _up_past(node, {"p"}, {"td", "th", "caption", "button", "object", "table"})
    if name in CLOSES and any(open_names[n] > 0 for n in CLOSES[name][0]):
        node = _up_past(node, *CLOSES[name])
    return node


def _up_past(node: Node, names: set[str], stops: set[str]) -> Node:
    out, here = node, node
    while here.parent is not None and here.name not in stops:
        if here.name in names:
            out = here.parent
        here = here.parent
    return out


def _closed(node: Node, name: str) -> Node:
    if name in ("body", "html"):
        return node
    here = node
    while here.parent is not None:
        if here.name == name:
            return here.parent
        if here.name in BLOCKS and name not in BLOCKS:
            return node  # an inline end does not close the block around it
        here = here.parent
    return node


def settle(root: Node, every: list[Node], *trusted: str) -> None:
    """Mark as unwanted the doubtful nodes that are not, and do not hold, the article.

    A form or a node marked as part of a layout stays if it holds most of the page's paragraph points,
    or has a mark of an article beside (with few links); one marked as another text only if it also
    holds the title or the article's element. Doubts of the `trusted` kinds do not count. `every` has
    the nodes that may be wanted at all, in page order.
    """
    for node in every:
        node.weight, node.titled, node.unwanted = 0.0, False, False
    _measure(root)
    for node in reversed(every):
        if _is_paragraph(node) and node.length:
            node.weight += _paragraph_points(node)
        if node.parent is not None:
            node.parent.weight += node.weight
            node.parent.titled |= node.titled or node.name in ("h1", "main") or (node.name == "article" and not _marked(node))
    for node in every:
        if not node.doubt or node.doubt in trusted:
            continue
        most = node.weight > 0.5 * root.weight
        if node.doubt == "other":
            node.unwanted = not (most and node.titled)
        else:
            node.unwanted = not (most or (node.doubt == "layout" and _also_wanted(node)))


def _marked(node: Node) -> bool:
    return bool(OTHER_TEXT.search(node.marks) or LAYOUT.search(node.marks))


def _also_wanted(node: Node) -> bool:
    """A mark of an article on its own, or on a widget, and few links."""
    if not node.length or node.linked > 0.25 * node.length:
        return False
    own = any(WANTED.search(m) and not LAYOUT.search(m) for m in node.marks.split())
    return own or bool(WANTED.search(node.marks) and not LAYOUT.search(_NO_WIDGET.sub("", node.marks)))


def _measure(root: Node) -> list[Node]:
    """Set lengths and linked lengths of what is not unwanted; those nodes in page order."""
    order: list[Node] = []
    stack = [root]
    while stack:
        node = stack.pop()
        if node.unwanted:
            continue
        order.append(node)
        node.length = node.linked = 0
        stack += [c for c in reversed(node.children) if isinstance(c, Node)]
    for node in reversed(order):
        for child in node.children:
            if isinstance(child, str):
                node.length += len(child.strip())
                node.linked += len(child.strip()) if node.name == "a" else 0
            elif not child.unwanted:
                node.length += child.length
                node.linked += child.length if node.name == "a" else child.linked
    return order


def _paragraph_points(node: Node) -> float:
    points = 1 + _commas(node) + min(node.length / 100, 3.0)
    return points * (1 - node.linked / node.length)


def score(root: Node) -> list[Node]:
    """Give points to all containers; the wanted nodes in page order."""
    order = _measure(root)
    for node in order:
        node.points = BASE_POINTS.get(node.name, 0.0)
        if node.marks and WANTED.search(node.marks):
            node.points += 25.0
    for node in order:
        if _is_paragraph(node) and node.length:
            points = _paragraph_points(node)
            above, share = node.parent, 1.0
            while above is not None and share > 0.1:
                above.points += points * share
                above, share = above.parent, share / 2
    return order


def _is_paragraph(node: Node) -> bool:
    """Text of its own: a paragraph, or a block that holds text beside or without other blocks."""
    if node.name in ("p", "pre", "blockquote"):
        return True
    return node.name in ("div", "section", "article", "main", "td", "li", "dd", "body", "form", "fieldset") and any(
        isinstance(c, str) and not c.isspace() and c for c in node.children
    )


def _commas(node: Node) -> int:
    total, stack = 0, [node]
    while stack:
        here = stack.pop()
        for c in here.children:
            if isinstance(c, str):
                total += c.count(",")
            elif not c.unwanted and not (c.name in BLOCKS):
                stack.append(c)
    return total


def kept_nodes(root: Node) -> list[Node]:
    """The article of a page as nodes in page order; none without text.

    That is the article or main element around the best container, or else the container with what
    reads on beside it and beside the nodes that hold it, up to one that stands among links.
    """
    order = score(root)

    def value(node: Node) -> float:
        return node.points * (1 - node.linked / node.length) if node.length else 0.0

    containers = [n for n in order if n.name in BLOCKS and n.length and n.name not in ("p", "html")]
    best = max(containers, key=value, default=None)
    if best is None:
        return [root] if root.length else []
    node: Node | None = best
    while node is not None and node.name != "article":
        node = node.parent
    if node is None:
        node = best
        while node is not None and node.name != "main":
            node = node.parent
    if node is not None:
        return [node]
    # no element of the article: what reads on beside the container, and beside what holds it
    out, here = [best], best
    while here.parent is not None and here.name != "body":
        around = _beside(here.parent)
        at = around.index(here)
        reading = [k for k, n in enumerate(around) if k == at or _reads_on(n)]
        out = [
            n
            for k in range(reading[0], reading[-1] + 1)
            for n in (out if k == at else [around[k]] if k in reading or _few_links(around[k]) else [])
        ]
        others = [n for n in around if n is not here]
        if sum(n.linked for n in others) >= 0.5 * max(sum(n.length for n in others), 1):
            break
        here = here.parent
    return out


def _beside(parent: Node) -> list[Node]:
    """The wanted blocks of a node in page order, and its other text between them as blocks."""
    out: list[Node] = []
    loose: Node | None = None
    for child in parent.children:
        if isinstance(child, Node) and child.name in BLOCKS:
            loose = None
            if not child.unwanted:
                out.append(child)
            continue
        if loose is None:
            loose = Node("p", parent)
            out.append(loose)
        loose.children.append(child)
        if isinstance(child, str):
            loose.length += len(child.strip())
        elif not child.unwanted:
            loose.length += child.length
            loose.linked += child.length if child.name == "a" else child.linked
    return [n for n in out if n.length]


def _few_links(node: Node) -> bool:
    return node.linked < 0.25 * node.length


def _reads_on(node: Node) -> bool:
    """Few links, and a heading, long text or a paragraph that ends as a sentence."""
    if not _few_links(node):
        return False
    if re.fullmatch("h[1-6]", node.name):
        return node.linked == 0
    stack = [node]
    while stack:
        here = stack.pop()
        own = [c for c in here.children if isinstance(c, Node) and not c.unwanted]
        if here.name in ("p", "pre", "blockquote") or _is_paragraph(here):
            if here.length > 80 or (here.linked == 0 and _ends_sentence(here)):
                return True
        if here is not node and re.fullmatch("h[1-6]", here.name) and here.length and not here.linked:
            return True
        stack += own
    return False


def _ends_sentence(node: Node) -> bool:
    while node.children:
        last = next((c for c in reversed(node.children) if not (isinstance(c, str) and not c.strip())), "")
        if isinstance(last, str):
            return last.rstrip(" \t\r\n\"'»”’)").endswith((".", "!", "?", "…", "。", "！", "？"))
        node = last
    return False


def blocks(node: Node) -> Iterator[str]:
    """Texts of the blocks below a node in page order, white space made one, empty ones left out."""
    pieces: list[str] = []
    out: list[str] = []

    def flush() -> None:
        text = _SPACES.sub(" ", "".join(pieces)).strip(" ")
        pieces.clear()
        if text:
            out.append(text)

    stack: list[tuple[Node | str, bool]] = [(node, False)]
    while stack:
        item, done = stack.pop()
        if done:
            flush()
        elif isinstance(item, str):
            pieces.append(item)
        elif item.name == "br":
            pieces.append(" ")
        elif not item.unwanted and not _only_links(item):
            if item.name in BLOCKS:
                flush()
                stack.append((item, True))
            stack += [(c, False) for c in reversed(item.children)]
    flush()
    return iter(out)


def _only_links(node: Node) -> bool:
    """A list or box of nothing but several links: a menu."""
    if node.name not in ("ul", "ol", "div", "section", "table") or not node.length:
        return False
    return node.linked >= 0.9 * node.length and node.linked > 0 and _links(node) > 1


def _links(node: Node) -> int:
    found, stack = 0, [node]
    while stack and found < 2:
        here = stack.pop()
        found += here.name == "a"
        stack += [c for c in here.children if isinstance(c, Node)]
    return found


def main_text(page: str) -> str:
    """The article of a page: its blocks, joined by one space; empty where there is none."""
    if not page:
        return ""
    root = parse(page)
    every = _measure(root)
    total, doubts = root.length, {node.doubt for node in every}
    first = _article(root, every)
    if len(first) >= LITTLE * total or not doubts & {"layout", "other"}:
        return first
    if not first:
        return _article(root, every, "layout") or _article(root, every, "layout", "other")
    whole = _article(root, every, "layout")
    return whole if len(first) < LITTLE * len(whole) else first


def _article(root: Node, every: list[Node], *trusted: str) -> str:
    settle(root, every, *trusted)
    return " ".join(text for node in kept_nodes(root) for text in blocks(node))


def extract_pages(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", markup: str = "html"
) -> DataFrame:
    """(page_id, url, text, n_chars) of every page.

    Null markup counts as empty, which has an empty text; so has a page without an article. A page
    without markup is its own text. Rows that repeat are extracted each; an empty table gives no
    rows; other columns are not read.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, markups in string_batches(batches, "markup"):
            texts = [main_text(m) for m in markups]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(
        F.col(page_id).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"), text_of(markup).alias("markup")
    )
    return rows.mapInArrow(work, "page_id long, url string, text string, n_chars long")
