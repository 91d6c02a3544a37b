"""Main text of web pages by tree scoring.

Paragraphs give points to their parent and half as many to its parent: one, one more for each comma,
and up to three for length.  A container's points are discounted by the share of its text that
stands in links.  The best container is kept, with those siblings that score well or read
like text; inside, subtrees that are plainly no article (menus, forms, notices, comments) go.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed lists of element names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp".split())
#: Ordinary elements that hold no article: skipped to their own closing tag; one left open is taken as empty.
SKIPPED = frozenset("template svg math object canvas audio video".split())
FOREIGN = frozenset(("svg", "math"))
DROPPED = RAW | SKIPPED | frozenset("head nav header footer aside form button select option label fieldset dialog menu".split())
BLOCK = frozenset("address article blockquote body center dd details div dl dt figcaption figure h1 h2 h3 h4 h5 h6 hr html li main ol p pre section summary table tbody td tfoot th thead tr ul caption".split())
PARAGRAPHS = frozenset("p pre td blockquote dd li".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An open element on the left ends when one on the right begins.
CLOSED_BY = {
    "p": BLOCK - frozenset(("html", "body")) | DROPPED & frozenset("nav header footer aside form fieldset menu".split()),
    "li": frozenset(["li"]),
    "dt": frozenset(("dt", "dd")),
    "dd": frozenset(("dt", "dd")),
    "tr": frozenset(("tr", "tbody", "tfoot", "thead")),
    "td": frozenset(("td", "th", "tr", "tbody", "tfoot")),
    "th": frozenset(("td", "th", "tr", "tbody", "tfoot")),
    "option": frozenset(("option", "optgroup")),
}
#: An element that begins ends no open element outside of these.
SCOPE = frozenset("table ul ol dl div article section main body html td th blockquote".split())
_NOISE = re.compile(r"(?i)(?:^|[\s_-])(?:ads?|adverts?|advertisement|adsense|banners?|sponsor(?:ed)?|promo(?:tion)?s?|nav|navbar|navigation|menu|breadcrumbs?|sidebar|side|widgets?|footer|masthead|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|share|sharing|social|related|recommended|comments?|commentlist|disqus|respond|replies|reply|pagination|pager|toolbar|skip|copyright|disclaimer)(?=$|[\s_-])")
_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
#: As in browsers, a quote in a tag counts after "=" only.
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:=\s*+(?:\"[^\"]*+\"|'[^']*+')|[^>])*+)>|([^<]+)|(<)", re.S)
_CUT = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9:-]*)([^>]*)>")
_ATTR = re.compile(r"([A-Za-z_:][-\w:.]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|(?<=\s)(hidden)(?=[\s/]|$)")
_HIDDEN = re.compile(r"(?i)display\s*:\s*none|visibility\s*:\s*hidden")


class Node:
    __slots__ = ("name", "parent", "items", "noise", "main", "score", "size", "linked")

    def __init__(self, name: str, parent: Node | None) -> None:
        self.name, self.parent, self.items = name, parent, []
        self.noise = self.main = False
        self.score, self.size, self.linked = 0.0, 0, 0


def _marked(node: Node, attrs: str) -> None:
    """Whether the attributes say that an element is noise, or the article."""
    for m in _ATTR.finditer(attrs):
        name, value = (m[1] or m[5]).lower(), next((g for g in m.groups()[1:4] if g is not None), "")
        if name in ("class", "id"):
            node.noise |= bool(_NOISE.search(value)) and node.name not in ("html", "body", "article", "main")
        elif name == "role":
            node.noise |= value.lower() in _ROLES
            node.main |= value.lower() in ("main", "article")
        elif name == "itemprop":
            node.main |= value.lower() == "articlebody"
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and _HIDDEN.search(value):
            node.noise = True


def _closings(page: str, name: str) -> dict[int, int]:
    """Start of each element of a name that has a closing tag of its own, to the end of that tag."""
    found, left = {}, []
    for m in re.compile(rf"<(/?){name}(?=[\s/>])(?:=\s*+(?:\"[^\"]*+\"|'[^']*+')|[^>])*+>", re.I).finditer(page):
        if m[1]:
            if left:
                found[left.pop()] = m.end()
        elif name not in FOREIGN or not m[0].endswith("/>"):
            left.append(m.start())
    return found


def parse(page: str) -> Node:
    """The tree of a page; text and elements stand in ``items``.  Unclosed and misplaced tags are mended as browsers do, roughly."""
    root = Node("html", None)
    node, at, end = root, 0, len(page)
    closed: dict[str, dict[int, int]] = {}
    while at < end:
        m = _TOKEN.match(page, at)
        if not m:  # cannot be: the last alternative takes any "<"
            break
        start, at = at, m.end()
        if m[4] is not None:
            node.items.append(m[4])
            continue
        if m[5] is not None:
            cut = page[at : at + 1] in ("/", "!", "?") or page[at : at + 1].isascii() and page[at : at + 1].isalpha()
            if not cut:
                node.items.append("<")
                continue
            if (close := page.find(">", at)) < 0:
                break  # the page's end cuts the tag off
            m, at = _CUT.match(page, at - 1), close + 1
            if not m:  # a comment to browsers
                continue
        if m[2] is not None:
            name = m[2].lower()
            if m[1]:
                up = node
                while up.parent and up.name != name:
                    up = up.parent
                if up.parent:
                    node = up.parent
                elif name in ("p", "br"):
                    node.items.append(Node(name, node))
                continue
            if name in ("html", "body"):
                continue
            up = node
            while up.parent:
                if name in CLOSED_BY.get(up.name, ()):
                    node = up.parent
                    break
                if up.name in SCOPE:
                    break
                up = up.parent
            child = Node(name, node)
            node.items.append(child)
            child.noise = name in DROPPED
            child.main = name in ("article", "main")
            if m[3]:
                _marked(child, m[3])
            if name in RAW:
                close = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(page, at)
                at = close.end() if close else end
            elif name in SKIPPED:
                if name not in closed:
                    closed[name] = _closings(page, name)
                at = closed[name].get(start, at)
            elif name not in VOID and not m[3].endswith("/"):
                node = child
    return root


def _in_article(node: Node) -> bool:
    up = node.parent
    while up:
        if up.main:
            return True
        up = up.parent
    return False


def _clean(text: str) -> str:
    return " ".join(html.unescape(text).split())


def _walk(root: Node) -> list[Node]:
    """All elements outside noise, parents first."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo += [c for c in reversed(node.items) if isinstance(c, Node) and not c.noise]
    return out


def _inline_text(node: Node) -> str:
    """Text of an element up to the blocks in it."""
    out, todo = [], list(reversed(node.items))
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            out.append(item)
        elif item.name == "br":
            out.append(" ")
        elif not item.noise and item.name not in BLOCK:
            todo += reversed(item.items)
    return "".join(out)


def _score(nodes: list[Node]) -> None:
    for node in reversed(nodes):  # children first
        for item in node.items:
            if isinstance(item, str):
                node.size += len(item.strip())
            elif not item.noise:
                node.size += item.size
                node.linked += item.size if item.name == "a" else item.linked
    for node in nodes:
        paragraph = node.name in PARAGRAPHS or node.name in ("div", "section", "article", "main", "center", "html") and any(isinstance(i, str) and i.strip() for i in node.items)
        if not paragraph:
            continue
        text = _clean(_inline_text(node))
        if not text:
            continue
        points = 1 + text.count(",") + text.count("،") + text.count("，") + text.count("、") + min(len(text) / 100, 3)
        if len(text) < 25:
            points *= 0.2
        if node.size:
            points *= 1 - node.linked / node.size
        holder = node.parent if node.name in PARAGRAPHS and node.parent else node
        holder.score += points
        if holder.parent:
            holder.parent.score += points / 2


def _value(node: Node) -> float:
    return node.score * (1 - node.linked / node.size if node.size else 1)


def _article(node: Node) -> Node:
    """The nearest article, or else the main element, that an element stands in; the element itself where there is none.

    All that such an element holds outside noise is the text: short sections, lists and tables as well.
    """
    main, at = None, node
    while at is not None:
        if at.name == "article":
            return at
        if main is None and (at.main or at.name == "main"):
            main = at
        at = at.parent
    return main or node


def _only_headings(node: Node) -> bool:
    """Whether all text of an element stands in headings."""
    todo, found = [node], False
    while todo:
        for item in todo.pop().items:
            if isinstance(item, str):
                if item.strip():
                    return False
            elif item.name in HEADINGS:
                found = True
            elif not item.noise:
                todo.append(item)
    return found


def _kept(root: Node) -> list[Node]:
    """The best container and the siblings that go with it, in page order."""
    nodes = _walk(root)
    _score(nodes)
    containers = [n for n in nodes if n.name not in PARAGRAPHS and n.name not in HEADINGS and n.score > 0]
    if not containers:
        return [root]
    best = max(containers, key=_value)
    while best.parent and best.name in ("tr", "tbody", "table", "ul", "ol", "dl", "figure", "b", "i", "em", "strong", "span", "a", "font"):
        best = best.parent
    best = _article(best)
    if best.parent is None:
        return [best]
    least = max(10.0, 0.2 * _value(best))
    out = []
    for item in best.parent.items:
        if item is best:
            out.append(item)
        elif isinstance(item, Node) and not item.noise and item.size:
            dense = item.linked / item.size
            text = item.name in PARAGRAPHS and (item.size > 80 and dense < 0.25 or item.size and dense == 0 and item.name == "p")
            listed = item.name in ("ul", "ol", "dl", "table", "figure") or any(isinstance(c, Node) and c.name in ("ul", "ol", "dl", "table") for c in item.items)
            if dense < 0.5 and (item.name in HEADINGS or _only_headings(item)) or text or listed and dense < 0.25 or _value(item) >= least:
                out.append(item)
    return out


def _blocks(node: Node) -> list[str]:
    """Texts of the blocks below an element in page order."""
    out: list[str] = []
    held: list[str] = []

    def end() -> None:
        if text := _clean("".join(held)):
            out.append(text)
        held.clear()

    todo: list[Node | str | None] = [node]
    while todo:
        item = todo.pop()
        if item is None:
            end()
        elif isinstance(item, str):
            held.append(item)
        elif item.name == "br":
            held.append(" ")
        elif not item.noise:
            if item.name in BLOCK:
                end()
                todo.append(None)
            todo += reversed(item.items)
    end()
    return out


def _rescue(root: Node) -> None:
    """Headings of an article may stand in its own <header>: that one is no page header."""
    todo = [root]
    while todo:
        node = todo.pop()
        for item in node.items:
            if isinstance(item, Node):
                if item.name == "header" and (item.parent.main or _in_article(item)) and any(isinstance(c, Node) and c.name in HEADINGS for c in item.items):
                    item.noise = False
                todo.append(item)


def main_text(page: str | None) -> str:
    """The article's blocks, joined by line ends; empty where there is none."""
    if not page:
        return ""
    root = parse(page)
    _rescue(root)
    return "\n".join(b for n in _kept(root) for b in _blocks(n))


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            batch = whole.slice(at, 256)
            texts = [main_text(h) for h in batch.column("_html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for each page from its whole html.

    A null or empty page, or one without text, has an empty text; ids and urls may be null or repeated; an
    empty table gives no rows; other columns are not read.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("_html"))
    return rows.mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")
