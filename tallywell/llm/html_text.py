"""Main text of web pages by composite text density."""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript iframe noembed noframes xmp template textarea title".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hgroup hr main menu nav ol p pre search section table ul".split()
)
#: Start tags that end an open element of these names, unless one of the second set is nearer.
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"}),
    "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
}
#: Never article text, wherever they stand.
BOILERPLATE = RAW | frozenset(
    "head nav footer aside form button select option optgroup datalist label input object applet svg math canvas audio video "
    "dialog menu search".split()
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar status".split()
)
#: Words of class and id values, split at anything but letters.
HINTS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs header masthead footer foot sidebar aside widget widgets related recommended share sharing social "
    "comment comments discussion disqus reply replies respond reaction reactions cookie cookies consent gdpr notice notices "
    "notification popup modal overlay newsletter subscribe subscription signup login pagination pager skip toolbar copyright "
    "legal disclaimer".split()
)
#: A word before a hint that says the element only concerns one.
NEGATED = frozenset("has with without no not is main content article".split())

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_LETTERS = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("tag", "attrs", "parent", "items", "out", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.items: list[Node | str] = []
        self.out = False


def _attributes(raw: str) -> dict[str, str]:
    return {k.lower(): html.unescape(v.strip("\"'")) for k, v in _ATTRIBUTE.findall(raw)} if raw.strip(" /") else {}


def parse(page: str) -> tuple[Node, list[Node]]:
    """The tree of a page and its nodes in document order. Any text gives a tree; end tags may be left out or misplaced."""
    root = Node("#root", {}, None)
    nodes, top, at = [root], root, 0
    while True:
        found = _TOKEN.search(page, at)
        if text := page[at : found.start() if found else len(page)]:
            top.items.append(text)
        if not found:
            return root, nodes
        at = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue
        if found[1]:
            node = top
            while node and node.tag != name:
                node = node.parent
            if node:  # an inline end tag does not close the blocks around it
                crossed = top
                while name in INLINE and crossed is not node and crossed.tag in INLINE:
                    crossed = crossed.parent
                if name not in INLINE or crossed is node:
                    top = node.parent
            continue
        if name in ("html", "body") and any(n.tag == name for n in nodes[:50]):
            continue
        if name == "body" or (name == "head" and top.tag == "html"):
            while top.tag not in ("#root", "html"):
                top = top.parent
        ends, within = IMPLIED_END.get(name, (None, None))
        if name in CLOSES_P:
            ends, within = {"p"}, {"td", "th", "li", "dd", "button", "caption", "object"}
        if ends:
            node, last = top, None
            while node and node.tag not in within and node.tag != "#root":
                if node.tag in ends:
                    last = node
                    if name in CLOSES_P:
                        break
                elif node.tag not in INLINE and name in CLOSES_P and node.tag != "p":
                    break
                node = node.parent
            if last:
                top = last.parent
        node = Node(name, _attributes(found[3]), top)
        top.items.append(node)
        nodes.append(node)
        if name in VOID or found[3].endswith("/") and name in ("svg", "path"):
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*(?:>|\Z)|\Z", re.IGNORECASE).search(page, at)
            if name not in ("template", "noscript"):
                node.items.append(page[at : end.start()])
            at = end.end()
            continue
        top = node


def _hinted(node: Node) -> bool:
    for key in ("class", "id"):
        for value in node.attrs.get(key, "").lower().split():
            parts = _LETTERS.findall(value)
            for i, part in enumerate(parts):
                if part in HINTS and not (i and parts[i - 1] in NEGATED):
                    return True
    return False


def _is_boilerplate(node: Node) -> bool:
    tag, attrs = node.tag, node.attrs
    role = attrs.get("role", "").lower()
    # Some frameworks write the whole body in one form.
    if (tag == "form" or role == "form") and tag not in BOILERPLATE - {"form"} and role in ("", "form"):
        if not _holds(node):
            return True
    elif tag in BOILERPLATE or role in ROLES:
        return True
    if "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true":
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", ""), re.IGNORECASE):
        return True
    if tag in ("html", "body", "main", "#root", "h1"):
        return False
    if tag == "header" or _hinted(node):
        # A wrapper named after a part of the page still holds the article.
        return tag == "header" and not _inside(node, ("article", "main")) or tag != "header" and not _holds(node)
    return False


def _inside(node: Node, tags: tuple[str, ...]) -> bool:
    while node := node.parent:
        if node.tag in tags:
            return True
    return False


def _holds(node: Node) -> bool:
    todo = [x for x in node.items if isinstance(x, Node)]
    while todo:
        x = todo.pop()
        if x.tag in ("article", "main", "h1") and not (x.tag == "article" and _hinted(x)):
            return True
        todo.extend(y for y in x.items if isinstance(y, Node))
    return False


def _measure(nodes: list[Node], body: Node) -> None:
    """Composite text density of each node in use, and the sum of its children's."""
    for node in nodes:
        node.chars = node.tags = node.link_chars = node.link_tags = 0
        node.density = node.total = 0.0
    for node in reversed(nodes):  # children before parents
        if node.out:
            continue
        own = sum(len(" ".join(html.unescape(x).split())) for x in node.items if isinstance(x, str))
        node.chars += own
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.tags + 1
        if node.parent:
            up = node.parent
            up.chars += node.chars
            up.tags += node.tags + 1
            up.link_chars += node.link_chars
            up.link_tags += node.link_tags
    share = body.link_chars / max(body.chars, 1)
    for node in nodes:
        if node.out or not node.chars:
            continue
        c, t, lc, lt = node.chars, max(node.tags, 1), max(node.link_chars, 1), max(node.link_tags, 1)
        plain = max(c - node.link_chars, 1)
        base = math.log(c / plain * lc + share * c + math.e)  # above 1
        node.density = max(c / t * math.log(c / lc * t / lt) / math.log(base), 0.0)
        if node.parent:
            node.parent.total += node.density


def _emit(node: Node, out: list[str]) -> None:
    """All text below ``node`` but boilerplate; blocks are set apart by a space."""
    todo: list[Node | str] = [node]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
        elif not x.out:
            if x.tag in INLINE:
                todo.extend(reversed(x.items))
            else:
                todo.append(" ")
                todo.extend(reversed(x.items))
                todo.append(" ")


def main_text(page: str | None) -> str:
    """Main text of a page; empty if it has none.

    Navigation, page header and footer, sidebars, notices, adverts, forms, comments, scripts and styles are cut out by
    element, role and name. Of the rest each node gets its composite text density: characters per tag, adjusted by its
    links. The node with the largest sum of its children's densities is the core; the least density on its path to the body
    is the threshold. Beside the path, whole subtrees at or above the threshold and headings belong to the text too, and
    all that stands in the same article.
    """
    if not page:
        return ""
    root, nodes = parse(page)
    body = next((n for n in nodes if n.tag == "body"), root)
    for node in nodes:
        node.out = node.parent is not None and (node.parent.out or _is_boilerplate(node))
    _measure(nodes, body)
    inside = [n for n in nodes if not n.out and n.chars]
    if not inside:
        return ""
    core = max((n for n in inside if n is body or _inside(n, ("body", "#root"))), key=lambda n: n.total, default=body)
    path = []
    node = core
    while node is not None:
        path.append(node)
        if node is body:
            break
        node = node.parent
    threshold = min(n.density for n in path)
    whole = next((n for n in reversed(path) if n.tag == "article" or n.attrs.get("itemprop") == "articleBody"), None) or core
    on_path = set(path)
    out: list[str] = []

    def walk(node: Node) -> None:
        for x in node.items:
            if isinstance(x, str):
                if node is not body or x.strip():
                    out.append(x)
            elif x is whole:
                _emit(x, out)
            elif x in on_path:
                out.append(" ")
                walk(x)
                out.append(" ")
            elif not x.out and (x.tag in INLINE or x.density >= threshold or x.tag in ("h1", "h2", "h3", "h4", "h5", "h6")):
                _emit(x, out)

    if whole is body or whole is root:
        for x in whole.items:
            # The body itself is the core: leave out blocks that are mostly links.
            if isinstance(x, str) or x.tag in INLINE or 2 * x.link_chars < max(x.chars, 1):
                _emit(x, out) if isinstance(x, Node) else out.append(x)
    else:
        walk(path[-1])
    return " ".join("".join(map(html.unescape, out)).split())


def extract_pages(pages: DataFrame, column: str = "html") -> DataFrame:
    """Add ``text`` and ``n_chars`` (its code points) to ``pages`` without ``column``.

    A null or empty page has the empty text. Columns named text or n_chars are replaced, all others are kept;
    each page is handled by itself, so repeated rows give repeated rows and no rows give none.
    """
    kept = [c for c in pages.columns if c not in (column, "text", "n_chars")]
    rows = pages.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(kept)], F.col(column).cast("string").alias("_page"))
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in rows.drop("_page").schema), "_text string"])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p) for p in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(texts, pa.string())], [*batch.schema.names[:-1], "_text"]
            )

    found = rows.mapInArrow(of, schema)
    names = [F.col(f"c{i}").alias(c) for i, c in enumerate(kept)]
    return found.select(*names, F.col("_text").alias("text"), F.char_length("_text").cast("long").alias("n_chars"))
