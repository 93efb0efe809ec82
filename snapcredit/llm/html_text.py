"""Main text of web pages by composite text density over the nodes of the document tree."""

from __future__ import annotations

import html
import math
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapcredit.llm.common import free_name, map_arrow

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript textarea title iframe template svg annotation annotation-xml object select".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
#: Opening one of these ends an open element of the second set, up to one of the third.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Elements that a paragraph end is not looked for beyond.
SCOPE = frozenset("html body table td th button object".split())

#: What is never main text: elements, roles, and words of a class or id.
DROPPED = frozenset("head nav aside footer form button dialog menu canvas audio video input".split()) | RAW
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
#: An article is only given up as one of these.
COMMENT_WORDS = frozenset("comment reply replies".split())
LAYOUT_WORDS = frozenset("has with no without".split())
#: Elements that hold an article.
ARTICLES = ("article", "main")
DROPPED_WORDS = frozenset(
    "ad ads adsbygoogle adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion "
    "nav navbar navigation menu submenu breadcrumb breadcrumbs footer masthead sidebar sidebars rail widget widgets "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe "
    "signup login search searchform toolbar pagination pager share sharing social related recommended "
    "comment comments commentlist reply replies respond disqus discussion".split()
)
#: Also words of an article: inside one they only drop an element that is mostly links.
AMBIGUOUS_WORDS = frozenset(
    "advert advertising sponsor sponsored promotion nav navigation menu banner rail notice notices notification alert consent "
    "overlay subscribe login signup search share sharing social related recommended respond discussion cookie cookies "
    "gdpr newsletter".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What an id says of a section of an article.
SECTION_WORDS = frozenset("comment comments commentlist reply replies disqus".split())
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>"
    r"|<[!?/][^>]*>"
    r"|<[!?/a-zA-Z][^>]*\Z",
    re.S,
)
NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORDS = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass(eq=False)
class Node:
    """An element: its parts are texts and elements in order."""

    tag: str
    parent: Node | None = None
    dropped: bool = False
    suspect: bool = False
    parts: list = field(default_factory=list)
    chars: int = 0
    tags: int = 0
    link_chars: int = 0
    link_tags: int = 0
    density: float = 0.0
    total: float = 0.0


def unwanted(tag: str, attributes: str, in_article: bool) -> tuple[bool, bool]:
    """Whether an element is page furniture by its name, role, class or id, and whether it is if mostly links.

    Inside an article an id of a heading or paragraph is a place to link to, one of a section mostly so.
    """
    if tag in DROPPED or (tag in ("header", "label") and not in_article):
        return True, False
    suspect = False
    for name, *values in NAMED.findall(attributes) if attributes else ():
        value = "".join(values)
        kind = name.lower()
        if kind == "role":
            if value.strip().lower() in DROPPED_ROLES:
                return True, False
        elif tag not in ("html", "body") and not (
            in_article and kind == "id" and (tag in HEADINGS or tag == "p")
        ):
            words = WORDS.findall(CAMEL.sub(" ", value).lower())
            named = COMMENT_WORDS if tag in ARTICLES else DROPPED_WORDS
            for before, word in zip(("", *words), words, strict=False):
                # A layout "with-sidebar" is not the sidebar.
                if word in named and before not in LAYOUT_WORDS:
                    slug = tag == "section" and kind == "id" and word not in SECTION_WORDS
                    if not in_article or tag in ARTICLES or not (slug or word in AMBIGUOUS_WORDS):
                        return True, False
                    suspect = True
    return False, suspect


def without_link_lists(root: Node) -> Node:
    """The tree without suspect elements half of whose text, or more, is links."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo.extend(p for p in node.parts if isinstance(p, Node))
    counts: dict[int, tuple[int, int]] = {}
    for node in reversed(order):
        chars = links = 0
        for part in node.parts:
            c, n = counts[id(part)] if isinstance(part, Node) else (len("".join(part.split())), 0)
            chars, links = chars + c, links + n
        if node.tag == "a":
            links = chars
        if node.suspect and 2 * links >= chars:
            node.dropped, chars, links = True, 0, 0
        counts[id(node)] = chars, links
        node.parts = [p for p in node.parts if not (isinstance(p, Node) and p.dropped)]
    return root


def parse(page: str) -> Node:
    """Tree of a page without its page furniture; text is kept as written."""
    root = Node("html")
    stack, at, low = [root], 0, None
    articles, suspects = 0, False
    while match := TAG.search(page, at):
        if match.start() > at and not stack[-1].dropped:
            stack[-1].parts.append(page[at : match.start()])
        at = match.end()
        tag = (match[2] or match[5] or "").lower()
        if not tag:
            continue
        if match[1] or match[4]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    articles -= sum(n.tag in ARTICLES for n in stack[depth:])
                    del stack[depth:]
                    break
            continue
        attributes = match[3] or match[6] or ""
        if tag in RAW:
            low = low or page.lower()
            end = low.find(f"</{tag}", at)
            closing = page.find(">", end) if end >= 0 else -1
            at = closing + 1 if closing >= 0 else len(page)
            continue
        ends, bound = IMPLIED.get(tag, ((), ()))
        if tag in BLOCKS:
            ends, bound = {*ends, "p"}, {*bound, *SCOPE}
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in ends:
                del stack[depth:]
            elif stack[depth].tag in bound:
                break
        top = stack[-1]
        if tag in ("html", "body") and any(n.tag == tag for n in stack[1:]):
            continue
        drop, suspect = (True, False) if top.dropped else unwanted(tag, attributes, articles > 0)
        node = Node(tag, top, drop, suspect)
        suspects |= suspect
        if not node.dropped:
            top.parts.append(node)
        if tag not in VOID:
            stack.append(node)
            articles += tag in ARTICLES
    if at < len(page) and not stack[-1].dropped:
        stack[-1].parts.append(page[at:])
    return without_link_lists(root) if suspects else root


def measure(root: Node) -> list[Node]:
    """Nodes in page order with their composite density and the sum of their children's densities.

    Density is characters per tag, taken down as links make up more of the characters and tags.
    """
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo.extend(p for p in reversed(node.parts) if isinstance(p, Node))
    for node in reversed(order):
        link = node.tag == "a"
        for part in node.parts:
            if isinstance(part, Node):
                node.chars += part.chars
                node.tags += part.tags + 1
                node.link_chars += part.link_chars
                node.link_tags += part.link_tags + (part.tag == "a")
            else:
                node.chars += len("".join(part.split()))
        if link:
            node.link_chars = node.chars
    whole = root.chars or 1
    for node in order:
        c, t = node.chars, max(node.tags, 1)
        links, link_tags = max(node.link_chars, 1), max(node.link_tags, 1)
        plain = max(c - node.link_chars, 1)
        base = math.log(c * links / plain + root.link_chars * c / whole + math.e) or 1.0
        ratio = (c / links) * (t / link_tags)
        node.density = c / t * math.log(ratio) / base if ratio > 1 else 0.0
    for node in order:
        node.total = sum(p.density for p in node.parts if isinstance(p, Node))
    return order


def main_nodes(order: list[Node]) -> list[Node]:
    """The subtree with the largest sum of densities, and what else is as dense as the path to it.

    The threshold is the smallest density on the path from that subtree up to the body. An article or
    main element around the subtree is taken whole: headings and short paragraphs belong to it.
    """
    best = max(order, key=lambda n: n.total)
    path, node = [best], best
    while node.parent is not None:
        node = node.parent
        path.append(node)
    for node in reversed(path):
        if node.tag in ARTICLES:
            return [node]
    body = next((i for i, n in enumerate(path) if n.tag == "body"), len(path) - 1)
    threshold = min(n.density for n in path[: body + 1])
    around = set(map(id, path))
    chosen = {id(best)}
    for node in path[1 : body + 1]:
        for part in node.parts:
            if isinstance(part, Node) and id(part) not in around:
                if part.tag in ("h1", "h2", "h3", "hgroup", "header") or (part.density >= threshold and part.tag != "a"):
                    chosen.add(id(part))
    return [n for n in order if id(n) in chosen]


def blocks_of(node: Node) -> list[str]:
    """Texts of the block elements below a node in page order, white space as one space."""
    out: list[str] = []
    held: list[str] = []

    def close() -> None:
        text = " ".join(html.unescape("".join(held)).split())
        held.clear()
        if text:
            out.append(text)

    # Each entry is a part still to come, or None where a block ends.
    todo: list = [node]
    while todo:
        part = todo.pop()
        if part is None:
            close()
        elif isinstance(part, str):
            held.append(part)
        elif part.tag in BLOCKS:
            close()
            todo.append(None)
            todo.extend(reversed(part.parts))
        elif part.tag == "br":
            held.append(" ")
        else:
            todo.extend(reversed(part.parts))
    close()
    return out


def main_text(page: str) -> str:
    """Blocks of the main text of a page, joined by one newline; empty if there is none."""
    order = measure(parse(page))
    if not order[0].chars:
        return ""
    return "\n".join(block for node in main_nodes(order) for block in blocks_of(node))


def extract_main_text(pages: DataFrame, page: str = "html", text: str = "text") -> DataFrame:
    """All rows and columns of `pages` with the main text of the whole page in column `text`.

    Null, empty and textless pages have an empty text; a repeated row has its text again; a column with
    the name of the text is replaced. Pages are worked on one by one where they lie: nothing is shuffled.
    """

    def extract(batches):
        for batch in batches:
            source = batch.column(held).to_pylist()
            texts = pa.array([main_text(p) if p else "" for p in source], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], texts], [*batch.schema.names[:-1], text])

    kept = [c for c in pages.columns if c.lower() not in (text.lower(), page.lower())]
    held = free_name(pages, "_page")
    rows = pages.select(*kept, F.col(page).cast("string").alias(held))
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in pages.select(*kept).schema)
    return map_arrow(rows, extract, f"{schema}`{text}` string")
