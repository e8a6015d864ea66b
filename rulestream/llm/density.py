"""Main-text extraction by composite text density (operator 8).

A page is parsed into a tree of elements.  Elements that are boilerplate by their tag, role, class or id (menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles, comments of readers) are left out, unless they
wrap the page's main part or most of its text; they end by the same implied-end rules as others.  Every remaining node gets a composite text density: its characters per tag, scaled down by the share of its link characters
and link tags against the body's.  A node's density sum is the sum of its children's densities.  From the node of the
largest sum the path to the body is climbed while the parent's density reaches the threshold, the body's own density;
an article or main element on the path ends the climb.  The text of that subtree is returned, block by block.

One page is one row; pages are parsed independently in Arrow batches, no shuffle.  Null html counts as empty; an empty
page, or one without text, has an empty text.  Repeated rows are kept; other columns are not carried.
"""

from __future__ import annotations

import html as _html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulestream.llm.common import batches

# HTML element classes and the words by which boilerplate is named.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title xmp noembed noframes svg math object select canvas".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split())
TEXT_ONLY = frozenset("script style textarea title iframe xmp noembed noframes".split())  # run to the page's end if unclosed
HEAD = frozenset("base link meta title style script noscript template head html".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
REPLIES = frozenset("comment comments discussion disqus replies reply".split())
P_SCOPE = frozenset("button caption table td th".split())
SKIP = frozenset("nav footer aside form button dialog head menu input label fieldset".split()) | RAW
SKIP_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
SKIP_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header masthead "
    "comment comments discussion disqus replies reply cookie cookies consent gdpr notice notification alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended widget toolbar pagination pager".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"tbody", "thead", "tr", "td", "th"}}
SCOPE = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "tbody": {"table"}}

_MARK = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)>", re.S)
_LOOSE = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*)>")
_ATTR = re.compile(r"(class|id|role|aria-hidden|hidden|style)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORD = re.compile(r"[a-z0-9]+")


class Node:
    __slots__ = ("tag", "parent", "children", "chars", "tags", "link_chars", "link_tags", "density", "total", "left_out", "replies")

    def __init__(self, tag: str, parent: "Node | None"):
        self.tag, self.parent, self.children = tag, parent, []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0
        self.left_out = self.replies = False


def _boilerplate(tag: str, attrs: str, inside_article: bool) -> bool:
    if tag in SKIP or tag == "header" and not inside_article:
        return True
    for name, *values in _ATTR.findall(attrs):
        name, value = name.lower(), "".join(values).lower()
        if (name == "class" or name == "id" and tag not in HEADING) and not SKIP_WORDS.isdisjoint(_WORD.findall(value)):
            return True
        if name == "role" and value.strip() in SKIP_ROLES or name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
            return True
    return False


def parse(page: str) -> Node:
    """The tree of elements and texts below ``body``, without boilerplate.  Unclosed and stray tags are tolerated."""
    root = node = Node("body", None)
    open_tags: list[str] = []  # of the elements from the body's child to ``node``
    marked = False
    pos, size = 0, len(page)

    def close_to(k: int):
        """End the open elements from the ``k``-th on."""
        nonlocal node
        for _ in range(len(open_tags) - k):
            open_tags.pop()
            node = node.parent

    while pos < size:
        at = page.find("<", pos)
        if at < 0:
            at = size
        if at > pos:
            text = page[pos:at]
            if open_tags and open_tags[-1] == "head" and not text.isspace():
                close_to(len(open_tags) - 1)
            node.children.append(_html.unescape(text))
        if at == size:
            break
        m = _MARK.match(page, at) or _LOOSE.match(page, at)
        if m is None:
            node.children.append("<")
            pos = at + 1
            continue
        pos = m.end()
        if not m.lastindex or m.group(2) is None:
            continue
        close, tag, attrs = m.group(1), m.group(2).lower(), m.group(3)
        if close:
            if tag in open_tags:
                while open_tags.pop() != tag:
                    node = node.parent
                node = node.parent
            continue
        if tag not in HEAD and "head" in open_tags:
            close_to(open_tags.index("head"))
        if tag in ("html", "body"):
            continue
        if tag in VOID:
            node.children.append(" " if tag in ("br", "hr") else "")
            continue
        if tag in BLOCK and "p" in open_tags:
            k = len(open_tags) - 1
            while k >= 0 and open_tags[k] != "p" and open_tags[k] not in P_SCOPE:
                k -= 1
            if k >= 0 and open_tags[k] == "p":
                close_to(k)
        for stop in range(len(open_tags) - 1, -1, -1):
            if tag not in CLOSED_BY or open_tags[stop] in SCOPE.get(tag, ()):
                break
            if open_tags[stop] in CLOSED_BY[tag]:
                close_to(stop)
                break
        left_out = _boilerplate(tag, attrs, "article" in open_tags or "main" in open_tags)
        if left_out and tag in RAW:
            end = re.compile(f"</{re.escape(tag)}(?=[\\s/>])[^>]*>", re.I).search(page, pos)
            if end or tag in TEXT_ONLY:
                pos = end.end() if end else size
                continue
        if left_out and attrs.rstrip().endswith("/"):
            continue
        child = Node(tag, node)
        child.left_out = left_out
        if left_out:
            marked = True
            child.replies = any(name.lower() in ("class", "id") and not REPLIES.isdisjoint(_WORD.findall("".join(v).lower())) for name, *v in _ATTR.findall(attrs))
        node.children.append(child)
        if not attrs.rstrip().endswith("/") or tag in BLOCK:
            node = child
            open_tags.append(tag)
    if marked:
        _leave_out(root)
    return root


def _leave_out(root: Node) -> None:
    """Take the marked elements out of the tree, but spare wrappers of the page's text.

    Spared is what holds most of the body's characters outside links (readers' comments are not spared for that), a main
    element, or an article where none stands outside the marked elements.
    """
    nodes = _nodes(root)
    plain: dict[Node, int] = {}
    articles: dict[Node, int] = {}
    mains: dict[Node, int] = {}
    for n in reversed(nodes):
        below = [c for c in n.children if type(c) is Node]
        own = sum(len("".join(c.split())) for c in n.children if type(c) is str)
        plain[n] = 0 if n.tag in ("a", "head") else own + sum(plain[c] for c in below)
        mains[n] = sum(mains[c] for c in below) + (n.tag == "main" and not n.left_out)
        articles[n] = sum(articles[c] for c in below if not c.replies) + (n.tag == "article" and not n.left_out)
    outside, todo = 0, [root]
    while todo:
        n = todo.pop()
        outside += n.tag in ("article", "main")
        todo += [c for c in n.children if type(c) is Node and not c.left_out]

    def goes(n: Node) -> bool:
        if not n.left_out:
            return False
        if n.tag == "head":
            return True
        return not (mains[n] or not outside and articles[n] or not n.replies and 2 * plain[n] > plain[root])

    todo = [root]
    while todo:
        n = todo.pop()
        n.children = [c for c in n.children if type(c) is str or not goes(c)]
        todo += [c for c in n.children if type(c) is Node]


def _nodes(root: Node) -> list[Node]:
    """Parents before children."""
    out = [root]
    for n in out:
        out.extend(c for c in n.children if type(c) is Node)
    return out


def main_node(root: Node) -> Node:
    """The subtree of the largest density sum, extended towards the body by the body's threshold."""
    nodes = _nodes(root)
    for n in reversed(nodes):
        n.chars += sum(len("".join(c.split())) for c in n.children if type(c) is str)
        if n.tag == "a":
            n.link_chars, n.link_tags = n.chars, n.link_tags + 1
        if n.parent is not None:
            n.parent.chars += n.chars
            n.parent.tags += n.tags + 1
            n.parent.link_chars += n.link_chars
            n.parent.link_tags += n.link_tags
    share = root.link_chars / max(1, root.chars)
    for n in nodes:
        if n.chars:
            c, t = n.chars, max(1, n.tags)
            base = math.log(c / max(1, c - n.link_chars) * n.link_chars + share * c + math.e)
            links = c / max(1, n.link_chars) * t / max(1, n.link_tags)
            n.density = c / t * max(0.0, math.log(links) / math.log(base)) if base > 1 and n.link_tags else c / t
        if n.parent is not None:
            n.parent.total += n.density
    best = max(nodes, key=lambda n: n.total if n.total else n.density * 1e-9)
    path = [best]
    while path[-1].parent is not None:
        path.append(path[-1].parent)
    for n in reversed(path):
        if n.tag in ("article", "main"):
            return n
    while best.parent is not None and best.parent.parent is not None and best.parent.density >= root.density:
        best = best.parent
    return best if best.parent is not None and best.tag in BLOCK else (best.parent or best)


def block_text(node: Node) -> str:
    """Blocks in page order, one a line; white space inside a block is one space."""
    blocks: list[str] = []
    now: list[str] = []

    def end():
        line = " ".join("".join(now).split())
        if line:
            blocks.append(line)
        now.clear()

    todo: list = [node]
    while todo:
        n = todo.pop()
        if n is None:
            end()
        elif type(n) is str:
            now.append(n)
        else:
            if n.tag in BLOCK:
                end()
                todo.append(None)
            todo.extend(reversed(n.children))
    end()
    return "\n".join(blocks)


def main_text(page: str | None) -> str:
    return block_text(main_node(parse(page))) if page else ""


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text): the main text of every page."""

    def run(it):
        yield from batches(it, ["id", "url", "text"], [pa.int64(), pa.string(), pa.string()],
                           lambda b: (b.column(0), b.column(1), [main_text(x) for x in b.column(2).to_pylist()]))

    return pages.select(F.col(id_col).cast("bigint").alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html")).mapInArrow(run, "id bigint, url string, text string").toDF(id_col, url_col, "text")
