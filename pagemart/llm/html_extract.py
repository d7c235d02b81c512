"""Main text of web pages by tree scoring.

A page becomes a tree. Menus, page headers and footers, sidebars, notices, adverts, forms, scripts,
styles, reader comments and hidden parts are cut. Every paragraph passes points for its length and
its commas to its ancestors (all to the parent, half to the grandparent, less further up), and a
container's points are discounted by its link density. The best container and those siblings that
score well or read like prose are kept; inside an ``article`` or ``main`` that whole element is.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_text, map_batches

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

# fixed values: HTML's elements without content, with raw text, and those that start a block
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody td
tfoot th thead tr ul caption""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# an opening tag closes these, up to a boundary
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "tbody": {"tr", "td", "th", "tbody", "thead"}, "option": {"option"}}
BOUNDARY = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}}
TABLE_PARTS = frozenset({"table"})
BUTTON_SCOPE = frozenset("table td th caption button object html".split())

DROPPED = RAW | frozenset("""nav footer aside form button input select option svg canvas object embed audio video map
dialog menu search label fieldset""".split())
# words of a class, id or role that mark what is not the article
UNWANTED = frozenset("""nav navbar navigation menu menus breadcrumb breadcrumbs footer foot masthead sidebar side aside widget
widgets banner cookie cookies consent gdpr notice notices alert popup modal overlay subscribe subscription newsletter signup
promo promotion ad ads adv advert adverts advertisement advertising adsense sponsor sponsored share sharing social related
recommended recommendations comment comments disqus respond reply replies pagination pager toolbar login search
complementary contentinfo skip outbrain taboola disclaimer feedback""".split())
UNWANTED_PAGE = frozenset({"header", "topbar"})       # only outside the article
COMMENTS_AND_ADS = frozenset("comment comments ad ads".split())
UNWANTED_STEMS = ("comment", "advert", "sidebar", "cookie", "newsletter", "breadcrumb", "sponsor", "navbar")


class Node:
    __slots__ = ("tag", "words", "parent", "children", "hidden")

    def __init__(self, tag: str, parent: "Node | None", words: frozenset[str] = frozenset(), hidden: bool = False):
        self.tag, self.parent, self.words, self.hidden = tag, parent, words, hidden
        self.children: list[Node | str] = []


def _attributes(raw: str) -> tuple[frozenset[str], bool]:
    """Words of class, id and role; whether the element is hidden."""
    if "=" not in raw and "hidden" not in raw:
        return frozenset(), False
    words: set[str] = set()
    hidden = False
    for name, a, b, c in _ATTRIBUTE.findall(raw):
        name, value = name.lower(), a or b or c
        if name in ("class", "id", "role"):
            words.update(w.lower() for w in _WORDS.findall(value))
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            hidden = True
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            hidden = True
    return frozenset(words), hidden


def parse(html: str) -> Node:
    """Tree of a page, forgiving: unclosed and stray tags are mended as browsers do in the main cases."""
    root = Node("#root", None)
    stack, at = [root], 0

    def close(tags: set[str] | frozenset[str], stop: set[str] | frozenset[str]) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                del stack[i:]
                return
            if stack[i].tag in stop:
                return

    n = len(html)
    while at < n:
        m = _MARKUP.search(html, at)
        if m is None:
            stack[-1].children.append(html[at:])
            break
        if m.start() > at:
            stack[-1].children.append(html[at:m.start()])
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                stack[-1].children.append(m[0][9:].removesuffix("]]>").replace("&", "&amp;"))
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "p" and not any(x.tag == "p" for x in stack):
                continue
            block = tag in BLOCK
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if not block and stack[i].tag in BLOCK:     # a stray inline end tag closes no block
                    break
            continue
        if tag in BLOCK:
            close({"p"}, BUTTON_SCOPE)
        if tag in HEADINGS and stack[-1].tag in HEADINGS:
            stack.pop()
        if tag in CLOSES:
            close(CLOSES[tag], BOUNDARY.get(tag, TABLE_PARTS))
        words, hidden = _attributes(m[3])
        node = Node(tag, stack[-1], words, hidden)
        stack[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(html, at)
            at = end.end() if end else n
        elif tag not in VOID and not m[3].rstrip().endswith("/") or tag in BLOCK and tag not in VOID:
            stack.append(node)
    return root


def _holds_article(node: Node) -> bool:
    """Whether the main element, or a heading of the first rank, lies in ``node``."""
    todo = [node]
    while todo:
        x = todo.pop()
        if x.tag in ("main", "h1") or x.tag == "article" and not x.words & UNWANTED:
            return True
        todo.extend(c for c in x.children if isinstance(c, Node))
    return False


def _unwanted(node: Node, inside: bool) -> bool:
    """Whether ``node`` is cut; ``inside``: it lies in the article."""
    if node.tag in DROPPED or node.hidden or node.tag == "header" and not inside:
        return True
    if node.tag in ("html", "body", "main") or inside and node.tag in HEADINGS:
        return False
    if node.words & COMMENTS_AND_ADS or any(w.startswith(UNWANTED_STEMS) for w in node.words):
        return not (node.tag == "div" and _holds_article(node))
    return bool(node.words & (UNWANTED if inside else UNWANTED | UNWANTED_PAGE)) and not _holds_article(node)


def prune(root: Node) -> None:
    """Cut what is not the article."""
    todo = [(root, False)]
    while todo:
        node, inside = todo.pop()
        node.children = [c for c in node.children if isinstance(c, str) or not _unwanted(c, inside)]
        todo.extend((c, inside or c.tag in ("article", "main")) for c in node.children if isinstance(c, Node))


def _order(root: Node) -> list[Node]:
    out, todo = [], [root]
    while todo:
        x = todo.pop()
        out.append(x)
        todo.extend(c for c in reversed(x.children) if isinstance(c, Node))
    return out


def _measure(root: Node) -> tuple[list[Node], dict[Node, tuple[int, int, int]]]:
    """Nodes in page order; per node: characters, characters in links, commas."""
    nodes = _order(root)
    sums: dict[Node, tuple[int, int, int]] = {}
    for x in reversed(nodes):
        chars = link = commas = 0
        for c in x.children:
            if isinstance(c, str):
                s = " ".join(c.split())
                chars += len(s)
                commas += s.count(",") + s.count("、") + s.count("，")
            else:
                a, b, d = sums[c]
                chars, link, commas = chars + a, link + b, commas + d
        sums[x] = (chars, chars if x.tag == "a" else link, commas)
    return nodes, sums


def _paragraphs(nodes: list[Node]) -> list[Node]:
    """Elements that hold text of their own and no further block."""
    out = []
    for x in nodes:
        if x.tag in ("p", "pre", "td", "li", "dd", "blockquote", "div", "section", "figcaption") or x.tag in HEADINGS:
            if x.tag == "p" or not any(isinstance(c, Node) and c.tag in BLOCK for c in x.children):
                out.append(x)
    return out


def main_nodes(root: Node) -> list[Node]:
    """The best container and its worthy siblings, in page order."""
    nodes, sums = _measure(root)
    points: dict[Node, float] = {}
    for p in _paragraphs(nodes):
        chars, link, commas = sums[p]
        if not chars:
            continue
        own = (1.0 if chars >= 25 else 0.2) + commas + min(chars / 100, 3.0)
        if p.tag in HEADINGS or p.tag == "li":
            own *= 0.3
        own *= 1 - link / chars
        x, level = p.parent, 0
        while x is not None and level < 5:
            if x not in points:
                points[x] = {"article": 10.0, "main": 8.0, "div": 2.0, "section": 2.0, "td": 1.0, "ul": -3.0, "ol": -3.0,
                             "dl": -3.0}.get(x.tag, 0.0)
                if x.words & {"article", "content", "main", "post", "entry", "story", "text", "body"}:
                    points[x] += 5.0
            points[x] += own / (1, 2, 6, 9, 12)[level]
            x, level = x.parent, level + 1
    scored = {x: s * (1 - sums[x][1] / max(1, sums[x][0])) for x, s in points.items()}
    if not scored:
        return [root]
    best = max(scored, key=lambda x: scored[x])         # page order settles ties
    x = best
    while x is not None:
        if x.tag in ("article", "main"):
            best = x
            if x.tag == "article":
                break
        x = x.parent
    if best.parent is None or best.tag in ("body", "html", "main"):
        return [best]
    least = max(5.0, 0.2 * scored.get(best, 0.0))
    kept: list[Node] = []
    for c in best.parent.children:
        if not isinstance(c, Node):
            continue
        chars, link, _ = sums[c]
        density = link / max(1, chars)
        if c is best or scored.get(c, 0.0) >= least and c.tag == best.tag \
                or c.tag == "p" and density < 0.25 and chars >= 80 \
                or c.tag in ("h1", "h2") and best.tag not in ("article", "main") and density < 0.5:
            kept.append(c)
    return kept


def blocks(node: Node) -> list[str]:
    """Texts of the blocks under ``node``: references decoded, white space runs made one space. Two
    line breaks in a row part a block like an element would."""
    out: list[str] = []
    run: list[str] = []

    def end() -> None:
        if run:
            if text := " ".join(unescape("".join(run)).split()):
                out.append(text)
            run.clear()

    todo: list[Node | str | None] = [node]       # None: a block ends here
    breaks = 0
    while todo:
        x = todo.pop()
        if x is None:
            end()
        elif isinstance(x, str):
            run.append(x)
            breaks = breaks if x.isspace() else 0
        elif x.tag == "br":
            breaks += 1
            run.append("\n")
            if breaks > 1:
                end()
        else:
            if x.tag in BLOCK:
                end()
                breaks = 0
                todo.append(None)
            todo.extend(reversed(x.children))
    end()
    return out


def main_text(html: str) -> str:
    """The article of a page: its blocks in page order, joined by one newline."""
    root = parse(html)
    prune(root)
    return "\n".join(b for node in main_nodes(root) for b in blocks(node))


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` without ``html``, with text (empty if there is none) and n_chars (code points).

    Null and empty pages give empty text; broken markup and pages without tags are read as text. Repeated rows are
    extracted each; columns of ``pages`` named text or n_chars are replaced."""
    kept = [c for c in pages.columns if c not in (html, "text", "n_chars")]

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(t) if t else "" for t in as_text(b.column(b.num_columns - 1))]
        return pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                          names=[*kept, "text", "n_chars"])
    schema = pages.select(*kept).schema.add("text", "string").add("n_chars", "long")
    return map_batches(pages.select(*kept, F.col(html).cast("binary").alias("_html")), run, schema)
