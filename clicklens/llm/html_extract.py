"""Main text of web pages by tree scoring.

The page becomes a tree of elements. Parts that never belong to an article go
first: by element (scripts, menus, forms, ...) or by a word of their class or
id (advert, sidebar, ...) unless that speaks of the page's layout or
of an article's part (has-sidebar, entry-header), or the element holds an
article or nearly all text of the page. Elements named for readers' comments go
first of all, article elements among them, whatever they hold. Each block with text of its own is a
paragraph; it passes points for its length and commas to its parent and half of
them to its grandparent, and each container's sum is discounted by the share of
its text that stands in links. The best container, or the article element around
it, is kept with those of its siblings that score well beside it, or are plain
paragraphs beside it. Beside a container that is no article element, headings,
lists, short paragraphs and bare text with few links stay too, and so does every
block with few links between two kept ones.

A page is cut where a tag begins that never ends, as readers of markup do, and
elements nest ``DEEPEST`` levels deep at most, further ones stand beside each
other; no text is lost by the latter. Time is linear in the page.

Text of the kept elements is read in page order: references decoded, blocks
split at block elements and line breaks, white space within a block turned
into one blank, blocks joined by one blank. Nothing else is dropped.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicklens.llm.common import blocks

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set("address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure "
            "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table "
            "tbody td tfoot th thead title tr ul".split())
NEVER = set("script style noscript template head title nav footer aside form button select textarea input iframe object "
            "embed svg canvas audio video dialog menu".split())
#: Elements that an opening tag closes when one of the first is still open.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
BARRIER = set("article aside blockquote body div dl fieldset footer form header html main nav ol section table td th "
              "ul".split())
NOT_MAIN = set("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent "
               "cookie cookies disqus footer header masthead menu modal nav navbar navigation newsletter notice notices "
               "pager pagination popup promo related replies respond share sharing sidebar social sponsor sponsored "
               "subscribe toolbar widget".split())
COMMENTS = set("comment comments disqus replies respond".split())
MAIN_WORDS = set("article body content entry main post story text".split())
#: A name that starts with one of these tells what stands in the element or beside it, not what it is.
STATE = set("has have is no not with without show shows hide hides hidden enable enabled disable disabled "
            "open closed".split())
DEEPEST = 400
#: Elements whose content is no markup.
RAW = set("script style textarea title xmp iframe noembed noframes".split())
TAG_END = re.compile(r"[>\"']")
TAG_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
NAME = re.compile(r"[a-z0-9]+")
NEARLY_ALL = 0.8
#: Elements that stay beside the best container, if few of their words are links.
BESIDE = set("h1 h2 h3 h4 h5 h6 hgroup p ul ol dl blockquote pre table figure".split())
LEAST_LENGTH, SIBLING_SHARE, SIBLING_LENGTH = 25, 0.2, 80


class Node:
    __slots__ = ("tag", "parent", "items", "words", "points", "names", "block", "within", "depth")

    def __init__(self, tag: str, parent: Node | None, named: str = ""):
        self.tag, self.parent = tag, parent
        # The block that the element's text belongs to, whether it stands in an article, and how deep.
        self.block = self if tag in BLOCK or parent is None else parent.block
        self.within = parent is not None and (parent.within or parent.tag in ("article", "main"))
        self.depth = 0 if parent is None else parent.depth + 1
        self.words = frozenset(NAME.findall(named)) if named else frozenset()
        self.names = named.split() if self.words & NOT_MAIN else []
        self.items: list[Node | str] = []
        self.points = 0.0


class TreeBuilder(HTMLParser):
    """Tolerant tree: closes what HTML closes by itself, and ignores end tags without a start."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("html", None)
        self.open: Counter[str] = Counter()

    def _leave(self, to):
        while self.at is not to:
            self.open[self.at.tag] -= 1
            self.at = self.at.parent

    def handle_starttag(self, tag, attrs):
        if tag == "html":
            return
        if tag in BLOCK and tag != "br":
            self._close({"p"})
        if tag in CLOSES:
            self._close(CLOSES[tag])
        named = " ".join(v for k, v in attrs if k in ("class", "id", "role") and v).lower()
        if self.at.depth >= DEEPEST:
            self._leave(self.at.parent)
        node = Node(tag, self.at, named)
        self.at.items.append(node)
        if tag not in VOID:
            self.at = node
            self.open[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.at.tag == tag and tag not in BLOCK:
            self._leave(self.at.parent)

    def _close(self, tags):
        if not any(self.open[t] for t in tags):
            return
        node = self.at
        while node.parent and node.tag not in tags:
            if node.tag in BARRIER:
                return
            node = node.parent
        if node.parent:
            self._leave(node.parent)

    def handle_endtag(self, tag):
        if tag in VOID:
            if tag == "br":
                self.at.items.append(Node("br", self.at))
            return
        if not self.open[tag]:
            return
        node = self.at
        while node.parent and node.tag != tag:
            if node.tag in BARRIER and tag not in BARRIER:
                return
            node = node.parent
        if node.parent:
            self._leave(node.parent)

    def handle_data(self, data):
        self.at.items.append(data)


def _tag_end(html: str, at: int) -> int:
    """Behind the tag that begins at ``at``; -1 if the page ends before it does. Signs in quoted values end nothing."""
    while m := TAG_END.search(html, at):
        if m[0] == ">":
            return m.end()
        before = m.start() - 1
        while html[before].isspace():
            before -= 1
        at = m.end()
        if html[before] == "=":
            at = html.find(m[0], at) + 1
            if not at:
                return -1
    return -1


def whole_tags(html: str) -> str:
    """The page up to a tag or comment that never ends; what follows is part of that, and no text."""
    at = html.find("<")
    while at >= 0:
        sign = html[at + 1:at + 2]
        if html.startswith("<!--", at):
            end = html.find("-->", at + 4) + 3
            if end < 3:
                return html[:at]
        elif sign in ("!", "?"):
            end = html.find(">", at) + 1
            if not end:
                return html[:at]
        elif name := TAG_NAME.match(html, at + 1 + (sign == "/")):
            end = _tag_end(html, name.end())
            if end < 0:
                return html[:at]
            if sign != "/" and name[0].lower() in RAW:
                close = re.compile(f"</{name[0]}", re.IGNORECASE).search(html, end)
                end = close.start() if close else len(html)
        else:
            end = at + 1
        at = html.find("<", end)
    return html


def parse(html: str) -> Node:
    """The tree of a page."""
    builder = TreeBuilder()
    builder.feed(whole_tags(html))
    builder.close()
    return builder.root


def _unwanted(node: Node) -> bool:
    """Whether the element itself is of no article."""
    return node.tag in NEVER or node.tag == "header" and not node.within


def _ill_named(node: Node) -> bool:
    """Whether a class, id or role says that the element is no part of an article."""
    if not node.names or node.tag in ("html", "body"):
        return False
    plain, parts = False, False
    for name in node.names:
        words = NAME.findall(name)
        bad = set(words) & NOT_MAIN
        if not bad or words[0] in STATE or words[-1] in STATE:
            continue
        if bad == {"header"} and (set(words) & MAIN_WORDS or node.within):
            continue
        plain |= len(words) == 1
        parts = True
    # Beside a name like post, only a plain one such as sidebar counts.
    return plain or parts and not any(n in MAIN_WORDS for n in node.names)


def _of_comments(node: Node) -> bool:
    """Whether a class or id says that readers wrote the element."""
    if node.tag in ("html", "body", "main"):
        return False
    for name in node.names:
        words = NAME.findall(name)
        if set(words) & COMMENTS and not set(words) & STATE:
            return True
    return False


def prune(root: Node) -> None:
    """Take unwanted elements out of the tree."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        node.items = [x for x in node.items if isinstance(x, str) or not (_unwanted(x) or _of_comments(x))]
        todo += [x for x in node.items if not isinstance(x, str)]
    ill = {n for n in order if n.names and n.tag not in ("article", "main") and _ill_named(n)}
    if not ill:
        return
    size, holds = dict.fromkeys(order, 0), set()
    for node in reversed(order):
        if node.tag != "a":
            size[node] += sum(len(x.strip()) for x in node.items if isinstance(x, str))
            if node.parent:
                size[node.parent] += size[node]
        if node.parent and (node in holds or node.tag in ("article", "main") and not _ill_named(node)):
            holds.add(node.parent)
    # A compound name on what holds nearly all text is that of a wrapper.
    ill = {n for n in ill if n not in holds and (
        any(x in NOT_MAIN for x in n.names) or size[n] < max(LEAST_LENGTH, NEARLY_ALL * size[root]))}
    for node in order:
        node.items = [x for x in node.items if isinstance(x, str) or x not in ill]


def measure(root: Node):
    """Score the containers; returns (containers by points, text length and linked length of each node)."""
    own: dict[Node, list] = {}
    length: dict[Node, int] = {}
    linked: dict[Node, int] = {}
    order, todo = [], [(root, False)]
    while todo:
        node, link = todo.pop()
        order.append(node)
        link = link or node.tag == "a"
        n = 0
        for x in node.items:
            if isinstance(x, str):
                if size := len(x.strip()):
                    n += size
                    got = own.setdefault(node.block, [0, 0])
                    got[0] += size
                    got[1] += x.count(",")
            else:
                todo.append((x, link))
        length[node] = n
        linked[node] = n if link else 0
    for node in reversed(order):
        if node.parent:
            length[node.parent] += length[node]
            linked[node.parent] += linked[node]
    for node, (size, commas) in own.items():
        points = 1 + commas + min(size / 100, 3) if size >= LEAST_LENGTH else size / 100
        to = node if node.tag in BARRIER and node.tag not in ("td", "th") else node.parent or node
        to.points += points
        if to.parent:
            to.parent.points += points / 2
    for node in order:
        if node.points:
            bonus = 1.25 if node.tag in ("article", "main") or node.words & MAIN_WORDS else 1.0
            node.points *= bonus * (1 - linked[node] / max(1, length[node]))
    return [n for n in order if n.points > 0], length, linked


def main_nodes(root: Node) -> list[Node | str]:
    """The best container with the siblings that are kept, in page order."""
    prune(root)
    scored, length, linked = measure(root)
    if not scored:
        return [root]
    best = max(scored, key=lambda n: n.points)
    # Sections of one article share its paragraphs: what holds them together is the container.
    around, up = None, best
    while up:
        around = up if up.tag == "article" or (up.tag == "main" and not around) else around
        up = up.parent
    best = around or best
    if not best.parent:
        return [best]
    plain = best.tag not in ("article", "main")
    kept: list[Node | str] = []
    run: list[Node | str] = []
    # Blocks with few links that are kept only if a kept one follows.
    between: list[Node | str] = []
    for x in [*best.parent.items, None]:
        node = isinstance(x, Node)
        few_links = node and linked[x] <= 0.25 * length[x]
        good = node and (x is best or x.points >= max(SIBLING_SHARE * best.points, 0.5))
        if isinstance(x, str) or node and not good and (x.tag == "br" or x.tag not in BLOCK):
            run.append(x)
            continue
        # Bare text and the inline elements in it are one paragraph.
        size = sum(len(r.strip()) if isinstance(r, str) else length[r] for r in run)
        if plain and size and sum(linked[r] for r in run if isinstance(r, Node)) <= 0.25 * size:
            kept += between + run
            between = []
        run = []
        if good or few_links and (x.tag == "p" and length[x] >= SIBLING_LENGTH or plain and x.tag in BESIDE):
            kept += [*between, x]
            between = []
        elif plain and few_links and kept and length[x]:
            between.append(x)
    return kept


def text_of(nodes: list[Node | str]) -> str:
    """Blocks in page order, joined by one blank."""
    parts: list[str] = []
    todo: list[Node | str] = nodes[::-1]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            parts.append(x)
        elif x.tag in BLOCK:
            parts.append("\n")
            todo.append("\n")
            todo += x.items[::-1]
        else:
            todo += x.items[::-1]
    return " ".join("".join(parts).split())


def main_text(html: str | None) -> str:
    """The article of a page; empty for a null or empty page, or one without text."""
    return text_of(main_nodes(parse(html))) if html else ""


def extract(pages: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with ``out``, the main text, in the place of the page.

    Defined cases: a null or empty page, and a page without an article, give the
    empty text; broken or unfinished markup is read as far as it goes; a page of
    any length is read whole; of equally good containers the first in the page
    is taken; repeated rows each get the same text; an empty table gives an
    empty one; a column already named ``out`` is replaced.
    """
    rest = [c for c in pages.columns if c not in (html_col, out)]
    schema = T.StructType([*(pages.schema[c] for c in rest), T.StructField(out, T.StringType())])

    def run(batches):
        for batch in batches:
            for b in blocks(batch, len(rest)):
                texts = pa.array([main_text(h) for h in b.column(len(rest)).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([*b.columns[:len(rest)], texts], names=schema.names)

    return pages.select(*[F.col(f"`{c}`") for c in rest], F.col(html_col)).mapInArrow(run, schema)
