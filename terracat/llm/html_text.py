"""Main text of web pages by tree scoring.

Each paragraph gives points (one, one for each comma, one for each 100 characters up to three) to its parent and half
of them to its grandparent; a container's points are discounted by its link density. An article element (main, where a
page has none) has the points of all paragraphs within, or one for each 100 characters if that is more, and passes none
on. The best of all containers is kept with those siblings that score or read like it. What is never text (scripts, styles, menus, headers and footers of the
page, sidebars, forms, notices, adverts, reader comments) is taken out of the tree before scoring; articles, paragraphs
and inline elements go by their class or id too. The title of an article belongs to its text where it stands within the
article, in a header of it or not; a heading before the marked element is the page's and stays out.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
DROPPED = {"script", "style", "noscript", "template", "nav", "footer", "aside", "form", "button", "select", "textarea", "iframe", "object", "svg", "canvas", "head", "title", "dialog", "menu", "input", "label", "option"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
#: A start tag of the key closes an open element of the value, if nothing of SCOPES lies between.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"ul", "ol", "dl", "table", "select", "div", "article", "section", "body", "main"}
ENDS_P = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"}
#: Class and id words of what surrounds an article.
NOISE = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notices?|popup|modal|overlay|newsletter|subscri\w*|sidebar|side|breadcrumbs?|menu|nav\w*|pagination|pager|footer|header|masthead|comments?|disqus|replies|respond|share|sharing|social|related|recommend\w*|widget|login|signup|search|toolbar|skip)(?:$|[\s_-])", re.I)
NOISY_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "menu", "menubar", "dialog", "alert", "alertdialog"}
PARAGRAPHS = {"p", "pre", "blockquote", "td", "li", "h1", "h2", "h3", "h4", "h5", "h6", "dd", "dt", "figcaption"}
SPACE = re.compile(r"\s+")
#: Parts of a class or id by which articles, paragraphs and inline elements are noise too: readers' comments, adverts,
#: notices and what stands beside an article. Names that only tell what else a page has (has-sidebar, no-comments,
#: comments-open, category-ads) don't count, nor does anything within pre and code, where names style source text.
MARKED_NOISE = re.compile(r"ads?|advert\w*|adsense|sponsor\w*|promo\w*|cookies?|consent|gdpr|notices?|popup|newsletter|subscri\w*|sidebar|comments?|disqus|replies|related|teaser", re.I)
MERELY_TOLD = {"has", "no", "with", "without", "category", "tag", "type", "format", "hide", "show"}
STATES = {"open", "closed", "count", "off", "on", "free", "link"}
#: Header of an article, in divs of one: its title and byline belong to the text.
OWN_HEADER = re.compile(r"(?:^|\s)(?:entry|post|article|story|content|page)[_-]header(?=\s|$)", re.I)


def marked_noise(names: str) -> bool:
    """Whether one of the names (class and id) of an article, paragraph or inline element tells noise."""
    for name in names.split():
        parts = re.split("[-_]+", name.lower())
        if parts[0] not in MERELY_TOLD and parts[-1] not in STATES and any(MARKED_NOISE.fullmatch(p) for p in parts):
            return True
    return False


class Node:
    __slots__ = ("tag", "parent", "children", "noise", "score", "holder", "total", "linked")

    def __init__(self, tag: str, parent: Node | None, noise: bool = False):
        self.tag, self.parent, self.children, self.noise, self.score = tag, parent, [], noise, 0.0
        self.holder, self.total, self.linked = self, 0, 0


class Tree(HTMLParser):
    """A forgiving tree of any depth: unclosed elements end with their parent, stray end tags are ignored."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("html", None)
        self.path = [self.root]
        self.open: dict[str, list[int]] = defaultdict(list)  # where open elements of a tag stand in the path
        self.blocks = [0]  # where those stand that are not inline
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body"):
            return
        if tag in ENDS_P:
            self.end("p", SCOPES | {"li", "td", "th", "blockquote"})
        if tag in CLOSES:
            for t in CLOSES[tag]:
                self.end(t, SCOPES - {tag})
        if tag in VOID:
            self.at.children.append(Node(tag, self.at))
            return
        given = {k: v or "" for k, v in attrs}
        noise = tag in DROPPED or "hidden" in given or given.get("aria-hidden") == "true" or given.get("role", "").lower() in NOISY_ROLES or bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", given.get("style", ""), re.I))
        names = f"{given.get('class', '')} {given.get('id', '')}"
        if noise or tag == "main" or not names.strip():
            pass
        elif tag in ("article", "p") or tag in INLINE:
            noise = not self.inside("pre") and not self.inside("code") and marked_noise(names)
        else:
            noise = bool(NOISE.search(OWN_HEADER.sub(" ", names) if self.inside("article") or self.inside("main") else names))
        if tag == "header" and not self.inside("article"):
            noise = True
        node = Node(tag, self.at, noise)
        self.at.children.append(node)
        self.open[tag].append(len(self.path))
        if tag not in INLINE:
            self.blocks.append(len(self.path))
        self.path.append(node)
        self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def inside(self, tag: str) -> bool:
        return bool(self.open[tag])

    def end(self, tag: str, stop: set[str]) -> None:
        if self.open[tag]:
            last = self.open[tag][-1]
            if all(not self.open[t] or self.open[t][-1] <= last for t in stop):
                self.rise(last)

    def rise(self, to: int) -> None:
        """Close the element that stands there in the path and all within it."""
        while len(self.path) > to:
            tag = self.path.pop().tag
            self.open[tag].pop()
            if tag not in INLINE:
                self.blocks.pop()
        self.at = self.path[-1]

    def handle_endtag(self, tag):
        if tag in VOID or tag in ("html", "body") or not self.open[tag]:
            return
        last = self.open[tag][-1]
        if tag in INLINE and self.blocks[-1] > last:
            return  # an inline end tag does not close blocks
        self.rise(last)

    def handle_data(self, data):
        self.at.children.append(data)


def blocks_of(node: Node) -> list[str]:
    """Texts of the blocks below a node, in page order, without noise."""
    out: list[list[str]] = [[]]
    todo: list = [node]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out[-1].append(x)
        elif x is None:
            out.append([])
        elif not x.noise:
            if x.tag == "br":
                out[-1].append(" ")
            block = x.tag not in INLINE and x.tag != "br"
            todo += ([None] if block else []) + x.children[::-1] + ([None] if block else [])
    return [t for b in out if (t := SPACE.sub(" ", "".join(b)).strip())]


def measure(nodes: list[Node]) -> None:
    """Characters of text and of linked text below each node; nodes stand after their parents."""
    for x in reversed(nodes):
        x.total += sum(len(c.strip()) for c in x.children if isinstance(c, str))
        if x.tag == "a":
            x.linked = x.total
        if x.parent:
            x.parent.total += x.total
            x.parent.linked += x.linked


def main_text(html: str | None) -> str:
    """The article of a page, blocks joined by one space; a page of no paragraphs gives all its text that isn't noise."""
    if not html or not html.strip():
        return ""
    root = Tree(html).root
    nodes, todo = [], [root]
    while todo:
        x = todo.pop()
        nodes.append(x)
        todo += [c for c in x.children if isinstance(c, Node) and not c.noise]
    measure(nodes)
    marked = [x for x in nodes if x.tag == "article"] or [x for x in nodes if x.tag == "main"]
    special = {id(x) for x in marked}
    within: dict[int, float] = defaultdict(float)  # points of the paragraphs below a node
    for x in nodes:
        if x.parent and (x.tag in PARAGRAPHS or x.tag in INLINE or x.tag in ("ul", "ol", "table", "tr", "tbody", "dl")):
            x.holder = x.parent.holder
        if x.tag in PARAGRAPHS and x.parent:
            text = " ".join(c for c in x.children if isinstance(c, str)).strip()
            points = 1 + text.count(",") + min(3, len(text) // 100) if text else 0
            up = x.parent.holder
            within[id(up)] += points
            up.score += points
            if up.parent and id(up) not in special:
                up.parent.score += points / 2
    for x in reversed(nodes):
        if id(x) in special:
            x.score = max(within[id(x)], x.total / 100)
        if x.parent:
            within[id(x.parent)] += within[id(x)]
    for x in nodes:
        if x.score:
            x.score *= 1 - x.linked / x.total if x.total else 0.0
    best = max(marked + nodes, key=lambda x: x.score)
    if not marked and best.score <= 0:
        return " ".join(blocks_of(root))
    if not best.parent:
        return " ".join(blocks_of(best))
    kept: list[str] = []
    bare = id(best) not in special
    for sibling in best.parent.children:
        if isinstance(sibling, str) or sibling.noise:
            continue
        dense = sibling.linked / sibling.total if sibling.total else 0.0
        reads = sibling.tag in PARAGRAPHS and bare and sibling.total > 80 and dense < 0.25
        if sibling is best or (sibling.tag == best.tag and sibling.score >= 0.2 * best.score and dense < 0.5) or reads or (bare and sibling.tag == "h1"):
            kept += blocks_of(sibling)
    return " ".join(kept)


def extract_pages(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text (empty if none), n_chars long.

    Null, empty or broken html gives an empty or best-effort text, never a failure. Null ids and urls, and repeated
    rows, keep their rows. Extra columns are ignored.
    """
    fields = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([main_text(h) for h in b.column(2).to_pylist()], pa.string())], schema=fields)

    source = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return source.mapInArrow(run, "page_id long, url string, text string").select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
