"""Main text of web pages by consensus host paths.

Each page's containers are scored by the prose that stands directly in them and in their paragraphs.
From the best one the choice climbs to the article around it, or to a container that holds it with prose of
its own, so titles, leads and further sections stay.  The path of a page's container, tags with classes from the root, generalised so that
numbers in classes and ids don't matter, is a vote of its host.  Votes are summed in Spark; where the winning
path of its host is on a page, the text is taken from there, whatever the page itself prefers, so a
page with a long sidebar or little text is read as its host's others are; from there it climbs on that page as well.  Elsewhere, and
where the page's own container lies around the host's and directly holds more than that covers, the page's own counts.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.session import Scratch

# Fixed values of the markup language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea select svg math object canvas audio video title".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Tags whose text is never part of the article, and words in classes, ids and roles that say the same.
OUTSIDE_TAGS = frozenset("nav aside footer form button head dialog menu label".split())
OUTSIDE_WORDS = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead banner footer foot sidebar side aside widget notice alert cookie cookies consent gdpr popup modal overlay newsletter subscribe signup login "
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion comment comments discussion discussions opinions disqus reply replies respond share sharing social related recommended search pagination pager toolbar tags "
    "complementary contentinfo dialog".split()
)
#: Words for the article itself, for what wraps a page's columns, and for columns beside the article.
CONTENT_WORDS = frozenset("content article main post entry hentry story".split())
WRAP_WORDS = frozenset("wrap wrapper container layout page row body".split())
SIDE_WORDS = frozenset("sidebar side aside".split())
#: Words before what a wrapper has or lacks, and before what an article is filed under.
HAS_WORDS = frozenset("with has no without".split())
FILED_WORDS = frozenset("category tag type status format topic".split())
#: Words that an article's own element never has as a name's first.
NEVER_CONTENT = ("comment", "repl", "respond", "ad", "promo", "sponsor", "cookie", "notice")
#: Names of parts of an article that hold a word of the above.
PART_NAMES = re.compile(r"(?:^|\s)related[\s-](?:works?|research|literature|studies)(?:\s|$)")
#: Tags that a new one of the same group closes, and where looking for it ends.
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_LIMITS = frozenset("ul ol dl table body html article section main div".split())
_CONTAINERS = frozenset("article main section div td body html blockquote center".split())
#: Containers that are parts of what they stand in.
_PARTS = frozenset("section blockquote center".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>\x00]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|([^\s=/>\"']+)")
_NUMBERS = re.compile(r"\d+")
_WHITE = re.compile(r"\s+")


@dataclass(eq=False)
class Node:
    tag: str
    path: str
    parent: Node | None
    outside: bool
    #: Text pieces and child nodes in order.
    parts: list = field(default_factory=list)
    score: float = 0.0


def _attributes(raw: str) -> dict[str, str]:
    return {(m[1] or m[5]).lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(raw)}


def _step(tag: str, attributes: dict[str, str]) -> str:
    """A tag with its classes, without what varies from page to page."""
    classes = sorted({_NUMBERS.sub("#", c.lower()) for c in attributes.get("class", "").split()})
    return ".".join([tag, *classes])


def _name_outside(name: str, tag: str, wraps: bool) -> bool:
    """Does one name, a class or id, say that the element is no part of the article?"""
    parts = re.findall("[a-z]+", name)
    if not parts or parts[0] in FILED_WORDS and len(parts) > 1:
        return False
    # "content with-sidebar" has a sidebar and is none.
    parts = parts[: next((i for i, p in enumerate(parts) if p in HAS_WORDS), len(parts))]
    found = [p for p in parts if p in OUTSIDE_WORDS and not (p == "discussion" and tag == "section")]
    if not found:
        return False
    first = parts.index(found[0])
    if set(found) == {"header"} and any(p in CONTENT_WORDS or p == "page" for p in parts[:first]):
        # "entry-header" holds a title.
        return False
    if set(found) <= SIDE_WORDS:
        # "content-sidebar-wrap" holds both; "container sidebar-left" says where the sidebar is.
        both = any(p in CONTENT_WORDS for p in parts[:first]) and parts[-1] in WRAP_WORDS
        return not (both or "layout" in parts or wraps and len(parts) > 1)
    return True


@lru_cache(1 << 16)
def _names_outside(tag: str, named: str) -> bool:
    """Do an element's names say that it is no part of the article?

    Each name is judged by itself: "menu-container" is a menu, whatever it contains.
    """
    if not named.strip() or tag in ("html", "body", "article", "main"):
        return False
    names = PART_NAMES.sub(" ", named).split()
    wraps = any(n in WRAP_WORDS or n in CONTENT_WORDS for n in names)
    outside = [n for n in names if _name_outside(n, tag, wraps)]
    if any(n in CONTENT_WORDS for n in names):
        outside = [n for n in outside if n.startswith(NEVER_CONTENT)]
    return bool(outside)


def parse(page: str) -> Node:
    """The page's elements; unclosed paragraphs and list items end where the next begin."""
    root = Node("", "", None, False)
    node, at, end = root, 0, len(page)
    while at < end:
        token = _TOKEN.search(page, at)
        if not token:
            node.parts.append(page[at:])
            break
        if token.start() > at:
            node.parts.append(page[at : token.start()])
        at = token.end()
        if not token[2]:
            continue
        tag = token[2].lower()
        if token[1]:
            above = node
            while above is not root and above.tag != tag:
                above = above.parent
            if above is not root:
                node = above.parent
            elif tag == "p":
                node.parts.append(Node("p", "", node, False))
            continue
        if tag in BLOCKS:
            # A block ends an open paragraph, and with it what is open inside.
            above = node
            while above is not root and above.tag not in BLOCKS:
                above = above.parent
            if above.tag == "p":
                node = above.parent
        if tag in _CLOSES:
            above = node
            while above is not root and above.tag not in _LIMITS and above.tag not in _CLOSES[tag]:
                above = above.parent
            if above.tag in _CLOSES[tag]:
                node = above.parent
        raw = token[3]
        attributes = _attributes(raw) if raw and "=" in raw or "hidden" in raw else {}
        named = " ".join(attributes.get(a, "") for a in ("class", "id", "role")).lower().replace("_", "-")
        hidden = "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in attributes.get("style", "").replace(" ", "").lower()
        outside = node.outside or tag in OUTSIDE_TAGS or hidden or _names_outside(tag, named)
        if tag == "header" and not outside:
            # A header within the article holds its title.
            above = node
            while above is not None and above.tag not in ("article", "main"):
                above = above.parent
            outside = above is None
        child = Node(tag, f"{node.path}/{_step(tag, attributes)}" if tag in _CONTAINERS else node.path, node, outside)
        node.parts.append(child)
        if tag in VOID or raw.endswith("/") and tag in RAW:
            continue
        if tag in RAW:
            child.outside = True
            close = re.compile(f"</{re.escape(tag)}\\s*>", re.I).search(page, at)
            at = close.end() if close else end
            continue
        node = child
    return root


def _prose(text: str) -> float:
    """How much a run of text looks like prose."""
    words = text.count(" ") + 1 if text.strip() else 0
    return words + 2 * (text.count(".") + text.count(",")) if words > 3 else 0.2 * words


@dataclass(eq=False)
class Containers:
    """What the containers of a page hold, by path."""

    scores: dict[str, float]
    #: Prose directly in them, without links, and all below them, with links.
    own: dict[str, float]
    every: dict[str, float]
    tags: dict[str, str]
    parents: dict[str, str | None]
    #: Paths of the containers that stand in them.
    children: dict[str, list[str]]

    def above(self, path: str) -> Iterator[str]:
        """Paths of the containers around one, from the inside."""
        around = self.parents.get(path)
        while around is not None:
            yield around
            around = self.parents[around]

    def _climb_once(self, path: str) -> str | None:
        around = list(self.above(path))
        if self.tags[path] not in ("article", "main"):
            article = next((p for p in around if self.tags[p] == "article"), None)
            article = article or next((p for p in around if self.tags[p] == "main" and self.own.get(p)), None)
            if article is not None:
                return article
        elif self.tags[path] == "main":
            return None
        # What a container adds must be its own prose and its other parts rather than what stands in others.
        gain, strange, below = 0.0, 0.0, path
        for p in around:
            whole = self.tags[p] in ("body", "html")
            gain += self.own.get(p, 0.0)
            for other in self.children[p]:
                if other != below:
                    if self.tags[other] in _PARTS and not whole:
                        gain += self.every[other]
                    else:
                        strange += self.every[other]
            # An article is only left for the main element around it.
            if gain > 0 and strange <= gain and (self.tags[path] != "article" or self.tags[p] == "main"):
                return p
            below = p
        return None

    def climb(self, path: str) -> str:
        """The path of the container to take for one: the article around it, or what holds it with prose of its own."""
        while path in self.tags and (higher := self._climb_once(path)) is not None:
            path = higher
        return path


def measure(root: Node) -> Containers:
    """Scores and contents of every container path on the page.

    Prose counts for the container it stands in and, less, for that one's container; links don't count.
    """
    scores: dict[str, float] = {}
    own: dict[str, float] = {}
    every: dict[str, float] = {}
    tags: dict[str, str] = {}
    parents: dict[str, str | None] = {}
    stack: list[tuple[Node, Node | None, bool]] = [(root, None, False)]
    while stack:
        node, container, linked = stack.pop()
        if node.outside:
            continue
        inside = node if node.tag in _CONTAINERS else container
        if inside is node and node.path not in tags:
            tags[node.path] = node.tag
            parents[node.path] = container.path if container is not None else None
            every[node.path] = 0.0
        for part in node.parts:
            if isinstance(part, Node):
                stack.append((part, inside, linked or node.tag == "a"))
            elif inside is not None and (value := _prose(part)):
                every[inside.path] += value
                if not linked and node.tag != "a":
                    own[inside.path] = own.get(inside.path, 0.0) + value
                    scores[inside.path] = scores.get(inside.path, 0.0) + value
                    above = inside.parent
                    while above is not None and above.tag not in _CONTAINERS:
                        above = above.parent
                    if above is not None and above.path != inside.path:
                        scores[above.path] = scores.get(above.path, 0.0) + value / 2
    # Paths around others come before them.
    children: dict[str, list[str]] = {p: [] for p in tags}
    for p in reversed(tags):
        if parents[p] is not None:
            every[parents[p]] += every[p]
            children[parents[p]].append(p)
    # An article's own element wins over equally good ones.
    scores = {p: s * (1.25 if p.rpartition("/")[2].split(".")[0] in ("article", "main") else 1.0) for p, s in scores.items()}
    return Containers(scores, own, every, tags, parents, children)


def best_path(found: Containers) -> tuple[str | None, float]:
    """The path that the page is read from, and the score of its best container."""
    scores = found.scores
    if not scores:
        return None, 0.0
    path = min(scores, key=lambda p: (-scores[p], len(p), p))
    return found.climb(path), scores[path]


def _blocks(node: Node, out: list[list[str]]) -> None:
    """Text pieces by block, in page order."""
    stack: list = [node]
    while stack:
        item = stack.pop()
        if item is None:
            out.append([])
        elif isinstance(item, str):
            out[-1].append(item)
        elif item.tag in ("br", "wbr", "img"):
            out[-1].append(" " if item.tag == "br" else "")
        elif not item.outside:
            edge = item.tag in BLOCKS
            if edge:
                out.append([])
                stack.append(None)
            stack.extend(reversed(item.parts))


def text_at(root: Node, path: str | None) -> str | None:
    """The text of all elements of the path, or None if there is none on the page."""
    found, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.outside:
            continue
        if node.path == path and node.tag in _CONTAINERS:
            found.append(node)
            continue
        stack.extend(reversed([p for p in node.parts if isinstance(p, Node)]))
    if not found:
        return None
    blocks: list[list[str]] = [[]]
    for node in found:
        _blocks(node, blocks)
        blocks.append([])
    lines = (_WHITE.sub(" ", entities.unescape("".join(b))).strip() for b in blocks)
    return "\n".join(line for line in lines if line)


def extract(page: str, path: str | None) -> str:
    """The main text of a page, by its host's path if the page has it."""
    root = parse(page)
    found = measure(root)
    own = best_path(found)[0]
    if path in found.tags:
        path = found.climb(path)
        if own in found.above(path) and found.own.get(own, 0.0) > found.every[path]:
            path = own
    text = text_at(root, path) if path is not None else None
    if text is None:
        text = text_at(root, own) if own is not None else None
    if text is None:
        # No container at all: everything that isn't outside.
        root.tag = "body"
        text = text_at(root, "")
    return text or ""


def host(url: str) -> Column:
    """The host of an address, lower-cased; null addresses and others without one share an empty host."""
    return F.lower(F.coalesce(F.regexp_extract(F.col(url).cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def host_paths(df: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``host`` and its winning ``path``: the one with the most votes, then the largest score, then the first by name."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            votes = [best_path(measure(parse(page or ""))) for page in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("host"), pa.array([p for p, _ in votes], pa.string()), pa.array([s for _, s in votes], pa.float64())], ["host", "path", "score"]
            )

    pages = df.select(host(f"`{url}`").alias("host"), F.col(f"`{html}`").cast("string").alias("html"))
    votes = pages.mapInArrow(run, "host string, path string, score double").where("path IS NOT NULL")
    # Whole numbers add up alike in any order.
    counted = votes.groupBy("host", "path").agg(F.count("*").alias("votes"), F.sum(F.round("score").cast("long")).alias("score"))
    order = F.struct(-F.col("votes"), -F.col("score"), "path")
    return counted.groupBy("host").agg(F.min_by("path", order).alias("path"))


def main_text(scratch: Scratch, df: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``df`` without its markup, with ``text`` and ``n_chars`` (code points) for every row.

    Null and empty pages have an empty text, as have pages without an article; they vote for nothing.  Repeated rows vote each.  Pages
    without a host vote together.  ``text`` and ``n_chars`` replace columns of these names, other columns pass through.
    """
    # Stored, the table of winners shows its size: it is broadcast if small, else joined by host.
    winners = scratch.keep(host_paths(df, url, html), "paths")
    held = [f for f in df.schema if f.name not in (html, "text", "n_chars")]
    schema = T.StructType([*held, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    kept = [f.name for f in held]
    # A struct needs a field; columns are told by place, so their names don't matter.
    fields = [F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(kept)] or [F.lit(0).alias("c0")]
    rows = df.select(F.struct(*fields).alias("row"), host(f"`{url}`").alias("host"), F.col(f"`{html}`").cast("string").alias("html"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = [extract(page or "", path) for page, path in zip(part.column("html").to_pylist(), part.column("path").to_pylist(), strict=True)]
            row = part.column("row")
            yield pa.RecordBatch.from_arrays([*(row.field(i) for i in range(len(kept))), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=schema.names)

    return rows.join(winners, "host", "left").select("row", "html", "path").mapInArrow(run, schema)
