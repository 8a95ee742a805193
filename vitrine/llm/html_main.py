"""Main-text extraction by consensus host paths.

Pass 1 scores the containers of every page and lets the page vote for their generalised tag-class paths.  Spark adds
the votes per host.  Pass 2 extracts every page again from the containers on its host's winning path, or from the
page's own best container where the page has none there.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.llm.scratch import Scratch

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop|hidden|aria-hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)

#: Fixed values of HTML: elements without content, whose content is no markup, that stand in lines, and that end an open <p>.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
SIBLING_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
                "th": ("td", "th"), "option": ("option",)}
SCOPES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",), "option": ("select",)}

#: Elements and words of class, id or role that mark what is no main text.
FURNITURE_TAGS = frozenset("nav footer aside form script style noscript template button select input textarea title head iframe "
                           "object svg canvas audio video dialog menu header".split())
FURNITURE_WORDS = frozenset("ad ads adv advert adverts advertisement banner breadcrumb breadcrumbs comment comments cookie cookies "
                            "consent disqus footer header menu modal nav navbar navigation newsletter notice notices pager pagination "
                            "popup promo promoted promotion related replies reply respond share sharing sidebar sidebars signup skip "
                            "social sponsor sponsored subscribe subscription toolbar widget widgets".split())
CONTENT_WORDS = frozenset("article articlebody body content entry main post story text".split())
CONTAINERS = frozenset("article body center div main section td".split())


#: Words of reader comments, words that turn a class into a statement about the page, heads of articles, plugin parts.
READER_WORDS = frozenset("comment comments disqus replies reply respond".split())
QUALIFIERS = frozenset("disabled enabled has have is no non not with without".split())
HEADED = frozenset("article entry post story".split())
PARTS = frozenset("widget widgets".split())
MARKED = ("article", "main")
HEADINGS = ("h1", "h2")
PATH_CHARS = 512


class _Node:
    """An element with links to what is above it; sums of text are filled in by ``_weigh``."""

    __slots__ = ("tag", "words", "parent", "path", "inline", "hard", "dropped", "in_article", "content", "marked", "linked", "container",
                 "score", "links", "mass", "good", "link_mass", "anchors", "paragraphs", "headings")

    def __init__(self, tag: str, words: tuple[str, ...], parent: _Node | None, hidden: bool):
        self.tag, self.words, self.parent = tag, words, parent
        self.inline = tag in INLINE
        self.score = self.links = 0.0
        self.mass = self.good = self.link_mass = self.anchors = self.paragraphs = self.headings = 0
        self.path = "" if parent is None else parent.path
        if not self.inline:
            self.path = (self.path + ">" if self.path else "") + ".".join((tag, *sorted({re.sub(r"\d+", "#", w) for w in words})))
            if len(self.path) > PATH_CHARS:  # a node's path stays short however deep it lies
                self.path = "~" + hashlib.blake2b(self.path.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()
        above = parent is not None
        self.in_article = tag in MARKED or above and parent.in_article
        self.content = tag in MARKED or tag != "body" and any(p in CONTENT_WORDS for p in self._parts())
        self.marked = self.content or above and parent.marked
        self.linked = self.inline and (tag == "a" or above and parent.linked)
        self.hard = self.dropped = (above and parent.hard) or hidden or tag in FURNITURE_TAGS and not (tag == "header" and above and parent.in_article)
        # the container that a text counts for: an article or main part holds all that lies in it
        self.container = parent.container if above else None
        if tag in CONTAINERS and (tag in MARKED or self.container is None or self.container.tag not in MARKED):
            self.container = self

    def _parts(self) -> list[str]:
        return [p for w in self.words for p in re.split(r"[^a-z]+", w)]

    def furniture(self) -> set[str]:
        """Words of class, id and role that speak for furniture; a hint, which the texts around may outweigh."""
        hits: set[str] = set()
        for w in self.words:
            parts = set(re.split(r"[^a-z]+", w))
            if parts & QUALIFIERS:
                continue
            found = parts & FURNITURE_WORDS
            if self.in_article or parts & HEADED:
                found = found - {"header"}
            hits |= found
        if self.tag in ("html", "body", "main"):
            return set()
        return hits & READER_WORDS if self.tag == "article" else hits


def _weigh(root: _Node, nodes: list[_Node], events: list[tuple[_Node | None, str | None]]) -> None:
    """Sum the texts of every element and decide which elements are furniture.

    Elements and hidden parts of HTML that are never main text are cut as they are.  A class word cuts an element unless
    it wraps the page: it holds more than half of the page's text, holds marked content, a heading or several paragraphs, and leaves (almost) no
    marked content outside.  In a main part without article, lists and blocks made of links are menus.
    """
    for node, text in events:
        if text is not None and not node.hard and (size := len(text.strip())):
            node.mass += size
            node.good += size * node.marked
            node.link_mass += size * node.linked
    for node in reversed(nodes):
        up = node.parent
        if not node.hard:
            up.mass += node.mass
            up.good += node.good
            up.link_mass += node.link_mass
            up.anchors += node.anchors + (node.tag == "a")
            up.paragraphs += node.paragraphs + (node.tag == "p" and node.mass > 0)
            up.headings += node.headings + (node.tag in HEADINGS and node.mass > 0)
    for node in nodes:
        if node.dropped or node.parent.dropped:
            node.dropped = True
            continue
        if hits := node.furniture():
            wraps = 2 * node.mass > root.mass and (node.good > 0 or node.headings > 0 or node.paragraphs > 1)
            outside = (root.mass - node.mass if hits & READER_WORDS else root.good - node.good) * 20
            part = hits <= PARTS and node.marked and 3 * node.link_mass < node.mass
            node.dropped = not part and not (wraps and outside <= node.mass and not (hits & READER_WORDS and outside))
        elif node.parent.tag == "main" and node.anchors > 2 and 5 * node.link_mass > 4 * node.mass and not node.paragraphs and not node.headings:
            node.dropped = not node.inline and not node.content


def parse(page: str) -> tuple[list[_Node], list[tuple[_Node | None, str | None]]]:
    """(nodes in page order, events): an event is a text with its node, or a block border (node, None)."""
    root = _Node("#", (), None, False)
    nodes: list[_Node] = []
    events: list[tuple[_Node | None, str | None]] = []
    stack = [root]
    open_tags: Counter[str] = Counter()
    at, end = 0, len(page)

    def close_to(depth: int) -> None:
        while len(stack) > depth:
            node = stack.pop()
            open_tags[node.tag] -= 1
            if not node.inline:
                events.append((node, None))

    while at < end:
        m = _TAG.search(page, at)
        if m is None:
            # a tag that the end of the page cuts off is no text
            cut = page.rfind("<", at)
            rest = page[at:cut] if cut >= 0 and re.match(r"</?[a-zA-Z!?]", page[cut:cut + 3]) else page[at:]
            events.append((stack[-1], rest))
            break
        if m.start() > at:
            events.append((stack[-1], page[at:m.start()]))
        at = m.end()
        closing, name, rest = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            continue
        tag = name.lower()
        if closing:
            if not open_tags[tag]:
                continue
            for depth in range(len(stack) - 1, 0, -1):
                node = stack[depth]
                if node.tag == tag:
                    close_to(depth)
                    break
                if tag in INLINE and not node.inline:
                    break
            continue
        if tag not in INLINE and open_tags["p"]:
            # a block ends an open paragraph; an item ends the one before
            for depth in range(len(stack) - 1, 0, -1):
                node = stack[depth]
                if node.tag == "p":
                    close_to(depth)
                    break
                if not node.inline:
                    break
        if tag in SIBLING_ENDS and any(open_tags[t] for t in SIBLING_ENDS[tag]):
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in SCOPES[tag]:
                    break
                if stack[depth].tag in SIBLING_ENDS[tag]:
                    close_to(depth)
                    break
        words: list[str] = []
        hidden = False
        if rest:
            for a in _ATTRIBUTE.finditer(rest):
                key, value = a[1].lower(), (a[2] or "").strip("\"'").lower()
                if key in ("class", "id", "role", "itemprop"):
                    words += value.split()
                else:
                    hidden = hidden or key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and "display:none" in value.replace(" ", "")
        if tag == "br":
            events.append((stack[-1], " "))
            continue
        node = _Node(tag, tuple(words), stack[-1], hidden)
        if not node.inline:
            events.append((node, None))
        if tag in VOID:
            continue
        nodes.append(node)
        if tag in RAW:
            over = re.compile(f"</{re.escape(tag)}[\\s/>]", re.I).search(page, at)
            at = end if over is None else over.start()
        if not (rest and rest.rstrip().endswith("/") and tag in ("svg", "path")):
            stack.append(node)
            open_tags[tag] += 1
    close_to(1)
    _weigh(root, nodes, events)
    return nodes, events


def _score(nodes: list[_Node], events: list[tuple[_Node | None, str | None]]) -> list[_Node]:
    """Containers by score: texts count for their container, half for the next one above and a quarter for the one after."""
    for node, text in events:
        if text is None or node is None or node.dropped or not (size := len(text.strip())):
            continue
        share, over = 1.0, node.container
        while over is not None and share > 0.2:
            over.score += share * size
            over.links += share * size * node.linked
            share /= 2
            over = over.parent.container if over.parent is not None else None
    found = []
    for node in nodes:
        if node.score > 0 and not node.dropped:
            node.score *= (1 - node.links / node.score) * (1.5 if node.content else 1.0)
            if node.score > 0:
                found.append(node)
    return sorted(found, key=lambda n: -n.score)


def _blocks(roots: set[int], events: list[tuple[_Node | None, str | None]], everything: bool = False) -> str:
    """Texts below the root nodes (or all), one line per block."""
    lines: list[str] = []
    now: list[str] = []
    inside: dict[int, bool] = {}

    def wanted(node: _Node | None) -> bool:
        chain = []
        while node is not None and id(node) not in inside:
            chain.append(node)
            if id(node) in roots:
                break
            node = node.parent
        known = everything if node is None else id(node) in roots or inside.get(id(node), False)
        for n in chain:
            inside[id(n)] = known
        return known

    for node, text in events:
        if text is None:
            if now and (line := " ".join(html.unescape("".join(now)).split())):
                lines.append(line)
            now = []
        elif not node.dropped and wanted(node):
            now.append(text)
    if now and (line := " ".join(html.unescape("".join(now)).split())):
        lines.append(line)
    return "\n".join(lines)


def page_votes(page: str) -> list[tuple[str, str, float]]:
    """(path, path of the element above, share of the page's vote) of the page's containers, the best one first."""
    found = _score(*parse(page))
    paths: dict[tuple[str, str], float] = {}
    for n in found:
        key = (n.path, n.parent.path)
        paths[key] = max(paths.get(key, 0.0), n.score)
    total = sum(paths.values())
    return [(p, above, s / total) for (p, above), s in paths.items()]


def main_text(page: str, path: str | Sequence[str] | None) -> str:
    """Main text of one page, from the containers on the path or paths if any has text, else from its best container."""
    nodes, events = parse(page)
    if path:
        wanted = {path} if isinstance(path, str) else set(path)
        roots = {id(n) for n in nodes if n.path in wanted and not n.inline and not n.dropped}
        if roots and (text := _blocks(roots, events)):
            return text
    found = _score(nodes, events)
    if found:
        return _blocks({id(found[0])}, events)
    return _blocks(set(), events, everything=True)


def host(url: Column) -> Column:
    """Lower-case host of a URL, empty where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#:]+)", 1), F.lit("")))


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(h, *v) for h, page in zip(batch.column(0).to_pylist(), batch.column(1)) for v in page_votes(page.as_py() or "")]
        if rows:
            types = (pa.string(), pa.string(), pa.string(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=["host", "path", "above", "share"])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, urls, pages, paths = batch.columns
        texts = [main_text(page.as_py() or "", path) for page, path in zip(pages, paths.to_pylist())]
        yield pa.RecordBatch.from_arrays([ids, urls, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                         names=["page_id", "url", "text", "n_chars"])


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html", least: float = 0.5, floor: float = 0.05) -> DataFrame:
    """host, paths: the container paths that win a host's pages, the smaller of equal ones first.

    The winner is the path with most of the votes (ties: more pages, then the smaller path).  Paths beside it below the
    same element win too if they have ``least`` of its votes and ``floor`` of all the host's, so an article that is split
    over neighbours stays whole and a host has at most 1 / floor further paths.
    Votes are added per host and path before any shuffle, so a host with a third of all pages costs no more rows.
    """
    rows = pages.select(host(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    # votes in steps of a thousandth, so that the order of adding does not decide
    votes = Scratch(pages.sparkSession, "votes").write(
        rows.mapInArrow(_vote, "host string, path string, above string, share double").groupBy("host", "path", "above")
        .agg(F.round(F.sum("share"), 3).alias("share"), F.count("*").alias("n")), "votes")
    best = F.max_by(F.struct("path", "above", "share"), F.struct("share", "n", F.expr("transform(split(path, ''), c -> -ascii(c))")))
    winner = votes.groupBy("host").agg(best.alias("best"), F.sum("share").alias("total"))
    beside = (F.col("path") == F.col("best.path")) | ((F.col("share") >= least * F.col("best.share")) & (F.col("share") >= floor * F.col("total")))
    return (votes.join(winner, "host").where((F.col("above") == F.col("best.above")) & beside)
            .groupBy("host").agg(F.array_sort(F.collect_set("path")).alias("paths")))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars: the main text of every page row, also of repeated ones.

    The whole html is read; null html counts as empty and has the text ''; a null url is the host ''.  Other columns
    are ignored.  An empty table gives no rows.
    """
    scratch = Scratch(pages.sparkSession, "html")
    # written, so that the planner knows its size and moves the pages only if the winners are too many to send
    winners = scratch.write(host_paths(pages, url_col, html_col).select("host", "paths"), "winners")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"), host(F.col(url_col)).alias("host"))
    joined = rows.join(winners, "host", "left").select("page_id", "url", "html", "paths")
    return joined.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
