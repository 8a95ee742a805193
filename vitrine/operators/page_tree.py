"""D3 / H2-H7 on markup as it comes: nested, loosely quoted, unclosed.

The patterns of ``product_pages`` read flat, double-quoted markup inside the JVM.  Here two Python table functions (UDTFs)
read a page's element tree instead and generate its records: ``CardRows`` the listing cards, ``DetailRows`` the label and
value pairs.  Everything after that (whitelist, folding, pivot, prices) is DataFrame work.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from vitrine.constants import HB_FIELDS, HB_PAGE, LINK, SCRAPED_AT, TY_FIELDS, TY_PAGE
from vitrine.operators.html import attribute_table, scrape_stamp
from vitrine.session import materialise

# fixed values: elements without an end tag, elements whose text is not shown
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
HIDDEN = {"script", "style", "template", "noscript", "head"}
# fixed values: an element that a new one of the named kinds ends, if it is still open
ENDED_BY = {"li": {"li"}, "p": {"p", "div", "ul", "ol", "h1", "h2", "h3", "table"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"},
            "option": {"option"}}

FIELDS = {"ty": TY_FIELDS, "hb": HB_FIELDS}


class Element:
    __slots__ = ("tag", "attributes", "children", "classes")

    def __init__(self, tag: str, attributes: dict[str, str], classes: frozenset[str] | None = None):
        self.tag, self.attributes, self.children = tag, attributes, []
        self.classes = frozenset(attributes.get("class", "").split()) if classes is None else classes

    def below(self) -> Iterator[Element]:
        """All elements inside this one, in page order, however deep."""
        waiting = [c for c in reversed(self.children) if isinstance(c, Element)]
        while waiting:
            e = waiting.pop()
            yield e
            waiting += [c for c in reversed(e.children) if isinstance(c, Element)]

    def text(self) -> str:
        parts: list[str] = []
        waiting: list = [self]
        while waiting:
            e = waiting.pop()
            if isinstance(e, str):
                parts.append(e)
            elif e.tag not in HIDDEN:
                parts.append(" ")
                waiting += reversed([*e.children, " "])
        return " ".join("".join(parts).split())

    def first(self, tag: str | None = None, cls: str | None = None, name: str | None = None, value: str = "", starts: bool = False
              ) -> Element | None:
        return next(self.every(tag, cls, name, value, starts), None)

    def every(self, tag: str | None = None, cls: str | None = None, name: str | None = None, value: str = "", starts: bool = False
              ) -> Iterator[Element]:
        """Elements inside by tag, class, or an attribute that equals (or starts with) a value."""
        for e in self.below():
            own = e.attributes.get(name, "") if name else ""
            if (tag is None or e.tag == tag) and (cls is None or cls in e.classes) and (
                    name is None or (own.startswith(value) and name in e.attributes if starts else name in e.attributes and own == value)):
                yield e


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Element("", {})
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        if self.open[-1].tag in ENDED_BY and tag in ENDED_BY[self.open[-1].tag]:
            self.open.pop()
        attributes: dict[str, str] = {}
        for k, v in attrs:
            attributes.setdefault(k, v or "")
        self.add(Element(tag, attributes))

    def add(self, e: Element):
        self.open[-1].children.append(e)
        if e.tag not in VOID:
            self.open.append(e)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.open.pop()

    def handle_endtag(self, tag):
        # an end tag ends the nearest open element of its kind; one without such an element is skipped
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)


_SPACE = r"[ \t\n\r\f]"
_NAME = r"[a-zA-Z][a-zA-Z0-9:_-]*"
_VALUE = r"""(?:"[^"]*"|'[^']*'|[a-zA-Z0-9:._-]+)"""
#: A run of text, an end tag, or a start tag in one of the usual forms.
_TOKEN = re.compile(rf"([^<]+)|</({_NAME}){_SPACE}*>|<({_NAME})((?:{_SPACE}+{_NAME}(?:={_VALUE})?)*){_SPACE}*>")
_ATTRIBUTE = re.compile(rf"({_NAME})(?:=({_VALUE}))?")
#: A reference that does not end in a semicolon is read by other rules inside attributes.
_LOOSE_REFERENCE = re.compile(r"&(?!(?:#[0-9]+|#[xX][0-9a-fA-F]+|[a-zA-Z][a-zA-Z0-9]*);)")
# fixed values: elements whose content may not be markup
RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "noscript", "xmp", "plaintext", "svg", "math"}


def _read_start(name: str, rest: str) -> tuple[str, dict[str, str], frozenset[str]] | None:
    """Tag, attributes and classes of a start tag; None if only the general parser can tell."""
    tag = name.lower()
    if tag in RAW or _LOOSE_REFERENCE.search(rest):
        return None
    attributes: dict[str, str] = {}
    for k, v in _ATTRIBUTE.findall(rest):
        attributes.setdefault(k.lower(), unescape(v[1:-1] if v[:1] in ("'", '"') else v))
    return tag, attributes, frozenset(attributes.get("class", "").split())


#: A site's pages repeat their tags; the attributes of an element are never changed, so elements may share them.
_known_start = lru_cache(maxsize=4096)(_read_start)
#: Longer tags are not kept.
KEPT_CHARS = 256


def _plain_tree(html: str) -> Element | None:
    """The tree of a page whose tags all have a usual form, as ``_Builder`` gives it; None for any other page."""
    builder = _Builder()
    at, opened, end = 0, builder.open, builder.handle_endtag
    for token in _TOKEN.finditer(html):
        if token.start() != at:
            return None
        at = token.end()
        kind = token.lastindex
        if kind == 1:
            text = token[1]
            opened[-1].children.append(unescape(text) if "&" in text else text)
        elif kind == 2:
            end(token[2].lower())
        else:
            name, rest = token[3], token[4]
            read = (_known_start if len(rest) < KEPT_CHARS else _read_start)(name, rest)
            if read is None:
                return None
            ended = ENDED_BY.get(opened[-1].tag)
            if ended is not None and read[0] in ended:
                opened.pop()
            builder.add(Element(*read))
    return builder.root if at == len(html) else None


def tree(html: str) -> Element:
    """The page's elements; pages in usual markup are split by one pattern, which costs a fraction of the general parser."""
    plain = _plain_tree(html)
    if plain is not None:
        return plain
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root


def _shown(e: Element | None) -> str | None:
    return e.text() if e is not None else None


def _named(e: Element | None, attribute: str) -> str | None:
    value = e.attributes.get(attribute, "").strip() if e is not None else ""
    return value or None


def cards(page: Element, site: str) -> Iterator[tuple[str | None, str | None, str | None, bool]]:
    """(name, price, link, whole) of every card of a list page."""
    if site == "ty":
        for card in page.every("a", TY_PAGE["card"]):
            brand, name = (_shown(card.first(cls=TY_PAGE[x])) for x in ("brand", "name"))
            price, link = _shown(card.first("div", name="data-testid", value=TY_PAGE["price"])), _named(card, "href")
            both = None if brand is None or name is None else f"{brand} {name}".strip()
            yield both, price, link, None not in (both, price, link)
        return
    for card in page.every("li"):
        a = card.first("a")
        price, link = _shown(card.first(name="data-test-id", value=HB_PAGE["price"], starts=True)), _named(a, "href")
        yield _named(a, "title"), price, link, None not in (price, link)


def details(page: Element, site: str) -> Iterator[tuple[str, str]]:
    """(label, value) of a detail page: title and brand first, then its rows in page order."""
    names = TY_PAGE if site == "ty" else HB_PAGE
    if site == "ty":
        h1 = page.first("h1", names["title"])
        brand = h1.first("strong") if h1 is not None else None
        if brand is not None:
            yield "Marka", brand.text()
            yield "Başlık", h1.text().replace(brand.text(), "").strip()
        rows = [r for r in page.every("div", names["row"])]
    else:
        title, brand = page.first(name="data-test-id", value=names["title"]), _named(page.first(name="data-test-id", value=names["brand"]), "title")
        if title is not None and brand is not None:
            yield "Başlık", title.text()
            yield "Marka", brand
        rows = [r for r in page.every(cls=names["row"])]
    for row in rows:
        label, cell = row.first(cls=names["label"]), row.first(cls=names["value"])
        if label is None or cell is None:
            continue
        link = cell.first("a") if site == "hb" else None
        value = _named(link, "title") if link is not None else cell.text()
        yield label.text(), cell.text() if value is None else value


@udtf(returnType="pos int, name string, price string, link string, whole boolean")
class CardRows:
    """Cards of a page; none for a null page."""

    def eval(self, html: str, site: str):
        for i, row in enumerate(cards(tree(html), site) if html else ()):
            yield i, *row


@udtf(returnType="pos int, label string, value string")
class DetailRows:
    """Pairs of a page; a page without any, or a null one, still has one row, of nulls."""

    def eval(self, html: str, site: str):
        found = list(details(tree(html), site)) if html else []
        for i, row in enumerate(found or [(None, None)]):
            yield i, *row


def _lateral(pages: DataFrame, fn, site: str, keep: list[str]) -> DataFrame:
    return pages.lateralJoin(fn(F.col("html").outer(), F.lit(site))).select(*keep, "pos", *[f for f in ("name", "price", "link", "whole", "label", "value")
                                                                                           if f in fn.returnType.fieldNames()])


def extract_links(pages: DataFrame, site: str) -> DataFrame:
    """Page, pos, Name, Price, Link, Timestamp, as ``product_pages.extract_links`` gives them."""
    found = _lateral(pages, CardRows, site, ["page", "fetched_at"]).where("whole")
    return found.select("page", F.col("pos").cast("long").alias("pos"), F.col("name").alias("Name"), F.col("price").alias("Price"),
                        F.col("link").alias("Link"), scrape_stamp(F.col("fetched_at")).alias("Timestamp"))


def extract_details(pages: DataFrame, site: str) -> DataFrame:
    """Link, the site's fields and the scrape time, one row per page.

    The pairs of one page are one group; labels outside the whitelist go, repeated ones fold in page order.  Pages of one
    url are told apart by their scrape time.  The pairs are written, so that every page is read once.
    """
    pairs = materialise(_lateral(pages.withColumnRenamed("url", LINK), DetailRows, site, [LINK, "fetched_at"]), "pairs")
    keyed = pairs.withColumn("_page", F.struct(LINK, "fetched_at"))
    every = keyed.groupBy("_page").agg(F.count(F.lit(1)).alias("_n")).select("_page")
    wide = attribute_table(keyed, "_page", "label", "value", "pos", list(FIELDS[site]))
    rows = every.join(wide, "_page", "left")
    return rows.select(F.col(f"_page.{LINK}").alias(LINK), *[F.col(f"`{f}`") for f in FIELDS[site]], scrape_stamp(F.col("_page.fetched_at")).alias(SCRAPED_AT))
