"""Marketplace pages -> link rows and detail rows.

A site is a ``SiteProfile``; ``extract_links`` and ``extract_details`` are pure functions of a table of raw pages and a
profile.  All of it is row-local expressions over the page: no shuffle, no Python; the only join is ``with_list_price``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.constants import HB_FIELDS, HB_PAGE, LINK, PRICE, SCRAPED_AT, TY_FIELDS, TY_PAGE
from vitrine.operators.html import QUOTES, attribute_pattern, element_text, fold_repeated, scrape_stamp, unescape


def _has_class(name: str) -> str:
    return rf'class="(?:[^"]*\s)?{name}(?:\s[^"]*)?"'


def _element(attribute: str) -> str:
    """Pattern of an element with the attribute: group 1 its tag, group 2 its attributes, group 3 its content."""
    return rf'(?s)<(\w+)\b([^>]*\s{attribute}[^>]*)>(.*?)</\1>'


def _inner(html: Column, pattern: str) -> Column:
    """Text of the first element that matches, NULL if there is none."""
    return F.when(F.regexp_extract(html, pattern, 1) != "", element_text(F.regexp_extract(html, pattern, 3)))


def _attribute(attributes: Column, name: str) -> Column:
    """Decoded and trimmed attribute value, NULL if the attribute is absent or blank."""
    return F.nullif(F.trim(unescape(F.regexp_replace(F.regexp_extract(attributes, attribute_pattern(name), 1), QUOTES, ""))), F.lit(""))


@dataclass(frozen=True)
class SiteProfile:
    """How a site shows its listings.

    ``card`` and ``row`` are patterns of a listing card and of a label/value row; the functions read name and price of a
    card, (title, brand) of a detail page, and label and value of a row.  NULL means the element is missing.
    """
    card: str
    name: Callable[[Column], Column]
    price: Callable[[Column], Column]
    #: Whether a card without a name is skipped (else it stays with a NULL name).
    name_needed: bool
    heading: Callable[[Column], tuple[Column, Column]]
    row: str
    label: Callable[[Column], Column]
    value: Callable[[Column], Column]
    fields: tuple[str, ...]


def _ty_name(card: Column) -> Column:
    brand, name = (_inner(card, _element(_has_class(TY_PAGE[x]))) for x in ("brand", "name"))
    return F.trim(F.concat(brand, F.lit(" "), name))


def _ty_heading(html: Column) -> tuple[Column, Column]:
    h1 = F.regexp_extract(html, _element(_has_class(TY_PAGE["title"])), 3)
    brand = _inner(h1, r"(?s)<(strong)\b([^>]*)>(.*?)</\1>")
    return F.trim(F.replace(element_text(h1), brand, F.lit(""))), brand


def _hb_heading(html: Column) -> tuple[Column, Column]:
    title = _inner(html, _element(f'data-test-id="{HB_PAGE["title"]}"'))
    brand = _attribute(F.regexp_extract(html, _element(f'data-test-id="{HB_PAGE["brand"]}"'), 2), "title")
    # one without the other counts as a page that did not load
    return F.when(brand.isNotNull(), title), F.when(title.isNotNull(), brand)


def _hb_value(row: Column) -> Column:
    pattern = _element(_has_class(HB_PAGE["value"]))
    cell = F.regexp_extract(row, pattern, 3)
    return F.coalesce(_attribute(F.regexp_extract(cell, r"<a\b([^>]*)>", 1), "title"), _inner(row, pattern))


TY = SiteProfile(
    card=rf'(?s)<a\b[^>]*\s{_has_class(TY_PAGE["card"])}[^>]*>.*?</a>',
    name=_ty_name,
    price=lambda card: _inner(card, _element(f'data-testid="{TY_PAGE["price"]}"')),
    name_needed=True,
    heading=_ty_heading,
    row=rf'(?s)<div\b[^>]*\s{_has_class(TY_PAGE["row"])}[^>]*>.*?</div>',
    label=lambda row: _inner(row, _element(_has_class(TY_PAGE["label"]))),
    value=lambda row: _inner(row, _element(_has_class(TY_PAGE["value"]))),
    fields=tuple(TY_FIELDS),
)

HB = SiteProfile(
    card=r"(?s)<li\b[^>]*>.*?</li>",
    name=lambda card: _attribute(F.regexp_extract(card, r"<a\b([^>]*)>", 1), "title"),
    price=lambda card: _inner(card, _element(f'data-test-id="{HB_PAGE["price"]}[^"]*"')),
    name_needed=False,
    heading=_hb_heading,
    # a row ends where its value's element does
    row=rf'(?s)<div\b[^>]*\s{_has_class(HB_PAGE["row"])}[^>]*>.*?{_has_class(HB_PAGE["value"])}[^>]*>.*?</span>',
    label=lambda row: _inner(row, _element(_has_class(HB_PAGE["label"]))),
    value=_hb_value,
    fields=tuple(HB_FIELDS),
)

PROFILES = {"ty": TY, "hb": HB}


def _cards(pages: DataFrame, profile: SiteProfile) -> DataFrame:
    """One row per card of a page, in page order; name, price and link are NULL where they cannot be read."""
    found = pages.select("page", "fetched_at", F.posexplode(F.regexp_extract_all("html", F.lit(profile.card), 0)).alias("pos", "card"))
    card = F.col("card")
    found = found.select("page", "pos", "fetched_at", profile.name(card).alias("Name"), profile.price(card).alias("Price"),
                         _attribute(F.regexp_extract(card, r"<a\b([^>]*)>", 1), "href").alias("Link"))
    whole = F.col("Price").isNotNull() & F.col("Link").isNotNull()
    return found.withColumn("_good", whole & F.col("Name").isNotNull() if profile.name_needed else whole)


def extract_links(pages: DataFrame, profile: SiteProfile) -> DataFrame:
    """Page, pos, Name, Price, Link, Timestamp of every card that has all the site asks for.

    ``pages`` needs page, html and fetched_at; a null html has no cards.
    """
    return _cards(pages, profile).where("_good").select(
        "page", F.col("pos").cast("long").alias("pos"), "Name", "Price", "Link", scrape_stamp(F.col("fetched_at")).alias("Timestamp"))


def link_health(pages: DataFrame, profile: SiteProfile) -> DataFrame:
    """Page, n_links, extract_errors (cards skipped because a part is missing)."""
    good = F.count_if(F.col("_good"))
    return _cards(pages, profile).groupBy("page").agg(good.alias("n_links"), (F.count("*") - good).alias("extract_errors"))


def extract_details(pages: DataFrame, profile: SiteProfile) -> DataFrame:
    """Link, the site's fields and the scrape time, one row per page.

    Heading first, then the rows in page order; labels outside the fields go; repeated labels fold.  A row without
    label or value is skipped, and a page that holds nothing (or is null) still gives its row, of NULLs.
    """
    html = F.col("html")
    title, brand = profile.heading(html)
    pair = "struct<label:string,value:string>"
    rows = F.transform(F.regexp_extract_all(html, F.lit(profile.row), 0),
                       lambda r: F.struct(profile.label(r).alias("label"), profile.value(r).alias("value")))
    head = F.array(*[F.struct(F.lit(f).alias("label"), v.alias("value")) for f, v in (("Başlık", title), ("Marka", brand))])
    pairs = F.concat(head.cast(f"array<{pair}>"), F.coalesce(rows, F.array().cast(f"array<{pair}>")))
    read = pages.select(F.col("url").alias(LINK), "fetched_at", F.filter(pairs, lambda p: p["label"].isNotNull() & p["value"].isNotNull()).alias("_pairs"))

    def field(name: str) -> Column:
        own = F.filter("_pairs", lambda p: p["label"] == name)
        return fold_repeated(F.transform(own, lambda p: p["value"])).alias(name)

    return read.select(LINK, *[field(f) for f in profile.fields], scrape_stamp(F.col("fetched_at")).alias(SCRAPED_AT))


def with_list_price(links: DataFrame, details: DataFrame) -> DataFrame:
    """H9: every link row's details with the list page's price; a link without a page gets NULL fields."""
    priced = links.select("Link", F.col("Price").alias(PRICE))
    return priced.join(details.withColumnRenamed(LINK, "Link"), "Link", "left").withColumnRenamed("Link", LINK)
