"""Product pages of the two marketplaces, derived from the bronze listings (and so from every row of ``part``).

``list_pages`` shows ``PER_PAGE`` listings per page in the site's card markup, ``detail_pages`` one listing per page.
Every ``NO_PRICE_MOD``-th card carries no price, a listing whose detail page failed gets an error page, a value of
several parts ('a; b') becomes several rows of one label, and one label per page is outside the whitelist.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.constants import HB_FIELDS, HB_PAGE, LINK, PRICE, SCRAPED_AT, TY_FIELDS, TY_PAGE
from vitrine.sources.listing_view import SITES

PER_PAGE = 24
NO_PRICE_MOD = 29


def escape(c: Column) -> Column:
    """Text as HTML character data or attribute value."""
    for plain, ref in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        c = F.replace(c, F.lit(plain), F.lit(ref))
    return c


def card_title(c: Column) -> Column:
    """Name on the card: the listing's title, or a plain one where the detail page failed."""
    return F.coalesce(c, F.concat(F.lit("Laptop <P> "), F.col("_seq").cast("string")))


def _text(c: str) -> Column:
    return escape(F.coalesce(F.col(c), F.lit("")))


def _card(site: str) -> Column:
    no_price = F.col("_seq") % NO_PRICE_MOD == 0
    link, name = escape(F.col(LINK)), escape(card_title(F.col("Başlık")))
    if site == "ty":
        price = F.concat(F.lit(f'<div data-testid="{TY_PAGE["price"]}">\n  '), _text(PRICE), F.lit(" </div>"))
        return F.concat(
            F.lit(f'<a class="card {TY_PAGE["card"]}" href="'), link, F.lit(f'"><h3><span class="{TY_PAGE["brand"]}">'),
            _text("Marka"), F.lit(f'</span> <span class="{TY_PAGE["name"]}"><b>'), name, F.lit("</b></span></h3>"),
            F.when(no_price, F.lit("")).otherwise(price), F.lit("</a>\n"))
    price = F.concat(F.lit(f'<div data-test-id="{HB_PAGE["price"]}-0">'),
                     F.regexp_replace(_text(PRICE), " ", "\n"), F.lit("</div>"))
    title = F.when(F.col("Başlık").isNull(), F.lit("")).otherwise(F.concat(F.lit(' title="'), name, F.lit('"')))
    return F.concat(F.lit('<li class="item"><a href="'), link, F.lit('"'), title, F.lit("><img></a>"),
                    F.when(no_price, F.lit("")).otherwise(price), F.lit("</li>\n"))


def loosened(html: Column) -> Column:
    """The same page in looser markup: upper-case tags, single or no quotes, decoy attributes, nested blocks in rows, open list items."""
    rules = ((r'<a class="([^"]*)" href="([^"]*)"', "<A data-title='no' CLASS='$1 x' data-href=\"/no\" HREF='$2'"),
             (r'<a href="([^"]*)" title="([^"]*)"', "<a data-title='decoy' href='$1' title='$2'"),
             (r'<li class="item">', "<LI class=item><div class=box><div>"), (r"</li>", "</div></div>"),
             (r'<div class="([\w-]+)"><(span|div) class="([\w-]+)">', "<div data-x='<div>' class='odd $1 odd'><div class=inner><br><$2 class=$3>"),
             (r'<span class="([\w-]+)">([^<]*)</span></div>', "<div><div class='$1'><p>$2</div></div></div></div>"),
             (r'<span class="([\w-]+)">(<a[^>]*>[^<]*</a>)</span></div>', "<div><span class='$1'><b>$2</b></span></div></div></div>"))
    for pattern, new in rules:
        html = F.regexp_replace(html, pattern, new)
    return html


def list_pages(bronze: DataFrame, site: str) -> DataFrame:
    """page, url, html, fetched_at: ``PER_PAGE`` neighbouring listings per page, in order."""
    domain, _, snap, _ = SITES[site]
    cards = bronze.select((F.floor(F.col("_seq") / PER_PAGE) + 1).cast("long").alias("page"), "_seq", _card(site).alias("card"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_seq", "card"))), lambda x: x["card"]), "")
    menu = '<nav><ul><li><a href="/" title="Home">Home</a></li></ul><a class="product-cards" href="/all">All</a></nav>\n'
    return cards.groupBy("page").agg(body.alias("body")).select(
        "page", F.concat(F.lit(f"https://{domain}/laptop?sayfa="), F.col("page").cast("string")).alias("url"),
        F.concat(F.lit("<html><body>" + menu + "<ul>"), "body", F.lit("</ul></body></html>")).alias("html"),
        F.to_timestamp(F.lit(snap)).alias("fetched_at"))


def _row(site: str, label: str, value: Column) -> Column:
    if site == "ty":
        parts = (f'<div class="{TY_PAGE["row"]}"><span class="{TY_PAGE["label"]}"> {label} </span><span class="{TY_PAGE["value"]}">',
                 "</span></div>")
        return F.concat(F.lit(parts[0]), value, F.lit(parts[1]))
    # the second site shows some values as links, whose title counts
    inner = (F.concat(F.lit('<a href="/f" title="'), value, F.lit('">more</a>')) if label in ("Renk", "İşlemci Tipi") else value)
    return F.concat(F.lit(f'<div class="{HB_PAGE["row"]}"><div class="{HB_PAGE["label"]}">{label}</div>'
                          f'<span class="{HB_PAGE["value"]}">'), inner, F.lit("</span></div>"))


def _rows(site: str, label: str, values: Column) -> Column:
    return F.transform(values, lambda v: _row(site, label, escape(v)))


def detail_pages(bronze: DataFrame, site: str) -> DataFrame:
    """url, html, fetched_at: one page per listing."""
    fields = [f for f in (TY_FIELDS if site == "ty" else HB_FIELDS) if f not in ("Başlık", "Marka")]
    panel = "Panel Tipi" if site == "ty" else "Ekran Panel Tipi"
    rows = [_rows(site, f, F.split(F.col(f), "; ")) for f in fields]
    rows += [F.array(_row(site, "Garanti Tipi", F.lit("24 Ay"))), _rows(site, panel, F.array(F.col(panel)))]
    table = F.array_join(F.concat(*[F.coalesce(r, F.array().cast("array<string>")) for r in rows]), "\n")
    if site == "ty":
        head = F.concat(F.lit(f'<h1 class="{TY_PAGE["title"]}"><a href="/b"><strong>'), _text("Marka"),
                        F.lit("</strong></a> "), _text("Başlık"), F.lit("</h1>"))
    else:
        head = F.concat(F.lit(f'<h1 data-test-id="{HB_PAGE["title"]}">'), _text("Başlık"),
                        F.lit(f'</h1><a data-test-id="{HB_PAGE["brand"]}" title="'), _text("Marka"), F.lit('" href="/b">brand</a>'))
    page = F.concat(F.lit("<html><body>"), head, F.lit('<div class="attributes">'), table, F.lit("</div></body></html>"))
    return bronze.select(F.col(LINK).alias("url"), F.when(F.col("Başlık").isNull(), F.lit("<html><body>503</body></html>"))
                         .otherwise(page).alias("html"), F.to_timestamp(SCRAPED_AT).alias("fetched_at"))
