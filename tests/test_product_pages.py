"""Product pages: tolerant cards and rows, folds, link titles, pages without content."""

from vitrine.constants import HB_PAGE
from vitrine.operators import product_pages as P

DDL = "page LONG, url STRING, html STRING"


def _pages(spark, *html):
    from pyspark.sql import functions as F

    rows = [(i, f"u{i}", h) for i, h in enumerate(html)]
    return spark.createDataFrame(rows, DDL).withColumn("fetched_at", F.timestamp_seconds(F.lit(0)))


def test_first_site_cards(spark):
    card = ('<a href="/x?a=1&amp;b=2" class="product-card wide"><i class="product-brand"> A </i><b class="product-name">B&#39;s\n'
            '<em>15</em></b>%s</a>')
    price = '<div data-testid="single-price">1.000\nTL</div>'
    other = '<a class="product-card-x" href="/n"><b class="product-name">n</b></a>'
    pages = _pages(spark, card % price + other + card % "", None, "")
    rows = P.extract_links(pages, P.TY).collect()
    assert [(r["page"], r["pos"], r["Name"], r["Price"], r["Link"]) for r in rows] == [(0, 0, "A B's 15", "1.000 TL", "/x?a=1&b=2")]
    assert rows[0]["Timestamp"] == "1970-01-01 00:00:00"
    assert [tuple(r) for r in P.link_health(pages, P.TY).collect()] == [(0, 1, 1)]


def test_second_site_items(spark):
    price = '<p data-test-id="final-price-7">24.999\nTL </p>'
    pages = _pages(spark, f'<ul><li><a href="/a" title="T &amp; U">x</a>{price}</li><li><a href="/b">x</a>{price}</li>'
                          f'<li><a href="/c" title="c">x</a></li><li>{price}</li></ul>')
    rows = P.extract_links(pages, P.HB).orderBy("pos").collect()
    assert [(r["Name"], r["Price"], r["Link"]) for r in rows] == [("T & U", "24.999 TL", "/a"), (None, "24.999 TL", "/b")]


def test_first_site_details(spark):
    def row(label, value):
        return f'<div class="attribute-item"><span class="name">{label}</span><span class="value"> {value} </span></div>'

    heading = '<h1 class="product-title"><a><strong>Acer</strong></a> Acer Aspire  5</h1>'
    rows = "".join(row("Renk", v) for v in ("Gri", "Gri", "Mavi", "Gri")) + row("Garanti", "2") + '<div class="attribute-item">x</div>'
    found = {r["Link"]: r for r in P.extract_details(_pages(spark, heading + rows, '<h1 class="product-title">no brand</h1>', None), P.TY).collect()}
    assert (found["u0"]["Başlık"], found["u0"]["Marka"], found["u0"]["Renk"]) == ("Aspire 5", "Acer", "Gri; Mavi; Gri")
    assert "Garanti" not in found["u0"].asDict() and found["u0"]["Panel Tipi"] is None
    assert all(found[u][f] is None for u in ("u1", "u2") for f in ("Başlık", "Marka", "Renk"))



def test_second_site_details(spark):
    def row(label, value):
        return f'<div class="{HB_PAGE["row"]}"><div class="{HB_PAGE["label"]}">{label}</div><span class="{HB_PAGE["value"]}">{value}</span></div>'

    heading = '<h1 data-test-id="title"> T </h1><a data-test-id="brand" title=" HP ">hp</a>'
    rows = row("Renk", '<a title="Gri" href="/g">more</a>') + row("İşlemci", "<a>i5</a>") + row("Ram Tipi", "DDR5")
    pages = _pages(spark, heading + rows, '<h1 data-test-id="title">T</h1>')
    found = {r["Link"]: r for r in P.extract_details(pages, P.HB).collect()}
    assert [found["u0"][f] for f in ("Başlık", "Marka", "Renk", "İşlemci", "Ram Tipi")] == ["T", "HP", "Gri", "i5", "DDR5"]
    assert found["u1"]["Başlık"] is None and found["u1"]["Marka"] is None


def test_list_price_joins_every_link(spark):
    links = spark.createDataFrame([("u0", "1 TL"), ("u9", "2 TL")], "Link STRING, Price STRING")
    details = P.extract_details(_pages(spark, ""), P.TY)
    rows = sorted((r["Link"], r["Fiyat (TRY)"]) for r in P.with_list_price(links, details).collect())
    assert rows == [("u0", "1 TL"), ("u9", "2 TL")]
