"""Element trees of loose markup, and the table functions over them."""

import datetime

from vitrine.operators import page_tree as T
from vitrine.operators import product_pages as P


def test_tree_of_loose_markup():
    t = T.tree("<UL><LI class=a>one<li class='b c'>two <b>three</b></ul><p>x<div id=d data-title='no' title=yes>y &amp; z<br>w</div></nope>"
               "<script>var a = '<li>';</script>")
    items = list(t.every("li"))
    assert [i.text() for i in items] == ["one", "two three"] and items[1].classes == {"b", "c"}
    d = t.first(name="id", value="d")
    assert d.attributes["title"] == "yes" and d.text() == "y & z w"
    assert t.first("p").text() == "x" and "var" not in t.text()
    deep = T.tree("<div>" * 30_000 + "x")
    assert deep.text() == "x" and sum(1 for _ in deep.below()) == 30_000


HTML = """<h1 class='product-title big'><a href=/b><strong>Acme</strong></a> Acme Book 15</h1>
<div class="x attribute-item"><div><div><span class=name>Renk</span></div></div><div class='value'><p>Mavi</div></div>
<div class='attribute-item'><span class="name">Renk</span><span class="value">Gri</span></div>
<div class='attribute-item'><span class="name">Renk</span></div>
<div class='attribute-item'><span class="name">Garanti</span><span class="value">2</span></div>"""


def test_details_and_failed_pages(spark):
    at = datetime.datetime(2025, 12, 17, 13, 3, 44)
    pages = spark.createDataFrame([("u1", HTML, at), ("u2", None, at), ("u3", "<html>503", at), ("u4", "", at)], "url string, html string, fetched_at timestamp")
    rows = {r["Link"]: r.asDict() for r in T.extract_details(pages, "ty").collect()}
    assert rows["u1"]["Renk"] == "Mavi; Gri" and rows["u1"]["Marka"] == "Acme" and rows["u1"]["Başlık"] == "Book 15"
    assert rows["u1"]["Çekilme Zamanı"] == "2025-12-17 13:03:44" and "Garanti" not in rows["u1"]
    for u in ("u2", "u3", "u4"):
        assert all(v is None for k, v in rows[u].items() if k not in ("Link", "Çekilme Zamanı"))


def test_attribute_of_exactly_that_name(spark):
    html = """<li><a data-href="/no" href='/yes' data-title="no" title='Book "1"'>x</a><div data-test-id="final-price-0">1 TL</div></li>"""
    pages = spark.createDataFrame([(1, html, datetime.datetime(2025, 1, 1)), (2, None, None)], "page long, html string, fetched_at timestamp")
    for rows in (T.extract_links(pages, "hb"), P.extract_links(pages, P.PROFILES["hb"])):
        got = rows.collect()
        assert [(r.Name, r.Price, r.Link) for r in got] == [('Book "1"', "1 TL", "/yes")]


def _general(html):
    builder = T._Builder()
    builder.feed(html)
    builder.close()
    return builder.root


def _shape(e):
    out = []
    for c in e.children:
        if isinstance(c, str) and out and isinstance(out[-1], str):
            out[-1] += c
        else:
            out.append(c if isinstance(c, str) else _shape(c))
    return e.tag, e.attributes, e.classes, out


def test_pages_in_usual_markup_have_the_general_parsers_tree():
    rows = "".join(f"<div class='row r{i}' data-x='<b>'><span class=name>A &amp; &lt;{i}</span><br><p title=\"&quot;{i}&#39;\">x<p>y</div>" for i in range(30))
    page = f"<html><BODY><ul><LI class=a>1<li>2</ul>{rows}</nope>tail &nbsp"
    assert T._plain_tree(page) is not None and _shape(T._plain_tree(page)) == _shape(_general(page))
    for odd in ("<script>a<b</script>", "<!-- x -->", "a < b", "<p x = 1>", "<br/>", "<a href='q?a&lt=1'>", "<p", "</"):
        assert T._plain_tree(odd) is None and _shape(T.tree(odd)) == _shape(_general(odd))


def test_every_page_is_read_once_and_repeated_pages_are_one_row(spark):
    at = datetime.datetime(2025, 12, 17, 13, 3, 44)
    pages = spark.createDataFrame([("u1", HTML, at), ("u1", HTML, at), (None, HTML, None), ("u1", HTML, at.replace(day=18))],
                                  "url string, html string, fetched_at timestamp")
    got = T.extract_details(pages, "ty")
    assert got._jdf.queryExecution().optimizedPlan().toString().count("DetailRows") == 0  # already read, into a written table
    rows = {(r["Link"], r["Çekilme Zamanı"]): r for r in got.collect()}
    assert set(rows) == {("u1", "2025-12-17 13:03:44"), (None, None), ("u1", "2025-12-18 13:03:44")}
    # labels at the same place of equal pages follow each other
    assert rows["u1", "2025-12-17 13:03:44"]["Renk"] == "Mavi; Gri; Gri" and rows[None, None]["Renk"] == "Mavi; Gri"
