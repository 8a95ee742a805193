import random
import tracemalloc

import pytest

from vitrine.llm import html_main as H

SCHEMA = "page_id long, url string, html string, text string"
PAGE = ('<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/">Menu</a></li>'
        '</ul></nav><!-- no --><div class="ad">Buy</div><article><h1>Head &amp; line</h1><p><b>One<br> two<p>Three &lt;b&gt;\n  four</p>'
        '<form><input>Send</form></article><div class="comments"><p>A reader says a lot of things here, far more than the article itself.</p></div>'
        '<footer>&copy; f</footer></body></html>')


def test_main_text():
    want = "Head & line\nOne two\nThree <b> four"
    assert H.main_text(PAGE, None) == want
    assert H.main_text(PAGE, "html>body>article") == want
    assert H.main_text(PAGE, "html>body>div.gone") == want
    assert H.main_text(PAGE[:PAGE.index("<form")], None) == want


def test_odd_pages():
    assert H.main_text("", None) == ""
    assert H.main_text("plain &amp; text", None) == "plain & text"
    assert H.main_text("<p>a<p", None) == "a"
    assert H.main_text("<div><ul><li>a<li>b</ul>tail</div>", None) == "a\nb\ntail"
    assert H.main_text("<nav>only menu</nav>", None) == ""
    assert H.main_text("<div class='x' hidden>no</div><div>yes</div>", None) == "yes"
    assert H.main_text('<p title="a>b">x &nbsp; y</p>', None) == "x y"
    assert len(H.main_text("<p>" + "long text " * 200_000, None)) == 1_999_999


def test_host_vote_decides(spark, frame):
    def page(n, main, other):
        return f"<html><body><div class='m{n}'><p>{main}</p></div><div class='o'><p>{other}</p></div></body></html>"

    rows = [(i, "http://h.example/x", page(i, "main words here and more of them", "short"), "c") for i in range(5)]
    rows += [(9, "http://H.example/y", page(9, "few", "a longer aside that would win on this page alone"), None)]
    rows += [(10, None, None, None), (11, "", "", "c"), (0, "http://h.example/x", rows[0][2], "c")]
    got = H.extract(frame(rows, SCHEMA))
    assert got.columns == ["page_id", "url", "text", "n_chars"] and got.count() == 9
    texts = {r.page_id: (r.text, r.n_chars) for r in got.collect()}
    assert texts[9] == ("few", 3) and texts[0][0] == "main words here and more of them"
    assert texts[10] == ("", 0) and texts[11] == ("", 0)
    assert H.extract(frame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("page, want", [
    ('<div id="page" class="site no-sidebar"><h1>T</h1><p>One two.</p><p>Three.</p></div>', "T\nOne two.\nThree."),
    ('<body class="x"><div class="has-comments with-sidebar social-enabled"><p>One two.</p></div></body>', "One two."),
    ('<article><div class="article-header"><h1>Title</h1></div><p>Text here.</p></article>', "Title\nText here."),
    ('<main><div class="intro">The intro.</div><div class="story">The longer story is told here.</div></main>', "The intro.\nThe longer story is told here."),
    ('<div class="sidebar-layout"><article><p>Long enough text.</p></article><div class="sidebar"><p>Aside</p></div></div>', "Long enough text."),
    ('<article><p>Short.</p></article><div class="comments"><article><p>A reader says a lot more than that.</p></article></div>', "Short."),
    ('<main><ul><li><a>One</a><li><a>Two</a><li><a>Three</a></ul><p>Main text.</p></main>', "Main text."),
    ('<article><div class="widget text-widget"><p>A part of the text.</p></div><div class="widget"><a>Share it</a></div></article>', "A part of the text."),
    ('<div class="cookie-notice">We use cookies on all of these pages.</div><p>Text.</p>', "Text."),
    ('<div class="ad">Buy this</div>', ""),
])
def test_class_words_are_hints(page, want):
    assert H.main_text(page, None) == want


def test_neighbours_that_both_win(spark, frame):
    def page(i):
        return f"<body><div class=top{i}><div class=lead>Lead number {i} with some words</div><div class=rest>Rest {i} with some more words</div><p>x</p></div></body>"

    rows = [(i, "http://n.example/a", page(i), "c") for i in range(4)]
    got = {r.page_id: r.text for r in H.extract(frame(rows, SCHEMA)).collect()}
    assert got == {i: f"Lead number {i} with some words\nRest {i} with some more words" for i in range(4)}
    assert [len(r.paths) for r in H.host_paths(frame(rows, SCHEMA)).collect()] == [2]


def test_deep_pages_stay_small():
    page = '<div class="abc def">' * 50_000 + "words" + "</div>" * 50_000
    tracemalloc.start()
    assert H.main_text(page, None) == "words"
    assert tracemalloc.get_traced_memory()[1] < 300 << 20
    tracemalloc.stop()
    assert H.main_text("<b>" * 50_000 + "words" + "<p>x" * 1_000, None).startswith("words")


def _tree(rng):
    """(html, main text): a page put together from an article and furniture, whose text is known beforehand."""
    word = lambda n: " ".join(rng.choice("alpha beta gamma delta caf&eacute; x&lt;y &#8364;5 zeta".split()) for _ in range(n))
    plain = lambda t: t.replace("&eacute;", "\u00e9").replace("&lt;", "<").replace("&#8364;", "\u20ac")
    quote = lambda v: rng.choice([f'"{v}"', f"'{v}'"])
    lines = []

    def block(depth):
        kind = rng.randrange(6 if depth < 3 else 3)
        if kind == 0:
            t = word(rng.randint(3, 30))
            lines.append(plain(t))
            return f"<p class={quote('para')}>{t.replace(' ', rng.choice([' ', '  ', chr(10)]), 1)}" + rng.choice(["</p>", ""])
        if kind == 1:
            t = [word(2) for _ in range(rng.randint(1, 4))]
            lines.extend(map(plain, t))
            return "<ul>" + "".join(f"<li>{x}" + rng.choice(["</li>", ""]) for x in t) + "</ul>"
        if kind == 2:
            t = word(4)
            lines.append(plain(t + " end"))
            return f"<h2><em>{t}</em> end</h2>"
        if kind == 3:
            return rng.choice(['<div class="ad box">Buy now</div>', "<form>Send <input name=q></form>", "<script>if (a < b) x('</p>')</script>",
                               "<aside>Aside</aside>", '<div class="newsletter-signup">Join us</div>', "<!-- note -->"])
        return f"<div class={quote(rng.choice(['row', 'entry-part no-sidebar', 'section 12']))}>" + "".join(block(depth + 1) for _ in range(rng.randint(1, 4))) + "</div>"

    title = word(3)
    lines.append(plain(title))
    head = rng.choice([f"<h1>{title}</h1>", f"<header><h1>{title}</h1></header>", f"<div class='entry-header'><h1>{title}</h1></div>"])
    first = word(40)
    lines.append(plain(first))
    body = head + f"<p>{first}</p>" + "".join(block(0) for _ in range(rng.randint(1, 8)))
    tag = rng.choice(["article", "main"])
    before = "<nav><ul><li><a href=/>Home</a></ul></nav>" + rng.choice(["", "<div id=cookie-notice>Cookies!</div>", "<div class=banner>Sale</div>"])
    after = rng.choice(["", f"<div class='comments'><p>{word(60)}</p></div>", "<div class=sidebar>Side</div>"]) + "<footer>&copy;</footer>"
    wrap = rng.choice(["{}", "<div id='page' class='site has-sidebar'>{}</div>", "<div class=wrapper><div class='layout-sidebar'>{}</div></div>"])
    return f"<html><head><title>t</title></head><body>{wrap.format(f'{before}<{tag}>{body}</{tag}>{after}')}</body></html>", "\n".join(lines)


def test_generated_pages(spark, frame):
    rng = random.Random(4)
    trees = [_tree(rng) for _ in range(300)]
    rows = [(i, f"http://h{i % 5}.example/{i}", page, None) for i, (page, _) in enumerate(trees)]
    got = {r.page_id: r.text for r in H.extract(frame(rows, SCHEMA)).collect()}
    assert [i for i, (_, want) in enumerate(trees) if got[i] != want] == []
