import html
import re

from tickwise.llm import html_text as M

PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header>Site name</header>
<div class="cookie-notice">We use cookies a lot here for you and me and everyone who reads.</div><div id="wrap">
<div class="sidebar"><p>Side text, long text that goes on and on and on and on and on.</p></div>
<div class="post"><h2>Title &amp; more</h2><p>First para <a href="x">link</a>graph with&nbsp;text long enough to be main.
<p>Second <i>para</i>graph also   long enough,<br>and more &#233; words follow it here.<script>var x = "</p>";</script>
<ul><li>x<li>y</ul></div><section id="comments"><p>Reader comment that is longer than the others are, really.</p></section></div>
<form><p>enter your address</p></form><nav><a href="a">one</a> <a href="b">two</a></nav><footer>(c)</footer></body>"""


def test_article_only():
    assert M.main_text(PAGE) == ("Title & more First para linkgraph with text long enough to be main. "
                                 "Second paragraph also long enough, and more é words follow it here. x y")


def test_broken_and_empty():
    assert M.main_text(None) == M.main_text("") == M.main_text("<nav>a</nav>") == M.main_text("<script>x") == ""
    assert M.main_text("plain  text") == "plain text"
    assert M.main_text("<article><p>a &amp") == "a &"
    assert M.main_text("<div>" * 50_000 + "deep") == "deep"
    assert M.main_text("<article><p>" + "w " * 500_000) == " ".join("w" * 500_000)


def test_densities_prefer_plain_text():
    tree = M._Tree()
    tree.feed("<body><div><a>link one</a><a>link two</a></div><div><p>" + "plain text " * 20 + "</p></div></body>")
    density, total = M.densities(tree)
    at = {t: i for i, t in enumerate(tree.tag)}
    assert density[at["p"]] > density[at["div"] - 3] and total[at["div"]] > 0


def test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r for r in M.extract_text(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        blocks = re.sub(r"</?b>", "", re.sub(r"<(h1|/h1|p|/p|br)>", "\0", inner)).split("\0")
        want = " ".join(x for x in (" ".join(html.unescape(b).split()) for b in blocks) if x)
        assert (got[r.page_id].text, got[r.page_id].n_chars, got[r.page_id].url) == (want, len(want), r.url)


def test_edges(spark):
    rows = [(1, None, None), (None, "u", "<p>x</p>"), (2, "u", ""), (2, "u", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'q' AS text", "1 AS n_chars")
    got = sorted(map(tuple, M.extract_text(df).collect()), key=str)
    assert got == sorted([(1, None, "", 0), (None, "u", "x", 1), (2, "u", "", 0), (2, "u", "", 0)], key=str)
    assert M.extract_text(df.limit(0)).count() == 0


def words(n, k=0):
    return " ".join(f"word{k}x{i}" for i in range(n))


def test_sections_lists_and_headings_of_div_pages():
    links = '<div id="links"><ul>' + '<li><a href="x">some link</a></li>' * 15 + "</ul></div>"
    side = "<div><p>short line</p></div>"

    def section(tag, inner, n, size, k):
        texts = [words(size, 100 * k + j) for j in range(n)]
        return f"<{tag}>" + "".join(f"<{inner}>{t}</{inner}>" for t in texts) + f"</{tag}>", " ".join(texts)

    for noise in ("", links, links + side):
        for second in (("div", "p", 10, 25, 2), ("div", "p", 8, 22, 2), ("ul", "li", 40, 12, 2), ("div", "p", 5, 40, 2)):
            for first in (("div", "p", 10, 25, 1), ("div", "p", 5, 40, 1)):
                (a, ta), (b, tb) = section(*first), section(*second)
                page = f"<body>{noise}<h1>The title</h1>{a}<h2>Part two</h2>{b}<h3>Links</h3>{links}</body>"
                assert M.main_text(page) == f"The title {ta} Part two {tb}", (noise, first, second)


def test_direct_text_beside_the_main_block():
    bare = words(60, 7)
    page = f"<body>Menu<br>{bare} <b>bold</b> end<div>" + f"<p>{words(25)}</p>" * 10 + "</div></body>"
    assert f"{bare} bold end" in M.main_text(page)
    assert M.main_text("<body><h3>News</h3><form>mail</form><div>" + f"<p>{words(25)}</p>" * 4 + "</div></body>") \
        == " ".join([words(25)] * 4)


def test_wrappers_named_like_other_parts():
    text = " ".join(words(25, j) for j in range(8))
    inner = "".join(f"<p>{words(25, j)}</p>" for j in range(8))
    rest = ('<div class="sidebar"><p>Side text that goes on and on.</p></div><div class="cookie_notice">We use cookies.</div>'
            '<section id="comments"><article><p>Reader comment, a longer one.</p></article></section>')
    for name in ('class="content no-sidebar"', 'class="has-sidebar"', 'class="has-header-image"', 'id="widget-page"',
                 'class="post comments-open"', 'class="widget"', 'id="search"', 'class="content sidebar"'):
        for body in (inner, f"<article>{inner}</article>", f"<main><div>{inner}</div></main>"):
            assert M.main_text(f"<body><div {name}>{body}</div>{rest}</body>") == text, (name, body[:9])
            assert M.main_text(f"<body><div {name}>{rest}{body}</div></body>") == text, (name, body[:9])
    short = "<article><p>A short article of few words.</p></article>"
    assert M.main_text(f'<body><div class="header">{short}</div>{rest}</body>') == "A short article of few words."
    longer = "".join(f"<li><p>{words(30, 50 + j)}</p></li>" for j in range(20))
    for name in ("comment-list", "comments", "replies"):
        assert M.main_text(f'<body><div>{inner}</div><ol class="{name}">{longer}</ol></body>') == text


def test_parts_named_by_their_last_word():
    inner = "".join(f"<p>{words(25, j)}</p>" for j in range(8))
    text = " ".join(words(25, j) for j in range(8))
    for name in ("reader-comments", "user-comments", "post-comments", "fb-comments", "discussion", "cc-window", "ad-slot",
                 "adbox", "top-nav", "main-menu", "skip-link", "author-box", "commentList", "siteFooter", "cookie_consent-banner"):
        part = f'<div class="{name}">{words(70, 99)}</div>'
        for page in (f"<body><article>{inner}</article>{part}</body>", f"<body>{part}<div>{inner}</div></body>",
                     f'<body><main>{inner}</main><div class="x {name}" id=y>{words(60, 98)}</div></body>'):
            assert M.main_text(page) == text, name
    # a part of a paper, and names that tell of the article itself
    assert words(40, 9) in M.main_text(f"<article>{inner}<section id=discussion><p>{words(40, 9)}</p></section></article>")
    for name in ("entry-header", "with-sidebar-content", "no-comments", "layout-has-menu", "author"):
        assert words(40, 9) in M.main_text(f'<article><div class="{name}"><p>{words(40, 9)}</p></div>{inner}</article>'), name


def test_headers_of_articles_stay():
    inner = "".join(f"<p>{words(25, j)}</p>" for j in range(4))
    text = " ".join(words(25, j) for j in range(4))
    for outer in ("article", "main"):
        page = (f"<body><header><h1>Site</h1><p>of many pages</p></header><{outer}><header><h1>TITLE</h1><p>The lead.</p></header>"
                f'{inner}<header><a href="x">one topic</a> <a href="y">other topics</a> in</header></{outer}></body>')
        assert M.main_text(page) == f"TITLE The lead. {text}"
    assert M.main_text(f"<body><header><h1>Site</h1></header><div>{inner}</div></body>") == text


def test_markup_as_browsers_read_it():
    for page, want in (
            ("a < b <3 c<1", "a < b <3 c<1"), ("<p>one<!-- x > <p>no --><p>two", "one two"), ("<!DOCTYPE html><p>x<?php y ?>z", "xz"),
            ("<P CLASS='a>b' title=\"</p>\">x</P>y", "x y"), ("<p>x<br/>y<hr />z", "x y z"), ("<div/>x", "x"), ("<p a=/>x", "x"),
            ("<p>x</p><p class=\"unended>y", "x"), ("<p>x</p><p clas", "x"), ("<p>x<!-- y", "x"), ("<p>x<script>y</scripts>z", "x"),
            ("<p>x<title>t<p>y", "x"), ("<title>t<b></title><p>x", "x"), ("<textarea><p>no</textarea>x</>y</ 1>z", "xyz"),
            ("<p>&lt;b&gt; &amp;amp; &#233;</p>", "<b> &amp; é"), ("<a =x ==y / >x", "x"), ("x</p >y</div z=1>w", "xyw"),
            ("<li>a<li>b<td>c", "a b c"), ("<p class=menu id=x/y>no</p><p>xyz", "xyz")):
        assert M.main_text(page) == want, page


def test_odd_pages_of_a_megabyte():
    import time
    many = ["<a ", "<!--", "<", '<a href="', "<div>", "<b><hr>", "&amp", "</b>", "<script>", "<title>", "<!x", "<a x=y ", "<a/", "<li>"]
    pages = [m * (1_000_000 // len(m)) for m in many]
    pages += ["<p><td>" + "<b>" * 100_000 + "<hr>" * 100_000, "<div>" * 100_000 + "</b>" * 100_000,
              '<div class="' + "advert_" * 140_000 + 'zz">x</div>']
    for page in pages:
        start = time.process_time()
        M.main_text(page)
        assert time.process_time() - start < 15, page[:20]     # quadratic ones take minutes


def plain_densities(html):
    """The composite density of every element, in page order, by recursion over a well-formed page."""
    import math
    import xml.etree.ElementTree as ET
    body = ET.fromstring(html)

    def measure(e, linked):
        linked = linked or e.tag == "a"
        texts = [t for t in (e.text, *(c.tail for c in e)) if t and t.strip()]
        c = sum(len(" ".join(t.split())) for t in texts)
        out = [c, 0, c if linked else 0, 0]
        for child in e:
            for k, v in enumerate(measure(child, linked)):
                out[k] += v
            out[1] += 1
            out[3] += child.tag == "a"
        return out

    whole = measure(body, False)
    share = whole[2] / max(1, whole[0])

    def density(e, linked):
        c, t, lc, lt = measure(e, linked)
        if not c:
            return 0.0
        base = math.log(max(1, lc) / max(1, c - lc) * c + share * c + math.e)
        t, lc, lt = max(1, t), max(1, lc), max(1, lt)
        return c / t * math.log(max(1, c / lc * t / lt) + 1e-6) / math.log(base + 1e-6)

    out = []

    def walk(e, linked):
        linked = linked or e.tag == "a"
        out.append((e.tag, density(e, linked), sum(density(x, linked or x.tag == "a") for x in e)))
        for child in e:
            walk(child, linked)

    walk(body, False)
    return out


def test_densities_equal_a_plain_version():
    import random
    rnd = random.Random(3)

    def page(depth):
        inner = "".join(f"<{t}>{words(rnd.randint(0, 9))}{page(depth - 1) if depth else ''}</{t}>{words(rnd.randint(0, 3))}"
                        for t in rnd.choices(["div", "section", "a", "b", "i", "div"], k=rnd.randint(0, 4)))
        return words(rnd.randint(0, 5)) + inner

    for _ in range(60):
        html = f"<body>{page(3)}</body>"
        tree = M._Tree()
        tree.feed(html)
        density, total = M.densities(tree)
        want = plain_densities(html)
        assert tree.tag[1:] == [t for t, _, _ in want]
        for i, (_, d, s) in enumerate(want, 1):
            assert abs(density[i] - d) < 1e-6 * max(1, d) and abs(total[i] - s) < 1e-6 * max(1, s), html
        if any(s for _, _, s in want):
            top = max(range(1, len(want) + 1), key=lambda i: total[i])
            assert abs(total[top] - max(s for _, _, s in want)) < 1e-6 * max(1, total[top])
